import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lexspark.llm import mixing
from lexspark.llm.queries import op12_mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """Shares by weight, round after round: what is above a bound is shared among the sources below theirs."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, out = sum(sizes.values()), dict.fromkeys(order, 0.0)
    open_, left = set(order), float(total)
    while left > 1e-9 * max(total, 1) and open_:
        share = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in list(open_):
            out[s] += share * weight[s]
            if out[s] >= most * sizes[s]:
                left += out[s] - most * sizes[s]
                out[s] = float(most * sizes[s])
                open_.discard(s)
    return out


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string, source string")


def made(spark):
    docs = [(i, " ".join(["w"] * (i * 7 % 50)), f"s{i % 4}") for i in range(300)]
    docs += [(1000 + i, "x y z " * 300, "hot") for i in range(200)]
    docs += [(5, "one two three", "few"), (5, "one two three", "few"), (None, "a b", None), (None, None, None), (6, "", "none"), (7, " \x0b\x0c", "none"), (8, "long " * 20_000, "s1")]
    return docs


def test_words_targets_and_taken_words(spark):
    docs = made(spark)
    got = mixing.Mix(frame(spark, docs), shards=5, block=64).taken().collect()
    assert len(got) == len(docs)
    count = lambda t: len(WORD.findall(t or ""))
    sizes = Counter()
    for _, t, s in docs:
        sizes[s] += count(t)
    want = plain_targets(sizes)
    by_size = defaultdict(list)
    for i, t, s in docs:
        by_size[i, count(t), sizes[s], round(want[s], 6)].append(1)
    seen, sums = defaultdict(list), Counter()
    for r in got:
        seen[r.doc_id, r.size, r.source_size, round(r.target, 6)].append(1)
        sums[r.source_size, round(r.target, 6)] += r.taken
        assert 0 <= r.taken <= 3 * r["size"]
    assert seen == by_size
    groups = Counter((sizes[s], round(want[s], 6)) for s in sizes)
    assert all(abs(sums[k] - n * k[1]) <= 0.5 * n + 1e-3 for k, n in groups.items())
    assert sum(sums.values()) == pytest.approx(sum(sizes.values()), abs=len(sizes))


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 1000, "c": 1, "d": 1, None: 50}, {"a": 0, "b": 0}, {"b": 5, "B": 7, "é": 1, "z": 900}, {"a": 100}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_pieces_are_the_taken_words_once_for_each_pass(spark):
    docs = made(spark)
    mix = mixing.Mix(frame(spark, docs), shards=5, block=64)
    pieces = mix.pieces().collect()
    sums, taken = Counter(), Counter()
    for p in pieces:
        sums[p.doc_id, p.source] += p.n_words
    for r, s in ((r, s) for r in mix.taken().collect() for s in [next(s for i, t, s in docs if i == r.doc_id and len(WORD.findall(t or "")) == r["size"])]):
        taken[r.doc_id, s] += r.taken
    assert +sums == +taken
    # blocks of a shard have places without gaps, and a pass takes a word at most once
    for shard in range(5):
        places = {p.place for p in pieces if p.shard == shard}
        assert places == set(range(len(places)))
    once = Counter((p.doc_id, p.source, p["pass"], p.from_word) for p in pieces if p.doc_id not in (5, None))
    assert max(once.values()) == 1
    # every shard has as many blocks, and a source's blocks are what its quota says
    blocks = Counter(r.shard for r in mix.drawn.collect())
    assert max(blocks.values()) - min(blocks.values()) <= 1
    quotas = Counter()
    for r in mix.quotas.collect():
        quotas[r.src] += r.blocks
    assert quotas == Counter(r.src for r in mix.drawn.collect())


def test_the_same_seed_gives_the_same_mix(spark):
    docs = frame(spark, made(spark))
    run = lambda d, seed: sorted(map(tuple, mixing.Mix(d, shards=3, block=64, seed=seed).taken().collect()), key=repr)
    first = run(docs, 1)
    assert first == run(docs.repartition(7), 1)
    assert first != run(docs, 2)


def test_hypergeometric_draws_follow_the_distribution(spark):
    for good, bad, draws in ((5, 3, 4), (40, 60, 30), (1000, 9000, 500), (3, 0, 2), (0, 4, 2), (7, 9, 0), (7, 9, 16)):
        n = 20_000
        u = (F.col("id") + 0.5) / n
        got = Counter(r.x for r in spark.range(n).select(mixing.hypergeometric(F.lit(good), F.lit(bad), F.lit(draws), u).alias("x")).collect())
        p = {x: math.comb(good, x) * math.comb(bad, draws - x) / math.comb(good + bad, draws) for x in range(max(0, draws - bad), min(good, draws) + 1)}
        assert set(got) <= set(p)
        assert all(abs(got[x] / n - q) < 2 / n for x, q in p.items())


def test_large_draws_keep_their_mean_and_spread(spark):
    good, bad, draws, n = 3_000_000, 7_000_000, 5_000_000, 400
    got = [r.x for r in spark.range(n).select(mixing.hypergeometric(F.lit(good), F.lit(bad), F.lit(draws), (F.col("id") + 0.5) / n).alias("x")).collect()]
    total = good + bad
    sd = math.sqrt(draws * good / total * bad / total * (total - draws) / (total - 1))
    mean = sum(got) / n
    assert abs(mean - draws * good / total) < 0.01 * sd
    assert abs(math.sqrt(sum((x - mean) ** 2 for x in got) / n) - sd) < 0.02 * sd


def test_tree_splits_quotas_exactly_and_evenly(spark):
    quota = [1000, 0, 7, 333, 1]
    rows = spark.createDataFrame(list(enumerate(quota)), "src int, quota long")
    for shards in (1, 2, 7, 16):
        got = mixing.splitting_tree(rows, shards, seed=3).collect()
        by_source, by_shard = Counter(), Counter()
        for r in got:
            by_source[r.src] += r.blocks
            by_shard[r.shard] += r.blocks
        assert [by_source[i] for i in range(5)] == quota
        assert max(by_shard.values()) - min(by_shard[i] for i in range(shards)) <= 1


def test_tree_of_many_seeds_is_unbiased(spark):
    rows = spark.createDataFrame([(0, 30), (1, 70)], "src int, quota long")
    firsts = [next((r.blocks for r in mixing.splitting_tree(rows, 4, seed=s).collect() if r.shard == 2 and r.src == 0), 0) for s in range(15)]
    assert abs(sum(firsts) / 15 - 7.5) < 1.5


def test_empty_tables_and_clashing_names(spark):
    assert mixing.Mix(frame(spark, [])).taken().collect() == []
    docs = frame(spark, [(1, "a b", "x"), (2, None, None)]).withColumns({"row": F.lit(1), "src": F.lit("q"), "block": F.lit(2), "size": F.lit(9), "key": F.lit(0)})
    assert sorted(tuple(r) for r in mixing.Mix(docs).taken().collect()) == [(1, 2, 2, 2.0, 2), (2, 0, 0, 0.0, 0)]


def test_no_python_in_the_plan(spark):
    plan = op12_mixing(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|InMap", plan)
