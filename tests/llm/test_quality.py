import math
import random
from collections import Counter

import numpy as np
import pytest

from lexspark.llm import quality
from lexspark.llm._scratch import Scratch


def grams(text, n):
    t = "\x02" * (n - 1) + (text or "") + "\x03"
    return [t[i : i + n] for i in range(len(t) - n + 1)]


def model(texts, order):
    """Interpolated modified Kneser-Ney, straight from its definition."""
    counts = {order: Counter(g for t in texts for g in grams(t, order))}
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    discounts = {}
    for n, c in counts.items():
        k = Counter(min(v, 5) for v in c.values())
        y = k[1] / (k[1] + 2 * k[2]) if k[1] else 0
        plain = {1: 0.5, 2: 1.0, 3: 1.5}
        discounts[n] = {i: max(0.01, min(i, i - (i + 1) * y * k[i + 1] / k[i] if k[i] else plain[i])) if k[1] else plain[i] for i in (1, 2, 3)}

    def p(g):
        if not g:
            return 1 / (len(counts[1]) + 1)
        n = len(g)
        c, d = counts[n], discounts[n]
        after = [v for h, v in c.items() if h[:-1] == g[:-1]]
        if not after:
            return p(g[1:])
        own = max(0, c[g] - d[min(c[g], 3)]) if c[g] else 0
        return (own + sum(d[min(v, 3)] for v in after) * p(g[1:])) / sum(after)

    return p


def corpus():
    rng = random.Random(1)
    return ["".join(rng.choice("abc de") for _ in range(rng.randrange(1, 60))) for _ in range(60)]


@pytest.mark.parametrize("order", [2, 4])
def test_equals_definition(spark, order):
    texts = corpus()
    docs = [(i, t, "x") for i, t in enumerate(texts)] + [(100, None, "x"), (101, "zzz\x00é\U0001f600", "x"), (102, "ab", "unseen"), (None, "abc", "x"), (103, "", None)]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, lang string, threshold int").repartition(3)
    trusted = spark.createDataFrame([(i,) for i in range(40)] + [(None,), (999,), (3,)], "doc_id long")
    for block in (1 << 20, 300):
        got = {r.doc_id: r for r in quality.perplexities(frame, trusted, order, block).collect()}
        assert len(got) == len(docs)
        assert {i for i, r in got.items() if r.trusted} == set(range(40))
        p = model([texts[i] for i in range(40) if not got[i].held], order)
        for i, t, lang in docs:
            r = got[i]
            if lang != "x":
                assert r.log_perplexity is None
                continue
            t = (t or "").replace("\x00", "￿")
            want = -sum(math.log(p(g)) for g in grams(t, order)) / (len(t) + 1)
            assert abs(r.log_perplexity - want) < 1e-9, i


def test_probabilities_sum_to_one(spark):
    texts = corpus()[:20]
    letters = "abc de\x03"
    rows = [("x", g, 1) for t in texts for g in grams(t, 3)] + [("x", c + l, 0) for c in ("ab", " d", "ea") for l in letters]
    logs = {r.gram: r.log for r in quality.gram_logs(spark.createDataFrame(rows, "lang string, gram string, c long"), 3, Scratch(spark, "test")).collect()}
    seen = {g[-1] for _, g, c in rows if c}
    for c in ("ab", " d", "ea"):
        known = sum(math.exp(logs[c + l]) for l in seen)
        assert known < 1 and known > 0.9


def test_long_pieces_and_alphabets():
    rng = random.Random(3)
    text = "".join(chr(rng.choice([97, 98, 0x4E00 + rng.randrange(20000), 0x20000 + rng.randrange(40000)])) for _ in range(90_000))
    segments = list(quality._segments(text, 4, 10_000))
    found, counts = quality.distinct_grams(segments, 4)
    assert dict(zip(found.tolist(), counts.tolist())) == Counter(grams(text, 4))
    logs = np.arange(len(found), dtype=float)
    total = quality.Scorer(found.tolist(), logs, 4).totals(segments).sum()
    where = {g: i for i, g in enumerate(found.tolist())}
    assert total == sum(where[g] for g in grams(text, 4))


def test_thresholds(spark):
    rows = [("x", True, True, i / 100) for i in range(100)] + [("x", False, True, 9.0), ("x", True, False, 9.0), ("y", True, True, 1.0), ("z", True, True, None)]
    scores = spark.createDataFrame(rows, "lang string, trusted boolean, held boolean, log_perplexity double")
    assert {r.lang: r.threshold for r in quality.thresholds(scores, 0.9).collect()} == {"x": 0.89, "y": 1.0}


def test_small_language_is_not_set_by_its_worst(spark):
    rows = [("x", True, True, i / 1000) for i in range(1000)] + [("y", True, True, 1.0)] * 9 + [("y", True, True, 9.0)]
    scores = spark.createDataFrame(rows, "lang string, trusted boolean, held boolean, log_perplexity double")
    got = {r.lang: r.threshold for r in quality.thresholds(scores, 0.99).collect()}
    assert got["x"] == 0.989 and 1.0 <= got["y"] < 2.0


def test_repetition(spark):
    assert [quality.repeated_pairs(t) for t in (None, "", "a", "a b", "a a a", "a b a b a")] == [0, 0, 0, 0, 0.5, 0.5]
    rng = random.Random(4)
    prose = lambda n: " ".join("".join(rng.choices("abcde", k=rng.randrange(2, 6))) for _ in range(n))
    docs = [(i, prose(80), "x") for i in range(400)] + [(1000, "abcd " * 200, "x"), (1001, "ab cde " * 200, "x"), (1002, prose(80), "x"), (1003, "ab " * 200, "unseen")]
    out = quality.classify(spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.range(400).toDF("doc_id"))
    got = {r.doc_id: r.repetitive for r in out.where("doc_id >= 1000").collect()}
    assert got == {1000: True, 1001: True, 1002: False, 1003: True}


def test_repetition_does_not_decide(spark):
    """What is accepted follows from the perplexity and its language's threshold alone."""
    docs = [(i, f"some words of text number {i} and more", "x") for i in range(60)] + [(100, "some words " * 300, "x"), (101, "zq#" * 50, "x")]
    out = quality.classify(spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.range(60).toDF("doc_id")).collect()
    assert all(r.accepted == (r.perplexity <= r.threshold) for r in out)
    assert {r.doc_id: r.repetitive for r in out if r.doc_id >= 100} == {100: True, 101: False}


def test_blocks_share_a_bounded_number_of_tasks(spark, monkeypatch):
    rng = random.Random(6)
    docs = [(i, " ".join("".join(rng.choices("abcde", k=4)) for _ in range(40)), "xy"[i % 2]) for i in range(300)]
    frame, trusted = spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.range(200).toDF("doc_id")
    one = lambda: sorted(map(tuple, quality.perplexities(frame, trusted, block_bytes=2000).collect()))
    want, sizes, deal = one(), [], type(frame).repartitionById
    monkeypatch.setattr(quality, "TASKS", 3)
    monkeypatch.setattr(type(frame), "repartitionById", lambda self, n, c: (sizes.append(n), deal(self, n, c))[1])
    assert one() == want and sizes == [3, 3]


def test_junk_of_repeated_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = quality.classify(docs, labels.where("quality = 1 and doc_id % 2 = 0").select("doc_id")).join(labels.where("quality = 0").select("doc_id"), "doc_id").join(docs.select("doc_id", "text"), "doc_id")
    rows = [(r.text.split(), r.accepted and not r.repetitive) for r in out.select("text", "accepted", "repetitive").collect()]
    repeated = [a for w, a in rows if len(w) > 20 and len(set(w)) < 0.15 * len(w)]
    assert len(repeated) > 100 and sum(repeated) <= 0.05 * len(repeated)


def test_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = quality.classify(docs, labels.where("quality = 1 and doc_id % 2 = 0").select("doc_id"))
    judged = out.join(labels.where("doc_id % 2 = 1"), "doc_id").groupBy("quality", "accepted").count().collect()
    n = {(r.quality, r.accepted): r["count"] for r in judged}
    assert n[1, True] >= 0.985 * (n[1, True] + n.get((1, False), 0))
    assert n[0, False] >= 0.7 * (n[0, False] + n.get((0, True), 0))


def test_keep_and_empty(spark):
    docs = spark.createDataFrame([(None, "zz", "x"), (1, "a b", "x")], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long")
    assert quality.keep_accepted(docs, none).count() == 2
    assert quality.classify(docs.limit(0), none).collect() == []
