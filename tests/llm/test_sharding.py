import math
import random
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from lexspark.llm import sharding


def check(rows, sent, shards):
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in sent)
    counts = Counter(r.shard for r in rows)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert sum(sizes) == len(sent) and max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    assert {(r.law, r.grown_shard) for r in rows} <= {("rows", None)}


def cut(rows):
    groups = {}
    for r in rows:
        groups.setdefault((r.size, r.text_crc32), []).append(r.shard)
    pairs = sum(len(g) * (len(g) - 1) / 2 for g in groups.values())
    return sum(len(g) * (len(g) - 1) / 2 - sum(n * (n - 1) / 2 for n in Counter(g).values()) for g in groups.values()) / pairs


def run(spark, sent, shards, monkeypatch=None):
    docs = spark.createDataFrame([(*r, "s") for r in sent], "doc_id long, text string, shard string").repartition(4)
    return sharding.shard_documents(docs, shards).collect()


def test_small_groups_meet(spark):
    sent = [(i, f"text {i // 3}" if i % 4 else f"alone {i}") for i in range(2000)]
    rows = run(spark, sent, 40)
    check(rows, sent, 40)
    assert cut(rows) < 0.05


def test_hot_group_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RANKED", 50)
    sent = [(i, "the same") for i in range(700)] + [(700 + i, f"t{i % 400}") for i in range(1200)] + [(None, None), (None, None), (5000, ""), (3, "the same"), (3, "the same")]
    rows = run(spark, sent, 40)
    check(rows, sent, 40)
    hot = Counter(r.shard for r in rows if r.text_crc32 == zlib.crc32(b"the same"))
    assert sum(n for _, n in hot.most_common(15)) >= 0.9 * 702  # it needs 15 shards
    assert run(spark, sent, 40) and sorted(map(str, run(spark, sent, 40))) == sorted(map(str, rows))


def even_plain(state, nodes, size, shards):
    loads = Counter(state.values())
    rank = sorted(range(shards), key=lambda j: (-loads[j], j))
    want = {j: len(nodes) // shards + (i < len(nodes) % shards) for i, j in enumerate(rank)}

    def turn(n):
        k = size[n["g"]]
        weight = -4 if k == 1 else max(-3, min(3, math.floor(math.log2(k)) - 4))
        return weight * 2**61 + ((n["turned"] % 2**64) >> 3)

    leavers = []
    for j in range(shards):
        inside = sorted((n for n in nodes if state[n["id"]] == j), key=turn)
        leavers += inside[: max(0, loads[j] - want[j])]
    leavers.sort(key=lambda n: n["mix"])
    room = [j for j in range(shards) for _ in range(max(0, want[j] - loads[j]))]
    return state | {n["id"]: j for n, j in zip(leavers, room)}


def plain(nodes, voices, shards, rounds=6):
    """Balanced label propagation, node by node. ``voices`` has a hash for each (group, shard)."""
    size = Counter(n["g"] for n in nodes)
    share = -(-len(nodes) // shards)
    most = max(share, math.floor(share * 1.05))
    large = {g for g, k in size.items() if k > 1 and 4 * k >= share}
    state = {n["id"]: i % shards for i, n in enumerate(sorted(nodes, key=lambda n: n["spot"]))}
    for turn in range(rounds):
        first = turn < rounds // 2
        if turn == rounds // 2:
            state = even_plain(state, nodes, size, shards)
        members = [n for n in nodes if (n["g"] in large if first else size[n["g"]] > 1 and n["g"] not in large)]
        loads = Counter(state.values())
        big = Counter(state[n["id"]] for n in nodes if n["g"] in large)
        loose = Counter(state[n["id"]] for n in nodes if size[n["g"]] == 1)
        votes = defaultdict(Counter)
        for n in members:
            votes[n["g"]][state[n["id"]]] += 1
        homes = {}
        for g, seen in votes.items():
            crowded = lambda j: not first and 5 * big[j] >= 4 * share
            homes[g] = sorted(seen, key=lambda j: (crowded(j), -seen[j], voices[g, j]))[: -(-size[g] // share)]
        queues = defaultdict(list)
        for n in members:
            at = homes[n["g"]]
            if state[n["id"]] not in at:
                queues[state[n["id"]], at[n["spot"] % len(at)]].append(n)
        limits = [most + (loads[j] - big[j] if first else loose[j]) for j in range(shards)]
        grants = sharding._quotas({k: len(q) for k, q in queues.items()}, [loads[j] for j in range(shards)], limits)
        for (_, to), q in queues.items():
            for n in sorted(q, key=lambda n: n["order"])[: grants[_, to]]:
                state[n["id"]] = to
    return even_plain(state, nodes, size, shards)


def test_propagation_by_definition(spark):
    rng = random.Random(11)
    sizes = [130, 60, 25, 25, 12, 9, 7, 5, 4, 3, 3, 2, 2, 2, 2] + [1] * 90
    texts = [f"text {g} {rng.random()}" for g, n in enumerate(sizes) for _ in range(n)]
    groups = {}
    texts = [groups.setdefault(t.split()[1], t) for t in texts]
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    hashed = docs.select("doc_id", F.xxhash64("text").alias("g1"), F.xxhash64(F.lit(5), "text").alias("g2")).withColumn("spot", F.xxhash64("doc_id", "g1", F.lit(1)))
    rows = hashed.select("*", F.xxhash64("spot", "g1").alias("turned"), F.xxhash64("spot", "g1", "g2").alias("mix"), F.xxhash64("g1", "g2", "spot").alias("order")).collect()
    nodes = [{"id": r.doc_id, "g": r.g1, "spot": r.spot, "turned": r.turned, "mix": r.mix, "order": r["order"]} for r in rows]
    for shards in (7, 3, 40):
        pairs = hashed.select("g1").distinct().crossJoin(spark.range(shards).selectExpr("cast(id as int) shard"))
        voices = {(r.g1, r.shard): r.h for r in pairs.select("g1", "shard", F.xxhash64("g1", "shard").alias("h")).collect()}
        want = plain(nodes, voices, shards)
        got = sharding.shard_documents(docs, shards).collect()
        assert {r.doc_id: r.shard for r in got} == want
        spots = {n["id"]: n["spot"] for n in nodes}
        for j in range(shards):
            assert [r.doc_id for r in sorted((r for r in got if r.shard == j), key=lambda r: r.slot)] == sorted((i for i, x in want.items() if x == j), key=spots.get)


def test_equal_rows_are_numbered_in_parts(spark):
    sent = [(1, None, 1), (None, "a", 7), (2, "b", 3), (2, "c", 8)]
    counted = spark.createDataFrame(sent, "doc_id long, g1 string, n long")
    for most in (3, 7, 100):
        got = sharding.numbered(counted, most).collect()
        assert sorted((str(r.doc_id), str(r.g1), r.nth) for r in got) == sorted((str(i), str(g), k) for i, g, n in sent for k in range(n))


def test_few_and_empty(spark):
    for sent, shards in (([(1, "a")], 40), ([(i, "a") for i in range(7)], 3), ([(i, str(i)) for i in range(10)], 1)):
        check(run(spark, sent, shards), sent, shards)
    assert run(spark, [(1, "a")], 40)[0].shard in range(40)
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.shard_documents(docs).collect() == []


def test_quotas():
    grants = sharding._quotas({(0, 1): 50, (1, 0): 30, (2, 1): 20}, [100, 100, 100], [105] * 3)
    load = [100 - grants[0, 1] + grants[1, 0], 100 + grants[0, 1] + grants[2, 1] - grants[1, 0], 100 - grants[2, 1]]
    assert max(load) <= 105 and sum(grants.values()) >= 60
