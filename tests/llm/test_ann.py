import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexspark.llm import ann, queries


def brute(rows, k):
    """{query id: lists of (id, score)}, a list for each vector of the id. A row is an id and a vector."""
    rows = sorted({(i, tuple(v)) for i, v in rows})
    out = {}
    for at, (q, v) in enumerate(rows):
        if q % 20 == 0:
            v = np.array(v, dtype=np.float64)
            near = sorted((-float((np.array(w, dtype=np.float64) * v).sum()), i) for j, (i, w) in enumerate(rows) if j != at and len(w) == len(v))
            out.setdefault(q, []).append([(i, -c) for c, i in near[:k]])
    return {q: sorted(x for x in lists if x) for q, lists in out.items() if any(lists)}


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.query_class, r["rank"])):
        near = out.setdefault(r.query_id, {}).setdefault(r.query_class, [])
        assert r["rank"] == len(near) + 1
        near.append((r.vec_id, r.score))
    return {q: sorted(lists.values()) for q, lists in out.items()}


def recall(rows, got, k=20):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=np.float64)
    hits = total = 0
    for at in np.flatnonzero(ids % 20 == 0):
        s = x @ x[at]
        s[at] = -np.inf
        want = set(ids[np.argsort(-s, kind="stable")[:k]].tolist())
        (near,) = got[int(ids[at])]
        hits, total = hits + len(want & {i for i, _ in near}), total + len(want)
    return hits / total


def test_recall_and_scores(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    got = found(queries.op3_ann(spark, "/root/testdata/sf0.1"))
    assert got.keys() == {i for i, _ in rows if i % 20 == 0}
    assert recall(rows, got) >= 0.9
    vectors = {i: np.array(v, dtype=np.float64) for i, v in rows}
    for q, (near,) in got.items():
        assert len(near) == 20 and all(s == (vectors[q] * vectors[i]).sum() for i, s in near)
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))


def clustered(n, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((150, 24))
    return (centres[rng.integers(0, 150, n)] + 0.3 * rng.standard_normal((n, 24))).astype(np.float32).tolist()


def test_clusters_are_pruned(spark, monkeypatch):
    rows = list(enumerate(clustered(10_000)))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for parts, leaf in ((ann.PARTS, ann.LEAF), (6, 64)):  # one network; networks below it
        monkeypatch.setattr(ann, "PARTS", parts)
        assert recall(rows, found(ann.nearest(table, F.col("vec_id") % 20 == 0, 20, leaf=leaf))) >= 0.9
        *_, trees = ann.build(table, F.col("vec_id") % 20 == 0, 20, leaf=leaf)
        assert bool(trees[24].below) == (parts == 6) and trees[24].leaves() >= 10_000 / ann.LEAF
        probes = trees[24].probes(np.array([v for i, v in rows if i % 20 == 0]))[1]
        assert probes.mean() <= trees[24].leaves() / 4


def test_leaves_grow_with_the_rows(spark):
    for n in (1500, 6000):
        table = spark.createDataFrame(list(enumerate(clustered(n))), "vec_id long, embedding array<float>")
        *_, blocks, trees = ann.build(table, F.col("vec_id") % 20 == 0, leaf=100)
        assert trees[24].leaves() == n // 100 and blocks.count() <= n // 100


def test_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(0, 300)] + [(i, rng.standard_normal(3).round(3).tolist()) for i in range(300, 420)]
    rows += rows[:40] + [(420, [0.0, -0.0, 1.0]), (421, [-0.0, 0.0, 1.0])]
    odd = [(500, None), (520, [0.0, 0.0, 0.0]), (540, [1.0, None, 0.0]), (560, [math.nan, 1.0, 0.0]), (580, [math.inf, 0.0, 0.0]), (600, []), (620, [1.0, 2.0]), (None, [1.0, 1.0, 1.0])]
    frame = spark.createDataFrame([(*r, 7, 8) for r in [*rows, *odd]], "vec_id long, embedding array<float>, rank int, h1 int").repartition(3)
    rows = [(i, (np.float32(v) + np.float32(0)).tolist()) for i, v in rows]
    for block in (16, ann.BLOCK):
        got = found(ann.nearest(frame, F.col("vec_id") % 20 == 0, 20, block=block))
        assert got == brute(rows, 20)
    few = ann.nearest(frame.where("vec_id in (0, 20, 500, 300)"), F.col("vec_id") % 20 == 0, 20)
    assert {q: [len(x) for x in v] for q, v in found(few).items()} == {0: [2], 20: [2], 300: [2]}
    assert ann.nearest(frame.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_one_id_on_several_vectors_and_several_lengths(spark):
    rng = np.random.default_rng(5)
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0])] + [(i, rng.standard_normal(2).round(2).tolist()) for i in range(1, 25)]
    rows += [(i, rng.standard_normal(n).round(2).tolist()) for i, n in enumerate([2] * 60 + [3] * 41 + list(range(4, 16)), 30)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, want = found(ann.nearest(frame, F.col("vec_id") % 20 == 0, 20)), brute(rows, 20)
    assert got == want and len(got[0]) == 2 and {100, 120} <= got.keys()
    some = found(ann.nearest(frame, F.col("vec_id") % 20 == 0, 20, leaf=10_000))
    assert some == want


def test_ties_over_several_leaves(spark, monkeypatch):
    # all that is told apart by the first two places has the same product with the queries, in leaves and blocks of its own
    rng = np.random.default_rng(6)
    rows = [(i, [1.0, 0.0, 0.0, 0.0]) for i in (0, 20)] + [(i, [float(i % 2), *rng.choice([-1.0, 1.0], 3).tolist()]) for i in range(21, 600) if i % 20]
    rows += [(i, [0.0, *rng.integers(-9, 9, 3).astype(float).tolist()]) for i in range(601, 1200) if i % 20]
    rows = [(i, v) for i, v in rows if any(v)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    monkeypatch.setattr(ann, "_settle", lambda *_: None)  # every leaf is probed
    *_, trees = ann.build(frame, F.col("vec_id") % 20 == 0, leaf=50)
    assert trees[4].leaves() > 4
    assert found(ann.nearest(frame, F.col("vec_id") % 20 == 0, 20, leaf=50, block=7)) == brute(rows, 20)


def test_balanced_cut():
    x = np.random.default_rng(1).standard_normal((1000, 16))
    graph = ann.neighbour_graph(x, 10)
    labels = ann.balanced_cut(x, graph, 7)
    assert np.bincount(labels, minlength=7).max() <= math.ceil(1.05 * 1000 / 7) + 1
    inside = (labels[graph] == labels[:, None]).mean()
    assert inside > 1.5 / 7


@pytest.mark.parametrize("norm", [1e-100, 1e-6, 1e-3, 1.0, 1e4])
def test_vectors_of_any_norm_are_routed(spark, norm):
    x = np.array(clustered(4000, 3), dtype=np.float64)
    x *= norm / np.linalg.norm(x, axis=1).mean()
    table = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    *_, index, blocks, trees = ann.build(table, F.col("vec_id") % 20 == 0, 20, leaf=128)
    sizes = {r.leaf: r["count"] for r in index.groupBy("leaf").count().collect()}
    assert max(sizes.values()) <= 4 * 128
    leaves, n = trees[24].probes(x[::20])
    scanned = sum(sizes.get(leaf, 0) for leaf in leaves.tolist()) / len(n)
    assert scanned <= 1000  # a quarter of the rows
    assert recall(list(enumerate(x.tolist())), found(ann.nearest(table, F.col("vec_id") % 20 == 0, 20, leaf=128))) >= 0.9


def test_queries_and_candidates_of_mixed_norms(spark):
    x = np.array(clustered(4000, 4), dtype=np.float64)
    x[::20] *= 1e-7 / 5  # the queries; as candidates they are far from every other one
    x[1::97] *= 1e5
    rows = list(enumerate(x.tolist()))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert recall(rows, found(ann.nearest(table, F.col("vec_id") % 20 == 0, 20, leaf=128))) >= 0.9


def test_entries_whose_products_overflow_are_refused(spark):
    table = spark.createDataFrame([(20 * i, [1e160, float(i)]) for i in range(4)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond 1e"):
        ann.nearest(table, F.col("vec_id") % 20 == 0).collect()
