import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexspark.llm import whitening
from lexspark.llm.queries import op13_whitening


def plain(vectors, k=16):
    """By the definition, with the whole covariance: (n, x rows, deviations, eigenvalues, vectors, trace)."""
    x = [tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for v in vectors]
    fit = sorted(set(x))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in fit])
    cov = centred.T @ centred / n
    values, q = np.linalg.eigh(cov)
    return n, x, [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x], values[::-1][:k], q[:, ::-1][:, :k], np.trace(cov), sums


def held(got, vectors, ids, k=16):
    """Rows equal the definition, up to one sign for each component."""
    n, x, deviations, values, q, trace, sums = plain(vectors, k)
    by = {}
    for r in got:
        by.setdefault(r.component, {}).setdefault(r.vec_id, []).append(r)
    size = len(values)
    assert sorted(by) == list(range(1, size + 1))
    for c in range(1, size + 1):
        want = {}
        for i, v, d in zip(ids, x, deviations):
            want.setdefault(i, []).append((sum((n * a - s) / n * w for a, s, w in zip(v, sums, q[:, c - 1])) / math.sqrt(values[c - 1]), d))
        assert {i: len(w) for i, w in want.items()} == {i: len(rs) for i, rs in by[c].items()}
        sign = np.sign(sum(w[0][0] * sorted(by[c][i], key=lambda r: r.deviation)[0].whitened for i, w in want.items() if len(w) == 1))
        for i, w in want.items():
            rows = by[c][i]
            assert sorted(d for _, d in w) == sorted(r.deviation for r in rows)
            if len(w) == 1:
                assert sign * rows[0].whitened == pytest.approx(w[0][0], abs=1e-6)
        assert all(r.n == n and r.explained == pytest.approx(values[c - 1] / trace, rel=1e-9) and r.identity_error < 1e-8 for rs in by[c].values() for r in rs)


def test_query_equals_the_definition(spark):
    d = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{d}/embeddings.parquet").collect()
    got = op13_whitening(spark, d).collect()
    held(got, [r.embedding for r in rows], [r.vec_id for r in rows])
    assert len(got) == 16 * len(rows)


def test_nulls_repeats_and_clashing_names(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.standard_normal((200, 5)) * [5, 4, 3, 2, 1]).tolist()
    good = [(i, v) for i, v in enumerate(vectors)] + [(3, vectors[3])] * 50 + [(None, vectors[4])]
    bad = [(900, None), (901, [1.0, None, 2.0, 3.0, 4.0]), (902, [float("nan")] * 5), (903, [1.0, 2.0, float("inf"), 0.0, 0.0]), (904, [])]
    frame = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").withColumns({"x": F.lit(1), "n": F.lit("a"), "length": F.lit(0)})
    got = whitening.whiten(frame.repartition(6), k=4).collect()
    held(got, [v for _, v in good], [i for i, _ in good], k=4)
    assert len(got) == 4 * len(good)


def test_close_eigenvalues_in_many_dimensions_are_certified(spark):
    rng = np.random.default_rng(7)
    vectors = rng.standard_normal((1500, 160))
    vectors[:, :10] *= np.linspace(4, 1.2, 10)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = whitening.whiten(frame, k=6).collect()
    held(got, vectors.tolist(), range(1500), k=6)
    assert all(r.residual <= 1e-12 and r.passes > 1 for r in got)


def test_lengths_are_fitted_apart(spark):
    rng = np.random.default_rng(9)
    short, long = rng.standard_normal((40, 2)).tolist(), rng.standard_normal((60, 3)).tolist()
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(short + long)], "vec_id long, embedding array<float>")
    got = whitening.whiten(frame, k=2).collect()
    as_float = lambda m: [[float(np.float32(c)) for c in v] for v in m]
    held([r for r in got if r.vec_id < 40], as_float(short), range(40), k=2)
    held([r for r in got if r.vec_id >= 40], as_float(long), range(40, 100), k=2)


def test_without_spread_there_are_no_components(spark):
    frame = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert whitening.whiten(frame([])).collect() == []
    assert whitening.whiten(frame([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    one = whitening.whiten(frame([(1, [0.0, 0.0]), (2, [1.0, 1.0])])).collect()
    assert {(r.vec_id, r.component, r.n, r.deviation) for r in one} == {(1, 1, 2, 2 * 64 * 64), (2, 1, 2, 2 * 64 * 64)}
    assert {abs(round(r.whitened, 9)) for r in one} == {1.0}


def test_numbers_beyond_a_long_are_refused(spark):
    frame = spark.createDataFrame([(1, [1e160]), (2, [0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond the grid"):
        whitening.whiten(frame).collect()
    with pytest.raises(OverflowError):
        whitening._deviation(np.array([[1 << 40]]), 1 << 20, np.array([0], dtype=object))


def test_sums_of_many_tasks_meet_in_few(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FANIN", 3)
    rows = spark.range(1000).repartition(20).selectExpr("array(id, 1L) x")
    assert whitening._summed(rows, lambda b: whitening._matrix(b).sum(axis=0), (2,)).tolist() == [499500.0, 1000.0]
