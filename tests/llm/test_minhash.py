import random

import numpy as np

from lexspark.llm import minhash
from lexspark.llm._components import connected_components
from lexspark.llm._scratch import Scratch, hot_join


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, size):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)}


def brute(rows, size, num, den):
    sets = [(i, shingles(t, size)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            common = len(a & b)
            if a and b and den * common >= num * (len(a) + len(b) - common):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: (len(s), find(i), find(i) == i) for i, s in sets}


def check(spark, rows, size=2, **more):
    docs = spark.createDataFrame([(i, t, "z", 5) for i, t in rows], "doc_id long, text string, n_shingles string, component_id int").repartition(3)
    got = minhash.near_duplicates(docs, size=size, **more).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute(rows, size, 80, 100)


def test_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows)


def test_chains_and_edges(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(1000)}" for _ in range(60)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "ONE "), (5, "one two"), (6, "One\x0btwo"), (7, "été"), (8, "Été")]
    for i in range(60):  # neighbours are alike, the ends are not
        base = base[: (k := rng.randrange(len(base)))] + [f"n{i}"] + base[k + 1 :]
        rows.append((100 + i, " ".join(base)))
    rows += [(500 + i, "the same text again and again") for i in range(40)]
    check(spark, rows)
    check(spark, rows, size=5)


def test_hot_keys(spark, monkeypatch):
    # all keys of more than three rows are split, companies are compared in blocks of four
    monkeypatch.setattr(minhash, "hot_join", lambda *a, **b: hot_join(*a, **{**b, "least": 3}))
    monkeypatch.setattr(minhash, "MEMBERS", 4)
    rng, rows = random.Random(5), []
    for group in range(3):
        base = [f"g{group}w{rng.randrange(80)}" for _ in range(30)]
        for i in range(25):
            at = rng.sample(range(30), rng.randrange(5))
            rows.append((group * 100 + i, " ".join(f"x{rng.randrange(9)}" if k in at else w for k, w in enumerate(base))))
    rows += [(500 + i, "the same text again and again") for i in range(20)]
    check(spark, rows)


def test_repeats_nulls_empty(spark):
    docs = spark.createDataFrame([(2, "a b c"), (2, "a b c"), (None, "a b c"), (None, None), (7, "A b\tc")], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, size=2).collect())
    assert got == [("2", 2, 2, True), ("2", 2, 2, True), ("7", 2, 2, False), ("None", 0, None, True), ("None", 2, None, True)]
    assert minhash.near_duplicates(docs.limit(0)).collect() == []
    assert sorted(str(r.doc_id) for r in minhash.drop_near_duplicates(docs).collect()) == ["2", "2", "None", "None"]


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 50, 5000):
        items = rng.integers(0, 2**63, n).astype(np.uint64)
        sketch = minhash.fast_sketch(items, 200)
        assert (sketch != minhash._EMPTY).all()
        assert (sketch == minhash.fast_sketch(rng.permutation(items), 200)).all()
    pool = rng.integers(0, 2**63, 1200).astype(np.uint64)
    a, b = pool[:1000], pool[200:]
    same = np.mean([np.mean(minhash.fast_sketch(a ^ np.uint64(s), 200) == minhash.fast_sketch(b ^ np.uint64(s), 200)) for s in range(40)])
    assert abs(same - 800 / 1200) < 0.03


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200, 100 + i) for i in range(50)] + [(5, 5), (900, 901), (901, 900)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}, 200: 100, 900: 900, 901: 900}
    hot = connected_components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test"), least=8)
    assert {r.node: r.component for r in hot.collect()} == got
    assert connected_components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "test")).collect() == []


def template(n, seed=1):
    """Pages of one template: a common part and words of their own; any two are of similarity 0.64 (shingles of two words)."""
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(100)]
    return [(i, " ".join(common + [f"x{i}y{rng.randrange(10**6)}" for _ in range(28)])) for i in range(n)]


def test_texts_of_a_template_travel_in_proportion(spark, monkeypatch):
    sent, write = {}, Scratch.write

    def counted(self, df, name, *more):
        out = write(self, df, name, *more)
        if name == "near":
            sent[rows] = out.count()
        return out

    monkeypatch.setattr(minhash.Scratch, "write", counted)
    for rows in (500, 1000, 2000):
        docs = spark.createDataFrame(template(rows), "doc_id long, text string").repartition(4)
        assert all(r.kept for r in minhash.near_duplicates(docs, size=2).collect())
    assert sent[1000] <= 2.5 * max(sent[500], 100) and sent[2000] <= 2.5 * max(sent[1000], 100)


def test_links_within_a_template_are_found(spark):
    """Pairs that are alike among many that are not, in one company: they are in no leader's first comparison alone."""
    rows = template(150, 2)
    for i in range(20):
        w = rows[i][1].split()
        rows.append((1000 + i, " ".join(w[:110] + [f"z{i}"] + w[111:])))
    check(spark, rows)


def test_sketches_of_linked_pairs_agree_enough():
    rng = np.random.default_rng(1)
    least = minhash.least_agreement(80, 100)
    assert 700 < least < 819
    byte = lambda s: minhash._mix(minhash.fast_sketch(s, minhash.COORDINATES)) >> np.uint64(56)
    for union in (5, 10, 50, 300, 3000):
        low, far = [], []
        for _ in range(200 if union < 3000 else 40):
            items = rng.integers(0, 1 << 63, union, dtype=np.uint64)
            side, common = union // 10, union - 2 * (union // 10)  # similarity 0.8, or more for the smallest
            a, b = np.sort(items[: side + common]), np.sort(items[side:])
            low.append(int((byte(a) == byte(b)).sum()))
            cut = union * 18 // 100
            c, d = np.sort(items[: union - cut]), np.sort(items[cut:])
            far.append(int((byte(c) == byte(d)).sum()))
        assert min(low) >= least
        if union >= 50:  # similarity 0.64
            assert max(far) < least
