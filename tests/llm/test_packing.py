import random

from lexspark.llm import packing


def plain(items, capacity):
    """Best fit by trying every bin."""
    out, bins = [], []
    tails = []
    for i, (length, source, cluster) in enumerate(items):
        full = max(0, (length - 1) // capacity)
        for p in range(full):
            bins.append([0, None, None, True])
            out.append((i, p, p * capacity, capacity, len(bins) - 1, 0))
        tails.append((-(length - full * capacity), i, full))
    when = 0
    for negative, i, p in sorted(tails):
        length, source, cluster = -negative, items[i][1], items[i][2]
        fits = [(b[0], b[3], n) for n, b in enumerate(bins) if b[3] is not True and b[0] >= length and (source is None or source not in b[1]) and (cluster is None or cluster not in b[2])]
        when += 1
        if fits:
            n = min(fits)[2]
        else:
            bins.append([capacity, set(), set(), when])
            n = len(bins) - 1
        b = bins[n]
        out.append((i, p, p * capacity, length, n, capacity - b[0]))
        b[0] -= length
        b[1].add(source)
        b[2].add(cluster)
        b[3] = when
    return out


def test_equals_exhaustive_search():
    rng = random.Random(2)
    for capacity in (1, 7, 50, 64):
        for _ in range(30):
            items = [(rng.choice([0, rng.randrange(2 * capacity), rng.randrange(capacity)]), rng.choice([None, "hot", "hot", *"abcdef"]), rng.choice([None, "h", *range(30)])) for _ in range(rng.randrange(80))]
            assert packing.pack(items, capacity) == plain(items, capacity)


def check(rows, sent, capacity):
    bins, docs = {}, {}
    for r in rows:
        bins.setdefault((r.shard, r.bin), []).append(r)
        docs.setdefault(r.doc_id, []).append(r)
    for members in bins.values():
        at = 0
        for r in sorted(members, key=lambda r: (r.bin_start, r.piece_bytes)):
            assert r.bin_start == at
            at += r.piece_bytes
        assert at <= capacity
        for key in ("source", "cluster"):
            values = [getattr(r, key) for r in members if getattr(r, key) is not None]
            assert len(values) == len(set(values))
    assert sorted(map(str, docs)) == sorted({str(i) for i, _, _ in sent})


def test_frames(spark):
    rng = random.Random(5)
    sent = [(i, "x" * rng.randrange(300) if i % 3 else "same text", "src0" if i % 3 == 0 else f"src{i % 20}") for i in range(700)] + [(1000, None, None), (1001, "", "src1"), (1002, "é" * 5000, "src2"), (None, "q", "src3")]
    docs = spark.createDataFrame([(*r, 1) for r in sent], "doc_id long, text string, source string, bin int").repartition(5)
    for shard_docs in (10_000, 100):
        rows = packing.best_fit(docs, capacity=500, shard_docs=shard_docs).collect()
        check(rows, sent, 500)
        assert sum(r.piece_bytes for r in rows) == sum(len((t or "").encode()) for _, t, _ in sent)
        again = packing.best_fit(docs.repartition(2), capacity=500, shard_docs=shard_docs).collect()
        assert sorted(map(str, rows)) == sorted(map(str, again))
    assert packing.best_fit(docs.limit(0)).collect() == []


def test_fill(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.best_fit(docs).collect()
    check(rows, [tuple(r) for r in docs.select("doc_id", "text", "source").collect()], 8192)
    bins = len({(r.shard, r.bin) for r in rows})
    assert sum(r.piece_bytes for r in rows) / (8192 * bins) > 0.8
