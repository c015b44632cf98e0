import collections
import hashlib
import math
import random

import numpy as np

from lexspark.llm import fingerprint as fp


def entropy(window):
    _, n = np.unique(list(window), return_counts=True)
    p = n / len(window)
    return -(p * np.log2(p)).sum()


def levels(text):
    return [min(1023, max(0, int(entropy(text[i : i + 64]) * 1023 / 6 + 1e-5))) for i in range(len(text) - 63)]


def sample(rng, n):
    return bytes(rng.choice(b"abcdefgh   \n") if rng.random() < 0.8 else rng.randrange(256) for _ in range(n))


def test_levels_and_counts():
    rng = random.Random(1)
    texts = [sample(rng, n) for n in (0, 1, 63, 64, 65, 200, 900)] + [b"a" * 100]
    data, starts = fp._joined(texts)
    got = fp.window_levels(data)
    counts = np.zeros(fp.LEVELS, dtype=int)
    for t, s in zip(texts, starts):
        want = levels(t)
        assert all(abs(a - b) <= 1 for a, b in zip(got[s : s + len(want)], want))
        counts += np.bincount(got[s : s + len(want)], minlength=fp.LEVELS)
    assert (fp.level_counts(texts) == counts).all()


def test_features_by_definition(monkeypatch):
    rng = random.Random(2)
    ranks = np.array(rng.sample(range(fp.LEVELS), fp.LEVELS))
    for n in (64, 100, 127, 128, 500, 3000):
        text = sample(rng, n)
        data, starts = fp._joined([text])
        rank = ranks[fp.window_levels(data)][starts[0] : starts[0] + n - 63].tolist()
        points = [0] * len(rank)
        if len(rank) < 64:
            points[rank.index(min(rank))] = 16
        else:
            for a in range(len(rank) - 63):
                run = rank[a : a + 64]
                points[a + run.index(min(run))] += 1
        assert next(fp._points([text], ranks)).tolist() == points
    texts = [sample(rng, 5000), b"short", b"", sample(rng, 9000)]
    whole = [fp.to_text(d) for d in fp.digests(texts, ranks)]
    counts = fp.level_counts(texts)
    monkeypatch.setattr(fp, "_PIECE", 700)
    assert [fp.to_text(d) for d in fp.digests(texts, ranks)] == whole
    assert (fp.level_counts(texts) == counts).all()


def test_likeness():
    rng = random.Random(3)
    ranks = fp.precedence(fp.level_counts([sample(rng, 20000)]))
    a, b = sample(rng, 8000), sample(rng, 8000)
    da, db, half, empty, short = fp.digests([a, b, a[:4000] + b[:4000], b"", b"tiny"], ranks)
    assert fp.likeness(da, da) == 1 and fp.likeness(empty, empty) == 1 and fp.likeness(da, empty) == 0
    assert fp.likeness(da, db) < 0.15 < 0.3 < fp.likeness(da, half) < 0.8
    assert 0 <= fp.likeness(short, da) < 0.5 and fp.likeness(short, short) == 1
    for d in (da, empty, short):
        bits, items = fp.from_text(fp.to_text(d))
        assert (bits == d[0]).all() and (items == d[1]).all()


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        out.append((str(i), len(t), hashlib.sha256((t[: len(t) - half] + following[:half]).encode()).hexdigest()))
    return sorted(out)


def test_next_document(spark):
    rng = random.Random(4)
    rows = [(i * 7 % 501, sample(rng, rng.randrange(400)).decode("latin-1")) for i in range(500)] + [(9000, None), (-5, ""), (250, "again"), (250, "again"), (None, "x" * 90), (None, "yy"), (-(10**15), "é" * 71)]
    docs = spark.createDataFrame([(*r, 2) for r in rows], "doc_id long, text string, n_chars int").repartition(4)
    for ranges in ((1 << 12, 1 << 30), fp.RANGE_BYTES):
        got = fp.compare_with_edited(docs, ranges=ranges).collect()
        assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == expected(rows)
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    one = fp.compare_with_edited(docs.where("doc_id = 9000")).collect()
    assert len(one) == 1 and one[0].near_next == 1
    assert fp.compare_with_edited(docs.limit(0)).collect() == []


def test_range_counts():
    assert [fp.range_count(n) for n in (0, 1, 16 << 20, (16 << 20) + 1, 10**11, 10**14)] == [1, 1, 1, 2, 5961, 186265]


def plain_digest(text, ranks):
    """The digest by definition: [(bits, items)] of the chain."""
    gain = lambda m: round(((m + 1) * math.log2(m + 1) - (m * math.log2(m) if m else 0)) * 2**20)
    sums = [0]
    for m in range(64):
        sums.append(sums[-1] + gain(m))
    level = lambda w: min(1023, max(0, int((6 - sum(sums[n] for n in collections.Counter(w).values()) / (64 * 2**20)) * (1023 / 6))))
    if not text:
        return []
    windows = [text[i : i + 64] for i in range(len(text) - 63)] or [text.ljust(64, b"\0")]
    points = [0] * len(windows)
    rank = [int(ranks[level(w)]) for w in windows]
    for a in range(max(1, len(windows) - 63)):
        points[a + min(range(len(rank[a : a + 64])), key=lambda j: (rank[a + j], j))] += 1 if len(windows) >= 64 else 16
    chosen = [i for i, n in enumerate(points) if n >= 16] or [points.index(max(points))]
    mask, features = 2**64 - 1, []
    for i in chosen:
        h = 0x243F6A8885A308D3
        for j in range(0, 64, 8):
            h = ((h ^ int.from_bytes(windows[i][j : j + 8], "little")) * 0x9E3779B97F4A7C15) & mask
            h ^= h >> 29
        h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & mask
        h ^= h >> 31
        h = h ^ len(text) if len(text) < 64 else h
        if h not in features:
            features.append(h)
    chain = []
    for a in range(0, len(features), 160):
        part = features[a : a + 160]
        chain.append(({(h >> (11 * j)) & 2047 for h in part for j in range(5)}, len(part)))
    return chain


def plain_likeness(a, b):
    if not a or not b:
        return float(len(a) == len(b))
    if (len(a), sum(n for _, n in a)) > (len(b), sum(n for _, n in b)):
        a, b = b, a
    if len(a) == len(b) and [x for x, _ in a] == [y for y, _ in b]:
        return 1.0
    total = 0
    for x, n in a:
        best = 0
        for y, _ in b:
            chance, most = len(x) * len(y) / 2048, min(len(x), len(y))
            best = max(best, min(1, max(0, (len(x & y) - chance) / max(most - chance, 1e-9))))
        total += best * n
    return min(1.0, total / sum(n for _, n in a))


def test_query_by_definition(spark):
    rng = random.Random(9)
    pool = sample(rng, 9000).decode("latin-1")
    rows = [(i, pool[(a := rng.randrange(6000)) : a + rng.choice([0, 5, 63, 64, 70, 127, 128, 400, 3000])]) for i in range(60)] + [(100, None), (101, "é" * 200), (102, pool)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = fp.level_counts([(t or "").encode() for _, t in rows])
    ranks = fp.precedence(counts)
    assert ranks.tolist() == [r for _, r in sorted((k, r) for r, k in enumerate(sorted(range(fp.LEVELS), key=lambda k: (counts[k], -k))))]
    order = sorted(rows, key=lambda r: -r[0])
    got = {r.doc_id: r for r in fp.compare_with_edited(docs, ranges=(1 << 12, 1 << 30)).collect()}
    longest = 0
    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        own, edited, after = (plain_digest(x.encode(), ranks) for x in (t, t[: len(t) - len(t) // 2] + following[: len(t) // 2], following))
        for text, chain in ((got[i].fingerprint, own), (got[i].edited_fingerprint, edited)):
            bits, items = fp.from_text(text)
            assert [set(np.flatnonzero(x).tolist()) for x in bits] == [x for x, _ in chain] and items.tolist() == [n for _, n in chain]
        assert abs(got[i].near_edited - plain_likeness(own, edited)) < 1e-6 and abs(got[i].near_next - plain_likeness(own, after)) < 1e-6
        longest = max(longest, len(own))
    assert longest > 1


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = fp.compare_with_edited(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    prints = {}
    for r in got:
        assert prints.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    long = [r for r in got if r.n_chars > 500]
    assert np.mean([r.near_edited > r.near_next for r in long]) > 0.95
    plain = {r.doc_id: r.fingerprint for r in fp.fingerprints(docs).collect()}
    assert all(plain[r.doc_id] == r.fingerprint for r in got)
