"""Improbable-feature digests of documents.

Every window of 64 bytes of a text has an entropy. How often each entropy occurs over all texts makes a precedence: the
less frequent, the more improbable. In every run of 64 windows the most improbable one (the first among equals) gets a
point, and a window with enough points is a feature. Features go, hashed, into a chain of Bloom filters of 2048 bits,
160 to a filter. Two digests are compared filter by filter by the bits they have in common beyond what chance gives.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.operators.relational import spread

WINDOW, POPULAR = 64, 16
LEVELS = 1024
FILTER_BITS, FILTER_ITEMS, HASHES = 2048, 160, 5
#: Bytes of texts that are worked on together.
_CHUNK = 1 << 18
_SCALE = 1 << 20
#: Longer texts are worked on in pieces.
_PIECE = 1 << 21
_GAIN = np.array([0] + [round(((m + 1) * np.log2(m + 1) - (m * np.log2(m) if m else 0)) * _SCALE) for m in range(0, WINDOW + 1)], dtype=np.int64)[1:]
_PAD = np.arange(256, 256 + WINDOW, dtype=np.uint16)


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts with a pad of values that never match between them, and where each text starts."""
    parts, starts, at = [_PAD], [], WINDOW
    for t in texts:
        starts.append(at)
        parts += [np.frombuffer(t, dtype=np.uint8).astype(np.uint16), _PAD]
        at += len(t) + WINDOW
    return np.concatenate(parts), np.array(starts, dtype=np.int64)


def window_levels(data: np.ndarray) -> np.ndarray:
    """The entropy, from 0 to LEVELS - 1, of the window that begins at each place of ``data`` (padded at its front).

    If a byte comes into a window that has m equal ones, the sum of n log n over its counts grows by a function of m
    alone. m is the number of matches among the WINDOW - 1 neighbours, so all sums come from 63 shifted comparisons.
    """
    n = len(data)
    ahead, behind = np.zeros(n, dtype=np.uint8), np.zeros(n, dtype=np.uint8)
    for k in range(1, WINDOW):
        same = (data[:-k] == data[k:]).view(np.uint8)
        ahead[:-k] += same
        behind[k:] += same
    # the first window is the front pad: all different, a sum of 0
    moves = _GAIN[behind[WINDOW:]] - _GAIN[ahead[: n - WINDOW]]
    sums = np.concatenate([[0], np.cumsum(moves)])
    entropy = np.log2(WINDOW) - sums / (WINDOW * _SCALE)
    return np.clip((entropy * ((LEVELS - 1) / np.log2(WINDOW))).astype(np.int64), 0, LEVELS - 1)


def _chunks(texts: list[bytes], most: int = _CHUNK) -> Iterator[list[bytes]]:
    group, size = [], 0
    for t in texts:
        if len(t) > _PIECE:  # a very long text is alone
            if group:
                yield group
                group, size = [], 0
            yield [t]
            continue
        group.append(t)
        size += len(t) + WINDOW
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


def _pieces(text: bytes, overlap: int) -> Iterator[tuple[int, bytes]]:
    """(start, piece) of a long text; pieces overlap so that each run of ``overlap`` + 1 bytes is in one."""
    for a in range(0, max(1, len(text) - overlap), _PIECE):
        yield a, text[a : a + _PIECE + overlap]


def level_counts(texts: list[bytes]) -> np.ndarray:
    """How many windows of the texts have each level."""
    out = np.zeros(LEVELS, dtype=np.int64)
    for group in _chunks([piece for t in texts for _, piece in _pieces(t, WINDOW - 1)]):
        data, starts = _joined(group)
        levels = window_levels(data)
        inside = np.zeros(len(levels) + 1, dtype=np.int64)
        sizes = np.array([len(t) for t in group])
        full = sizes >= WINDOW
        np.add.at(inside, starts[full], 1)
        np.add.at(inside, (starts + sizes - WINDOW + 1)[full], -1)
        out += np.bincount(levels[np.cumsum(inside)[:-1] > 0], minlength=LEVELS)
    return out


def precedence(counts: np.ndarray) -> np.ndarray:
    """A rank for each level: 0 for the rarest. Levels of equal frequency go by the higher entropy first."""
    order = np.lexsort((-np.arange(LEVELS), counts))
    out = np.empty(LEVELS, dtype=np.int64)
    out[order] = np.arange(LEVELS)
    return out


def _feature_hashes(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the window at each place."""
    out = np.zeros(len(places), dtype=np.uint64)
    for a in range(0, len(places), 1 << 14):
        at = places[a : a + (1 << 14)]
        words = data[at[:, None] + np.arange(WINDOW)].view(np.uint64)
        h = np.full(len(at), 0x243F6A8885A308D3, dtype=np.uint64)
        for j in range(WINDOW // 8):
            h = (h ^ words[:, j]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        out[a : a + (1 << 14)] = h ^ (h >> np.uint64(31))
    return out


def _filters(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(filters as rows of bits, items in each) of features in the order of the text, repeats left out."""
    _, first = np.unique(hashes, return_index=True)
    hashes = hashes[np.sort(first)]
    chain = -(-len(hashes) // FILTER_ITEMS)
    bits = np.zeros((chain, FILTER_BITS), dtype=bool)
    row = np.arange(len(hashes)) // FILTER_ITEMS
    for j in range(HASHES):
        bits[row, ((hashes >> np.uint64(11 * j)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
    return bits, np.bincount(row, minlength=chain)


def _points(group: list[bytes], ranks: np.ndarray) -> Iterator[np.ndarray]:
    """For each text the points of its windows; texts of less than a run of windows give all of them to the best."""
    data, starts = _joined(group)
    keyed = (ranks[window_levels(data)] << np.int64(32)) | np.arange(len(data) - WINDOW + 1)
    least = keyed
    for step in (1, 2, 4, 8, 16, 32):  # the least of 64 neighbours by doubling
        least = np.minimum(least[:-step], least[step:])
    winners = least & np.int64(0xFFFFFFFF)
    for t, start in zip(group, starts):
        windows = max(0, len(t) - WINDOW + 1)
        if 0 < windows < WINDOW:
            points = np.zeros(windows, dtype=np.int64)
            points[np.argmin(keyed[start : start + windows])] = POPULAR
            yield points
        else:
            yield np.bincount(winners[start : start + max(0, windows - WINDOW + 1)] - start, minlength=windows)


def digests(texts: list[bytes], ranks: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The chained filters of each text. A text of less than a window has itself as its only feature; an empty text
    has no filter. Memory follows the longest text at a few bytes for each of its own."""
    out = []
    for group in _chunks(texts):
        if len(group[0]) > _PIECE:
            found = [np.zeros(len(group[0]), dtype=np.uint8)]
            for a, piece in _pieces(group[0], 2 * WINDOW - 2):
                for points in _points([piece], ranks):
                    found[0][a : a + len(points)] += points.astype(np.uint8)
        else:
            found = _points(group, ranks)
        for t, points in zip(group, found):
            raw = np.frombuffer(t, dtype=np.uint8)
            if len(t) >= WINDOW:
                places = np.flatnonzero(points >= POPULAR)
                hashes = _feature_hashes(raw, places if len(places) else np.array([points.argmax()]))
            elif len(t):
                whole = np.zeros(WINDOW, dtype=np.uint8)
                whole[: len(t)] = raw
                hashes = _feature_hashes(whole, np.zeros(1, dtype=np.int64)) ^ np.uint64(len(t))
            else:
                hashes = np.empty(0, dtype=np.uint64)
            out.append(_filters(hashes))
    return out


def to_text(digest: tuple[np.ndarray, np.ndarray]) -> str:
    """number of filters : items in the last : base 64 of the bits"""
    bits, items = digest
    return f"{len(bits)}:{items[-1] if len(items) else 0}:{base64.b64encode(np.packbits(bits, axis=1).tobytes()).decode()}"


def from_text(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    chain, last, body = fingerprint.split(":", 2)
    n = int(chain)
    bits = np.unpackbits(np.frombuffer(base64.b64decode(body), dtype=np.uint8).reshape(n, FILTER_BITS // 8), axis=1).astype(bool) if n else np.zeros((0, FILTER_BITS), dtype=bool)
    return bits, np.array([FILTER_ITEMS] * (n - 1) + [int(last)] * (n > 0), dtype=np.int64)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """From 0 (no more in common than by chance) to 1 (equal).

    Each filter of the shorter chain is held against all of the other and keeps its best overlap; filters count by
    their items. Two empty digests are equal; an empty and another one have nothing in common.
    """
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    if (len(a[0]), a[1].sum()) > (len(b[0]), b[1].sum()):
        a, b = b, a
    if len(a[0]) == len(b[0]) and np.array_equal(a[0], b[0]):
        return 1.0
    ones_a, ones_b = a[0].sum(axis=1)[:, None].astype(float), b[0].sum(axis=1)[None, :].astype(float)
    common = a[0].astype(np.float32) @ b[0].astype(np.float32).T
    chance, most = ones_a * ones_b / FILTER_BITS, np.minimum(ones_a, ones_b)
    # a filter of few items only tells about as many: bits in common beyond chance, of those that could be
    best = np.clip((common - chance) / np.maximum(most - chance, 1e-9), 0, 1).max(axis=1)
    return float(min(1.0, (best * a[1]).sum() / a[1].sum()))


def corpus_ranks(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The precedence of levels over all texts. Each task sends one row of LEVELS counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(LEVELS, dtype=np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                out += level_counts([(t or "").encode("utf-8") for t in batch.column(0).slice(start, 500).to_pylist()])
        there = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(out[there])], ["level", "n"])

    rows = spread(docs.select(F.col(text_col).cast("string"))).mapInArrow(run, "level long, n long").groupBy("level").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(LEVELS, dtype=np.int64)
    for r in rows:
        counts[r.level] = r.n
    return precedence(counts)


def fingerprints(docs: DataFrame, ranks: np.ndarray | None = None, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each text; ``ranks`` by default from all of its texts. A null text is empty."""
    ranks = corpus_ranks(docs, text_col) if ranks is None else ranks
    base = docs.drop(out_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 200):
                batch = whole.slice(start, 200)
                texts = [(t or "").encode("utf-8") for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([to_text(d) for d in digests(texts, ranks)], pa.string())], [*batch.schema.names, out_col])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return base.mapInArrow(run, f"{fields}, `{out_col}` string")


def spliced(text: str, following: str) -> str:
    """The last floor(n / 2) code points of ``text`` replaced by the first as many (or all) of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


#: Bytes of text in a range of ids, on average: the first as long as there are at most RANGES, the second in any case. A range
#: streams through its task.
RANGE_BYTES, RANGES = (16 << 20, 512 << 20), 16_384


def range_count(size: int, ranges: tuple[int, int] = RANGE_BYTES) -> int:
    """How many ranges a table of ``size`` bytes of text is cut into."""
    return max(1, min(RANGES, -(-size // ranges[0])), -(-size // ranges[1]))


def _in_order(docs: DataFrame, ranges: tuple[int, int]) -> tuple[DataFrame, int]:
    """(rows, parts): rows so that, by part, descending id and text, each row but a tail has its next row behind it. Parts
    are ranges of ids; each ends with a copy of the first row of the next one (``tail``).

    Ties of ids go by text. Rows without an id come last. Two ids for each part reach the driver and the tasks: some
    200 000 parts at 100 TB.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    key = F.coalesce("doc_id", F.lit(-(2**63)))
    n = range_count(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0, ranges)
    cuts = rows.select(key.alias("k")).agg(F.percentile_approx("k", F.lit(np.arange(1, n) / n), F.lit(max(10_000, 2 * n)))).first()[0] if n > 1 else []
    bounds = np.array(sorted({int(c) for c in cuts or []}), dtype=np.int64)

    @F.pandas_udf("int")
    def part(k: pd.Series) -> pd.Series:
        return pd.Series(len(bounds) - np.searchsorted(bounds, k.to_numpy(), side="left")).astype("int32")

    tops = sorted((r.part, r.top) for r in rows.select(key.alias("k")).withColumn("part", part("k")).groupBy("part").agg(F.max("k").alias("top")).collect())
    behind = {tops[i][1]: tops[i - 1][0] for i in range(len(tops))}  # the very first row follows the last part

    @F.pandas_udf("int")
    def tail_part(k: pd.Series) -> pd.Series:
        return pd.Series([behind.get(x, -1) for x in k.tolist()], dtype="int32")

    own = rows.select(part(key).alias("part"), "doc_id", "text", F.lit(False).alias("tail"))
    tails = rows.select(tail_part(key).alias("part"), "doc_id", "text", F.lit(True).alias("tail")).where("part >= 0")
    return own.unionByName(tails), len(bounds) + 1


def _comparer(ranks: np.ndarray):
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (part, id, text, digest) of the row that waits for its next one
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                parts, ids, texts, tails = (part.column(i).to_pylist() for i in range(4))
                own = digests([t.encode("utf-8") for t in texts], ranks)
                pairs = []
                for p, i, t, tail, d in zip(parts, ids, texts, tails, own):
                    if last is not None and last[0] == p:
                        pairs.append((last, t, d))
                    last = None if tail else (p, i, t, d)  # further tails are ties of the first
                if not pairs:
                    continue
                edited = [spliced(a[2], t) for a, t, _ in pairs]
                changed = digests([e.encode("utf-8") for e in edited], ranks)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([a[1] for a, _, _ in pairs], pa.int64()),
                        pa.array([len(a[2]) for a, _, _ in pairs], pa.int64()),
                        pa.array([hashlib.sha256(e.encode("utf-8")).hexdigest() for e in edited], pa.string()),
                        pa.array([to_text(a[3]) for a, _, _ in pairs], pa.string()),
                        pa.array([to_text(d) for d in changed], pa.string()),
                        pa.array([likeness(a[3], d) for (a, _, _), d in zip(pairs, changed)], pa.float64()),
                        pa.array([likeness(a[3], d) for a, _, d in pairs], pa.float64()),
                    ],
                    names,
                )

    return run


def compare_with_edited(docs: DataFrame, ranks: np.ndarray | None = None, ranges: tuple[int, int] = RANGE_BYTES) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text): its fingerprint, that of its text spliced with the next document's,
    and the likeness to both. The next document is that of the next smaller id; the first follows the last.

    Null texts are empty. Equal ids go by text (equal rows follow one another); rows without an id come last. A single
    row is its own next. Other columns are ignored; an empty table gives an empty result.
    """
    ranks = corpus_ranks(docs) if ranks is None else ranks
    rows, parts = _in_order(docs, ranges)
    # each part is a task of its own
    ordered = rows.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "tail", F.col("doc_id").desc_nulls_last(), "text")
    return ordered.select("part", "doc_id", "text", "tail").mapInArrow(_comparer(ranks), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
