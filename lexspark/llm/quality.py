"""Quality classifier: an interpolated modified Kneser-Ney model of characters, trained on trusted text.

Documents are dealt into blocks of bounded size. A first pass takes from each block its distinct n-grams, with their
counts in trusted documents. Counts, continuation counts, discounts and back-off masses are grouped sums over that
table, and the probability of each distinct n-gram comes from joins of count tables that are sharded by n-gram, order
by order. The second pass sends each block the probabilities of its own n-grams, so no task holds the model; a block
scores its documents and a document is rejected if its perplexity is above a quantile of the perplexities of trusted
documents in its language that the model has not seen. Text that repeats a few words is cheap to any such model, so the
share of repeated word pairs is held against the same quantile of these documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.llm._scratch import Scratch, small

ORDER = 4
#: Rejected are documents above this quantile of held-out trusted documents of their language.
QUANTILE = 0.998
#: A share of repeated word pairs up to this one never rejects: a few held-out documents say little about long texts.
LEAST_REPEATS = 0.2
#: One in so many trusted documents is held out of training.
HELD_OUT = 5
#: Bytes of text in a block, on average, and the most tasks that blocks are dealt to.
BLOCK_BYTES, TASKS = 32 << 20, 16_384
#: Languages up to which a table of them is broadcast, once it was counted.
LANGUAGES = 100_000
#: Steps of log-perplexity that quantiles are counted in.
STEP = 1000
_START, _END = "\x02", "\x03"
_CHUNK = 1 << 20
#: Documents of an Arrow batch that are Python strings at a time.
_ROWS = 1000


def _segments(text: str | None, order: int, step: int = _CHUNK) -> Iterator[str]:
    """A text in pieces that overlap so that each n-gram is in one piece; one ends at every character and at the end."""
    padded = _START * (order - 1) + (text or "").replace("\x00", "￿") + _END
    for a in range(0, len(padded) - order + 1, step):
        yield padded[a : a + step + order - 1]


def _codes(segments: list[str]) -> np.ndarray:
    return np.frombuffer("".join(segments).encode("utf-32-le"), dtype=np.uint32)


def _rolled(dense: np.ndarray, bits: int, order: int) -> np.ndarray:
    n = len(dense) - order + 1
    key = dense[:n].astype(np.int64)
    for j in range(1, order):
        key <<= bits
        key |= dense[j : j + n]
    return key


def _inside(lengths: np.ndarray, order: int) -> np.ndarray:
    """Which of the rolled keys lie within one segment."""
    ends = np.cumsum(lengths)
    inside = np.ones(ends[-1] - order + 1, dtype=bool)
    cut = (ends[:, None] - np.arange(1, order)).ravel()
    inside[cut[cut < len(inside)]] = False
    return inside


def distinct_grams(segments: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct n-grams, counts) of segments."""
    codes = _codes(segments)
    there = np.zeros(0x110000, dtype=bool)
    there[codes] = True
    alphabet = np.flatnonzero(there).astype(np.uint32)
    bits = max(1, int(len(alphabet) - 1).bit_length())
    if bits * order > 63:  # so many characters need shorter pieces; one of 2 ** (63 // order) characters always fits
        step = (1 << (63 // order)) - order
        parts = [distinct_grams([s[a : a + step + order - 1]], order) for s in segments for a in range(0, len(s) - order + 1, step)]
        grams, where = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
        return grams, np.bincount(where, weights=np.concatenate([c for _, c in parts])).astype(np.int64)
    lookup = np.zeros(0x110000, dtype=np.int64)
    lookup[alphabet] = np.arange(len(alphabet))
    keys = _rolled(lookup[codes], bits, order)[_inside(np.fromiter(map(len, segments), np.int64), order)]
    where, found = pd.factorize(keys)
    digits = np.stack([alphabet[(found >> (bits * (order - 1 - j))) & ((1 << bits) - 1)] for j in range(order)], axis=1)
    return np.ascontiguousarray(digits).view(f"<U{order}").ravel(), np.bincount(where, minlength=len(found))


class Scorer:
    """Log-probabilities of one language's n-grams in a block."""

    def __init__(self, grams: list[str], logs: np.ndarray, order: int):
        self.order, self.logs = order, logs
        codes = _codes(grams).reshape(len(grams), order)
        alphabet = np.unique(codes)
        self.lookup = np.zeros(0x110000, dtype=np.int64)
        self.lookup[alphabet] = np.arange(len(alphabet))
        self.bits = max(1, int(len(alphabet) - 1).bit_length())
        self.index = pd.Index(self._keys(codes.ravel())[::order])

    def _keys(self, codes: np.ndarray) -> np.ndarray:
        dense = self.lookup[codes]
        if self.bits * self.order <= 63:
            return _rolled(dense, self.bits, self.order)
        n = len(dense) - self.order + 1  # too many characters to pack: a hash of 64 bits
        key = np.zeros(n, dtype=np.uint64)
        for j in range(self.order):
            key = (key ^ dense[j : j + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        return key.view(np.int64)

    def totals(self, segments: list[str]) -> np.ndarray:
        """The sum of log-probabilities of each segment."""
        lengths = np.fromiter(map(len, segments), np.int64)
        keys = self._keys(_codes(segments))[_inside(lengths, self.order)]
        values = self.logs[self.index.get_indexer(keys)]
        return np.bincount(np.repeat(np.arange(len(segments)), lengths - self.order + 1), weights=values, minlength=len(segments))


def _batched(texts: list[str | None], order: int) -> Iterator[tuple[list[int], list[str]]]:
    """(places, segments) of texts, about a chunk at a time."""
    places: list[int] = []
    segments: list[str] = []
    size = 0
    for i, t in enumerate(texts):
        for s in _segments(t, order):
            places.append(i)
            segments.append(s)
            size += len(s)
            if size >= _CHUNK:
                yield places, segments
                places, segments, size = [], [], 0
    if segments:
        yield places, segments


def repeated_pairs(text: str | None) -> float:
    """The share of a text's pairs of neighbouring words that it had before; 0 without a pair."""
    words = (text or "").split()
    return 1 - len(set(zip(words, words[1:]))) / (len(words) - 1) if len(words) > 1 else 0.0


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """(block, kind, slice) of batches that come by block and kind."""
    for batch in batches:
        keys = np.stack([batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            step = _ROWS if b > a and keys[a][1] == 2 else max(1, b - a)  # documents a few at a time
            for start in range(a, b, step):
                yield int(keys[a][0]), int(keys[a][1]), batch.slice(start, min(step, b - start))


def _counter(order: int):
    def emit(block: int, table: dict[str, dict[str, int]]) -> Iterator[pa.RecordBatch]:
        for lang, grams in table.items():
            names, counts = list(grams), np.fromiter(grams.values(), np.int64, len(grams))
            for a in range(0, len(names), 50_000):
                part = names[a : a + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), block, dtype=np.int64)), pa.array([lang] * len(part), pa.string()), pa.array(part, pa.string()), pa.array(counts[a : a + 50_000])], ["block", "lang", "gram", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, trusted, table = None, set(), {}
        for block, kind, rows in _by_block(batches):
            if block != at:
                if table:
                    yield from emit(at, table)
                at, trusted, table = block, set(), {}
            if kind == 0:
                trusted.update(rows.column(2).to_pylist())
                continue
            ids, langs, held, texts = (rows.column(i).to_pylist() for i in (2, 3, 4, 5))
            groups: dict[tuple[str, bool], list] = {}
            for i, lang, h, t in zip(ids, langs, held, texts):
                groups.setdefault((lang, i in trusted and not h), []).append(t)
            for (lang, fit), members in groups.items():
                grams = table.setdefault(lang, {})
                for _, segments in _batched(members, order):
                    found, counts = distinct_grams(segments, order)
                    names = found.tolist()
                    if fit:
                        for g, c in zip(names, counts.tolist()):
                            grams[g] = grams.get(g, 0) + c
                    else:
                        for g in names:
                            if g not in grams:
                                grams[g] = 0
        if table:
            yield from emit(at, table)

    return run


def _scorer(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, trusted, raw, scorers = None, set(), {}, {}
        for block, kind, rows in _by_block(batches):
            if block != at:
                at, trusted, raw, scorers = block, set(), {}, {}
            if kind == 0:
                trusted.update(rows.column(2).to_pylist())
                continue
            if kind == 1:
                frame = pd.DataFrame({"lang": rows.column(3).to_pandas(), "gram": rows.column(5).to_pandas(), "log": rows.column(6).to_numpy(zero_copy_only=False)})
                for lang, part in frame.groupby("lang"):
                    raw.setdefault(lang, []).append((part.gram.tolist(), part.log.to_numpy()))
                continue
            for lang, parts in raw.items():
                scorers[lang] = Scorer([g for names, _ in parts for g in names], np.concatenate([x for _, x in parts]), order)
            raw = {}
            ids, langs, held, texts = (rows.column(i).to_pylist() for i in (2, 3, 4, 5))
            total, size = np.zeros(len(ids)), np.fromiter((len(t or "") + 1 for t in texts), np.int64, len(ids))
            groups: dict[str, list[int]] = {}
            for i, lang in enumerate(langs):
                groups.setdefault(lang, []).append(i)
            for lang, members in groups.items():
                if lang not in scorers:
                    total[members] = np.nan
                    continue
                for places, segments in _batched([texts[i] for i in members], order):
                    np.add.at(total, np.array(members)[places], scorers[lang].totals(segments))
            mean = -total / size
            yield pa.RecordBatch.from_arrays([rows.column(2), rows.column(3), pa.array(size - 1), pa.array([i in trusted for i in ids]), rows.column(4), pa.array(mean, pa.float64(), mask=np.isnan(mean)), pa.array([repeated_pairs(t) for t in texts], pa.float64())], ["doc_id", "lang", "n_chars", "trusted", "held", "log_perplexity", "repeats"])

    return run


def _discount(c: Column) -> Column:
    return F.when(c >= 3, F.col("d3")).when(c == 2, F.col("d2")).when(c == 1, F.col("d1")).otherwise(0.0)


def _counts_of_order(top: DataFrame, order: int, scratch: Scratch) -> list[DataFrame]:
    """(lang, gram, c) by order: counts for the highest, numbers of distinct left neighbours for the others."""
    tables = [top]
    for _ in range(order - 1):
        tables.append(scratch.write(tables[-1].groupBy("lang", F.expr("substring(gram, 2)").alias("gram")).agg(F.count(F.lit(1)).alias("c")), "counts"))
    return tables[::-1]


def _by_language(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """A table of a row a language, to be joined where the n-grams are: a language may have most of them."""
    return small(scratch.write(rows, "languages"), LANGUAGES)


def _contexts(counts: DataFrame, n: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The discounts of an order by language, and (lang, context, total, mass) of its contexts."""
    number = lambda k: F.count_if(F.col("c") == k).cast("double")
    raw = counts.groupBy("lang").agg(*(number(k).alias(f"n{k}") for k in (1, 2, 3, 4)))
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    # Chen and Goodman's estimates; where a count of counts is 0 they are undefined and the plain value stands in
    one = lambda k, d: F.greatest(F.lit(0.01), F.least(F.lit(float(k)), F.coalesce(F.when(F.col(f"n{k}") > 0, k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")), F.lit(d))))
    discounts = _by_language(raw.where("n1 + n2 + n3 + n4 >= 0").select("lang", F.when(F.col("n1") > 0, one(1, 0.5)).otherwise(0.5).alias("d1"), F.when(F.col("n1") > 0, one(2, 1.0)).otherwise(1.0).alias("d2"), F.when(F.col("n1") > 0, one(3, 1.5)).otherwise(1.5).alias("d3")), scratch)
    sums = counts.groupBy("lang", F.expr(f"substring(gram, 1, {n - 1})").alias("context")).agg(F.sum("c").cast("double").alias("total"), F.count_if(F.col("c") == 1).alias("m1"), F.count_if(F.col("c") == 2).alias("m2"), F.count_if(F.col("c") >= 3).alias("m3"))
    contexts = sums.join(discounts, "lang").select("lang", "context", "total", (F.col("m1") * F.col("d1") + F.col("m2") * F.col("d2") + F.col("m3") * F.col("d3")).alias("mass"))
    return discounts, contexts


def gram_logs(grams: DataFrame, order: int, scratch: Scratch) -> DataFrame:
    """(lang, gram, log): the model's log-probability of each distinct (lang, gram) of ``grams`` (lang, gram, c).

    c counts the n-gram in training text (0: only asked for). Languages without training text have no rows.
    """
    top = scratch.write(grams.groupBy("lang", "gram").agg(F.sum("c").alias("c")), "grams")
    tables = _counts_of_order(top.where("c > 0"), order, scratch)
    asked = [top.select("lang", "gram")]
    for _ in range(order - 1):
        asked.append(asked[-1].select("lang", F.expr("substring(gram, 2)").alias("gram")).distinct())
    asked = asked[::-1]
    lower = _by_language(tables[0].groupBy("lang").agg((1.0 / (F.count(F.lit(1)) + 1)).alias("below")), scratch)  # even over the characters, and one more
    for n in range(1, order + 1):
        discounts, contexts = _contexts(tables[n - 1], n, scratch)
        rows = asked[n - 1].withColumn("context", F.expr(f"substring(gram, 1, {n - 1})"))
        if n == 1:
            rows = rows.join(lower, "lang")
        else:
            rows = rows.withColumn("suffix", F.expr("substring(gram, 2)")).join(lower, ["lang", "suffix"])
        rows = rows.join(tables[n - 1], ["lang", "gram"], "left").join(contexts, ["lang", "context"], "left").join(discounts, "lang")
        own = F.when(F.col("c").isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), F.col("c") - _discount(F.col("c"))))
        p = F.when(F.col("total").isNull(), F.col("below")).otherwise((own + F.col("mass") * F.col("below")) / F.col("total"))
        done, lower = lower, scratch.write(rows.select("lang", F.col("gram").alias("suffix"), p.alias("below")), "lower")
        if n > 1:
            scratch.drop(done)
    scratch.drop(top, *tables[:-1])
    return lower.select("lang", F.col("suffix").alias("gram"), F.log("below").alias("log"))


def perplexities(docs: DataFrame, trusted: DataFrame, order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, lang, n_chars, trusted, held, log_perplexity, repeats) of each row of ``docs`` (doc_id, text, lang).

    ``trusted`` has the ids of trusted documents. Those with ``held`` are not trained on. log_perplexity is the mean
    negative log-probability of a text's characters and its end; null for a language without training text.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = docs.select(F.sum(F.octet_length(text))).first()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("long").alias("block")
    ids = F.col("doc_id").cast("long")
    held = F.coalesce(F.pmod(F.xxhash64(F.lit(3), ids), F.lit(HELD_OUT)) == 0, F.lit(False))
    none = lambda kind: F.lit(None).cast(kind)
    told = trusted.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    told = told.select(block(F.col("doc_id")), F.lit(0).alias("kind"), "doc_id", F.lit("").alias("lang"), F.lit(False).alias("held"), none("string").alias("text"), none("double").alias("log"))
    rows = docs.select(block(F.coalesce(ids, F.xxhash64(text))), F.lit(2).alias("kind"), ids.alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), held.alias("held"), text.alias("text"), none("double").alias("log"))

    tasks = min(blocks, TASKS)

    def dealt(frame: DataFrame) -> DataFrame:
        # a task a block; beyond TASKS blocks a task has several, one behind the other, and still holds one at a time
        return frame.repartitionById(tasks, F.pmod("block", F.lit(tasks)).cast("int")).sortWithinPartitions("block", "kind")

    grams = scratch.write(dealt(told.unionByName(rows)).mapInArrow(_counter(order), "block long, lang string, gram string, c long"), "block-grams")
    logs = gram_logs(grams.select("lang", "gram", "c"), order, scratch)
    answers = grams.select("block", "lang", "gram").join(logs, ["lang", "gram"]).select("block", F.lit(1).alias("kind"), none("long").alias("doc_id"), "lang", F.lit(False).alias("held"), F.col("gram").alias("text"), "log")
    return scratch.write(dealt(told.unionByName(rows).unionByName(answers)).mapInArrow(_scorer(order), "doc_id long, lang string, n_chars long, trusted boolean, held boolean, log_perplexity double, repeats double"), "scores")


def thresholds(scores: DataFrame, quantile: float = QUANTILE, column: str = "log_perplexity") -> DataFrame:
    """(lang, threshold): the ``quantile`` of ``column`` over held-out trusted documents, up to the next step.

    Where a language has too few of them for any to be above that quantile, its worst document does not decide alone:
    the threshold is not above its median plus the quantile of all languages' distances from their medians.

    Values are counted in steps of 1 / STEP, so a task holds no language's documents and the result does not depend on
    the order of rows.
    """
    counted = scores.where(f"trusted and held and {column} is not null").groupBy("lang", F.ceil(F.col(column) * STEP).alias("step")).agg(F.count(F.lit(1)).alias("n"))

    def ranked(frame: DataFrame, by: str, order: str) -> DataFrame:
        return frame.select("*", F.sum("n").over(Window.partitionBy(by).orderBy(order)).alias("below"), F.sum("n").over(Window.partitionBy(by)).alias("of"))

    steps = ranked(counted, "lang", "step")
    enough = F.col("below") >= F.ceil(F.col("of") * quantile)
    own = steps.groupBy("lang").agg(F.min(F.when(enough, F.col("step"))).alias("own"), F.min(F.when(F.col("below") * 2 >= F.col("of"), F.col("step"))).alias("middle"), F.first("of").alias("of"))
    # at most as many rows as there are steps between the least and the greatest distance
    away = counted.join(own, "lang").groupBy((F.col("step") - F.col("middle")).alias("away")).agg(F.sum("n").alias("n")).withColumn("all", F.lit(0))
    tail = ranked(away, "all", "away").where(enough).agg(F.min("away").alias("tail"))
    out = F.when(F.ceil(F.col("of") * quantile) < F.col("of"), F.col("own")).otherwise(F.least("own", F.col("middle") + F.col("tail")))
    return own.crossJoin(F.broadcast(tail)).select("lang", (out / STEP).alias("threshold"))


def classify(docs: DataFrame, trusted: DataFrame, quantile: float = QUANTILE, order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, lang, n_chars, perplexity, threshold, accepted, repeats, most_repeats, repetitive) of each row of ``docs``
    (doc_id, text, lang).

    Accepted are rows whose perplexity is at most the threshold of their language; rows of a language without trusted or
    held-out documents as well, as nothing speaks against them. A null language is the empty one, a null text is empty,
    and empty texts are accepted (there is nothing to judge). Apart from that, ``repetitive`` tells whether the share of
    repeated word pairs is above ``most_repeats``, the quantile over all languages' held-out documents (LEAST_REPEATS at
    least): a text of few characters' sequences that repeats itself does not perplex a model of characters. Rows that repeat get equal results.
    Labels for ids that are not there, or for the null id, have no effect. Further columns are ignored; an empty table
    gives an empty result.
    """
    scores = perplexities(docs, trusted, order, block_bytes)
    limits = F.broadcast(thresholds(scores, quantile)) if scores.select("lang").distinct().count() <= LANGUAGES else thresholds(scores, quantile)
    most = thresholds(scores.withColumn("lang", F.lit("")), quantile, "repeats").agg(F.greatest(F.lit(LEAST_REPEATS), F.max("threshold")).alias("most_repeats"))
    judged = scores.join(limits, "lang", "left").crossJoin(F.broadcast(most))
    unjudged = F.col("log_perplexity").isNull() | F.col("threshold").isNull() | (F.col("n_chars") == 0)
    accepted = F.when(unjudged, True).otherwise(F.col("log_perplexity") <= F.col("threshold"))
    repetitive = F.coalesce(F.col("repeats") > F.col("most_repeats"), F.lit(False))
    return judged.select("doc_id", "lang", "n_chars", F.exp("log_perplexity").alias("perplexity"), F.exp("threshold").alias("threshold"), accepted.alias("accepted"), "repeats", "most_repeats", repetitive.alias("repetitive"))


def keep_accepted(docs: DataFrame, trusted: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """``docs`` without the documents that ``classify`` does not accept. Rows without an id stay, as nothing can name them."""
    scratch = Scratch(docs.sparkSession, "quality-drop")
    gone = scratch.write(classify(docs, trusted, quantile).where("not accepted and doc_id is not null").select("doc_id").distinct(), "gone")
    return docs.join(small(gone, 500_000), "doc_id", "left_anti").select(*docs.columns)
