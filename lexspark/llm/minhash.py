"""MinHash near-duplicate detection with fast similarity sketches.

The sketch (Dahlgaard, Knudsen and Thorup, 2017) deals a set's elements into bins, round after round with fresh hash
functions, and each bin keeps its least (round, value). Random rounds stop once every bin is filled; from round t on
bin i takes an element from all of them, so 2t rounds fill every coordinate of any non-empty set. Coordinates agree
with a probability equal to the Jaccard similarity, concentrated as if bins were independent. Bands of coordinates
give candidates; an exact intersection of the full shingle sets decides every link.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm._components import connected_components
from lexspark.llm._scratch import Scratch, hot_join, key_counts, small
from lexspark.operators.relational import spread

ROWS, BANDS = 5, 40
#: Followers that are compared with one copy of their leader; a leader with more gets several copies.
FOLLOWERS = 512
#: Members of a leader's company, and queries to them, whose texts are compared in a group of rows.
MEMBERS = 256
#: Members, and queries, whose sketches are compared in a group, and coordinates of these sketches, of a byte each.
SKETCHED, COORDINATES = 2048, 1024
#: Deviations below the expected agreement at the threshold up to which a pair's texts are compared: of pairs at the
#: threshold a share of 1e-9 agrees less.
DEVIATIONS = 6
#: Rows of ids up to which a counted table is broadcast.
BROADCAST_ROWS = 500_000
#: Bytes of text that are hashed together.
_CHUNK = 1 << 20
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 over an array of uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _seeds(n: int, salt: int) -> np.ndarray:
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))


def _fold(words: np.ndarray, k: int) -> np.ndarray:
    n = len(words) - k + 1
    out = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + words[j : n + j])
    return out


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """For each text the sorted hashes of its distinct shingles of ``size`` words.

    A-Z become lower case and words are runs of anything but ASCII white space. A text with fewer words has its whole
    sequence as one shingle (of its own length, so never equal to a longer one); without words the set is empty.
    """
    words = [(t or "").encode("utf-8").lower().split() for t in texts]
    flat = np.empty(sum(map(len, words)), dtype=object)
    at, bounds = 0, []
    for w in words:
        flat[at : at + len(w)] = w
        bounds.append((at, at + len(w)))
        at += len(w)
    hashes = pd.util.hash_array(flat, categorize=False) if at else np.empty(0, dtype=np.uint64)
    out = []
    for a, b in bounds:
        out.append(np.unique(_fold(hashes[a:b], min(size, b - a))) if b > a else np.empty(0, dtype=np.uint64))
    return out


def fast_sketch(items: np.ndarray, bins: int) -> np.ndarray:
    """The sketch of a non-empty set of uint64: one value for each of ``bins`` coordinates."""
    values, done, n = np.full(bins, _EMPTY), 0, len(items)
    seeds = _seeds(2 * bins, 7)
    while done < bins:
        rounds = min(bins - done, 1 + 3 * bins // n if done == 0 else 1 + bins // n)
        h = _mix(items[None, :] ^ seeds[done : done + rounds, None])
        number = np.arange(done, done + rounds, dtype=np.uint64)[:, None]
        np.minimum.at(values, ((h >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64).ravel(), ((number << np.uint64(48)) | _mix(h) >> np.uint64(16)).ravel())
        done += rounds
        if values.max() != _EMPTY:
            return values
    for i in np.flatnonzero(values == _EMPTY):
        h = _mix(items ^ seeds[bins + i])
        values[i] = (np.uint64(bins + int(i)) << np.uint64(48)) | (_mix(h) >> np.uint64(16)).min()
    return values


def band_keys(sketch: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """One 64-bit key for each band; the band's number is part of it."""
    out = _seeds(bands, 11)
    parts = sketch.reshape(bands, rows)
    for j in range(rows):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, j])
    return out.view(np.int64)


def set_key(items: np.ndarray) -> bytes:
    return hashlib.blake2b(items.tobytes(), digest_size=16).digest()


def _chunks(texts: list[str | None]) -> Iterator[list[str | None]]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= _CHUNK:
            yield texts[start : i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield texts[start:]


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches in parts, so that few texts are Python strings at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _sketcher(size: int, rows: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            counts, keys, found = [], [], []
            for texts in _chunks(batch.column(1).to_pylist()):
                for items in shingle_sets(texts, size):
                    counts.append(len(items))
                    keys.append(set_key(items) if len(items) else None)
                    found.append(band_keys(fast_sketch(items, rows * bands), rows, bands) if len(items) else None)
            offsets = np.concatenate([[0], np.cumsum([0 if x is None else bands for x in found])]).astype(np.int32)
            flat = np.concatenate([x for x in found if x is not None] or [np.empty(0, dtype=np.int64)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))], ["doc_id", "n_shingles", "set_key", "bands"])

    return run


def _verifier(size: int, num: int, den: int):
    """Rows come by leader; the leader's own text is the first row (no follower). Yields links that hold exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead, base = None, None
        for batch in _slices(batches):
            leads, followers, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()
            sets: list[np.ndarray] = []
            for texts in _chunks(batch.column(2).to_pylist()):
                sets += shingle_sets(texts, size)
            a, b = [], []
            for l, f, k, items in zip(leads, followers, keys, sets):
                if set_key(items) != k:
                    continue  # another row under the same id
                if f is None:
                    lead, base = l, items
                elif l == lead:
                    common = len(np.intersect1d(base, items, assume_unique=True))
                    if den * common >= num * (len(base) + len(items) - common):
                        a.append(f)
                        b.append(l)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _verified(pairs: DataFrame, candidates: DataFrame, scratch: Scratch, size: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. b leads: a's text travels to b's, in groups of bounded size."""
    fans = scratch.write(pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / FOLLOWERS).alias("copies"), F.count(F.lit(1)).alias("n")), "fans")
    told = scratch.write(hot_join(pairs, fans, ["b"], "n").select("a", "b", F.expr("pmod(xxhash64(a), copies)").alias("copy")), "told")
    text = candidates.select("doc_id", "set_key", "text")
    followers = text.join(small(told, BROADCAST_ROWS), F.col("doc_id") == F.col("a")).select("b", "a", "text", "set_key", "copy")
    leaders = text.join(small(fans, BROADCAST_ROWS), F.col("doc_id") == F.col("b")).select("b", F.lit(None).cast("long").alias("a"), "text", "set_key", F.explode(F.expr("sequence(0L, copies - 1)")).alias("copy"))
    dealt = followers.unionByName(leaders).repartition("b", "copy").sortWithinPartitions("b", "copy", F.col("a").asc_nulls_first())
    links = scratch.write(dealt.select("b", "a", "text", "set_key").mapInArrow(_verifier(size, num, den), "a long, b long"), "links")
    scratch.drop(fans, told)
    return links


def _block_comparer(size: int, num: int, den: int):
    """Rows come by (lead, block), its members before the queries. Exact intersections of a query with all members of a
    block are counted over their joined, sorted elements. Yields for each query one link into each other component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, index = None, [], None
        for batch in _slices(batches):
            rows = batch.to_pydict()
            sets: list[np.ndarray] = []
            for texts in _chunks(rows["text"]):
                sets += shingle_sets(texts, size)
            a, b = [], []
            for lead, block, query, rep, comp, key, items in zip(rows["lead"], rows["block"], rows["query"], rows["rep"], rows["comp"], rows["set_key"], sets):
                if set_key(items) != key:
                    continue  # another row under the same id
                if (lead, block) != at:
                    at, held, index = (lead, block), [], None
                if not query:
                    held.append((rep, comp, items))
                    continue
                if not held:
                    continue
                if index is None:
                    flat = np.concatenate([x for _, _, x in held])
                    owner = np.repeat(np.arange(len(held)), [len(x) for _, _, x in held])
                    order = np.argsort(flat, kind="stable")
                    index = flat[order], owner[order], np.array([len(x) for _, _, x in held]), np.array([c for _, c, _ in held]), np.array([r for r, _, _ in held])
                flat, owner, sizes, comps, reps = index
                left, right = np.searchsorted(flat, items, "left"), np.searchsorted(flat, items, "right")
                spans = right - left
                places = np.repeat(left - np.concatenate([[0], np.cumsum(spans)[:-1]]), spans) + np.arange(spans.sum())
                common = np.bincount(owner[places], minlength=len(held))
                hits = np.flatnonzero((den * common >= num * (len(items) + sizes - common)) & (comps != comp))
                for i in hits[np.unique(comps[hits], return_index=True)[1]]:
                    a.append(rep)
                    b.append(int(reps[i]))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def least_agreement(num: int, den: int, coordinates: int = COORDINATES) -> int:
    """How many coordinates of two sketches have to agree for their sets to be compared."""
    p = num / den
    return max(0, int(np.floor(coordinates * p - DEVIATIONS * np.sqrt(coordinates * p * (1 - p)))))


def _member_sketcher(size: int):
    """(rep, set_key, text) become (rep, n, sketch): the size of the set and a byte for each coordinate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            reps, keys, out = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            sets = (items for texts in _chunks(batch.column(2).to_pylist()) for items in shingle_sets(texts, size))
            for rep, key, items in zip(reps, keys, sets):
                if set_key(items) == key:  # else another row under the same id
                    out.append((rep, len(items), (_mix(fast_sketch(items, COORDINATES)) >> np.uint64(56)).astype(np.uint8).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r for r, _, _ in out], pa.int64()), pa.array([n for _, n, _ in out], pa.int64()), pa.array([x for _, _, x in out], pa.binary())], ["rep", "n", "sketch"])

    return run


def _sketch_comparer(num: int, den: int):
    """Rows come by (lead, block), its members before the queries. Yields the rows whose texts have to be compared, in smaller
    blocks: of different components, with sizes that allow the threshold, and sketches that agree enough."""
    least, names = least_agreement(num, den), ["lead", "block", "query", "rep", "comp"]

    def told(at: tuple[int, int], found: dict[tuple[int, int, int], int]) -> pa.RecordBatch:
        lead, block = at
        rows = [(lead, (block << 12) + sub, query, rep, comp) for (sub, query, rep), comp in found.items()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int32() if i == 2 else pa.int64()) for i in range(5)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, index, found, nth = None, [], None, {}, 0
        for batch in batches:
            lead, block, query, rep, comp, n = (batch.column(i).to_numpy() for i in range(6))
            sketch = np.frombuffer(b"".join(batch.column(6).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, COORDINATES)
            for i in range(batch.num_rows):
                if (lead[i], block[i]) != at:
                    if found:
                        yield told(at, found)
                    at, held, index, found, nth = (int(lead[i]), int(block[i])), [], None, {}, 0
                if not query[i]:
                    held.append((rep[i], comp[i], n[i], sketch[i]))
                    continue
                if not held:
                    continue
                if index is None:
                    index = *(np.array([h[j] for h in held]) for j in range(3)), np.stack([h[3] for h in held])
                reps, comps, sizes, matrix = index
                right = (comps != comp[i]) & (den * np.minimum(sizes, n[i]) >= num * np.maximum(sizes, n[i]))
                near = np.flatnonzero(right)
                near = near[np.count_nonzero(matrix[near] == sketch[i], axis=1) >= least]
                for j in near.tolist():
                    sub = (j // MEMBERS << 6) + nth // MEMBERS
                    found[sub, 0, int(reps[j])] = int(comps[j])
                    found[sub, 1, int(rep[i])] = int(comp[i])
                nth += 1
        if found:
            yield told(at, found)

    return run


def _across(company: DataFrame, candidates: DataFrame, scratch: Scratch, size: int, num: int, den: int) -> DataFrame:
    """Links between different components within a leader's company; ``company`` is (rep, lead, comp), a written table.

    The members outside the largest component are compared with all members, block by block: a query set against the
    rows of its company, without a row for each pair. Sketches of a kilobyte decide first: in a company of documents
    that resemble one another but are below the threshold, as pages of one template, hardly any text travels. Blocks of
    members meet blocks of queries, so that no group of rows grows with the company.
    """
    counts = company.groupBy("lead", "comp").agg(F.count(F.lit(1)).alias("n"))
    mixed = counts.groupBy("lead").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.sum("n").alias("members"), F.max("n").alias("largest"), F.count(F.lit(1)).alias("comps")).where("comps > 1 and members > 2")
    mixed = scratch.write(mixed.select("lead", "main", "members", F.ceil(F.col("members") / SKETCHED).alias("blocks"), F.ceil((F.col("members") - F.col("largest")) / SKETCHED).alias("parts")), "mixed")
    held = scratch.write(hot_join(company, mixed, ["lead"], "members"), "held")
    other = lambda n: F.explode(F.expr(f"sequence(0L, {n} - 1)"))
    members = held.select("lead", F.expr("pmod(xxhash64(rep), blocks)").alias("block"), other("parts").alias("part"), F.lit(0).alias("query"), "rep", "comp")
    queries = held.where("comp != main").select("lead", other("blocks").alias("block"), F.expr("pmod(xxhash64(rep, 1), parts)").alias("part"), F.lit(1).alias("query"), "rep", "comp")
    told = scratch.write(members.unionByName(queries).withColumn("block", F.col("block") * F.lit(1 << 24) + F.col("part")).drop("part"), "told")
    texts = candidates.select(F.col("doc_id").alias("rep"), "set_key", "text")
    sketched = texts.join(small(scratch.write(held.select("rep").distinct(), "asked"), BROADCAST_ROWS), "rep", "left_semi").mapInArrow(_member_sketcher(size), "rep long, n long, sketch binary")
    sketched = scratch.write(sketched, "member-sketches")
    met = sketched.join(small(told, BROADCAST_ROWS), "rep").select("lead", "block", "query", "rep", "comp", "n", "sketch").repartition("lead", "block").sortWithinPartitions("lead", "block", "query")
    near = scratch.write(met.mapInArrow(_sketch_comparer(num, den), "lead long, block long, query int, rep long, comp long"), "near")
    scratch.drop(mixed, held, told, sketched)
    dealt = texts.join(small(near, BROADCAST_ROWS), "rep")
    dealt = dealt.select("lead", "block", "query", "rep", "comp", "set_key", "text").repartition("lead", "block").sortWithinPartitions("lead", "block", "query")
    links = scratch.write(dealt.mapInArrow(_block_comparer(size, num, den), "a long, b long"), "links")
    scratch.drop(near)
    return links


def _labelled(frame: DataFrame, column: str, components: DataFrame, out: str) -> DataFrame:
    return frame.join(components.select(F.col("node").alias(column), F.col("component").alias(out)), column, "left").withColumn(out, F.coalesce(out, column))


def near_duplicates(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, rows: int = ROWS, bands: int = BANDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): a row for each row of ``docs``.

    Two documents are linked if ``den * |A & B| >= num * |A | B|`` for their sets of ``size``-word shingles;
    ``component_id`` is the smallest id reachable over links and ``kept`` marks the document of that id. With the
    default 40 bands of 5 coordinates a pair at similarity 0.8 misses all bands with probability 1.3e-7.

    Equal sets are one class and are compared once. Members of a bucket are compared with its leader first. Members
    that this leaves in different components are then compared with all of the leader's company, in blocks, so no
    candidate pair is left out and no bucket is expanded into pairs. There a pair's texts are only compared if sketches
    of 1024 coordinates agree up to six deviations below what the threshold lets expect, which a linked pair fails with
    probability 1e-9.

    Sets are of 64-bit hashes of shingles; the check of a link compares these.

    Null or wordless texts have an empty set and no links. A null id takes no part in links: its component is null
    and it is kept. Repeated rows get a row each; rows of one id with different texts each go by their own text.
    Other columns of ``docs`` are ignored. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "minhash")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    base = scratch.write(spread(docs).mapInArrow(_sketcher(size, rows, bands), "doc_id long, n_shingles long, set_key binary, bands array<long>"), "sketches")
    classes = scratch.write(base.where("set_key is not null and doc_id is not null").groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    reps = base.withColumnRenamed("doc_id", "rep").join(classes, ["set_key", "rep"], "left_semi")

    hashed = reps.select("rep", "set_key", F.explode("bands").alias("bucket"))
    buckets = hashed.groupBy("bucket").agg(F.min("rep").alias("least"), F.max("rep").alias("most"), F.count(F.lit(1)).alias("size")).where("least != most")
    buckets = scratch.write(buckets.select("bucket", "size"), "buckets")
    counts = key_counts(buckets, "size")  # a company of near copies may be in one bucket
    members = scratch.write(hot_join(hashed, buckets, ["bucket"], "size", counts=counts), "members")
    # the leader of a bucket is its member with most company in all buckets: an original rather than one of its copies
    company = members.groupBy("rep").agg(F.sum(F.col("size") - 1).alias("company"))
    leaders = members.join(company, "rep").groupBy("bucket").agg(F.max_by("rep", F.struct("company", -F.col("rep"))).alias("lead"), F.max("size").alias("size"))
    leaders = scratch.write(leaders, "leaders")
    spokes = scratch.write(hot_join(members.drop("size"), leaders, ["bucket"], "size", counts=counts).groupBy("rep", "lead").agg(F.count(F.lit(1)).alias("times")), "spokes")
    wanted = scratch.write(members.select(F.col("rep").alias("doc_id"), "set_key").distinct(), "wanted")
    scratch.drop(members, buckets, leaders)
    candidates = scratch.write(docs.join(small(wanted, BROADCAST_ROWS), "doc_id").select("doc_id", "set_key", "text"), "candidates")

    def verified(pairs: DataFrame) -> DataFrame:
        return _verified(pairs, candidates, scratch, size, num, den)

    apart = spokes.where("rep != lead")
    first = scratch.write(apart.groupBy(F.col("rep").alias("a")).agg(F.max_by("lead", F.struct("times", -F.col("lead"))).alias("b")), "pairs")
    links = verified(first)
    comps = scratch.write(connected_components(links, scratch), "components")

    # the other leaders, where the two sides are still in different components
    more = apart.select(F.col("rep").alias("a"), F.col("lead").alias("b")).join(first, ["a", "b"], "left_anti")
    more = scratch.write(_labelled(_labelled(more, "a", comps, "ca"), "b", comps, "cb").where("ca != cb").select("a", "b"), "pairs")
    if not more.isEmpty():
        links = links.unionByName(verified(more))
        comps = scratch.write(connected_components(links, scratch), "components")

    # two members of a bucket share its leader: what a leader's company does not hold together is compared in full
    companies = scratch.write(_labelled(spokes.select("rep", "lead"), "rep", comps, "comp"), "companies")
    rest = _across(companies, candidates, scratch, size, num, den)
    if not rest.isEmpty():
        links = links.unionByName(rest)
        comps = scratch.write(connected_components(links, scratch), "components")

    ends = scratch.write(_labelled(classes, "rep", comps, "component_id").select("set_key", "component_id", "copies"), "ends")
    scratch.drop(candidates, spokes, companies)
    # a third of all rows may have equal sets
    rows, known = base.select("doc_id", "n_shingles", "set_key"), F.col("set_key").isNotNull()
    joined = hot_join(rows.where(known & F.col("doc_id").isNotNull()), ends, ["set_key"], "copies").select("doc_id", "n_shingles", "component_id")
    joined = joined.unionByName(rows.where(~known | F.col("doc_id").isNull()).select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id")))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` (with a ``doc_id`` and a ``text`` column) without the documents that are not the first of their group."""
    scratch = Scratch(docs.sparkSession, "minhash-drop")
    gone = scratch.write(near_duplicates(docs, size, num, den).where("not kept").select("doc_id").distinct(), "gone")
    return docs.join(small(gone, BROADCAST_ROWS), "doc_id", "left_anti")
