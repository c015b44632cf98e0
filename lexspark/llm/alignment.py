"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

The alignment itself is relational. Token ids are exploded with their place, byte ends are running sums of token
lengths in a window, an equi-join on unit and end finds where both tokenizers cut, and running counts of these cuts
number the groups. Of two overlapping tokens one ends first or both end together, so each byte end belongs to exactly
one link: the tokens of either side that end there or next after it, which a window carries back. So links are as many
as ends, and no group is expanded into pairs.

A unit is a segment of a text rather than a whole text: there are places where both tokenizers cut whatever stands
around them, so texts are cut there, each distinct segment is tokenized and aligned once, and documents get the results
of their segments by a join: documents are dealt to lanes, and a lane's segments come to it. ``_check_pieces`` refuses
vocabularies that do not allow this.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexspark.llm._scratch import Scratch, setting
from lexspark.llm.bpe import byte_symbols
from lexspark.operators.relational import spread

#: Segments begin at a space or line feed after a letter, a number or an ASCII mark: byte-level words never go on there,
#: and no piece has a space or line feed after anything else.
CUT = r"(?=[ \n])(?<=[\p{L}\p{N}!-~])"
#: Bytes of text in a lane, the rows that share one table of segments and that a task holds, and the most tasks that lanes
#: are dealt to.
LANE_BYTES, TASKS = 12 << 20, 16_384
#: Words of documents, or of one long one, that a task handles together.
WORDS = 1 << 18
#: Rows that are already dealt by unit are joined on unit and end as they lie.
COLOCATED = "spark.sql.requireAllClusterKeysForCoPartition"
#: Segments that a task groups in memory before it sorts them.
GROUPED = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"


def _byte_level_json(source: str) -> list[bytes]:
    """The bytes of each id of a byte-level BPE file."""
    spec = json.loads(source)
    back = {c: b for b, c in enumerate(byte_symbols())}
    out = [b""] * (1 + max(spec["model"]["vocab"].values()))
    for text, i in spec["model"]["vocab"].items():
        out[i] = bytes(back[c] for c in text) if all(c in back for c in text) else text.encode()
    return out


def _pieces(model: bytes) -> list[bytes]:
    """The bytes of each id of a piece model; U+2581 is a space and <0xHH> a byte."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_proto=model)
    names = [p.id_to_piece(i) for i in range(p.get_piece_size())]
    _check_pieces(p, names)
    return [bytes([int(x[3:5], 16)]) if p.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)]


def _check_pieces(p, names: list[str]) -> None:
    """Raises unless no piece goes on with a space or a line feed after anything else, or with anything after a line feed."""
    plain = [x for i, x in enumerate(names) if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i))]
    if any("▁" in x.lstrip("▁") or "\n" in x or " " in x for x in plain):
        raise ValueError("pieces that go on after a space or a line feed cannot be aligned by segments")
    for probe, want in (("a  b ", " a  b "), ("a\n\nb", " a\n\nb")):
        got = b"".join(bytes([int(names[i][3:5], 16)]) if p.is_byte(i) else names[i].replace("▁", " ").encode() for i in p.encode(probe))
        if got.decode("utf-8", "replace") != want:
            raise ValueError("a piece model that drops or changes white space cannot be aligned")


_loaded: dict[tuple[bytes, bytes], tuple] = {}


def _tokenizers(a: bytes, b: bytes) -> tuple:
    """(tokenizer, its bytes by id, piece model, its bytes by id), made once in a worker."""
    if (a, b) not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        source, model = zlib.decompress(a).decode("utf-8"), zlib.decompress(b)
        byte_level = Tokenizer.from_str(source)
        byte_level.no_truncation()
        byte_level.no_padding()
        byte_level.encode_special_tokens = True
        _loaded.clear()
        _loaded[a, b] = byte_level, _byte_level_json(source), sentencepiece.SentencePieceProcessor(model_proto=model), _pieces(model)
    return _loaded[a, b]


def _encoder(a: bytes, b: bytes):
    """(segment, lanes) become (segment, lanes, a, b, whole); whole: both sides' bytes are the segment's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        byte_level, a_bytes, model, b_bytes = _tokenizers(a, b)
        ids = pa.list_(pa.int32())
        for batch in batches:
            texts = batch.column(0).to_pylist()
            left = [x.ids for x in byte_level.encode_batch(texts, add_special_tokens=False)]
            # the model itself puts a space before; a segment that begins with another character gets it as a piece, which goes
            spaced = [x.startswith(" ") for x in texts]
            right = model.encode([x[1:] if s else x for x, s in zip(texts, spaced)], num_threads=1)
            # of a lone space the model makes nothing, but in a text it is a piece
            lone = model.piece_to_id("▁")
            right = [([lone] if x == " " else y) if s else y[1:] for x, y, s in zip(texts, right, spaced)]
            coded = [x.encode() for x in texts]
            said = [[b"".join([entries[i] for i in ids]) for ids in side] for side, entries in ((left, a_bytes), (right, b_bytes))]
            whole = [x == y == z for x, y, z in zip(coded, *said)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(left, ids), pa.array(right, ids), pa.array(whole)], ["segment", "lanes", "a", "b", "whole"])

    return run


def token_ends(units: DataFrame, ids: str, lengths: DataFrame) -> DataFrame:
    """(unit, end, id): a row for each token of the array column ``ids``, with the bytes up to its end. ``lengths`` is (id,
    bytes), a row for each entry of the vocabulary."""
    tokens = units.select("unit", F.posexplode(ids).alias("pos", "id")).join(F.broadcast(lengths), "id")
    return tokens.select("unit", F.sum("bytes").over(Window.partitionBy("unit").orderBy("pos")).alias("end"), "id")


def aligned(units: DataFrame, a_lengths: DataFrame, b_lengths: DataFrame) -> DataFrame:
    """(unit, end, a, b, link_a, link_b, part) of ``units`` (unit, a, b: arrays of ids over the same bytes): a row for each end.

    ``a`` and ``b`` are the tokens that end there, or null; ``link_a`` and ``link_b`` those that cover the byte before it,
    which is the one link of that end. ``part`` numbers the groups of a unit, from its last one (1) back to its first.
    """
    left = token_ends(units, "a", a_lengths).withColumnRenamed("id", "a")
    right = token_ends(units, "b", b_lengths).withColumnRenamed("id", "b")
    ends = left.join(right, ["unit", "end"], "full_outer")
    back = Window.partitionBy("unit").orderBy(F.desc("end")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    return ends.select("unit", "end", "a", "b", F.last("a", True).over(back).alias("link_a"), F.last("b", True).over(back).alias("link_b"), F.count_if(both).over(back).alias("part"))


def _pair_type(a_entries: int, b_entries: int) -> str:
    """The type of a pair of ids as one number, ``a * b_entries + b``."""
    return "int" if a_entries * b_entries < 1 << 31 else "bigint"


def unit_digests(rows: DataFrame, a_entries: int, b_entries: int) -> DataFrame:
    """(unit, n_a, n_b, n_groups, n_links, groups, links) of ``aligned`` rows; groups is "a1,a2|b1;" and so on, links an array
    of pairs, each the number ``link_a * b_entries + link_b``."""
    kind = _pair_type(a_entries, b_entries)
    pair = (F.col("link_a").cast("long") * b_entries + F.col("link_b")).cast(kind)
    ordered = rows.select("unit", "end", "a", "b", "part", pair.alias("pair")).sortWithinPartitions("unit", F.desc("end"))

    def digest(table: pa.Table) -> pa.RecordBatch:
        cuts = _cuts(table.column("unit").to_numpy())
        starts, stops = cuts[:-1], cuts[1:]
        count = lambda c: pa.array(np.add.reduceat(pc.is_valid(table.column(c)).to_numpy().astype(np.int64), starts))
        a, b = (table.column(c).cast(pa.string()).to_pylist() for c in ("a", "b"))
        strings = []
        for start, stop in zip(starts.tolist(), stops.tolist()):
            out, left, right = [], [], []
            for i in range(stop - 1, start - 1, -1):  # rows run from the last end back; a part ends where tokens of both do
                x, y = a[i], b[i]
                if x is not None:
                    left.append(x)
                    if y is not None:
                        right.append(y)
                        out += [",".join(left), "|", ",".join(right), ";"]
                        left, right = [], []
                else:
                    right.append(y)
            strings.append("".join(out))
        links = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), table.column("pair").combine_chunks())
        first = lambda c, at: table.column(c).take(pa.array(at)).combine_chunks()
        columns = [first("unit", starts), count("a"), count("b"), first("part", stops - 1).cast(pa.int64()), pa.array(stops - starts), pa.array(strings, pa.string()), links]
        return pa.RecordBatch.from_arrays(columns, ["unit", "n_a", "n_b", "n_groups", "n_links", "groups", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of a unit that may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = batch.column(0).to_numpy()
            if unit[0] == unit[-1] and held and held[-1].column(0)[-1].as_py() == unit[0]:
                held.append(batch)
                continue
            at = 1 + int(np.flatnonzero(unit[:-1] != unit[-1])[-1]) if unit[0] != unit[-1] else 0
            done = pa.Table.from_batches([*held, batch.slice(0, at)])
            held = [batch.slice(at)]
            if done.num_rows:
                yield digest(done)
        if held:
            yield digest(pa.Table.from_batches(held))

    return ordered.mapInArrow(run, f"unit long, n_a long, n_b long, n_groups long, n_links long, groups string, links array<{kind}>")


def _cuts(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the number of values."""
    return np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]])


def _segment_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lane, segment): the distinct segments of each lane of a batch."""
    for batch in batches:
        lanes = batch.column(0).to_numpy()
        cuts = _cuts(lanes).tolist()
        for start, stop in zip(cuts[:-1], cuts[1:]) if len(lanes) else ():
            found = pc.unique(batch.column(1).slice(start, stop - start).flatten())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), lanes[start], dtype=np.int32)), found], ["lane", "segment"])


def _chunks(rows: pa.Table, segments: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, number of rows, words of each, the place of each word in ``segments``), some rows at a time."""
    lists = rows.column("words").combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = ends[start] - sizes[start]
        stop = max(start + 1, int(np.searchsorted(ends, before + WORDS, "right")))
        words = lists.slice(start, stop - start).flatten()
        yield start, stop - start, sizes[start:stop], pc.index_in(words, value_set=segments).to_numpy()
        start = stop


def _lane_pairs(rows: pa.Table, known: pa.Table) -> pa.Table:
    """(pair, n_docs): in how many documents of a lane each pair of ids is linked."""
    _loaded.clear()  # a worker that made tokens needs no tokenizers any more
    segments, lists = known.column("segment").combine_chunks(), known.column("links").combine_chunks()
    whole, n_links = known.column("whole").to_numpy(), pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
    pairs, codes = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    codes, starts = codes.astype(np.int32), np.cumsum(n_links) - n_links
    counts = np.zeros(len(pairs), dtype=np.int64)
    for _, n, sizes, at in _chunks(rows, segments):
        doc = np.repeat(np.arange(n, dtype=np.int64), sizes)
        right = np.ones(n, dtype=bool)
        right[doc[~whole[at]]] = False
        doc, at = np.divmod(np.unique(doc * len(segments) + at), max(1, len(segments)))
        doc, at = doc[right[doc]], at[right[doc]]
        upto = np.cumsum(n_links[at])
        # a document's links are counted together, and some documents at a time
        a = 0
        while a < len(doc):
            b = int(np.searchsorted(upto, (upto[a - 1] if a else 0) + WORDS, "right"))
            b = int(np.searchsorted(doc, doc[b], "left")) if b < len(doc) else b
            b = b if b > a else int(np.searchsorted(doc, doc[a], "right"))
            size = n_links[at[a:b]]
            places = np.repeat(starts[at[a:b]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            linked = np.unique(np.repeat(doc[a:b] - doc[a], size) * len(pairs) + codes[places])
            counts += np.bincount(linked % len(pairs), minlength=len(pairs))
            a = b
    held = counts > 0
    pa.default_memory_pool().release_unused()
    return pa.table({"pair": pa.array(pairs[held]), "n_docs": pa.array(counts[held], pa.int64())})


NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def _lane_documents(hashed: bool):
    """The results of a lane's documents: sums and joined groups of their segments, in order; with ``hashed`` the SHA-256 of the
    groups (of none the empty string) instead of them."""

    def run(rows: pa.Table, known: pa.Table) -> pa.Table:
        _loaded.clear()
        segments, groups = known.column("segment").combine_chunks(), known.column("groups").combine_chunks().cast(pa.large_string())
        whole = known.column("whole").to_numpy()
        # a group's ids are one more than the commas of either side, and its links as many as the ids less one
        n_a, n_best, count_sum = (pc.fill_null(known.column(c), 0).to_numpy() for c in ("n_a", "n_best", "count_sum"))
        n_groups = pc.fill_null(pc.count_substring(groups, ";"), 0).to_numpy()
        n_ids = pc.fill_null(pc.count_substring(groups, ","), 0).to_numpy() + 2 * n_groups
        numbers = [n_a, n_ids - n_a, n_groups, n_ids - n_groups, n_best, count_sum]
        sums, strings, none = np.zeros((rows.num_rows, len(NUMBERS)), dtype=np.int64), [], pa.scalar("", pa.large_string())
        for first, n, sizes, at in _chunks(rows, segments):
            ends = np.concatenate([[0], np.cumsum(sizes)])
            right = sizes > 0
            right[np.repeat(np.arange(n), sizes)[~whole[at]]] = False
            some = np.flatnonzero(sizes > 0)
            for i, values in enumerate(numbers if len(some) else []):
                sums[first + some, i] = np.add.reduceat(values[at], ends[some])
            sums[first : first + n][~right] = 0
            joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pc.fill_null(groups.take(pa.array(at)), "")), none)
            joined = pc.ascii_rtrim(pc.if_else(pa.array(right), joined, none), ";")
            strings.append(pa.array([hashlib.sha256(x.as_buffer()).hexdigest() if len(x.as_buffer()) else "" for x in joined]) if hashed else joined.cast(pa.string()))
        text = pa.chunked_array(strings, pa.string())
        pa.default_memory_pool().release_unused()
        return pa.table({"doc_id": rows.column("doc_id"), **{c: sums[:, i] for i, c in enumerate(NUMBERS)}, "groups": text})

    return run


def align_documents(docs: DataFrame, byte_level_path: str, piece_path: str, hashed: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each row of ``docs`` (doc_id, text).

    The byte-level tokenizer (A) encodes a space and the text, the piece model (B) the text, before which it puts the
    space itself. Tokens are without special ones, whose strings in a text are plain text. ``groups`` has the ids between
    places where tokens of both end, like "a1,a2|b1;a3|b2,b3". ``n_links`` counts pairs of occurrences whose bytes
    overlap; the count of a pair of ids is the number of documents (rows) that have it linked; ``n_best`` counts links whose
    count is the highest of their A id, ties included, and ``count_sum`` sums the counts of all links.

    Null and empty texts, and texts whose joined bytes of A or B differ from a space and the text (as U+2581 makes them),
    have no tokens: zeros and empty groups. With ``hashed`` the groups are hashed where they are made. Rows that repeat are
    documents of their own; a null id passes. Other columns are ignored; an empty table gives an empty result. A vocabulary
    that does not allow cuts before spaces is refused. A document is in one lane as a whole, however long.
    """
    scratch = Scratch(docs.sparkSession, "alignment")
    with scratch.guarded():
        return _align(docs, byte_level_path, piece_path, hashed, scratch)


def _align(docs: DataFrame, byte_level_path: str, piece_path: str, hashed: bool, scratch: Scratch) -> DataFrame:
    spark = docs.sparkSession
    with open(byte_level_path, "rb") as f, open(piece_path, "rb") as g:  # on the driver
        a_file, b_file = f.read(), g.read()
    packed = zlib.compress(a_file, 9), zlib.compress(b_file, 9)
    a_bytes, b_bytes = _byte_level_json(a_file.decode("utf-8")), _pieces(b_file)
    a_lengths, b_lengths = (spark.createDataFrame([(i, len(x)) for i, x in enumerate(entries)], "id int, bytes int") for entries in (a_bytes, b_bytes))
    kind = _pair_type(len(a_bytes), len(b_bytes))

    # lanes of rows, each with the distinct segments that it needs
    text = F.col("text").cast("string")
    total = docs.agg(F.sum(F.octet_length(text)).alias("n")).first().n or 0
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lanes = max(1, width, -(-total // LANE_BYTES))
    tasks = min(lanes, TASKS)
    words = F.when(F.octet_length("text") > 0, F.split(F.concat(F.lit(" "), "text"), CUT, -1))
    rows = spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))).withColumn("lane", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(lanes)).cast("int"))
    rows = scratch.write_sorted(rows.repartition(tasks, "lane").select("lane", "doc_id", words.alias("words")), "rows", ["lane"], buckets=tasks)
    needed = rows.select("lane", "words").where("words is not null").mapInArrow(_segment_lists, "lane int, segment string")
    segments = needed.repartition("segment").groupBy("segment").agg(F.collect_set("lane").alias("lanes"))  # few repeat in a task
    coded = segments.mapInArrow(_encoder(*packed), "segment string, lanes array<int>, a array<int>, b array<int>, whole boolean").withColumn("unit", F.monotonically_increasing_id())
    with setting(spark, GROUPED, str(1 << 20)):
        coded = scratch.write(coded, "segments")
    with setting(spark, COLOCATED, "false"):
        dealt = coded.where("whole").select("unit", "a", "b").repartition("unit")
        digests = scratch.write(unit_digests(aligned(dealt, a_lengths, b_lengths), len(a_bytes), len(b_bytes)), "digests")

    def by_lane(results: DataFrame):
        """Rows and the results of their lane's segments; a segment whose bytes differ has no results."""
        sent = results.select(F.explode("lanes").alias("lane"), *[c for c in results.columns if c != "lanes"])
        return rows.groupBy("lane").cogroup(sent.repartition(tasks, "lane").groupBy("lane"))

    # in how many documents a pair is linked, and what that makes for each segment
    known = coded.select("unit", "segment", "lanes", "whole")
    linked = known.join(digests.select("unit", "links"), "unit", "left").drop("unit")
    counted = by_lane(linked).applyInArrow(_lane_pairs, f"pair {kind}, n_docs long").groupBy("pair").agg(F.sum("n_docs").alias("n_docs"))
    best = F.col("n_docs") == F.max("n_docs").over(Window.partitionBy(F.expr(f"pair div {len(b_bytes)}")))  # a vocabulary's entries at most
    pairs = scratch.write(counted.withColumn("best", best.cast("long")), "pairs")
    scored = digests.select("unit", F.explode("links").alias("pair")).join(pairs, "pair").groupBy("unit").agg(F.sum("best").alias("n_best"), F.sum("n_docs").alias("count_sum"))
    scored = scratch.write(known.join(digests.select("unit", "n_a", "groups").join(scored, "unit"), "unit", "left").drop("unit"), "scored")
    scratch.drop(coded, digests, pairs)
    found = by_lane(scored).applyInArrow(_lane_documents(hashed), f"doc_id long, {', '.join(f'{c} long' for c in NUMBERS)}, groups string")
    found = scratch.write(found, "documents")
    scratch.drop(rows, scored)
    return found


def alignment_digests(docs: DataFrame, byte_level_path: str, piece_path: str) -> DataFrame:
    """``align_documents`` with the SHA-256 of the groups instead of them; the digest of no groups is the empty string."""
    return align_documents(docs, byte_level_path, piece_path, hashed=True).withColumnRenamed("groups", "groups_sha256")
