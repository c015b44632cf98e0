"""Conflict-constrained best-fit packing of documents into training sequences.

A bin holds pieces of at most ``capacity`` bytes in all, at most one document of a source and at most one of a cluster
of duplicates; it carries both facts as a bitmap. Open bins stand in order of their residual space. A piece goes to
the tightest bin that fits and has none of its bits: the search takes the successor of the piece's length and goes on
to larger residuals while bins conflict. A tree over the residuals keeps, for each range, the bits that *all* its bins
share, so the search steps over whole ranges that cannot take the piece.

Best fit is sequential, so documents are dealt by a hash of their id into shards of bounded size that are packed side
by side. A hot source or cluster is spread evenly by that hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Documents of a shard, on average. It bounds a task's memory, and more of them would hardly fill bins better.
SHARD_DOCS = 20_000


class Bins:
    """Open bins by residual space 0..capacity, with conflict bitmaps."""

    def __init__(self, capacity: int):
        self.leaves = 1 << (capacity + 1).bit_length()
        # The bits of every bin below, moved up by one; -1 (all bits) where there is none. Bit 0 is never a bin's, so a
        # search that asks for it as well takes empty ranges for conflicts.
        self.shared: list[int] = [-1] * (2 * self.leaves)
        self.at: dict[int, list[tuple[int, int]]] = {}  # residual: (bin, bitmap) in order of opening

    def _update(self, residual: int, bits: int) -> None:
        i = self.leaves + residual
        self.shared[i] = bits
        while i > 1:
            i >>= 1
            bits = self.shared[2 * i] & self.shared[2 * i + 1]
            if self.shared[i] == bits:
                break
            self.shared[i] = bits

    def put(self, residual: int, number: int, bits: int) -> None:
        self.at.setdefault(residual, []).append((number, bits))
        self._update(residual, self.shared[self.leaves + residual] & (bits << 1))

    def _successor(self, start: int, bits: int) -> int | None:
        """The least residual >= start whose bins do not all share one of ``bits``."""
        i = self.leaves + start
        while True:
            if self.shared[i] & bits:  # on to the next range to the right
                while i & 1:
                    i >>= 1
                if not i:
                    return None
                i += 1
            elif i >= self.leaves:
                return i - self.leaves
            else:
                i *= 2

    def take(self, length: int, bits: int) -> tuple[int, int, int] | None:
        """Removes and returns (residual, bin, bitmap) of the tightest compatible bin; among equals the oldest."""
        start, asked = length, bits << 1 | 1
        while start < self.leaves and (found := self._successor(start, asked)) is not None:
            entries = self.at[found]
            for k, (number, b) in enumerate(entries):
                if not b & bits:
                    del entries[k]
                    shared = -1
                    for _, rest in entries:
                        shared &= rest << 1
                    self._update(found, shared)
                    return found, number, b
            start = found + 1  # its bins conflict one by one, though they share no bit
        return None


def pack(items: list[tuple], capacity: int) -> list[tuple]:
    """(index, piece, offset, length, bin, start) for each piece of ``items`` (length, source, cluster).

    Longest first, ties by index. An item longer than ``capacity`` fills bins of its own; its last piece is packed
    like any other. Items of length 0 take part as well: they need a compatible bin, but no space.
    """
    sources: dict = {}
    seen: dict = {}
    for _, source, cluster in items:
        if source is not None:
            sources.setdefault(source, len(sources))
        if cluster is not None:
            seen[cluster] = seen.get(cluster, 0) + 1
    clusters: dict = {}
    for cluster, n in seen.items():
        if n > 1:  # a cluster alone in its shard cannot conflict
            clusters[cluster] = len(sources) + len(clusters)
    out, bins, opened = [], Bins(capacity), 0
    tails = []
    for index, (length, source, cluster) in enumerate(items):
        bits = (1 << sources[source] if source is not None else 0) | (1 << clusters[cluster] if cluster in clusters else 0)
        full = max(0, (length - 1) // capacity)
        for piece in range(full):
            out.append((index, piece, piece * capacity, capacity, opened, 0))
            opened += 1
        tails.append((-(length - full * capacity), index, full, bits))
    for negative, index, piece, bits in sorted(tails, key=lambda x: x[:2]):
        length = -negative
        got = bins.take(length, bits)
        residual, number, held = got or (capacity, opened, 0)
        opened += got is None
        out.append((index, piece, piece * capacity, length, number, capacity - residual))
        bins.put(residual - length, number, held | bits)
    return out


def _packer(capacity: int):
    columns = ["doc_id", "source", "cluster", "shard", "bin", "piece", "piece_offset", "piece_bytes", "bin_start", "doc_bytes"]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]

    def flush(shard: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        packed = [(rows[i][0], rows[i][2], rows[i][3], shard, number, piece, offset, length, start, rows[i][1]) for i, piece, offset, length, number, start in pack([r[1:4] for r in rows], capacity)]
        for k in range(0, len(packed), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*packed[k : k + 10_000]), types)], columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != shard:
                    if rows:
                        yield from flush(shard, rows)
                    shard, rows = row[0], []
                rows.append(row[1:])
        if rows:
            yield from flush(shard, rows)

    return run


PACKED = "doc_id long, source string, cluster string, shard long, bin long, piece long, piece_offset long, piece_bytes long, bin_start long, doc_bytes long"


def best_fit(docs: DataFrame, capacity: int = 8192, cluster_col: str | None = None, source_col: str | None = "source", shard_docs: int = SHARD_DOCS) -> DataFrame:
    """A row (``PACKED``) for each piece of each row of ``docs`` (doc_id, text, source, and others).

    ``shard`` and ``bin`` together name a bin; ``bin_start`` is the piece's place in it and ``piece_offset`` the place
    in the document's UTF-8 bytes. Within a bin no two documents share a source or a cluster. The cluster is
    ``cluster_col``, or else a digest of the whole text, so that equal texts never meet in a bin. Only ids, lengths and
    keys travel to the packers, not the texts.

    ``source_col=None`` lets documents of a source meet.

    Null and empty texts are pieces of length 0. A null source conflicts with nothing; a null cluster neither. Repeated
    rows are packed one by one (into different bins, as their clusters are equal). Columns beyond the named ones are
    ignored, an empty table gives an empty result. The result depends on the rows only, not on their order.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    text = F.coalesce("text", F.lit("")).cast("string")
    cluster = F.col(cluster_col).cast("string") if cluster_col else F.md5(text)
    shards = max(1, -(-docs.select(F.lit(1)).count() // shard_docs))
    rows = docs.select(F.pmod(F.xxhash64("doc_id", text), F.lit(shards)).cast("long").alias("shard"), F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("doc_bytes"), (F.col(source_col) if source_col else F.lit(None)).cast("string").alias("source"), cluster.alias("cluster"))
    return rows.repartition("shard").sortWithinPartitions("shard", "doc_id", "doc_bytes", "source", "cluster").mapInArrow(_packer(capacity), PACKED)
