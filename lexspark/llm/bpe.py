"""Byte-level BPE: encoding with a priority queue of merge ranks over a doubly linked list of symbols, and decoding.

The tokenizer file (the JSON of the public ``tokenizers`` library) is a parameter. Its text travels to the executors
inside the task closure, so no executor needs the path.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import zlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

#: The word pattern of byte-level BPE vocabularies.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words in each of the two generations of the memo; memory stays bounded however many words there are.
MEMO = 200_000
#: Longer words are merged anew each time.
MEMO_WORD = 64


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1 is itself, the others go from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class BytePairCodec:
    """Encodes and decodes single texts.

    ``encode`` equals the library's ``encode(text, add_special_tokens=False).ids`` and ``decode`` its
    ``decode(ids, skip_special_tokens=False)`` for byte-level BPE files without normaliser. Added tokens in a text are
    matched first, leftmost and longest. Null is an empty text.
    """

    def __init__(self, source: str):
        spec = json.loads(source)
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        if model.get("type", "BPE") != "BPE" or before.get("type") != "ByteLevel" or spec.get("normalizer") or before.get("add_prefix_space"):
            raise ValueError("a byte-level BPE file without normaliser or prefix space is needed")
        odd = [k for k in ("dropout", "ignore_merges", "byte_fallback", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "unk_token") if model.get(k)]
        if odd or not before.get("use_regex", True) or (spec.get("decoder") or {"type": "ByteLevel"}).get("type") != "ByteLevel":
            raise ValueError(f"options that change words or merges are not supported: {odd or 'word pattern or decoder'}")
        if any(x.get("single_word") or x.get("lstrip") or x.get("rstrip") for x in spec.get("added_tokens", [])):
            raise ValueError("added tokens with word or strip rules are not supported")
        symbols = byte_symbols()
        back = {c: b for b, c in enumerate(symbols)}
        vocab = model["vocab"]
        self.first = [vocab[c] for c in symbols]
        self.pieces = {i: bytes(back[c] for c in t) if all(c in back for c in t) else t.encode() for t, i in vocab.items()}
        self.added = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        self.pieces |= {i: t.encode() for t, i in self.added.items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.split = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.words = regex.compile(WORDS)
        self.decimals = {i: str(i) for i in self.pieces}
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def merge(self, word: str) -> tuple[int, ...]:
        """The symbols of one word after all merges, lowest rank first and leftmost among equals."""
        ids = [self.first[b] for b in word.encode("utf-8")]
        n, merges = len(ids), self.merges
        if n < 2:
            return tuple(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        queue = [(m[0], i, m[1]) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(queue)
        while queue:
            rank, i, new = heapq.heappop(queue)
            j = after[i] if ids[i] >= 0 else -1
            if j < 0 or (m := merges.get((ids[i], ids[j]))) is None or m[0] != rank:
                continue  # stale: one of the two has changed since
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if m := merges.get((new, ids[k])):
                    heapq.heappush(queue, (m[0], i, m[1]))
            if (h := before[i]) >= 0 and (m := merges.get((ids[h], new))):
                heapq.heappush(queue, (m[0], h, m[1]))
        return tuple(x for x in ids if x >= 0)

    def word(self, word: str) -> tuple[int, ...]:
        got = self.young.get(word)
        if got is None:
            got = self.old.get(word)
            if got is None:
                got = self.merge(word)
                if len(word) > MEMO_WORD:
                    return got
            if len(self.young) >= MEMO:
                self.old, self.young = self.young, {}
            self.young[word] = got
        return got

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self.split is None or not self.split.search(text):
            return list(chain.from_iterable(map(self.word, self.words.findall(text))))
        out: list[int] = []
        for part in self.split.split(text):
            out += [self.added[part]] if part in self.added else chain.from_iterable(map(self.word, self.words.findall(part)))
        return out

    def decode(self, ids: list[int]) -> str:
        """Unknown ids are left out; bytes that are not UTF-8 become U+FFFD."""
        pieces = self.pieces
        try:
            joined = b"".join(map(pieces.__getitem__, ids))
        except KeyError:
            joined = b"".join(pieces.get(i, b"") for i in ids)
        return joined.decode("utf-8", "replace")


_codecs: dict[bytes, BytePairCodec] = {}


def _codec(packed: bytes) -> BytePairCodec:
    """A worker makes the codec once and keeps it, with its memo, from task to task."""
    if packed not in _codecs:
        _codecs.clear()
        _codecs[packed] = BytePairCodec(zlib.decompress(packed).decode("utf-8"))
    return _codecs[packed]


def _packed(tokenizer_path: str) -> bytes:
    with open(tokenizer_path, "rb") as f:  # on the driver
        return zlib.compress(f.read(), 9)


def encode(docs: DataFrame, tokenizer_path: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``docs`` with a column of token ids (array of int) of the whole texts; a null text has no ids.

    Every other column and row passes unchanged, repeated rows included; a column called ``out_col`` is replaced.
    """
    packed, schema = _packed(tokenizer_path), docs.drop(out_col).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(packed)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            ids = pa.array((codec.encode(t.as_py()) for t in texts), pa.list_(pa.int32()), size=len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, out_col])

    return docs.drop(out_col).mapInArrow(run, schema.add(out_col, ArrayType(IntegerType())))


def decode(rows: DataFrame, tokenizer_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of a column of token ids; null ids give an empty text."""
    packed, schema = _packed(tokenizer_path), rows.drop(out_col).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(packed)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col))
            texts = pa.array((codec.decode([i for i in x.as_py() or [] if i is not None]) for x in ids), pa.string(), size=len(ids))
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, out_col])

    return rows.drop(out_col).mapInArrow(run, schema.add(out_col, StringType()))


def round_trip_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row: encoded and decoded in one pass over the texts.

    The digests are over the decimal ids joined by commas and over the decoded text in UTF-8. A null text is empty; a
    null id and repeated rows pass. Other columns are ignored; an empty table gives an empty result.
    """
    packed = _packed(tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(packed)
        for batch in batches:
            counts, coded, decoded = [], [], []
            for text in batch.column(1):
                ids = codec.encode(text.as_py())
                counts.append(len(ids))
                coded.append(hashlib.sha256(",".join(map(codec.decimals.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
