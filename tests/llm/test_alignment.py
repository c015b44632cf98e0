import hashlib
import json
import os
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexspark.llm import alignment
from lexspark.llm.queries import op11_alignment, tokenizer_path

A, B = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")


def plain(texts):
    """What ``align_documents`` should return, from whole texts and the definition, without segments."""
    import sentencepiece
    from tokenizers import Tokenizer

    byte_level = Tokenizer.from_file(A)
    byte_level.no_truncation()
    byte_level.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    to_byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in printable)}
    vocab = json.load(open(A))["model"]["vocab"]
    a_bytes = {i: bytes(to_byte[c] for c in t) for t, i in vocab.items() if all(c in to_byte for c in t)}
    found, docs = [], defaultdict(int)
    for text in texts:
        ids_a = byte_level.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = pieces.encode(text) if text else []
        parts_a = [a_bytes[i] for i in ids_a]
        parts_b = [bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [pieces.id_to_piece(i)]]
        if not text or not b"".join(parts_a) == b"".join(parts_b) == (" " + text).encode():
            found.append(None)
            continue
        spans = []
        for ids, parts in ((ids_a, parts_a), (ids_b, parts_b)):
            at, out = 0, []
            for i, x in zip(ids, parts):
                out.append((at, at + len(x), i))
                at += len(x)
            spans.append(out)
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups = "".join(";" + "|".join(",".join(str(i) for s, e, i in side if lo < e <= hi) for side in spans) for lo, hi in zip([0, *cuts], cuts))[1:]
        links = [(i, j) for s, e, i in spans[0] for u, v, j in spans[1] if s < v and u < e] if len(text) < 5000 else _sweep(*spans)
        for pair in set(links):
            docs[pair] += 1
        found.append((len(ids_a), len(ids_b), len(cuts), links, groups))
    highest = Counter()
    for (a, _), n in docs.items():
        highest[a] = max(highest[a], n)
    return [(0, 0, 0, 0, 0, 0, "") if x is None else (*x[:3], len(x[3]), sum(docs[p] == highest[p[0]] for p in x[3]), sum(docs[p] for p in x[3]), x[4]) for x in found]


def _sweep(left, right):
    out, j = [], 0
    for s, e, i in left:
        while right[j][1] <= s:
            j += 1
        k = j
        while k < len(right) and right[k][0] < e:
            out.append((i, right[k][2]))
            k += 1
    return out


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


ODD = [
    "", None, " ", "  ", "   ", "\n", "a", " a", "a ", "a  b", "a   b  ", "a\n b", "a \n\n  b\n", "\n\nDe\n", "a\tb \t c", "x\r\ny", "<|endoftext|> <s></s> <0x41> <unk>", "it's I'll 's ' s", "naïve café über ß", "é é ́",
    "漢字かな交じり文 漢字", "😀😃 👩‍👩‍👧 x", " a b 　c", "a▁b c", "▁", "tail ▁", "\u0085a b", "\x00 \x1f\x7f a", "1234567 12 3.14 1,000", "!!! ??? ... --- ==", "a" * 700, "ab " * 400, "ﬁ ﷺ Ǆ", "﻿bom x", "​ z​ w", "ᚠᚢᚦ ᚨ", "a\x0b b\x0c c", "end\n", " a  b",
]


def test_odd_texts_equal_the_definition(spark):
    texts = [*ODD, *ODD[5:12], "the cat sat on the mat " * 3000]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, row string, lane int").repartition(5)
    got = {r.doc_id: tuple(r)[1:] for r in alignment.align_documents(docs, A, B).collect()}
    want = plain(texts)
    assert {i: got[i] for i in got} == dict(enumerate(want))


def test_repeats_null_ids_and_empty_tables(spark):
    texts = ["the same words", "the same words", "other Words", None, ""]
    docs = spark.createDataFrame([(7, texts[0]), (7, texts[1]), (None, texts[2]), (None, None), (3, "")], "doc_id long, text string")
    want = plain(texts)
    assert rows(alignment.align_documents(docs, A, B)) == sorted([(7, *want[0]), (7, *want[1]), (None, *want[2]), (None, *want[3]), (3, *want[4])], key=repr)
    assert alignment.align_documents(docs.limit(0), A, B).collect() == []


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_equals_the_definition_on_whole_tables(spark, sf):
    d = f"/root/testdata/{sf}"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: (*x[:6], hashlib.sha256(x[6].encode()).hexdigest() if x[6] else "") for (i, _), x in zip(docs, plain([t for _, t in docs]))}
    got = op11_alignment(spark, d)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == want


def test_links_of_a_group_are_as_many_as_its_ends(spark):
    """Two tokenizers that meet only at the end: 1000 tokens of three bytes and 1500 of two make no pair by pair join."""
    lengths = spark.createDataFrame([(0, 3), (1, 2)], "id int, bytes int")
    units = spark.createDataFrame([(5, [1] + [0] * 999 + [1], [1] * 1499 + [0])], "unit long, a array<int>, b array<int>")
    out = alignment.aligned(units, lengths, lengths)
    digest = alignment.unit_digests(out, 2, 2).first()
    starts = lambda ids: {sum((3, 2)[i] for i in ids[:k]) for k in range(len(ids))}
    a, b = starts([1] + [0] * 999 + [1]), starts([1] * 1499 + [0])
    assert digest.n_links == len(a | b) == out.count()
    assert digest.n_groups == len((a & b))


def test_pieces_across_spaces_are_refused():
    class Odd:
        is_byte = is_control = is_unknown = staticmethod(lambda i: False)

    with pytest.raises(ValueError):
        alignment._check_pieces(Odd(), ["a", "▁a", "a▁b"])


def test_lanes_in_small_steps_give_the_same(monkeypatch):
    pick = random.Random(4)
    links = [[pick.randrange(9) for _ in range(pick.randrange(1, 6))] for _ in range(30)] + [None]
    words = [None if pick.random() < 0.1 else [f"s{pick.randrange(31)}" for _ in range(pick.randrange(0, 40))] for _ in range(50)]
    rows = pa.table({"lane": [1] * 50, "doc_id": list(range(50)), "words": pa.array(words, pa.list_(pa.string()))})
    known = {"lane": [1] * 31, "segment": [f"s{i}" for i in range(31)], "whole": [i < 30 for i in range(31)]}
    pairs = pa.table(known | {"links": pa.array(links, pa.list_(pa.int32()))})
    numbers = pa.table(known | {c: pa.array([i * k if i < 30 else None for i in range(31)], pa.int64()) for c, k in (("n_a", 0), ("n_best", 4), ("count_sum", 5))} | {"groups": pa.array([f"{i}|{i};" if i < 30 else None for i in range(31)])})
    right = [w if w and "s30" not in w else [] for w in words]
    count = Counter(p for w in right for p in {p for x in w for p in links[int(x[1:])]})
    for together in (1 << 20, 7, 1):
        monkeypatch.setattr(alignment, "WORDS", together)
        got = alignment._lane_pairs(rows, pairs)
        assert dict(zip(got["pair"].to_pylist(), got["n_docs"].to_pylist())) == count
        got = alignment._lane_documents(False)(rows, numbers)
        assert got["groups"].to_pylist() == [";".join(f"{x[1:]}|{x[1:]}" for x in w) for w in right]
        assert got["n_best"].to_pylist() == [sum(4 * int(x[1:]) for x in w) for w in right]


def test_a_failure_leaves_nothing_behind(spark, monkeypatch):
    docs, before, roots = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.catalog.listTables(), []
    make = alignment.Scratch.__init__
    monkeypatch.setattr(alignment.Scratch, "__init__", lambda self, *a: (make(self, *a), roots.append(self.root))[0])

    def broken(*_):
        raise RuntimeError("on the way")

    monkeypatch.setattr(alignment, "aligned", broken)
    with pytest.raises(RuntimeError):
        alignment.align_documents(docs, A, B)
    assert spark.catalog.listTables() == before and not os.path.exists(roots[0])


def test_many_lanes_in_few_tasks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(alignment, "LANE_BYTES", 60)
    monkeypatch.setattr(alignment, "TASKS", 2)
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in alignment.align_documents(docs, A, B).collect()}
    assert got == dict(enumerate(plain(ODD)))
