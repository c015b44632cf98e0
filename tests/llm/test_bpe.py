import hashlib
import json

import pytest

from lexspark.llm import bpe
from lexspark.llm.queries import tokenizer_path

TEXTS = ["", None, "hello world", "a", " \n\t x  y ", "It's we'll DON'T 12345 67", "été naïve Straße 日本語 \U0001f600‍", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "ab" * 5000, "z" * 3000, "\x00\x01\xa0  \r\n\r\n", "!!!???%%% &&&***", "é" * 50]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(tokenizer_path())
    out.no_truncation()
    out.no_padding()
    return out


def test_codec_equals_library(library):
    codec = bpe.BytePairCodec(open(tokenizer_path(), encoding="utf-8").read())
    for text in TEXTS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert codec.encode(text) == ids
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)
        for k in range(0, min(len(ids), 40)):  # cut ids leave broken UTF-8
            assert codec.decode(ids[k : k + 3]) == library.decode(ids[k : k + 3], skip_special_tokens=False)


def test_memo_generations(library):
    codec = bpe.BytePairCodec(open(tokenizer_path(), encoding="utf-8").read())
    text = " ".join(f"word{i} again" for i in range(500))
    old, bpe.MEMO = bpe.MEMO, 50
    try:
        assert codec.encode(text) == library.encode(text, add_special_tokens=False).ids
        assert len(codec.young) <= 50
    finally:
        bpe.MEMO = old


def test_documents(spark, library):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in bpe.round_trip_digests(spark.createDataFrame(rows), tokenizer_path()).collect()}
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_frames(spark):
    rows = [(i, t, "extra", [9]) for i, t in enumerate(TEXTS)] + [(0, "", "extra", [9]), (None, "x", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string, ids array<int>")
    out = bpe.decode(bpe.encode(docs, tokenizer_path()), tokenizer_path(), out_col="back").collect()
    assert len(out) == len(rows)
    assert all(r.back == (r.text or "") for r in out)
    assert bpe.encode(docs.limit(0), tokenizer_path()).collect() == []
    assert bpe.decode(spark.createDataFrame([(None,)], "ids array<int>"), tokenizer_path()).first().decoded == ""


def test_digests_of_odd_rows(spark, library):
    rows = [(i, t, 5, "x") for i, t in enumerate(TEXTS)] + [(0, "", 5, "x"), (0, "", 5, "x"), (None, "hello", None, None), (99, "long word " * 60_000, 1, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids_sha256 string").repartition(3)
    want = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((str(i), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip_digests(docs, tokenizer_path()).collect()) == sorted(want)
    assert bpe.round_trip_digests(docs.limit(0), tokenizer_path()).collect() == []


def test_odd_files_are_refused():
    with open(tokenizer_path(), encoding="utf-8") as f:
        spec = json.load(f)
    changes = [("model", "dropout", 0.1), ("model", "ignore_merges", True), ("model", "byte_fallback", True), ("model", "end_of_word_suffix", "</w>"), ("pre_tokenizer", "use_regex", False), ("pre_tokenizer", "add_prefix_space", True), ("pre_tokenizer", "type", "Whitespace")]
    for part, key, value in changes:
        with pytest.raises(ValueError):
            bpe.BytePairCodec(json.dumps(spec | {part: spec[part] | {key: value}}))
