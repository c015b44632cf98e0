"""The pipeline against a brute-force version of every stage, each on its predecessor's rows."""

import math
from collections import Counter, defaultdict

import corpus_pipeline
from lexspark.llm import packing, quality
from tests.llm.test_line_dedup import LOWER, STRIP
from tests.llm.test_minhash import brute as near_brute

DIR = "/root/testdata/sf0.001"


def grams(text, n):
    t = "\x02" * (n - 1) + (text or "") + "\x03"
    return [t[i : i + n] for i in range(len(t) - n + 1)]


class Model:
    def __init__(self, texts, order):
        self.counts = {order: Counter(g for t in texts for g in grams(t, order))}
        for n in range(order - 1, 0, -1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.order, self.discounts, self.contexts = order, {}, {}
        for n, c in self.counts.items():
            k = Counter(min(v, 5) for v in c.values())
            y = k[1] / (k[1] + 2 * k[2]) if k[1] else 0
            plain = {1: 0.5, 2: 1.0, 3: 1.5}
            d = self.discounts[n] = {i: max(0.01, min(i, i - (i + 1) * y * k[i + 1] / k[i] if k[i] else plain[i])) if k[1] else plain[i] for i in (1, 2, 3)}
            for g, v in c.items():
                total, mass = self.contexts.get(g[:-1], (0, 0))
                self.contexts[g[:-1]] = (total + v, mass + d[min(v, 3)])

    def p(self, g):
        if not g:
            return 1 / (len(self.counts[1]) + 1)
        total, mass = self.contexts.get(g[:-1], (0, 0))
        if not total:
            return self.p(g[1:])
        v = self.counts[len(g)][g]
        return (max(0, v - self.discounts[len(g)][min(v, 3)]) + mass * self.p(g[1:])) / total if v else mass * self.p(g[1:]) / total

    def mean(self, text):
        gs = grams(text, self.order)
        return -sum(math.log(self.p(g)) for g in gs) / len(gs)


def quality_brute(rows, trusted, held):
    models, means = {}, {}
    for lang in {r["lang"] for r in rows}:
        texts = [r["text"] for r in rows if r["lang"] == lang and r["doc_id"] in trusted and r["doc_id"] not in held]
        models[lang] = Model(texts, quality.ORDER) if texts else None
    kept = []
    for r in rows:
        means[r["doc_id"]] = models[r["lang"]].mean(r["text"]) if models[r["lang"]] else None
    judges = [r for r in rows if r["doc_id"] in trusted & held and means[r["doc_id"]] is not None]
    limits = limits_brute({lang: [means[r["doc_id"]] for r in judges if r["lang"] == lang] for lang in {r["lang"] for r in judges}})
    for r in rows:
        mean, limit = means[r["doc_id"]], limits.get(r["lang"])
        if limit is None or mean is None or not r["text"] or mean <= limit:
            kept.append(r)
    return kept


def limits_brute(groups):
    """The quantile of each group; not above its median plus the quantile of all distances, if it is its largest value."""
    nth = lambda values, q: values[math.ceil(len(values) * q) - 1]
    steps = {k: sorted(math.ceil(v * quality.STEP) for v in values) for k, values in groups.items()}
    away = sorted(x - nth(s, 0.5) for s in steps.values() for x in s)
    few = lambda s: math.ceil(len(s) * quality.QUANTILE) == len(s)
    return {k: min(nth(s, quality.QUANTILE), nth(s, 0.5) + nth(away, quality.QUANTILE) if few(s) else math.inf) / quality.STEP for k, s in steps.items()}


def lines_brute(rows):
    docs = defaultdict(set)
    for r in rows:
        for line in (r["text"] or "").split("\n"):
            docs[line.strip(STRIP).translate(LOWER)].add(r["doc_id"])
    out = []
    for r in rows:
        lines = (r["text"] or "").split("\n")
        kept = [x for x in lines if not (k := x.strip(STRIP).translate(LOWER)) or len(docs[k]) < 10 or min(docs[k]) == r["doc_id"]]
        if len(kept) == len(lines):
            out.append(r)
        elif "".join(kept).strip():
            out.append(r | {"text": "\n".join(kept), "n_chars": len("\n".join(kept))})
    return out


def near_rows(rows):
    found = near_brute([(r["doc_id"], r["text"]) for r in rows], 5, 80, 100)
    return [r for r in rows if found[r["doc_id"]][2]]


def ordered(rows):
    return sorted(rows, key=lambda r: r["doc_id"])


def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    trusted = {r.doc_id for r in spark.read.parquet(f"{DIR}/labels.parquet").collect() if r.quality == 1}
    held = {r.doc_id for r in docs.selectExpr("doc_id", f"pmod(xxhash64(3, doc_id), {quality.HELD_OUT}) = 0 as h").collect() if r.h}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "minhash near-dedup", "best-fit packing"]
    for (name, stage), brute in zip(corpus_pipeline.STAGES, (lambda r: quality_brute(r, trusted, held), lines_brute, near_rows)):
        out = stage(spark, docs, DIR)
        assert out.columns == docs.columns
        rows = brute(rows)
        assert ordered(r.asDict() for r in out.collect()) == ordered(rows), name
        docs = spark.createDataFrame(rows, docs.schema)
    got = corpus_pipeline.STAGES[3][1](spark, docs, DIR).collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert {r.doc_id for r in got} == set(by_id)
    shards = defaultdict(dict)
    for r in got:
        shards[r.shard][r.doc_id] = (r.doc_bytes, r.source, r.cluster)
    for shard, items in shards.items():
        order = sorted((i, *v) for i, v in items.items())
        want = {(order[i][0], piece, offset, length, number, start) for i, piece, offset, length, number, start in packing.pack([x[1:] for x in order], 8192)}
        assert {(r.doc_id, r.piece, r.piece_offset, r.piece_bytes, r.bin, r.bin_start) for r in got if r.shard == shard} == want


def test_run_and_odd_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (10**9, "", "en", None, 0), (10**9 + 1, None, "xx", "src0", None), (10**9 + 2, "long " * 50_000, "en", "src1", 250_000)], docs.schema)
    for name, frame in (("some", docs.unionByName(odd)), ("none", docs.limit(0))):
        frame.write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.read.parquet(f"{DIR}/labels.parquet").write.parquet(str(tmp_path / name / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path / "some")).collect()
    ids = {r.doc_id for r in out}
    assert None in ids and 10**9 in ids and 10**9 + 1 in ids
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).collect() == []


def test_repeated_rows_and_clashing_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").limit(60)
    wide = docs.unionByName(docs).selectExpr("*", "doc_id as h1", "text as gone", "1 as row", "2 as batch", "'k' as set_key", "3 as bucket", "true as kept", "4 as threshold", "5 as piece", "6 as bin", "7 as cluster")
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, wide, DIR)
        assert out.columns == wide.columns, name
        rows = [str(r) for r in out.collect()]
        assert rows and all(n == 2 for n in Counter(rows).values()), name
        wide = spark.createDataFrame(out.collect(), wide.schema)
    packed = corpus_pipeline.STAGES[3][1](spark, wide, DIR).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(r.doc_id for r in wide.collect())


def test_line_stage_drops_what_it_empties(spark):
    rows = [(i, "one line\n\nand another", "en", "s", 21) for i in range(12)] + [(20, "", "en", "s", 0), (21, None, "en", "s", None), (22, "\n", "en", "s", 1), (23, "one line\nof its own", "en", "s", 19)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in corpus_pipeline.line_stage(spark, docs, "").collect()}
    assert got == {0: rows[0][1], 20: "", 21: got[21], 22: "\n", 23: "of its own"}
