import random

import pytest
from pyspark.sql import functions as F

from lexspark.operators import lexicon, lookup, morph
from lexspark.operators import relational as R


def rows(spark, n=400, parts=1):
    rng = random.Random(4)
    data = [(i, rng.choice("abcde"), rng.randrange(20), rng.random() < 0.3) for i in range(n)]
    return data, spark.createDataFrame(data, "i long, k string, v int, ok boolean").repartition(parts)


@pytest.mark.parametrize("parts", [1, 8])
def test_order_dependent_tools(spark, parts, monkeypatch):
    monkeypatch.setattr(R, "CHUNK", 50)
    data, frame = rows(spark, parts=parts)
    first, best = {}, {}
    for r in data:
        if r[3]:
            first.setdefault(r[1], r)
        if r[1] not in best or r[2] > best[r[1]][2]:
            best[r[1]] = r
    assert {r.k: tuple(r) for r in R.dedupe_first(frame, "k", ["i"], F.col("ok")).collect()} == first
    assert {r.k: tuple(r) for r in R.max_per_key(frame, "k", "v", ["i"]).collect()} == best
    total, want = 0, {}
    for r in data:
        want[r[0]] = total
        total += r[2]
    assert {r.i: r.s for r in R.running(frame, "i", {"s": (F.col("v"), "sum")}).collect()} == want
    stop = next(r[0] for r in data if r[2] == 0)
    assert sorted(r.i for r in R.prefix_until(frame, "i", F.col("v") == 0).collect()) == list(range(stop))
    done, kept = 0, []
    for r in data:
        if done < 25:
            kept.append(r[0])
        done += r[3]
    assert sorted(r.i for r in R.until_enough(frame, "i", F.col("ok"), 25).collect()) == kept
    assert R.until_enough(frame, "i", F.col("ok"), 0).count() == 400
    for skip, keep in ((0, 100), (10, 33.3), (99, 50), (100, 10), (0, 0)):
        a = int(400 * skip / 100)
        assert sorted(r.i for r in R.percentile_slice(frame, ["i"], skip, keep).collect()) == list(range(a, min(400, a + int(400 * keep / 100))))


def test_running_reads_twice_and_cuts_evenly(spark, monkeypatch):
    monkeypatch.setattr(R, "CHUNK", 100)
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(len(b))
            yield b

    # half of the ids are far away from the others
    wide = spark.range(2000).selectExpr("id + (id div 1000) * (1L << 50) AS i", "id % 7 AS v").repartition(4)
    got = R.running(wide.mapInPandas(seen, "i long, v long"), "i", {"n": (F.lit(1), "sum"), "s": (F.col("v"), "sum"), "m": (F.col("v"), "max")})
    rows = sorted(tuple(r) for r in got.collect())
    got.count()
    assert read.value <= 4000
    vs = [r[1] for r in rows]
    assert [r[2:] for r in rows] == [(k, sum(vs[:k]), max(vs[:k], default=0)) for k in range(2000)]
    sizes = [r["count"] for r in R.in_pieces(wide, "i").groupBy("_piece").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 200


def test_conll_reads_twice(spark, monkeypatch):
    rng, read = random.Random(7), spark.sparkContext.accumulator(0)
    lines = ["header"] + [rng.choice(["", " ", f"{i} f l P X", f"{i}\tf\tl\tP\tX", "a b"]) for i in range(600)]

    def seen(batches):
        for b in batches:
            read.add(len(b))
            yield b

    want, sentence, tokens = [], 0, 0
    for i, line in enumerate(lines):
        if i and not line.strip():
            sentence, tokens = sentence + (tokens > 0), 0
        elif i and len(line.split()) >= 5:
            want.append((i, sentence))
            tokens += 1
    frame = spark.createDataFrame(list(zip(lines, [i << 33 for i in range(601)])), "line string, row_idx long").repartition(3)
    for chunk in (1, 13, 10_000):
        monkeypatch.setattr(R, "CHUNK", chunk)
        read.value = 0
        got = sorted((r.row_idx >> 33, r.sentence_id) for r in morph.conll_tokens(frame.mapInPandas(seen, "line string, row_idx long")).collect())
        assert got == want and read.value <= 1202
        closed = sorted((r.row_idx >> 33, r.sentence_id) for r in morph.conll_tokens(frame, drop_open_end=True).collect())
        assert closed == [x for x in want if x[1] < sentence]


def test_spread(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one"))
    one = spark.read.parquet(str(tmp_path / "one"))
    cores = spark.sparkContext.defaultParallelism
    assert R.spread(one).rdd.getNumPartitions() == cores and R.spread(one).count() == 100
    assert R.spread(spark.range(100, numPartitions=2 * cores)).rdd.getNumPartitions() == 2 * cores
    shuffled = one.groupBy("id").count()
    assert R.spread(shuffled) is shuffled


def test_empty(spark):
    _, frame = rows(spark)
    none = frame.limit(0)
    assert R.dedupe_first(none, "k", ["i"]).collect() == R.running(none, "i", {"s": (F.col("v"), "sum")}).collect() == R.prefix_until(none, "i", F.lit(True)).collect() == R.percentile_slice(none, ["i"], 10, 50).collect() == []


def test_suffix_and_sets(spark):
    frame = spark.createDataFrame([("singing",), ("singer",), ("s",), ("x",)], "w string")
    assert [r.s for r in frame.select(R.first_suffix(F.col("w"), ["er", "g", "ing", "s"]).alias("s")).collect()] == ["g", "er", "s", None]
    assert R.same_rows(frame, frame.repartition(4)) and not R.same_rows(frame, frame.union(frame))


def test_combine(spark):
    tagged = spark.createDataFrame([(" Foo ", "NOUN", "d1", 0, 0), ("foos", "X", "no", 0, 1), ("Fooa", "NOUN", "d2", 0, 2), ("fooa", "NOUN", "late", 0, 3), ("Fooa", "VERB", "aug", 1, 0), ("foos", "NAT", "no", 1, 1), ("foos", "ADJ", None, 1, 2)], "word string, tag string, definition string, source_ord int, row_idx long")
    counts = spark.createDataFrame([("fooa", "7", 0), ("Fooa ", "9", 1), ("Fooa", "11", 2), ("Fooa", "x", 3), ("foos", "3", 4)], "word string, count string, row_idx long")
    boosted = spark.createDataFrame([("FOOS",), ("foos",)], "word string")
    got = {r.word: tuple(r)[1:] for r in lexicon.combine(tagged, counts, least_weight=1, boosted=boosted).collect()}
    assert got == {"fooa": (12, "NOUN", "d2"), "foos": (40000, "ADJ", None)}


def test_retry_loop(spark):
    words = spark.createDataFrame([(i,) for i in range(20)], "word long")
    rounds = []

    def attempt(frame, n):
        rounds.append(frame.count())
        return frame.withColumn("outcome", F.when(F.col("word") < 3 + 3 * n, "VALIDATED").when(F.col("word") % 2 == n % 2, "NONEXISTENT").otherwise("RETRY"))

    out = {r.word: (r.outcome, r["round"]) for r in lookup.retry_until_stable(words, attempt).collect()}
    assert rounds == [20, 14, 11, 8, 5, 2] and out[0] == ("VALIDATED", 1) and out[19] == ("VALIDATED", 6) and len(out) == 20


def test_retry_stream_goes_on_where_it_was_stopped(spark, tmp_path):
    words = spark.createDataFrame([(i, "x") for i in range(20)], "word long, more string")
    rounds, broken = [], [3]

    def attempt(frame, n):
        rounds.append((n, frame.count()))
        if n in broken:
            broken.remove(n)
            raise RuntimeError("stopped half-way")
        return frame.withColumn("outcome", F.when(F.col("word") < 3 + 3 * n, "VALIDATED").when(F.col("word") % 2 == n % 2, "NONEXISTENT").otherwise("RETRY"))

    with pytest.raises(Exception, match="stopped half-way"):
        lookup.retry_stream(words, attempt, str(tmp_path / "s"))
    assert rounds == [(1, 20), (2, 14), (3, 11)]
    out = {r.word: (r.outcome, r["round"]) for r in lookup.retry_stream(words, attempt, str(tmp_path / "s")).collect()}
    assert rounds[3:] == [(3, 11), (4, 8), (5, 5), (6, 2)]
    assert out == {r.word: (r.outcome, r["round"]) for r in lookup.retry_until_stable(words, attempt).collect()}
    asked = len(rounds)
    assert lookup.retry_stream(words, attempt, str(tmp_path / "s")).count() == 20 and len(rounds) == asked


def test_retry_stream_stops_when_nothing_changes(spark, tmp_path):
    words = spark.range(10).toDF("word")
    attempt = lambda frame, n: frame.withColumn("outcome", F.when(F.col("word") < 4, "NONEXISTENT").when((F.col("word") == 9) & (F.lit(n) < 3), "RETRY").otherwise("VALIDATED"))
    got = {r.word: (r.outcome, r["round"]) for r in lookup.retry_stream(words, attempt, str(tmp_path / "s")).collect()}
    assert got == {r.word: (r.outcome, r["round"]) for r in lookup.retry_until_stable(words, attempt).collect()}
    assert lookup.retry_stream(words.limit(0), attempt, str(tmp_path / "e")).count() == 0


def test_pieces_are_even_whatever_tasks_hold(spark, monkeypatch):
    monkeypatch.setattr(R, "CHUNK", 500)
    for rows in (spark.range(0, 20_000, 1, 8), spark.range(20_000).repartition(8), spark.range(20_000).select((F.col("id") * F.col("id")).alias("id")).coalesce(1)):
        sizes = [r["count"] for r in R.in_pieces(rows, "id").groupBy("_piece").count().collect()]
        assert len(sizes) == 40 and max(sizes) <= 700


def test_kept_tables_are_columns_and_can_be_forgotten(spark, monkeypatch):
    R.forget(spark)
    monkeypatch.setattr(R, "CHUNK", 100)
    rows = spark.range(1000).select("id", F.lit("wide").alias("text"))
    out = R.running(rows, "id", {"before": (F.lit(1).cast("long"), "sum")})
    plan = out.select("before")._jdf.queryExecution().executedPlan().toString()
    assert "parquet" in plan.lower() and "text" not in "".join(x for x in plan.splitlines() if "ReadSchema" in x or "FileScan" in x)
    assert [r.before for r in out.orderBy("id").collect()] == list(range(1000))
    assert R.forget(spark) == 1 and R.forget(spark) == 0


def test_classify(spark):
    snapshot = spark.createDataFrame([("foo", 200, ["e"]), ("Foo", 200, ["E"]), ("bar", 404, None), ("Bar", 200, ["B"]), ("baz", 200, []), ("Baz", 404, None), ("qux", 200, None), ("no", 404, None), ("No", 404, None)], "title string, status int, entries array<string>")
    tokens = spark.createDataFrame([("Foo_NOUN",), ("bar",), ("baz",), ("qux",), ("no_x",), ("no",), ("gone",)], "token string")
    plain = {r.token: (r.outcome, r.entries) for r in lookup.classify(tokens, snapshot).collect()}
    assert plain == {"Foo_NOUN": ("VALIDATED", ["E"]), "bar": ("NONEXISTENT", None), "baz": ("REJECTED", None), "qux": ("RETRY", None), "no_x": ("RETRY", None), "no": ("NONEXISTENT", None), "gone": ("RETRY", None)}
    cap = {r.token: (r.outcome, r.entries) for r in lookup.classify(tokens, snapshot, cap=True).collect()}
    assert cap == {"Foo_NOUN": ("VALIDATED", ["e", "E"]), "bar": ("VALIDATED", ["B"]), "baz": ("REJECTED", None), "qux": ("RETRY", None), "no_x": ("RETRY", None), "no": ("NONEXISTENT", None), "gone": ("RETRY", None)}


def test_conll(spark):
    text = ["header", "1 a l P NN", "2 b l P VB x", "short line", "", "", "3 c l P XX", " ", "", "4 d l P NN"]
    lines = spark.createDataFrame([(t, i) for i, t in enumerate(text)], "line string, row_idx long")
    tokens = morph.conll_tokens(lines)
    assert [(r.sentence_id, r.form) for r in tokens.orderBy("row_idx").collect()] == [(0, "a"), (0, "b"), (1, "c"), (2, "d")]
    assert [(r.sentence_id, r.form) for r in morph.conll_tokens(lines, drop_open_end=True).orderBy("row_idx").collect()] == [(0, "a"), (0, "b"), (1, "c")]
    assert [[t.form for t in r.tokens] for r in morph.sentences(tokens).orderBy("sentence_id").collect()] == [["a", "b"], ["c"], ["d"]]


def test_observed(spark):
    frame, seen = lookup.observed(spark.createDataFrame([("RETRY",), ("VALIDATED",), ("RETRY",)], "outcome string"))
    frame.collect()
    assert seen.get == {"processed": 3, "validated": 1, "rejected": 0, "nonexistent": 0, "retry": 2}


def test_spread(spark, tmp_path):
    import duckdb

    cores = spark.sparkContext.defaultParallelism
    path, n = str(tmp_path / "t.parquet"), 400_000
    # one row group: of all its splits one has the rows
    duckdb.sql(f"COPY (SELECT i, md5(i::VARCHAR) AS s FROM range({n}) r(i)) TO '{path}' (FORMAT parquet, ROW_GROUP_SIZE {n})")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        frame = spark.read.parquet(path)
        assert frame.rdd.getNumPartitions() >= cores
        sizes = lambda f: [r["count"] for r in f.groupBy(F.spark_partition_id()).count().collect()]
        assert sizes(frame) == [n]
        out = R.spread(frame)
        assert max(sizes(out)) <= 2 * n / cores and out.exceptAll(frame).isEmpty() and out.count() == n
        narrow = R.spread(frame.select("i"), 10_000)
        assert max(sizes(narrow)) < 12_000 and narrow.distinct().count() == n
        assert R.spread(out) is out
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert R.spread(spark.range(0, 10, 1, cores), 100).count() == R.spread(spark.range(0)).count() + 10
