import re

from lexspark.llm import _scratch, line_dedup
from lexspark.llm._scratch import Scratch, hot_join, merging, setting

STRIP = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs, min_chars, keep_first=False):
    docs = {}
    for i, t in {*rows}:
        for line in (t or "").split("\n"):
            docs.setdefault(line.strip(STRIP).translate(LOWER), set()).update([] if i is None else [i])
    frequent = {k: v for k, v in docs.items() if len(k) >= min_chars and len(v) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = []
        for line in lines:
            key = line.strip(STRIP).translate(LOWER)
            if key not in frequent or keep_first and min(frequent[key]) == i:
                kept.append(line)
        out.append((str(i), "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out)


def run(docs, **how):
    return sorted((str(r.doc_id), r.text or "", r.n_lines, r.n_dropped) for r in line_dedup.dedup_lines(docs, **how).collect())


ROWS = [(i, f"  Home\tPage \nonly {i}\nÉtat {i % 2}\n\nLAST") for i in range(12)] + [(50, None), (51, ""), (52, "\n\n"), (53, "home\tpage\nhome\tpage\nx"), (54, "HOME\tPAGE\x0b\r"), (55, "état 0"), (55, "état 0"), (56, "\n".join(["last", "new"] * 30000))]
ROWS += [(60, f"one id\nin {i} rows\nstate {i}") for i in range(12)] + [(None, "one id\nstate 1\nhome\tpage")] * 2 + [(70 + i, "state 1\nlate") for i in range(4)]


def test_brute_force(spark):
    docs = spark.createDataFrame([(*r, "a", 1, 2, 3, 4, 5) for r in ROWS], "doc_id long, text string, lang string, n_lines int, r1 int, gone int, row int, batch int").repartition(4)
    for how in ({"min_docs": 10}, {"min_docs": 2}, {"min_docs": 3, "min_chars": 5}, {"min_docs": 3, "keep_first": True}, {"min_docs": 2, "batches": 7, "fanout": 3}):
        assert run(docs, **how) == brute(ROWS, how["min_docs"], how.get("min_chars", 1), how.get("keep_first", False))
    assert set(line_dedup.dedup_lines(docs).columns) == {"doc_id", "text", "lang", "r1", "gone", "row", "batch", "n_lines", "n_dropped"}


def test_heavy_lines(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "hot_join", lambda *a: hot_join(*a, least=20))
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert run(docs, min_docs=3) == brute(ROWS, 3, 1)


def test_the_anti_join_decides(spark, monkeypatch):
    rows = [r for r in ROWS if r[0] != 56]  # whose lines are most of all, and so nearly all of the batches
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 10, 1)
    assert run(docs, min_docs=10) == want
    for wrong in (lambda self, lines: lines, lambda self, lines: lines.where("false"), lambda self, lines: lines.where("h1 > 0")):
        monkeypatch.setattr(line_dedup.LineRuns, "unseen", wrong)
        assert run(docs, min_docs=10) != want


def test_null_ids_and_empty(spark):
    docs = spark.createDataFrame([(None, "a\nb"), (None, "a\nb"), (1, "a\nc"), (2, "a")], "doc_id long, text string")
    assert run(docs, min_docs=2) == [("1", "c", 2, 1), ("2", "", 1, 1), ("None", "b", 2, 1), ("None", "b", 2, 1)]
    assert run(docs, min_docs=3) == sorted((str(i), t, t.count("\n") + 1, 0) for i, t in [(None, "a\nb"), (None, "a\nb"), (1, "a\nc"), (2, "a")])
    assert run(docs.limit(0)) == []
    named = spark.createDataFrame([("b", "x\ny"), ("a", "x\nz")], "doc_id string, text string")
    assert run(named, min_docs=2, keep_first=True) == [("a", "x\nz", 2, 0), ("b", "y", 2, 1)]


BATCH = "h1 long, h2 long, n_docs long, n_rows long, first_doc long"


def test_runs(spark):
    runs = line_dedup.LineRuns(spark, Scratch(spark, "test"), fanout=2)
    for i in range(5):
        run = runs.add(spark.createDataFrame([(k, k, 1, 2, i) for k in range(i, i + 10)], BATCH))
        assert {r.h1 for r in run.where("new").collect()} == ({*range(10)} if i == 0 else {i + 9})
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    assert {r.h1 for r in runs.unseen(spark.createDataFrame([(3, 3), (13, 13), (14, 14)], "h1 long, h2 long")).collect()} == {14}
    got = {r.h1: (r.n_docs, r.n_rows, r.first_doc) for r in runs.totals().collect()}
    times = {k: min(k, 4) - max(0, k - 9) + 1 for k in range(14)}
    assert got == {k: (n, 2 * n, max(0, k - 9)) for k, n in times.items()}


def test_runs_merge_without_a_shuffle(spark):
    scratch = Scratch(spark, "test")
    runs = line_dedup.LineRuns(spark, scratch, fanout=2)
    batches = [scratch.write_sorted(spark.range(i, i + 4000).selectExpr("id h1", "id h2", "1L n_docs", "1L n_rows", f"{i}L first_doc").repartition(8, "h1", "h2"), "batch", ["h1", "h2"]) for i in range(4)]
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        for batch in batches[:3]:
            runs.add(batch)
        with merging(spark):
            for frame in (runs.unseen(batches[3]), runs.merged(*runs.runs()), runs.totals()):
                plan = frame._jdf.queryExecution().executedPlan().toString()
                assert "SortMergeJoin" in plan and "Exchange" not in plan and not re.search(r"\bSort \[", plan), plan


def test_main_path_is_native():
    assert not re.search("pandas|Arrow|udf|rdd", open(line_dedup.__file__).read().replace('"""', ""))


def test_scratch_goes(spark):
    scratch = Scratch(spark, "test")
    table = scratch.write(spark.range(5), "t")
    assert table.count() == 5 and _scratch.remove_all(spark) >= 1 and _scratch.remove_all(spark) == 0
    assert not spark._jvm.java.io.File(scratch.root.removeprefix("file:")).exists()
