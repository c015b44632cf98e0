import json
import sys

import lexspark.__main__ as cli
from lexspark.sources import live, readers


def scripted(*answers):
    queue = list(answers)

    def fetch(title):
        a = queue.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    return fetch, queue


def test_dump_policy():
    waits = []
    ok = (200, '{"a": 1}')
    assert live.fetch_dump("w", scripted((503, None), OSError(), (200, "broken"), ok)[0], sleep=waits.append) == ok
    assert waits == [0.5, 1.0, 2.0]
    assert live.fetch_dump("w", scripted((404, None))[0]) == (404, None)
    assert live.fetch_dump("w", scripted((403, None))[0]) == (403, None)
    assert live.fetch_dump("w", scripted((200, "[]"))[0]) == (200, None)
    waits.clear()
    assert live.fetch_dump("w", scripted(*[(429, None)] * 6)[0], sleep=waits.append) == (0, None)
    assert waits == [0.5, 1, 2, 4, 8, 10]


def test_cleanse_policy():
    waits = []
    assert live.fetch_cleanse("w", scripted(*[(429, None)] * 7)[0], sleep=waits.append) == (429, None)
    assert len(waits) == 6 and all(0.8 * b <= a <= 1.2 * b for a, b in zip(waits, (0.75, 1.5, 3, 6, 12, 20)))
    assert live.fetch_cleanse("w", scripted((503, None))[0]) == (503, None)
    assert live.fetch_cleanse("w", scripted(OSError())[0]) == (-1, None)
    assert live.fetch_cleanse("w", scripted((200, "x"))[0]) == (-1, None)
    assert live.fetch_cleanse("w", scripted((200, "[1]"))[0]) == (200, None)


def test_pacing():
    now, waits = [0.0], []

    def sleep(s):
        waits.append(round(s, 6))
        now[0] += s

    ask = live.paced(lambda t: (200, t), 4, lambda: now[0], sleep)
    for t in "abc":
        assert ask(t) == (200, t)
    assert waits == [0.25, 0.25]


def test_snapshot_and_analyser(spark):
    titles = spark.createDataFrame([("a",), ("b",), ("a",)], "title string")
    got = live.snapshot(titles, lambda t: (200, json.dumps({"t": t})) if t == "a" else (404, None), tasks=2)
    assert sorted(map(tuple, got.collect())) == [("a", 200, '{"t": "a"}'), ("b", 404, None)]
    words = spark.createDataFrame([("x", 1), ("y", 2), ("x", 3)], "word string, n int")
    command = [sys.executable, "-c", "import sys; print(' ' + sys.argv[1] + '1 \\n\\n' + sys.argv[1] + '2')", "{word}"]
    out = live.joined_analyses(live.analysed(words, command, 60)).collect()
    assert sorted((r.word, r.n, r.analyses) for r in out) == [("x", 1, "x1|x2"), ("x", 3, "x1|x2"), ("y", 2, "y1|y2")]
    batches = spark.createDataFrame([(0, "a", 0), (0, "b", 1), (1, "c", 2)], "batch long, word string, row_idx long")
    echo = [sys.executable, "-c", "import sys; [print(x.strip().upper()) for x in sys.stdin if x.strip()]"]
    assert sorted(map(tuple, live.analysed_batches(batches, echo).collect())) == [(0, "A"), (0, "B"), (1, "C")]
    assert live.run_command([sys.executable, "-c", "import time; time.sleep(30)"], "x", 0.2) == []


WORKER = """
import sys, time
open(sys.argv[1], "a").write("started\\n")
for line in sys.stdin:
    w = line.rstrip("\\n")
    if w == "slow":
        time.sleep(60)
    if w == "dies":
        sys.exit(1)
    print(f" {w}1 \\n\\n{w}2\\n." if w != "none" else ".", flush=True)
"""


def test_words_stream_through_a_process_a_task(spark, tmp_path):
    words = spark.createDataFrame([(f"w{i % 500}", i) for i in range(1000)] + [(None, -1), ("none", -2), ("two\nlines", -3)], "word string, n int")
    log = tmp_path / "log"
    out = live.analysed_lines(words, [sys.executable, "-c", WORKER, str(log)], 30, end=".", tasks=3).collect()
    got = {r.n: r.analyses for r in out}
    assert all(got[i] == [f"w{i % 500}1", f"w{i % 500}2"] for i in range(1000)) and got[-1] is None and got[-2] == [] and got[-3] == []
    assert len(log.read_text().split()) <= 3


def test_a_word_that_takes_too_long_or_kills_the_program_has_no_lines(tmp_path):
    log = tmp_path / "log"
    worker = live.LineWorker([sys.executable, "-c", WORKER, str(log)], 5, ".")
    assert worker.ask("a") == ["a1", "a2"]
    worker.timeout = 0.3
    assert worker.ask("slow") == []
    worker.timeout = 5
    assert [worker.ask(w) for w in ("b", "dies", "c", "d")] == [["b1", "b2"], [], ["c1", "c2"], ["d1", "d2"]]
    assert worker.started == 3
    worker.close()
    gone = live.LineWorker(["/nowhere/program"])
    try:
        gone.ask("a")
    except OSError:
        pass
    else:
        raise AssertionError("a program that is not there must not pass for one without answers")


def test_pages():
    book = {None: (["a", "b"], "2"), "2": (["c"], None)}
    assert list(live.pages(None, book.__getitem__)) == ["a", "b", "c"]


def test_tables_and_config(spark, tmp_path):
    (tmp_path / "a.csv").write_text('word,tag,definition\nx,N,"a, ""b"""\n')
    (tmp_path / "b.csv").write_text("tag,word\nV,y\n")
    rows = readers.tagged_tables(spark, str(tmp_path / "a.csv"), str(tmp_path / "b.csv"))
    assert [tuple(r) for r in rows.select("word", "tag", "definition", "source_ord").orderBy("source_ord").collect()] == [("x", "N", 'a, "b"', 0), ("y", "V", None, 1)]
    (tmp_path / "c.json").write_text(json.dumps({"menu": "m", "layout": [["a", "b"], ["c"]], "actions": {"enter": {"label": "l", "position": "end"}}}))
    r = readers.game_config(spark, str(tmp_path / "c.json")).first()
    assert r.layout == [["a", "b"], ["c"]] and r.actions["enter"].label == "l"
    (tmp_path / "d.txt").write_text("word 1,N\n \nother-x\n")
    assert [r.word for r in readers.word_forms(readers.dictionary_lines(spark, str(tmp_path / "d.txt"))).orderBy("row_idx").collect()] == ["word", "other"]


def test_commands(spark, tmp_path, capsys):
    records = [{"word": "runs", "frequency": 2, "entries": [{"partOfSpeech": "verb", "definitions": [{"definition": "third-person singular of run"}]}]}, {"word": "cat", "frequency": 9, "entries": [{"partOfSpeech": "noun", "definitions": [{"definition": "a rare, small animal"}]}]}]
    (tmp_path / "v.jsonl").write_text("\n".join(map(json.dumps, records)))
    assert cli.main(["parse", str(tmp_path / "v.jsonl"), str(tmp_path / "tags")]) == 0
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "tags")).collect()) == ["cat,9,NOUN,RARE", "runs,2,VERB,3PS,INFLECTED_FORM"]
    cli.main(["filter", str(tmp_path / "tags"), "!RARE", str(tmp_path / "kept")])
    assert [r.value for r in spark.read.text(str(tmp_path / "kept")).collect()] == ["runs,2,VERB,3PS,INFLECTED_FORM"]
    (tmp_path / "l").write_text("a,1\nb,5\na,7\n")
    cli.main(["remove_dups", str(tmp_path / "l"), str(tmp_path / "dups")])
    cli.main(["sort_freq", str(tmp_path / "l"), str(tmp_path / "sorted")])
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "dups")).collect()) == ["a,1", "b,5"]
    assert [r.value for r in spark.read.text(str(tmp_path / "sorted")).collect()] == ["a,7", "b,5", "a,1"]
    (tmp_path / "c.csv").write_text("word,count,tag,definition\nbird,3,N,d\nfish,9,N,e\nhorse,1,N,f\n")
    cli.main(["dictionaries", str(tmp_path / "c.csv"), str(tmp_path / "dict"), "2"])
    assert [r.value for r in spark.read.text(str(tmp_path / "dict/len=4")).collect()] == ["fish 9,N,e", "bird 3,N,d"]
    assert cli.main(["nothing"]) == 2 and cli.main([]) == 0 and "parse SOURCE TARGET" in capsys.readouterr().out


def test_listing_in_tasks(spark, monkeypatch):
    import pandas as pd
    from lexspark.plans import catalogue, files

    ask = files._listing(iter([pd.DataFrame({"k": range(1001), "title": map(str, range(1001))}), pd.DataFrame({"k": [5000], "title": ["x"]})]))
    assert ask(None)[1] == "1000" and ask("1000") == (["1000", "x"], None)
    assert list(live.pages(None, files._listing(iter([])))) == []
    # as many pages as there are, but no job for each
    monkeypatch.setattr(files, "_PAGE", 2)
    spark.sparkContext.setJobGroup("listing", "")
    rows = catalogue.queries()["category_list"](spark, "/root/testdata/sf0.001").collect()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("listing")
    spark.sparkContext.setJobGroup("", "")
    assert rows and len(jobs) < 20
