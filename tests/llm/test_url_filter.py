import random
import re
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from lexspark.llm import queries, url_filter
from lexspark.llm._scratch import Scratch
from lexspark.llm.url_filter import Rule


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    host = re.split("[/?#]", rest)[0]
    path = re.split("[?#]", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "http://example.com/en/", "http://example.com/en", "http://com/", "http://com", "http://xcom/", "http://a.net/es/1", "http://net/fr/?q", "x://y://z/a", "http://ÉCOLE.net/de/", "http://a.b.example.com/en/?", "http://example.com#/en/", "http://h\nx.net/es/", "http://u@p:80/x"]


def test_parts_and_rules(spark):
    pages = spark.createDataFrame([(i, u, None, "v") for i, u in enumerate(URLS)] + [(None, URLS[4], "<a href=", "v")], "page_id long, url string, html string, verdict string")
    out = url_filter.judge_urls(pages).collect()
    assert len(out) == len(URLS) + 1
    for r in out:
        host, path = split(URLS[4] if r.page_id is None else URLS[r.page_id])
        rule = rule_of(host, path, url_filter.RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule.text if rule else None)
        assert r.verdict == ("allow" if rule is None or rule.allow else "block")
    assert url_filter.judge_urls(pages.limit(0)).collect() == []


def test_rules_on_random_urls(spark):
    rng = random.Random(6)
    urls = [f"http://{'.'.join(rng.choices(['a', 'b', 'com', 'net'], k=rng.randrange(1, 4)))}/{'/'.join(rng.choices(['x', 'y', ''], k=rng.randrange(0, 4)))}" for _ in range(400)]
    rules = tuple({Rule(".".join(rng.choices(["a", "b", "com", "net"], k=rng.randrange(1, 3))), "/" + rng.choice(["", "x", "x/", "y/x"]), rng.random() < 0.5) for _ in range(12)})
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("page_id", "url", "cast(null as string) html")
    for r in url_filter.judge_urls(pages, rules).collect():
        rule = rule_of(*split(urls[r.page_id]), rules)
        assert (rule is None) == (r.rule is None) and (rule is None or len(rule.text) == len(r.rule))


def brute(edges, seeds, rounds, damping):
    state = dict(seeds)
    out, into = {}, {}
    for s, d, n in edges:
        out[s] = out.get(s, 0) + n
        into[d] = into.get(d, 0) + n
    for _ in range(rounds):
        new = {h: [(1 - damping) * t, (1 - damping) * b] for h, (t, b) in seeds.items()}
        for s, d, n in edges:
            if s in state:
                new.setdefault(d, [0, 0])[0] += damping * state[s][0] * n / out[s]
            if d in state:
                new.setdefault(s, [0, 0])[1] += damping * state[d][1] * n / into[d]
        state = {h: tuple(v) for h, v in new.items()}
    return state


def test_propagation(spark):
    rng = random.Random(8)
    edges = [(f"h{a}", f"h{b}", rng.randrange(1, 5)) for a in range(30) for b in rng.sample(range(30), 3) if a != b] + [("hub", f"h{b}", 1) for b in range(30)]
    seeds = {"h1": (1.0, 0.0), "h2": (0.0, 1.0), "hub": (0.5, 0.25)}
    frames = spark.createDataFrame(edges, "src string, dst string, n long"), spark.createDataFrame([(h, *v) for h, v in seeds.items()], "host string, trust double, distrust double")
    want = brute(edges, seeds, 5, 0.85)
    for least in (url_filter.LIGHT, 4):  # with 4 all but a few hosts are hubs
        got = {r.host: (r.trust, r.distrust) for r in url_filter.propagate(*frames, Scratch(spark, "test"), 5, 0.85, least).collect()}
        assert got.keys() == want.keys()
        assert all(abs(a - b) < 1e-9 for h in want for a, b in zip(got[h], want[h]))


def test_links_decide(spark):
    rules = (Rule("bad.example", "/", False), Rule("good.example", "/", True))
    link = lambda *u: "".join(f"<a href=\"{x}\">x</a>" for x in u)
    rows = [(1, "http://bad.example/", ""), (2, "http://good.example/", link("http://friend.test/", "//other.test/x")), (3, "http://farm.test/", link("HTTP://Bad.example/1", "/self", "http://bad.example/2")), (4, "http://friend.test/", link("http://friend.test/a")), (5, "http://alone.test/", ""), (6, "http://mixed.test/", link("http://bad.example/")), (7, "http://good.example/2", link(*["http://mixed.test/"] * 9))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for least in (url_filter.LIGHT, 1):
        got = {r.page_id: (r.verdict, r.by) for r in url_filter.judge_urls(pages, rules, least=least).collect()}
        assert got == {1: ("block", "rule"), 2: ("allow", "rule"), 3: ("block", "links"), 4: ("allow", "links"), 5: ("allow", "links"), 6: ("allow", "links"), 7: ("allow", "rule")}


def test_converges(spark, monkeypatch):
    # a chain of hosts: trust from t at its start, distrust from b at its end
    names = ["t", *(f"h{i}" for i in range(1, 13)), "b"]
    edges = [(a, b, 1) for a, b in zip(names, names[1:])] + [("p", "q", 1), ("q", "p", 2), ("q", "b", 1)]
    seeds = {"t": (1.0, 0.0), "b": (0.0, 1.0)}
    frames = spark.createDataFrame(edges, "src string, dst string, n long"), spark.createDataFrame([(h, *v) for h, v in seeds.items()], "host string, trust double, distrust double")
    got = {r.host: (r.trust, r.distrust) for r in url_filter.propagate(*frames, Scratch(spark, "test")).collect()}
    want = brute(edges, seeds, 400, 0.85)
    assert got.keys() == want.keys()
    assert all(abs(a - b) < 1e-7 for h in want for a, b in zip(got[h], want[h]))
    assert abs(got["h12"][0] - 0.15 * 0.85**12) < 1e-9
    monkeypatch.setattr(url_filter, "MOST_ROUNDS", 3)
    with pytest.raises(RuntimeError):
        url_filter.propagate(*frames, Scratch(spark, "test"))


def test_far_links_decide(spark):
    # a chain from a trusted host over ten links to x, and over three more to a blocked one; another chain of eleven
    rules = (Rule("bad.example", "/", False), Rule("good.example", "/", True))
    chain = ["good.example", *(f"a{i}.test" for i in range(1, 10)), "x.test", "y.test", "z.test", "bad.example"]
    other = [*(f"b{i}.test" for i in range(11)), "bad.example"]
    links = list(zip(chain, chain[1:])) + list(zip(other, other[1:]))
    pages = spark.createDataFrame([(i, f"http://{a}/", f'<a href="http://{b}/">x</a>') for i, (a, b) in enumerate([*links, ("bad.example", "bad.example")])], "page_id long, url string, html string")
    got = {r.host: r for r in url_filter.judge_urls(pages, rules).collect()}
    assert got["b0.test"].distrust > 1e-3 and got["b0.test"].verdict == "block"
    assert got["x.test"].trust < got["x.test"].distrust and got["x.test"].verdict == "block"


def test_verdict_of_a_link_to_a_hot_host(spark):
    # n hosts link to a blocked one; a trusted host with a thousand links has one to the first of them
    rules = (Rule("bad.example", "/", False), Rule("good.example", "/", True))
    link = lambda u: f'<a href="http://{u}/">x</a>'
    few = spark.createDataFrame([(-1, "http://bad.example/", ""), (-2, "http://good.example/", link("l0.test") + "".join(link(f"o{i}.test") for i in range(999)))], "page_id long, url string, html string")
    for n in (10, 140_000):
        many = spark.range(n).selectExpr("id page_id", "concat('http://l', id, '.test/') url", f"'{link('bad.example')}' html")
        out = url_filter.judge_urls(few.unionByName(many), rules).where("page_id >= 0")
        assert {(r.first, r.verdict): r["count"] for r in out.groupBy((out.page_id == 0).alias("first"), "verdict").count().collect()} == {(True, "allow"): 1, (False, "block"): n - 1}


def test_long_pages_take_linear_time(spark):
    pieces = ["<a href=", "<a ", "<a href=\"", "<a href ", "<a " + "b" * 50, "href=", "<", "<a href=http:", "<a href=//x "]
    pages = spark.createDataFrame([(i, f"http://h{i}.test/", p * (5_000_000 // len(p))) for i, p in enumerate(pieces)], "page_id long, url string, html string").repartition(8)
    begun = time.time()
    assert {r.page_id: r.verdict for r in url_filter.judge_urls(pages).collect()} == {i: "allow" for i in range(len(pieces))}
    assert time.time() - begun < 60
    assert [r.n for r in url_filter.host_links(pages.where("page_id = 8"), url_filter.url_host(F.col("url"))).collect()] == [5_000_000 // 12]


def test_sql_over_linked_pages(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    want = con.execute(queries.SQL_LINKED_URLS).fetchdf().sort_values("page_id")
    got = queries.linked_urls(spark, folder).toPandas().sort_values("page_id")
    for c in want.columns:
        assert [None if x != x else x for x in got[c]] == [None if x != x else x for x in want[c]], c
    by_links = got[got["by"] == "links"]
    assert {"allow", "block"} <= set(by_links["verdict"]) and (by_links["trust"] > 0).any()


def test_main_path_is_native():
    assert not re.search(r"pandas|mapIn|udf|\.rdd", open(url_filter.__file__).read())
