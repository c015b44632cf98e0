"""URL filters: written rules first, and trust and distrust over the link graph of hosts for the rest.

Trust is a personalised PageRank from hosts that rules allow, along links. Distrust starts at hosts that rules block and
runs against the links: a host that links to a bad one is suspect. Both are damped. Both are also divided among all links of
the host that sends them, so that they shrink as others link to it as well; a host is therefore judged by its exposure and
its backing, the same two scores by the shares of its own links. Everything is DataFrame operations; a round is two equi-joins and a grouped sum over host edges.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm._scratch import LIGHT, Scratch, hot_join, key_counts


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    allow: bool

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the query.
RULES = (Rule("com", "/", True), Rule("example.com", "/en/", False), Rule("www.example.com", "/en/", True), Rule("net", "/es/", False), Rule("net", "/fr/", False))
#: Scores have converged once no host's changes by more in a round: far below any threshold.
CONVERGED = 1e-9
#: Rounds after which scores that still change are an error. A round leaves 0.85 of a change, so that some 140 do.
MOST_ROUNDS = 400
_SCORES = ("trust", "distrust", "backing", "exposure")


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.coalesce(_ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for a url without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The number of the longest rule that fits (the first of equals), or null: one pass over a list that the caller
    writes by hand. A rule fits its host and all subdomains if the path starts with the rule's."""
    out = F.lit(None).cast("int")
    for i in sorted(range(len(rules)), key=lambda i: (len(rules[i].text), -i)):
        r = rules[i]
        out = F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), F.lit(i)).otherwise(out)
    return out


def host_links(pages: DataFrame, host: Column) -> DataFrame:
    """(src, dst, n): links from pages of a host to another host; relative links stay on their host and are left out.

    A tag's attributes are searched up to the next ``<`` or ``>``, so that a page takes time in proportion to its length."""
    links = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(r"""(?is)<a\s[^<>]*?href\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^\s"'<>]*)"""), F.lit(1))
    whole = F.transform(links, lambda x: F.when(x.startswith("//"), F.concat(F.lit("http:"), x)).otherwise(x))
    found = pages.select(host.alias("src"), F.explode(whole).alias("link")).select("src", url_host(F.col("link")).alias("dst"))
    return found.where("src != '' and dst != '' and src != dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def _round(flows: DataFrame, state: DataFrame, share: DataFrame, degrees: DataFrame, counts: tuple[int, int], damping: float, least: int) -> DataFrame:
    """What each host gets from the hosts around it and, as a seed, from itself. ``degrees`` has the rows of each host in
    ``flows``, so that the scores of a hub meet its links where these are."""
    sized = state.withColumnRenamed("host", "from").join(degrees, "from")
    sent = hot_join(flows, sized, ["from"], "rows", least, counts)
    flow = lambda c, forth, by: F.sum(F.when(F.col("forth") == forth, F.col(by) * F.col(c)).otherwise(0.0)).alias(c)
    got = sent.groupBy(F.col("to").alias("host")).agg(flow("trust", 1, "sent"), flow("distrust", 0, "sent"), flow("backing", 1, "had"), flow("exposure", 0, "had"))
    moved = got.select("host", *((F.col(c) * damping).alias(c) for c in _SCORES))
    return share.unionByName(moved).groupBy("host").agg(*(F.round(F.sum(c), 12).alias(c) for c in _SCORES))


def propagate(edges: DataFrame, seeds: DataFrame, scratch: Scratch, rounds: int | None = None, damping: float = 0.85, least: int = LIGHT) -> DataFrame:
    """(host, trust, distrust, backing, exposure) of hosts that a seed reaches, seeds included.

    ``edges`` has (src, dst, n), each pair once, ``seeds`` (host, trust, distrust). A round spreads trust over a host's
    outgoing links and distrust over its incoming ones, each link by its share of n; seeds get their own part back each
    time. Backing is trust where a link counts by its share of all links to its target, exposure is distrust where it
    counts by its share of all links from its source: neither depends on how many others have links with the same
    host. Scores are rounded to 12 places, so that they do not depend on the order of sums.

    Without ``rounds`` the seeds start with that part and rounds go on until no score changes by more than CONVERGED;
    RuntimeError if MOST_ROUNDS do not suffice. With ``rounds`` there are so many, from the seeds' whole scores.

    The links of a host with many (``least`` at the least) stay where they are: totals and scores of such hosts are
    broadcast, as there are few by their definition.
    """
    edges = scratch.write(edges, "edges")
    out = scratch.write(edges.groupBy("src").agg(F.sum("n").alias("out"), F.count(F.lit(1)).alias("rows")), "out")
    into = scratch.write(edges.groupBy("dst").agg(F.sum("n").alias("into"), F.count(F.lit(1)).alias("rows")), "into")
    halfway = scratch.write(hot_join(edges, out, ["src"], "rows", least).drop("rows"), "known")
    known = hot_join(halfway, into, ["dst"], "rows", least).select("src", "dst", (F.col("n") / F.col("out")).alias("of_out"), (F.col("n") / F.col("into")).alias("of_in"))
    forth = known.select(F.col("src").alias("from"), F.col("dst").alias("to"), F.lit(1).alias("forth"), F.col("of_out").alias("sent"), F.col("of_in").alias("had"))
    back = known.select(F.col("dst").alias("from"), F.col("src").alias("to"), F.lit(0).alias("forth"), F.col("of_in").alias("sent"), F.col("of_out").alias("had"))
    flows = scratch.write(forth.unionByName(back), "flows")
    degrees = scratch.write(out.select(F.col("src").alias("from"), "rows").unionByName(into.select(F.col("dst").alias("from"), "rows")).groupBy("from").agg(F.sum("rows").alias("rows")), "degrees")
    scratch.drop(edges, out, into, halfway)
    whole = seeds.select("host", "trust", "distrust", F.col("trust").alias("backing"), F.col("distrust").alias("exposure"))
    share = scratch.write(whole.select("host", *(F.round(F.col(c) * (1 - damping), 12).alias(c) for c in _SCORES)), "seeds")
    state = scratch.write(share if rounds is None else whole, "scores")
    if rounds is None and flows.isEmpty():
        return state  # a round would change nothing
    counts = key_counts(degrees, "rows")
    for _ in range(MOST_ROUNDS if rounds is None else rounds):
        after = scratch.write(_round(flows, state, share, degrees, counts, damping, least), "scores")
        if rounds is None:
            old = state.select("host", *(F.col(c).alias(f"old_{c}") for c in _SCORES))
            change = lambda c: F.abs(F.coalesce(F.col(c), F.lit(0.0)) - F.coalesce(F.col(f"old_{c}"), F.lit(0.0)))
            most = after.join(old, "host", "full").select(F.max(F.greatest(*map(change, _SCORES)))).first()[0]
        scratch.drop(state)
        state = after
        if rounds is None and (most or 0.0) <= CONVERGED:
            return state
    if rounds is None:
        raise RuntimeError(f"scores of hosts still change by {most} after {MOST_ROUNDS} rounds")
    return state


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, rounds: int | None = None, damping: float = 0.85, least_distrust: float = 1e-6, least: int = LIGHT) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust, by) of each row of ``pages`` (page_id, url, html).

    A rule that fits decides; the longest does. Other urls are blocked if their host's exposure is at least
    ``least_distrust`` and above its backing, and allowed otherwise. Seeds are the hosts of whose pages rules allow more
    than half (trust, by their share) or block more than half (distrust): a rule for a path alone does not condemn a
    host. ``by`` tells rule or links.

    Null urls and urls without ``://`` have an empty host and path; no rule fits them and, as nothing links to an empty
    host, they are allowed. Null html has no links. Repeated rows are judged alike, null ids pass. Further columns are
    ignored; an empty table gives an empty result.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    seen = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("nth", matching_rule(F.col("host"), F.col("path"), rules))
    seen = scratch.write(seen, "urls")
    edges = host_links(pages, host)
    fits = F.col("nth").isNotNull()  # element_at of a null place is not null for an array without nulls
    allows = F.when(fits, F.element_at(F.array(*[F.lit(r.allow) for r in rules]), F.col("nth") + 1)) if rules else F.lit(None).cast("boolean")
    hosts = scratch.write(seen.where("host != ''").groupBy("host").agg(F.count(F.lit(1)).alias("pages"), F.count_if(allows).alias("good"), F.count_if(~allows).alias("bad")), "hosts")
    share = lambda c: F.when(F.col(c) * 2 > F.col("pages"), F.col(c) / F.col("pages")).otherwise(0.0).alias({"good": "trust", "bad": "distrust"}[c])
    seeds = hosts.where("2 * good > pages or 2 * bad > pages").select("host", share("good"), share("bad"))
    scores = propagate(edges, seeds, scratch, rounds, damping, least)
    judged = scores.select("host", "trust", "distrust", ((F.col("exposure") >= least_distrust) & (F.col("exposure") > F.col("backing"))).alias("suspect"))
    # a host may have a third of all pages: those stay where they are
    judged = scratch.write(hosts.select("host", "pages").join(judged, "host", "left"), "judged")
    named = hot_join(seen.where("host != ''"), judged, ["host"], "pages", least)
    joined = named.unionByName(seen.where("host = ''"), allowMissingColumns=True)
    texts = F.when(fits, F.element_at(F.array(*[F.lit(r.text) for r in rules]), F.col("nth") + 1)) if rules else F.lit(None).cast("string")
    linked = F.when(F.coalesce("suspect", F.lit(False)), "block").otherwise("allow")
    verdict = F.when(F.col("nth").isNull(), linked).when(allows, "allow").otherwise("block")
    return joined.select("page_id", "host", "path", texts.alias("rule"), verdict.alias("verdict"), F.round(F.coalesce("trust", F.lit(0.0)), 9).alias("trust"), F.round(F.coalesce("distrust", F.lit(0.0)), 9).alias("distrust"), F.when(F.col("nth").isNull(), "links").otherwise("rule").alias("by"))
