"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

The documents of a source, in an order by hash, are one stream of words that is cut into blocks. A source's target is
met by an exact number of blocks: whole passes over the source, each in an order of its own, and a part of one more. A
tree splits these quotas among the output shards: at each node the left half's blocks are drawn from the node's blocks
without replacement, which is a multivariate hypergeometric draw over the sources, until each leaf is a shard with its
own count of blocks of each source. So shards are of equal size and each is a random sample of the mix, and no block has
been looked at yet. A shard then owns a range of each source's permuted blocks, disjoint from those of all others, and
orders its blocks by hash. Everything is DataFrame functions.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.llm._scratch import Scratch, hot_join
from lexspark.llm.sharding import RANKED, numbered, ranked
from lexspark.operators.relational import spread

#: A run of anything but ASCII white space is a word.
WORD = r"[^\x20\x09-\x0D]+"
#: Words of a block, and blocks that one row is exploded into at a time.
BLOCK, SPAN = 1024, 1 << 16


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def hypergeometric(good: Column, bad: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` items, taken without replacement from ``good`` and ``bad`` ones, are good; ``u`` in [0, 1) decides.

    Inverse transform around the mode: probabilities follow from their neighbours' by a ratio, out to 12 deviations, where
    what is left is below the precision of a double. The order of values is from the mode up, then from the mode down.
    """

    def walk(span: Column, ratio: Callable[[Column], Column], begin: Column, target: Column) -> Column:
        """(w, c, x): the last weight, the sum so far, and the first value at which the sum exceeds ``target``, or null."""

        def step(s: Column, x: Column) -> Column:
            return _let(s["w"] * ratio(x), lambda w: F.struct(w.alias("w"), (s["c"] + w).alias("c"), F.coalesce(s["x"], F.when(s["c"] + w > target, x)).alias("x")))

        return F.aggregate(span, F.struct(F.lit(1.0).alias("w"), begin.cast("double").alias("c"), F.lit(None).cast("long").alias("x")), step)

    def drawn(p: Column) -> Column:
        g, b, n, mode = p["g"], p["b"], p["n"], p["m"]
        # p(x) / p(x - 1), and p(x) / p(x + 1)
        up = lambda x: (g - x + 1).cast("double") * (n - x + 1).cast("double") / (x.cast("double") * (b - n + x).cast("double"))
        down = lambda x: (x + 1).cast("double") * (b - n + x + 1).cast("double") / ((g - x).cast("double") * (n - x).cast("double"))
        empty = F.array().cast("array<long>")
        above = F.when(p["hi"] > mode, F.sequence(mode + 1, F.least(p["hi"], mode + p["reach"]))).otherwise(empty)
        below = F.when(p["lo"] < mode, F.sequence(mode - 1, F.greatest(p["lo"], mode - p["reach"]), F.lit(-1).cast("long"))).otherwise(empty)
        no = F.lit(math.inf)
        weight = F.struct(walk(above, up, F.lit(1.0), no)["c"].alias("up"), walk(below, down, F.lit(0.0), no)["c"].alias("down"))

        def chosen(t: Column) -> Column:
            aim = u * (t["up"] + t["down"])
            return F.when(aim < 1, mode).when(aim < t["up"], walk(above, up, F.lit(1.0), aim)["x"]).otherwise(walk(below, down, t["up"], aim)["x"])

        return F.coalesce(_let(weight, chosen), mode)

    def bounds(q: Column) -> Column:
        g, b, n = q["g"], q["b"], q["n"]
        total = (g + b).cast("double")
        spread_ = F.sqrt(n.cast("double") * g.cast("double") / F.greatest(total, F.lit(1.0)) * (b.cast("double") / F.greatest(total, F.lit(1.0))) * (total - n.cast("double")) / F.greatest(total - 1, F.lit(1.0)))
        lo, hi = F.greatest(F.lit(0).cast("long"), n - b), F.least(n, g)
        mode = F.greatest(lo, F.least(hi, F.floor((n.cast("double") + 1) * (g.cast("double") + 1) / (total + 2)).cast("long")))
        return F.struct(g.alias("g"), b.alias("b"), n.alias("n"), lo.alias("lo"), hi.alias("hi"), mode.alias("m"), (F.ceil(spread_ * 12) + 20).cast("long").alias("reach"))

    whole = F.struct(good.cast("long").alias("g"), bad.cast("long").alias("b"), draws.cast("long").alias("n"))
    return _let(_let(whole, bounds), drawn)


def _uniform(*of: Column) -> Column:
    """A number in [0, 1) from a hash of the columns."""
    return F.shiftrightunsigned(F.xxhash64(*of), 11).cast("double") / F.lit(float(1 << 53))


def splitting_tree(quotas: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """(shard, src, blocks) for ``quotas`` (src, quota): how many blocks of each source every shard gets.

    The blocks of a source add up to its quota, and the totals of any two shards are at most one apart. Sources, numbered
    from 0, are one array in a row of a node; there are as many rows as nodes of a level.
    """
    listed = F.sort_array(F.collect_list(F.struct("src", "quota")))
    level = quotas.agg(F.transform(listed, lambda x: x["quota"].cast("long")).alias("q")).select(F.lit(0).alias("lo"), F.lit(shards).alias("hi"), "q")
    depth = math.ceil(math.log2(shards)) if shards > 1 else 0
    total = lambda q: F.aggregate(q, F.lit(0).cast("long"), lambda s, x: s + x)
    for turn in range(depth):
        # the left half takes its share of blocks, source after source, each from what is left
        mid = F.expr("int((lo + hi + 1) div 2)")
        asked = level.withColumn("mid", mid).withColumn("total", total(F.col("q"))).withColumn("wanted", F.expr("total * (mid - lo) div (hi - lo)"))
        start = F.struct(F.col("total").alias("rest"), F.col("wanted").alias("n"), F.array().cast("array<long>").alias("out"))

        def take(s: Column, quota: Column) -> Column:
            u = _uniform(F.lit(seed), F.col("lo"), F.col("hi"), F.size(s["out"]))
            return _let(hypergeometric(quota, s["rest"] - quota, s["n"], u), lambda x: F.struct((s["rest"] - quota).alias("rest"), (s["n"] - x).alias("n"), F.concat(s["out"], F.array(x)).alias("out")))

        left = asked.withColumn("left", F.aggregate("q", start, take, lambda s: s["out"]))
        both = F.array(F.struct("lo", F.col("mid").alias("hi"), F.col("left").alias("q")), F.struct(F.col("mid").alias("lo"), "hi", F.zip_with("q", "left", lambda q, x: q - x).alias("q")))
        split = F.when(F.col("hi") - F.col("lo") > 1, both).otherwise(F.array(F.struct("lo", "hi", "q")))
        level = left.select(F.explode(split).alias("n")).select("n.*")
        if turn == depth // 2:
            level = level.repartition("lo")
    return level.select(F.col("lo").alias("shard"), F.posexplode("q").alias("src", "blocks")).where("blocks > 0")


def targets(sizes: DataFrame, weights: Sequence[float] = (1, 2, 3), most: int = 3) -> DataFrame:
    """``sizes`` (source, source_size and others; a row for each source) with ``src``, its number in order of code points with
    null last, and ``target``.

    Weights go round by ``src``. All targets add up to the sum of all sizes; a target stops at ``most`` times its source's
    size, and what is beyond is shared by weight among the others until none is above: ``target`` is the smaller of that
    bound and a level times the weight, and the level follows from running sums in the order in which sources reach
    their bounds.
    """
    every = Window.partitionBy()
    out = sizes.withColumn("src", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    out = out.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("src") % len(weights) + 1)).withColumn("_most", (F.col("source_size") * most).cast("double"))
    before = Window.orderBy(F.col("_most") / F.col("_w"), "src").rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0.0))
    level = (F.sum("source_size").over(every) - earlier("_most")) / (F.sum("_w").over(every) - earlier("_w"))
    out = out.withColumn("_level", level)
    reached = F.when(F.col("_level") <= F.col("_most") / F.col("_w"), F.struct((F.col("_most") / F.col("_w")).alias("a"), "src", F.col("_level").alias("level")))
    out = out.withColumn("_at", F.min(reached).over(every)["level"])
    return out.withColumn("target", F.least(F.col("_most"), F.coalesce(F.col("_at") * F.col("_w"), F.col("_most")))).drop("_w", "_most", "_level", "_at")


def _streams(rows: DataFrame, total: int) -> DataFrame:
    """``rows`` (src, spot, size) with ``start``: the words of the same source before it, in order of the hash ``spot``. A source
    may have any number of rows: windows run in ranges of the hash, and a table of these has what is before each."""
    bits = max(0, min(16, math.ceil(math.log2(max(1, total / RANKED)))))
    cut = rows.withColumn("_range", F.shiftright("spot", 64 - bits) if bits else F.lit(0).cast("long"))
    sums = cut.groupBy("src", "_range").agg(F.sum("size").alias("_sum"))
    sums = sums.select("src", "_range", F.coalesce(F.sum("_sum").over(Window.partitionBy("src").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("src", "_range").orderBy("spot", "doc_id", "nth").rowsBetween(Window.unboundedPreceding, -1)
    return cut.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(sums, ["src", "_range"]).withColumn("start", F.col("_before") + F.col("_in")).drop("_range", "_in", "_before")


def _exploded(rows: DataFrame, count: str, out: str) -> DataFrame:
    """A row with ``out`` from 0 to ``count`` - 1 for each row; large counts are dealt to several tasks."""
    parts = rows.where(F.col(count) > 0).withColumn("_part", F.explode(F.expr(f"sequence(0L, ({count} - 1) div {SPAN})"))).repartition(*rows.columns, "_part")
    return parts.withColumn(out, F.explode(F.expr(f"sequence(_part * {SPAN}, least({count}, (_part + 1) * {SPAN}) - 1)"))).drop("_part")


class Mix:
    """The mix of ``docs`` (doc_id, text, source): ``sources``, ``documents``, ``quotas`` and ``drawn`` are written tables, ``pieces``
    and ``taken`` are made from them.

    Words are counted over whole texts; null texts have none. A null source is a source of its own, after all others.
    Rows that repeat are documents of their own. Null ids pass. Other columns are ignored, and an empty table gives an empty mix.
    ``seed`` decides all orders and draws: the same rows and seed give the same mix.
    """

    def __init__(self, docs: DataFrame, shards: int = 64, block: int = BLOCK, weights: Sequence[float] = (1, 2, 3), most: int = 3, seed: int = 0):
        if shards < 1 or block < 1:
            raise ValueError("there must be a shard, and a block must have a word")
        spark = docs.sparkSession
        self.block, self.seed = block, seed
        self.scratch = scratch = Scratch(spark, "mixing")
        source, text = F.col("source").cast("string"), F.col("text").cast("string")
        size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
        # null is a key too: "" stands for it, and names have a mark before them
        key = F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source))
        rows = spread(docs.select("doc_id", "text", "source")).select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"), size.alias("size"))
        counted = scratch.write(rows.groupBy("doc_id", "key", "size").agg(F.count(F.lit(1)).alias("n")), "counted")
        sizes = counted.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs"))
        name = F.when(F.col("key") != "", F.substring("key", 2, 1 << 30))
        self.sources = scratch.write(targets(sizes.withColumn("source", name), weights, most), "sources")
        spot = F.xxhash64(F.lit(seed), "doc_id", "key", "size", "nth")
        known = self.sources.select("key", "src", "n_docs", "source_size", "target")
        nodes = hot_join(numbered(counted).withColumn("spot", spot), known, ["key"], "n_docs").select("doc_id", "nth", "src", "size", "spot", "source_size", "target")
        placed = _streams(nodes, counted.count()).withColumn("row", F.monotonically_increasing_id())
        self.documents = scratch.write(placed.drop("spot"), "documents")
        scratch.drop(counted)

        # whole passes over a source's blocks, and words of one more pass
        words = F.round(F.col("target")).cast("long")
        plan = self.sources.where("source_size > 0").select("src", "source_size", words.alias("words"), F.expr(f"(source_size + {block - 1}) div {block}").alias("blocks"))
        plan = plan.withColumn("passes", F.expr("words div source_size")).withColumn("rest", F.expr("words % source_size"))
        self.plan = plan.withColumn("last", F.expr(f"(rest + {block - 1}) div {block}"))
        quotas = self.sources.select("src").join(self.plan.select("src", F.expr("passes * blocks + last").alias("quota")), "src", "left").select("src", F.coalesce("quota", F.lit(0)).alias("quota"))
        self.quotas = scratch.write(splitting_tree(quotas, shards, seed), "quotas")
        self.drawn = scratch.write(self._drawn(), "drawn")

    def _drawn(self) -> DataFrame:
        """(src, pass, block, shard, n): each drawn block of each pass over its source, its shard, and how many of its words
        are taken (all but for the last one of a source)."""
        block, full = self.block, F.expr(f"source_size div {self.block}")
        # shards own ranges of a source's sequence of passes and ranks, one after the other
        mine = self.quotas.withColumn("first", F.coalesce(F.sum("blocks").over(Window.partitionBy("src").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        own = _exploded(mine.withColumnRenamed("blocks", "n"), "n", "nth").select("src", "shard", (F.col("first") + F.col("nth")).alias("at"))
        # each pass orders the whole blocks by a hash of its own; the last block of a stream, if shorter, comes last
        passes = self.plan.withColumn("pass", F.explode(F.expr("sequence(0L, passes)"))).where("pass < passes or rest > 0").withColumn("full", full)
        rows = _exploded(passes.select("src", "pass", "full"), "full", "block").withColumn("mix", F.xxhash64(F.lit(self.seed), "src", "pass", "block")).drop("full")
        permuted = ranked(rows, ["src", "pass"], "mix", "rank", int(passes.agg(F.sum("full")).first()[0] or 0)).select("src", "pass", "block", "rank")
        short = passes.where("blocks > full").select("src", "pass", F.col("full").alias("block"), F.col("full").alias("rank"))
        every = permuted.unionByName(short).join(self.plan, "src").withColumn("at", F.col("pass") * F.col("blocks") + F.col("rank"))
        length = F.least(F.lit(block).cast("long"), F.col("source_size") - F.col("block") * block)
        taken = F.when(F.col("pass") < F.col("passes"), length).otherwise(F.least(length, F.col("rest") - F.col("rank") * block))
        return every.select("src", "pass", "block", "at", taken.alias("n")).hint("merge").join(own, ["src", "at"]).where("n > 0").drop("at")

    def _cut(self) -> DataFrame:
        """(row, src, block, into, begin, words): documents cut at blocks; ``into`` is the place in the block, ``begin`` that in the
        document."""
        block = self.block
        cut = self.documents.where("size > 0").withColumn("block", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")))
        begin = F.greatest(F.lit(0).cast("long"), F.col("block") * block - F.col("start"))
        cut = cut.withColumn("begin", begin).withColumn("into", F.col("start") + F.col("begin") - F.col("block") * block)
        return cut.withColumn("words", F.least(F.col("size") - F.col("begin"), block - F.col("into")))

    def pieces(self) -> DataFrame:
        """(shard, place, part, doc_id, source, pass, from_word, n_words): what each shard takes, in order of place and part.

        ``place`` counts a shard's blocks from 0 without gaps, in an order by hash; ``part`` counts the pieces of a block.
        """
        blocks = self.drawn.withColumn("mix", F.xxhash64(F.lit(self.seed), F.lit("place"), "src", "pass", "block"))
        blocks = ranked(blocks, ["shard"], "mix", "place", self.drawn.count())
        out = self._cut().hint("merge").join(blocks, ["src", "block"]).withColumn("n_words", F.least("words", F.col("n") - F.col("into"))).where("n_words > 0")
        out = out.withColumn("part", F.row_number().over(Window.partitionBy("shard", "place").orderBy("into")) - 1)
        named = self.sources.select("src", "source", F.col("n_docs").alias("_n"))
        return hot_join(self.scratch.write(out, "pieces"), named, ["src"], "_n").select("shard", "place", "part", "doc_id", "source", "pass", F.col("begin").alias("from_word"), "n_words")

    def taken(self) -> DataFrame:
        """(doc_id, size, source_size, target, taken) of every document: the words that all draws of its blocks take, repeats
        counted."""
        # tables of blocks and rows grow with the words; as files they are small, and Spark would broadcast them
        words = self._cut().hint("merge").join(self.drawn, ["src", "block"]).withColumn("n_words", F.least("words", F.col("n") - F.col("into"))).where("n_words > 0")
        sums = words.groupBy("row").agg(F.sum("n_words").alias("taken"))
        out = self.documents.hint("merge").join(sums, "row", "left")
        return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
