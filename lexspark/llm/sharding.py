"""Sharding by balanced label propagation.

Documents with equal texts are linked. A document's label is its shard. In each round a document looks at the shards
of its neighbours and wants to move to the one where most of them are; how many may move from one shard to another is
settled by a table of the wishes between shards, so that no shard grows beyond its share. Documents without links fill
the places that are left, and at the end all counts are at most one apart.

A group larger than a shard cannot be in one. It has as many homes as it needs shards (its fullest ones), and its
members outside move to one of them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.llm._scratch import Scratch

#: Rows that one task ranks together, on average.
RANKED = 20_000
#: Equal rows that one task numbers together.
REPEATS = 1 << 16


def ranked(rows: DataFrame, by: list[str], order: str, out: str, total: int) -> DataFrame:
    """``rows`` with ``out``, counting from 0 without gaps in each group of ``by`` and ascending in the long ``order``.

    Groups may be of any size: the order's range is cut into buckets, the counts of buckets (a small table) give each
    its offset, and windows run within buckets only. ``order`` must be spread evenly over the longs, as hashes are;
    equal values keep an arbitrary but fixed order by all other columns.
    """
    bits = max(0, min(16, math.ceil(math.log2(max(1, total / RANKED)))))
    cut = rows.withColumn("_bucket", F.shiftright(F.col(order), 64 - bits) if bits else F.lit(0).cast("long"))
    counts = cut.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    rest = [c for c in rows.columns if c not in by and c != order]
    within = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy(order, *rest))
    return cut.withColumn("_at", within).join(offsets, [*by, "_bucket"]).withColumn(out, F.col("_before") + F.col("_at") - 1).drop("_at", "_before", "_bucket")


def _even(total: int, shards: int) -> list[int]:
    """Sizes at most one apart; the larger ones come first."""
    return [total // shards + (i < total % shards) for i in range(shards)]


def _quotas(wishes: dict[tuple[int, int], int], loads: list[int], limits: list[int]) -> dict[tuple[int, int], int]:
    """How many may move from i to j, so that no load ends above its limit (or above what it is now).

    Starts from all wishes and takes moves into overfull shards back, evenly over their origins. That fills origins
    again, so it is repeated; grants only ever fall, so it ends.
    """
    grant = dict(wishes)
    while True:
        load = list(loads)
        for (i, j), n in grant.items():
            load[i] -= n
            load[j] += n
        over = [j for j, n in enumerate(load) if n > max(limits[j], loads[j])]
        if not over:
            return grant
        for j in over:
            inward = sorted((k for k, n in grant.items() if k[1] == j and n), key=lambda k: (k[0] - j) % len(loads))
            excess, came = load[j] - max(limits[j], loads[j]), sum(grant[k] for k in inward)
            back = {k: grant[k] * excess // came for k in inward}
            missing = excess - sum(back.values())
            for k in inward:
                if missing and back[k] < grant[k]:
                    back[k] += 1
                    missing -= 1
                grant[k] -= back[k]


def _case(column: Column, values: list[int]) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), column.cast("int") + 1)


def _evened(state: DataFrame, shards: int, total: int, scratch: Scratch) -> DataFrame:
    """``state`` with counts at most one apart: overfull shards give rows to the others, unlinked ones first, then those
    of the smallest groups."""
    loads = [0] * shards
    for r in state.groupBy("shard").count().collect():
        loads[r.shard] = r["count"]
    want = [0] * shards
    for i, n in zip(sorted(range(shards), key=lambda j: (-loads[j], j)), _even(total, shards)):
        want[i] = n
    excess = [max(0, a - b) for a, b in zip(loads, want)]
    if not sum(excess):
        return state
    # by twos' powers of the group's size, -4 for unlinked rows; a hash within them
    weight = F.when(F.col("size").isNull(), F.lit(-4)).otherwise(F.least(F.lit(3), F.floor(F.log2(F.col("size"))) - 4)).cast("long")
    weight = F.when(F.col("size").isNotNull() & (weight < -3), F.lit(-3)).otherwise(weight)
    turned = state.withColumn("turn", F.shiftleft(weight, 61) + F.shiftrightunsigned(F.xxhash64("spot", "g1"), 3))
    gone = ranked(turned, ["shard"], "turn", "place", 8 * total).withColumn("leaves", F.col("place") < _case(F.col("shard"), excess)).drop("place")
    gone = scratch.write(gone, "leaving")
    leavers = gone.where("leaves").drop("shard").withColumn("all", F.lit(0)).withColumn("mix", F.xxhash64("spot", "g1", "g2"))
    leavers = ranked(leavers.drop("turn", "leaves"), ["all"], "mix", "place", sum(excess))
    new, at = F.lit(None).cast("int"), 0
    for j in range(shards):
        if want[j] > loads[j]:
            new = F.when((F.col("place") >= at) & (F.col("place") < at + want[j] - loads[j]), F.lit(j)).otherwise(new)
            at += want[j] - loads[j]
    settled = leavers.withColumn("shard", new)
    after = scratch.write(gone.where("not leaves").select(*state.columns).unionByName(settled.select(*state.columns)), "labels")
    scratch.drop(gone)
    return after


def balanced_labels(nodes: DataFrame, shards: int, rounds: int = 6, slack: float = 0.05, scratch: Scratch | None = None) -> DataFrame:
    """(node columns, shard) for ``nodes``, which have a ``group`` (two longs g1, g2: the link) and a ``spot``, a hash
    that orders them.

    Counts of shards are at most one apart. Large groups gather first and may crowd others out; then small groups
    gather and may crowd out unlinked nodes. What is crowded out moves when counts are evened. Every step is a join or
    grouped count; the driver sees tables of shards by shards.
    """
    scratch = scratch or Scratch(nodes.sparkSession, "sharding")
    columns = [c for c in nodes.columns]
    total = nodes.count()
    share = max(1, -(-total // shards))
    most = max(share, math.floor(share * (1 + slack)))
    large = F.coalesce(F.col("size") * 4 >= share, F.lit(False))

    # at most 4 * shards groups are large, by their definition; their rows take no part in the shuffle of the others
    group = scratch.write(nodes.groupBy("g1", "g2").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "groups")
    start = ranked(nodes.withColumn("all", F.lit(0)), ["all"], "spot", "place", total).withColumn("shard", F.pmod("place", F.lit(shards)).cast("int")).drop("all", "place")
    crowds = F.broadcast(group.where(large).select("g1", "g2", F.col("size").alias("crowd")))
    start = start.join(crowds, ["g1", "g2"], "left").withColumn("k1", F.when(F.col("crowd").isNull(), F.col("g1")).otherwise(F.col("spot")))
    rest = group.where(~large).select(F.col("g1").alias("k1"), F.col("g2").alias("k2"), "size")
    start = start.join(rest, (start["k1"] == rest["k1"]) & (start["g2"] == rest["k2"]), "left")
    state = scratch.write(start.select(*columns, F.coalesce("crowd", "size").alias("size"), "shard"), "labels")

    for turn in range(rounds):
        gathers = large if turn < rounds // 2 else ~large & F.col("size").isNotNull()
        if turn == rounds // 2:
            state = _evened(state, shards, total, scratch)
        loads, loose, big = [0] * shards, [0] * shards, [0] * shards
        for r in state.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("size").isNull()).alias("loose"), F.count_if(large).alias("big")).collect():
            loads[r.shard], loose[r.shard], big[r.shard] = r.n, r.loose, r.big
        # shards of a group by how many neighbours are there; its first ones, as many as it needs, are its homes. A
        # shard that large groups fill is no place for a small group to gather in
        votes = state.where(gathers).groupBy("g1", "g2", "size", "shard").agg(F.count(F.lit(1)).alias("n"))
        full = _case(F.col("shard"), [int(turn >= rounds // 2 and x * 5 >= 4 * share) for x in big])
        best = Window.partitionBy("g1", "g2").orderBy(full, F.desc("n"), F.xxhash64("g1", "shard"))
        homes = votes.withColumn("k", F.row_number().over(best)).where(F.col("k") <= F.ceil(F.col("size") / share))
        homes = homes.groupBy("g1", "g2").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "shard"))), lambda x: x["shard"]).alias("homes"))
        homes = F.broadcast(homes) if turn < rounds // 2 else homes
        to = F.col("homes")[F.pmod("spot", F.size("homes")).cast("int")]
        movers = state.where(gathers).join(homes, ["g1", "g2"]).where(~F.array_contains("homes", F.col("shard"))).select(*columns, "shard", to.alias("to"))
        movers = scratch.write(movers, "movers")
        wishes = {(r["shard"], r["to"]): r["count"] for r in movers.groupBy("shard", "to").count().collect()}
        limits = [most + (a - b if turn < rounds // 2 else c) for a, b, c in zip(loads, big, loose)]
        grants = {k: n for k, n in _quotas(wishes, loads, limits).items() if n}
        if grants:
            quota = _case(F.col("shard") * shards + F.col("to"), [grants.get((i, j), 0) for i in range(shards) for j in range(shards)])
            order = movers.withColumn("turn", F.xxhash64("g1", "g2", "spot"))
            moved = ranked(order, ["shard", "to"], "turn", "place", sum(wishes.values())).where(F.col("place") < quota).select("spot", "g1", "g2", "shard", "to")
            after = scratch.write(state.join(moved, ["spot", "g1", "g2", "shard"], "left").select(*columns, "size", F.coalesce("to", "shard").alias("shard")), "labels")
            scratch.drop(state)
            state = after
        scratch.drop(movers)
    return _evened(state, shards, total, scratch).select(*columns, "shard")


def cut_share(labelled: DataFrame) -> float:
    """The share of linked pairs (of equal g1, g2) whose two ends are in different shards; from counts, not pairs."""
    pairs = lambda n: n * (n - 1) / 2
    inside = labelled.groupBy("g1", "g2", "shard").agg(F.count(F.lit(1)).cast("double").alias("n")).agg(F.sum(pairs(F.col("n")))).first()[0] or 0.0
    every = labelled.groupBy("g1", "g2").agg(F.count(F.lit(1)).cast("double").alias("n")).agg(F.sum(pairs(F.col("n")))).first()[0] or 0.0
    return 1 - inside / every if every else 0.0


def numbered(counted: DataFrame, most: int = REPEATS) -> DataFrame:
    """A row, with a number ``nth`` from 0, for each of the ``n`` equal rows that a row of ``counted`` (a written table) stands
    for. A row that repeats more than ``most`` times is dealt to several tasks."""
    span = lambda a, b: F.explode(F.expr(f"sequence({a}, {b})"))
    few = counted.where(F.col("n") <= most).withColumn("nth", span("0L", "n - 1")).drop("n")
    many = counted.where(F.col("n") > most)
    if many.isEmpty():
        return few
    keys = [c for c in counted.columns if c != "n"]
    dealt = many.withColumn("part", span("0L", f"(n - 1) div {most}")).repartition(*keys, "part")
    return few.unionByName(dealt.select(*keys, span(f"part * {most}", f"least(n, (part + 1) * {most}) - 1").alias("nth")))


def shard_documents(docs: DataFrame, shards: int = 40, rounds: int = 6) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of each row of ``docs`` (doc_id, text).

    The law is ``rows``: the counts of any two shards are at most one apart. ``slot`` counts from 0 without gaps in each
    shard; ``grown_shard`` is null, as the shards of this law are not a function of the id. size is the UTF-8 length
    of the text plus 16.

    Null and empty texts are equal (length 0). Rows that repeat are documents of their own with one more link. A null id
    is an id like others. Further columns are ignored; an empty table gives an empty result.
    """
    if shards < 1:
        raise ValueError("there must be a shard")
    scratch = Scratch(docs.sparkSession, "sharding")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size_bytes"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("g1"), F.xxhash64(F.lit(5), text).alias("g2"))
    # rows that repeat get numbers, so that each row is a node of its own; a third of all rows may be equal
    counted = scratch.write(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n")), "counted")
    spot = F.when(F.col("nth") == 0, F.xxhash64("doc_id", "g1", F.lit(1))).otherwise(F.xxhash64("doc_id", "g1", "nth"))
    nodes = scratch.write(numbered(counted).withColumn("spot", spot).drop("nth"), "nodes")
    scratch.drop(counted)
    placed = balanced_labels(nodes, shards, rounds, scratch=scratch)
    slotted = ranked(placed, ["shard"], "spot", "slot", nodes.count())
    return slotted.select("doc_id", F.col("size_bytes").alias("size"), "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
