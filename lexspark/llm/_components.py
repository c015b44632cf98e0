"""Connected components by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm._scratch import LIGHT, Scratch, hot_join


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo")), F.sum(F.col("lo").cast("decimal(20,0)"))).first()
    return tuple(row)


def _least_around(edges: DataFrame, of: str, value: str, scratch: Scratch, most: int, least: int) -> tuple[DataFrame, list[DataFrame]]:
    """``edges`` with ``m``, the smallest ``value`` of the same ``of``, and the tables to drop later. A node may have a third
    of all edges: such edges stay where they are. With fewer than ``least`` edges (``most``) no node has that many."""
    found = edges.groupBy(of).agg(F.min(value).alias("m"), F.count(F.lit(1)).alias("n"))
    if most < least:
        return edges.join(found.drop("n"), of), []
    found = scratch.write(found, "least")
    return hot_join(edges, found, [of], "n", least).drop("n"), [found]


def connected_components(edges: DataFrame, scratch: Scratch, most_rounds: int = 100, least: int = LIGHT) -> DataFrame:
    """(node, component) of every node that has an edge to another one; component is the smallest node reached.

    ``edges`` has two columns of longs, in any direction, with repeats and loops allowed. Each round is a few grouped
    minima and equi-joins over edges; no task holds a component, and the driver only sees a checksum.
    """
    a, b = edges.columns
    state = scratch.write(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "edges")
    before = _signature(state)
    for _ in range(most_rounds):
        if before[0] == 0:
            break
        # large star: each node hands its larger neighbours to the smallest node around it
        both = state.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(state.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        around, spent = _least_around(both, "u", "v", scratch, 2 * before[0], least)
        large = around.where("v > u").select(F.col("v").alias("hi"), F.least("u", "m").alias("lo")).distinct()
        # small star: each node hands its smaller neighbours, and itself, to the smallest of them
        if 2 * before[0] >= least:
            large = scratch.write(large, "large")
            spent.append(large)
        low, more = _least_around(large, "hi", "lo", scratch, before[0], least)
        given = low.where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).unionByName(low.select("hi", F.col("m").alias("lo")))
        after = scratch.write(given.distinct(), "edges")
        scratch.drop(*spent, *more)
        scratch.drop(state)
        state, now = after, _signature(after)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return state.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(state.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
