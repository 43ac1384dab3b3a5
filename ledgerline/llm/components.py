"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Root of every node that has a link: node, root (the smallest node reachable).

    links: two columns of one orderable type, in any direction, repeats allowed; nulls and self links are ignored.
    Every step is a join on a node and a minimum by node: a hub's links are split by the join and its minimum is
    formed on the map side, so no task gathers a component. Each round is written to the shared folder.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    done: list[Scratch] = [Scratch(links.sparkSession)]
    edges = done[-1].write(edges, "links")
    state = _state(edges)
    while state[0]:
        done.append(Scratch(links.sparkSession))
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.join(lowest, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        large = done[0].write(large, "links")
        lowest = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(lowest, "u").where(F.col("v") != F.col("low")).select(F.col("v").alias("u"), F.col("low").alias("v"))
        edges = done[-1].write(small.unionByName(lowest.select("u", F.col("low").alias("v"))).distinct(), "links")
        done.pop(0).release()  # the round before
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
