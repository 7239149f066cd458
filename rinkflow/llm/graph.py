"""Connected components of an edge table that never leaves the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import cut
from ._util import own_shuffle


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1000003)).first()
    return tuple(row)


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) of every node of ``edges(src, dst)``; component is its smallest node.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): all
    steps are grouped minima, which combine before the shuffle, and equi-joins,
    whose hot keys AQE splits, so a hub costs no single task.  Every round is
    cut to the shared folder.  Null ends and self-loops count as no edge.
    """
    edges = edges.where("src is not null and dst is not null")
    e = edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
    e = cut(e.where("u <> v").distinct())
    state = _state(e)
    for _ in range(rounds):
        if state[0] == 0:
            break
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(own_shuffle(least, "u"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(own_shuffle(least, "u"), "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()
        e = cut(small)
        after = _state(e)
        if after == state:
            break
        state = after
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(roots)
