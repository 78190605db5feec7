"""Connected components of a distributed edge list: alternating large and small stars.

Each round hooks the neighbours of every node to the least of them, as minima that are combined before the
shuffle and joined back (the rows of hubs are salted); rounds are written to the shared folder, each in place of
the one before, and end when the edges are stars. No edge list or component is ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C


SALTS, HUB_ROWS, HUBS = 16, 1000, 500


def join_least(rows: DataFrame, least: DataFrame, key: str, total: int) -> DataFrame:
    """rows joined with least (key, m, n: its rows) on key. A key with over HUB_ROWS rows and over 1 / HUBS of all is a
    hub, of which there are under HUBS: its rows are salted, and its least is repeated for each salt."""
    hub = F.col("n") > max(HUB_ROWS, total // HUBS)
    hubs = least.where(hub).select(key, F.lit(True).alias("_hub"))
    salt = F.when(F.col("_hub"), F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS))).otherwise(0).cast("int")
    salted = rows.join(F.broadcast(hubs), key, "left").withColumn("_salt", salt).drop("_hub")
    spread = least.withColumn("_salt", F.explode(F.when(hub, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    return salted.join(spread, [key, "_salt"]).drop("_salt", "n")


def _stars(edges: DataFrame, large: bool, total: int) -> DataFrame:
    """(a, b): large: each neighbour above its node hooks to the least of node and neighbours; small: node and
    the neighbours below it hook to the least of them."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n")
        out = join_least(both.where("b > a"), least, "a", total).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        out = join_least(down, least, "a", total).select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a != b")


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars already: each node has one edge up at most, and none if one comes down to it."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 or (up > 0 and down > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) of any one orderable type -> (node, root): each node of an edge with the least node that it
    reaches. Nulls and loops are left out; repeated edges change nothing; no edges, no rows."""
    now = C.cut(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _settled(now):
        total = now.count()
        before, now = now, C.cut(_stars(_stars(now, True, total), False, total).distinct(), "edges")
        C.discard(before)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
