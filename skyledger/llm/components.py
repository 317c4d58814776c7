"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.session import stage


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Tie the larger (large) or the smaller neighbours of every node, and it, to the smallest of them."""
    ends = links.select("u", "v")
    if large:
        ends = ends.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        ends = ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = ends.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    tied = ends.join(least, "u")
    if large:
        out = tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return out.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component_id) of every node that has a link to another one; the id is the smallest node reached.

    ``links`` has two long columns; direction, repeats and loops don't matter, null ends are left out. Each round
    is written to the shared folder, so a lost executor costs one round at most.
    """
    u, v = links.columns
    now = stage(
        links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
        .where(F.col(u).isNotNull() & F.col(v).isNotNull() & (F.col("u") != F.col("v")))
        .distinct(),
        "links",
    )
    mark = F.struct(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    seen = now.select(mark).first()[0]
    # Each round brings nodes nearer to the smallest one, so they settle without a bound on the rounds.
    was = None
    while was != seen:
        now = stage(_star(_star(now, True), False), "links")
        was, seen = seen, now.select(mark).first()[0]
    return now.select(F.col("u").alias("node"), F.col("v").alias("component_id")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component_id")).distinct()
    )
