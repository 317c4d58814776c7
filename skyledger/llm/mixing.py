"""Mixing sources to target weights along a curriculum.

Targets: each source has a size (words of its documents) and a weight. The sources share a budget by weight; a
source's target stops at ``most_repeats`` times its size and the excess is shared again among the others by weight.

Positions: each source also has a schedule, its relative weight over training progress from 0 to 1, given at knots
and linear between them. The integral of the schedule, scaled to the source's target, is the source's cumulative
demand for words. Documents of a source stand in a fixed shuffled order (by a hash of id and text); the order is
gone through up to ``most_repeats`` times until the target is taken, the last document in part. The word a document
begins with meets the cumulative demand at one progress: that is the document's training position. The result is
sorted by the position of the first copy, by range, so its files are in training order.

Cumulative words of a source are not summed in one task: documents fall by hash into about sqrt(rows) buckets of
about sqrt(rows) rows, bucket totals give each bucket's offset, and sums run inside buckets only.

Words are runs other than space and 0x09-0x0D; a null text has none. A null source is a source of its own, last in
order. Rows that repeat a doc_id are rows of their own. Documents without words take nothing and have a null
position. Empty tables give empty results. Columns of the input with the name of a result column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.session import stage

WORD = r"[^\x20\x09-\x0D]+"
# Relative weight at equally spaced knots of progress.
FLAT, EARLY, LATE = (1.0, 1.0, 1.0), (1.5, 1.0, 0.5), (0.5, 1.0, 1.5)


@dataclass(frozen=True)
class Mix:
    """Weights and schedules go to the sources in order of their names and repeat."""

    weights: tuple[int, ...] = (3, 1, 2)
    schedules: tuple[tuple[float, ...], ...] = (EARLY, LATE, FLAT)
    budget_percent: int = 150
    most_repeats: int = 2
    seed: int = 17
    results: tuple[str, ...] = field(default=("size", "source_size", "target", "taken", "position", "positions"))


def _share(sizes: DataFrame, mix: Mix) -> DataFrame:
    """(key..., source_size, weight, schedule, target) of each source.

    Each round shares what is left among the sources not yet at their limit; the level only rises, so a round
    without a new one at its limit is the last.
    """
    spark = sizes.sparkSession
    many = max(1, min(200, int(sizes.count() // 10_000) + 1))
    # Ranks without one task for all: sort by range, count each part, add the counts of the parts before.
    parts = sizes.repartitionByRange(many, "no_source", "source_key").withColumn("part", F.spark_partition_id())
    parts = stage(parts, "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("part").agg(F.count("*").alias("rows"))
    offsets = offsets.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part").orderBy("no_source", "source_key")
    ranked = parts.join(offsets, "part").withColumn("rank", F.col("offset") + F.row_number().over(inside) - 1)
    turn = lambda values: F.element_at(F.array(*map(F.lit, values)), (F.col("rank") % len(values) + 1).cast("int"))
    ranked = ranked.withColumn("weight", turn(mix.weights).cast("double"))
    ranked = stage(ranked.withColumn("schedule", (F.col("rank") % len(mix.schedules)).cast("int")), "sources")
    most = F.col("source_size") * mix.most_repeats
    level, full = 0.0, -1
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    while True:
        at_limit = most <= F.col("weight") * level
        done, taken, weight = ranked.agg(
            F.count(F.when(at_limit, 1)), F.sum(F.when(at_limit, most)), F.sum(F.when(~at_limit, F.col("weight")))
        ).first()
        if done == full or not weight:
            break
        full, level = done, (total * mix.budget_percent / 100 - float(taken or 0)) / weight
    target = F.when(at_limit, most.cast("double")).otherwise(F.col("weight") * level)
    keys = ["no_source", "source_key", "source_size", "weight", "schedule"]
    return stage(ranked.select(*keys, target.alias("target")), "targets")


def _progress(share: Column, schedule: Column, schedules: tuple[tuple[float, ...], ...]) -> Column:
    """The progress at which a schedule's integral reaches a share of its whole."""

    def inverse(knots: tuple[float, ...]) -> Column:
        step = 1 / (len(knots) - 1)
        areas = [(a + b) / 2 * step for a, b in zip(knots, knots[1:])]
        wanted, out = share * sum(areas), None
        for k in reversed(range(len(areas))):
            a, slope = knots[k], (knots[k + 1] - knots[k]) / step
            area = F.greatest(wanted - sum(areas[:k]), F.lit(0.0))
            # a x + slope / 2 x^2 = area, solved in the form that also holds for a flat piece.
            x = 2 * area / (a + F.sqrt(F.greatest(a * a + 2 * slope * area, F.lit(0.0))) + 1e-300)
            here = F.least(k * step + x, F.lit((k + 1) * step))
            out = here if out is None else F.when(wanted < sum(areas[: k + 1]), here).otherwise(out)
        return out

    out = inverse(schedules[-1])
    for k in range(len(schedules) - 1):
        out = F.when(schedule == k, inverse(schedules[k])).otherwise(out)
    return out


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The documents, with all columns, and size, source_size, target, taken, position and positions (of all copies)."""
    names = {name.lower() for name in mix.results}
    plain = docs.select(*[c for c in docs.columns if c.lower() not in names])
    buckets = max(1, int(plain.count() ** 0.5))
    rows = plain.select(
        F.struct("*").alias("_llm_row"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.col("source").isNull().alias("no_source"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source_key"),
        F.xxhash64(F.lit(mix.seed), "doc_id", "text").alias("draw"),
    ).withColumn("bucket", F.pmod("draw", F.lit(buckets)))
    keys = ["no_source", "source_key"]
    totals = stage(rows.groupBy(*keys, "bucket").agg(F.sum("size").alias("bucket_size")), "buckets")
    targets = _share(totals.groupBy(*keys).agg(F.sum("bucket_size").alias("source_size")), mix)
    before = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("offset", F.coalesce(F.sum("bucket_size").over(before), F.lit(0))).drop("bucket_size")
    inside = Window.partitionBy(*keys, "bucket").orderBy("draw", "size")
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("start", F.coalesce(F.sum("size").over(upto), F.lit(0)))
    placed = placed.join(stage(offsets.join(targets, keys), "offsets"), [*keys, "bucket"])
    start = F.col("offset") + F.col("start")
    whole = F.round("target").cast("long")
    copies = [start + F.col("source_size") * k for k in range(mix.most_repeats)]
    takes = [F.greatest(F.least(whole - c, F.col("size")), F.lit(0)) for c in copies]
    at = [
        F.when(take > 0, _progress(c / F.col("target"), F.col("schedule"), mix.schedules))
        for c, take in zip(copies, takes)
    ]
    result = placed.select(
        "_llm_row.*",
        "size",
        "source_size",
        "target",
        sum(takes[1:], takes[0]).alias("taken"),
        at[0].alias("position"),
        F.array_compact(F.array(*at)).alias("positions"),
    )
    # Documents that are not taken have no position; their ids keep them from one range.
    return result.orderBy(F.col("position").asc_nulls_last(), "doc_id")


def taken_only(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """What is trained on, in order: documents without a part in the mix are left out."""
    return mixed(docs, mix).where("taken > 0")
