"""Exact grouped median without a per-group buffer.

Equal values are counted first (partial counts on the map side). The counts are summed per value tile, a narrow range on a
logarithmic scale, so that the running total which locates the middle positions goes over the tiles of a group, whose number
follows from the number format and not from the rows. Only the one or two tiles that hold the middle are then ordered by value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Tiles per doubling of the value (any positive number is right).
TILES_PER_OCTAVE = 256


def _tile(v: Column) -> tuple[Column, Column]:
    """(rank of the kind of value, tile): their order never contradicts the order of the values; NaN, then null, come last."""
    kind = F.when(v.isNull(), 3).when(F.isnan(v), 2).otherwise(F.signum(v)).cast("int")
    size = F.floor(F.log2(F.abs(v)) * TILES_PER_OCTAVE)
    return kind, F.when(kind == 1, size).when(kind == -1, -size).otherwise(F.lit(0)).cast("bigint")


def exact_median(df: DataFrame, group: str, value: str, median: str = "mediana", rows: str = "filas") -> DataFrame:
    """One row per value of ``group`` (null is a group): ``(group, rows, median)``, the median of its non-null numbers.

    An even count takes the mean of the two middle values; NaN counts as the largest number, as Spark orders it; a group
    without a number has a null median.
    """
    v = F.col("_v")
    kind, tile = _tile(v)
    counted = (df.select(F.col(group).alias("_g"), F.col(value).cast("double").alias("_v")).groupBy("_g", "_v")
               .agg(F.count(F.lit(1)).alias("_n")).withColumns({"_kind": kind, "_tile": tile}))
    tiles = counted.groupBy("_g", "_kind", "_tile").agg(F.sum("_n").alias("_n"))
    whole = Window.partitionBy("_g")
    numbers = F.sum(F.when(F.col("_kind") < 3, F.col("_n")).otherwise(0)).over(whole)
    placed = tiles.select(
        "_g", "_kind", "_tile", "_n", F.sum("_n").over(whole).alias("_rows"), numbers.alias("_numbers"),
        F.sum("_n").over(whole.orderBy("_kind", "_tile").rowsBetween(Window.unboundedPreceding, 0)).alias("_end"))
    # 1-based middle positions; without numbers the second one falls on the nulls
    placed = placed.withColumns({"_lo": F.expr("(_numbers + 1) DIV 2"), "_hi": F.expr("_numbers DIV 2 + 1"),
                                 "_begin": F.col("_end") - F.col("_n")}).drop("_n", "_end", "_numbers")
    n = placed.withColumn("_stop", F.lead("_begin").over(whole.orderBy("_kind", "_tile")))
    holds = lambda p, begin, end: (F.col(p) > begin) & (end.isNull() | (F.col(p) <= end))
    middle = n.where(holds("_lo", F.col("_begin"), F.col("_stop")) | holds("_hi", F.col("_begin"), F.col("_stop")))
    m = middle.select(F.col("_g").alias("_mg"), F.col("_kind").alias("_mk"), F.col("_tile").alias("_mt"), "_begin", "_lo", "_hi", "_rows")
    # null-safe on all three: a plain equality would push "is not null" below the count on this side only, and the two uses of
    # ``counted`` would no longer be one shuffle that Spark runs once
    same = counted["_g"].eqNullSafe(m["_mg"]) & counted["_kind"].eqNullSafe(m["_mk"]) & counted["_tile"].eqNullSafe(m["_mt"])
    inside = counted.join(m, same)
    order = Window.partitionBy("_g", "_kind", "_tile").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("_begin") + F.sum("_n").over(order)
    ranked = inside.withColumn("_end", end).withColumn("_from", F.col("_end") - F.col("_n"))
    at = lambda p: F.max(F.when((F.col(p) > F.col("_from")) & (F.col(p) <= F.col("_end")), v))
    return ranked.groupBy("_g").agg(F.max("_rows").alias(rows), (at("_lo") * 0.5 + at("_hi") * 0.5).alias(median)).select(
        F.col("_g").alias(group), rows, median)
