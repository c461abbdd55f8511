"""Exchange rate as of a date (J1, M5, V9): the newest quotation that is not after the row's date.

The rate depends on currency and date alone, so the ordered merge runs over distinct dates, not over rows: the rows' distinct
(key, date) pairs (combined on the map side, so a currency with a third of all rows is a calendar's worth of pairs) and the
quotations are put in one line per key and read once in date order. The number of pairs of a key is bounded by the calendar. The
result is joined back on equal key and date; there is no range condition and no cross join, and Spark splits a hot date where
the join is skewed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of_pairs(pairs: DataFrame, quotes: DataFrame, keys: Sequence[str], at: str, quoted_at: str, values: Sequence[str]) -> DataFrame:
    """Distinct ``keys, at`` with ``values`` and ``quoted_at`` of the newest quotation not after ``at`` (null before the first).

    Of several quotations of a key and date the largest values count. Null keys or dates have no quotation.
    """
    day = quotes.where(F.col(quoted_at).isNotNull()).groupBy(*keys, quoted_at).agg(F.max(F.struct(*values)).alias("_quote"))
    line = (pairs.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(day.schema["_quote"].dataType).alias("_quote"))
            .unionByName(day.select(*keys, F.col(quoted_at).alias("_at"), F.lit(0).alias("_kind"), "_quote")))
    # a quotation comes before the rows of its own day
    order = Window.partitionBy(*keys).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    newest = F.last(F.when(F.col("_kind") == 0, F.struct(F.col("_at").alias("d"), "_quote")), ignorenulls=True).over(order)
    found = line.withColumn("_newest", newest).where("_kind = 1")
    return found.select(*keys, F.col("_at").alias(at), F.col("_newest.d").alias(quoted_at), *[F.col("_newest._quote").getField(v).alias(v) for v in values])


def join_as_of(rows: DataFrame, quotes: DataFrame, keys: Sequence[str] = ("moneda",), at: str = "fecha", quoted_at: str = "fecha_tasa",
               values: Sequence[str] = ("tasa",)) -> DataFrame:
    """``rows`` with ``values`` and ``quoted_at`` of the newest quotation of their ``keys`` that is not after ``at``.

    Every row stays. A row before its key's first quotation, of a key without quotations, or with a null key or date gets nulls.
    """
    pairs = rows.select(*keys, at).where(" and ".join(f"`{c}` is not null" for c in [*keys, at])).distinct()
    return rows.join(as_of_pairs(pairs, quotes, keys, at, quoted_at, values), [*keys, at], "left").select(*rows.columns, quoted_at, *values)
