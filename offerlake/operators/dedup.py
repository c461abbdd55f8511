"""Deduplication.

Most-complete survivor per composite key, computed as an aggregate: ``min(struct(-completeness, row...))`` per key.
The aggregate runs partially on the map side, so a key holding a third of all rows is reduced to one candidate per
task before the shuffle, unlike a ``row_number`` window that would sort the whole hot group in one task. The struct
compares every column after completeness, which makes the survivor a deterministic function of the rows (ties on all
columns are identical rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlake import rules


def completeness(columns: Sequence[str]) -> Column:
    """Number of non-null columns of the row."""
    total = F.lit(0)
    for c in columns:
        total = total + F.col(f"`{c}`").isNotNull().cast("int")
    return total


def keep_most_complete(df: DataFrame, keys: Sequence[str] = rules.DEDUP_KEYS,
                       order: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the most complete, ties broken by ``order`` then all columns ascending (nulls first)."""
    cols = df.columns
    lead = list(order or [])
    # the keys are equal within a group: they decide nothing and come back from the grouping
    rank = F.struct(
        (-completeness(cols)).alias("_neg_complete"),
        *[F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(lead)],
        *[F.col(f"`{c}`") for c in cols if c not in keys],
    )
    # struct minima are aggregated by sorting: a number as the first key spares comparing texts that begin alike
    best = df.groupBy(F.xxhash64(*[F.col(f"`{c}`") for c in keys]).alias("_h"), *keys).agg(F.min(rank).alias("_best"))
    # keys come from the grouping, so a filter on one passes below the shuffle
    return best.select(*[F.col(f"`{c}`") if c in keys else F.col(f"_best.`{c}`").alias(c) for c in cols])


def keep_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per ``key``: the first by ``order`` (a file-order column stands in for "keep first")."""
    cols = df.columns
    rank = F.struct(*[F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(order)],
                    *[F.col(f"`{c}`") for c in cols])
    best = df.groupBy(key).agg(F.min(rank).alias("_best"))
    return best.select(*[F.col(f"_best.`{c}`").alias(c) for c in cols])


def keep_most_complete_offers(df: DataFrame, split_unclassified: bool = False,
                              extra_keys: Sequence[str] = ()) -> DataFrame:
    """Offer dedup on the composite key. By default unclassified products at the same store, category and price
    collapse into one row, as in the reference; ``split_unclassified`` adds the title to the key for those rows only,
    and ``extra_keys`` (e.g. the snapshot date) extends the key for every row."""
    keys = list(rules.DEDUP_KEYS) + list(extra_keys)
    if not split_unclassified:
        return keep_most_complete(df, keys)
    tagged = df.withColumn("_title_key", F.when(F.col("clave_canonica") == rules.UNCLASSIFIED, F.col("producto")))
    cols = df.columns
    rank = F.struct((-completeness(cols)).alias("_neg_complete"), *[F.col(f"`{c}`") for c in cols])
    best = tagged.groupBy(*keys, "_title_key").agg(F.min(rank).alias("_best"))
    return best.select(*[F.col(f"_best.`{c}`").alias(c) for c in cols])
