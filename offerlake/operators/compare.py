"""Price comparison (A1, A2, F3, F5, T1, T2, V13): which store sells each product cheapest, and the saving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlake import rules
from offerlake.functions.price import rint_round

COMPARISON_COLUMNS = ["clave_canonica", "categoria", "tiendas_comparadas", "tienda_mas_barata", "precio_min_usd",
                      "precio_max_usd", "ahorro_usd", "ahorro_pct", "producto_ejemplo",
                      "producto"]


def best_prices(staged: DataFrame, min_stores: int = 2, example_chars: int = 70) -> DataFrame:
    """Per canonical key seen in at least ``min_stores`` stores: cheapest store, min/max price, saving.

    One partial+final aggregate on the key. The cheapest row is ``min(struct(price, store, title, category))`` so ties
    resolve by store then title; this aggregates map-side, so a hot key costs one candidate per task.
    """
    keyed = staged.filter(F.col("clave_canonica") != rules.UNCLASSIFIED)
    g = keyed.groupBy("clave_canonica").agg(
        F.countDistinct("tienda").alias("tiendas_comparadas"),
        F.min(F.struct("precio_usd", "tienda", "producto", "categoria")).alias("_min"),
        F.max("precio_usd").alias("_pmax"),
    ).filter(F.col("tiendas_comparadas") >= min_stores)
    pmin = F.col("_min.precio_usd")
    pmax = F.col("_pmax")
    return g.select(
        "clave_canonica",
        F.col("_min.categoria").alias("categoria"),
        "tiendas_comparadas",
        F.col("_min.tienda").alias("tienda_mas_barata"),
        rint_round(pmin, 2).alias("precio_min_usd"),
        rint_round(pmax, 2).alias("precio_max_usd"),
        rint_round(pmax - pmin, 2).alias("ahorro_usd"),
        F.when(pmax != 0, rint_round((1 - pmin / pmax) * 100, 1)).otherwise(F.lit(0.0)).alias("ahorro_pct"),
        F.substring(F.col("_min.producto"), 1, example_chars).alias("producto_ejemplo"),
        F.col("_min.producto").alias("producto"),
    )


def order_by_saving(df: DataFrame) -> DataFrame:
    """Largest saving first; key breaks ties so the order is total."""
    return df.orderBy(F.desc("ahorro_usd"), F.asc("clave_canonica"))


def top_savings(df: DataFrame, n: int = 10) -> DataFrame:
    """Top-``n`` preview (a take-ordered, no global sort)."""
    return order_by_saving(df).select("clave_canonica", "tienda_mas_barata", "precio_min_usd", "precio_max_usd",
                                      "ahorro_usd", "ahorro_pct").limit(n)
