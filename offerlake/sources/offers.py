"""Offer sources.

* ``offers_from_tables``: the portable offer view over the driver's order tables (store = supplier, country = nation,
  product = part, price text from the line's extended price in six formats, missing URLs and bad dates).
* ``read_raw_offers``: landed raw CSV files, one directory per store, read with an explicit schema.
* ``union_sources``: union by column name, absent columns as null.
* ``latest_snapshot``: newest dated snapshot of a source.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_OFFER_COLUMNS = ["tienda", "pais", "moneda", "categoria", "keyword_busqueda", "producto", "precio_raw",
                     "url_producto", "fecha_extraccion"]
RAW_OFFER_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_OFFER_COLUMNS])


def _s(c: Column) -> Column:
    return c.cast("string")


def offers_from_tables(lineitem: DataFrame, part: DataFrame, supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """Offer-shaped rows, one per line item (columns ``k1, k2, tienda ... fecha_extraccion``).

    Plan shape: line items join parts and suppliers on their keys (Catalyst sizes each side; AQE turns a small side
    into a broadcast at run time and splits skewed partitions).
    """
    li = lineitem.select(
        F.col("l_orderkey").alias("k1"),
        F.col("l_linenumber").alias("k2"),
        "l_partkey",
        "l_suppkey",
        "l_shipdate",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
    )
    p = part.select("p_partkey", "p_name", "p_brand", "p_type")
    s = supplier.select("s_suppkey", "s_name", "s_nationkey")
    n = nation.select("n_nationkey", "n_name")
    j = (
        li.join(p, li.l_partkey == p.p_partkey)
        .join(s, li.l_suppkey == s.s_suppkey)
        .join(n, s.s_nationkey == n.n_nationkey)
    )
    pk = F.col("p_partkey")
    w = F.expr("cents DIV 100")
    d = F.lpad(_s(F.col("cents") % 100), 2, "0")
    ws = _s(w)
    thousands = _s(F.expr("(cents DIV 100) DIV 1000"))
    rest = F.lpad(_s(F.expr("(cents DIV 100) % 1000")), 3, "0")
    big = w >= 1000
    categoria = (
        F.when(F.col("p_type") == "ECONOMY", "CPU")
        .when(F.col("p_type") == "STANDARD", "gpu")
        .when(F.col("p_type") == "PROMO", "Ram")
        .when(F.col("p_type") == "SMALL", " SSD ")
        .when(F.col("p_type") == "MEDIUM", "Monitor")
        .otherwise("Periferico")
    )
    title = (
        F.when(
            F.col("p_type") == "ECONOMY",
            F.concat(F.lit("Procesador  AMD ("), F.col("p_brand"), F.lit(") Ryzen "), _s(3 + 2 * (pk % 4)),
                     F.lit(" "), _s(5000 + 100 * (pk % 40)), F.lit("X")),
        )
        .when(
            F.col("p_type") == "STANDARD",
            F.concat(F.lit("Tarjeta de Video RTX "), _s(4050 + 10 * (pk % 6)), F.lit(" Ti "),
                     _s(8 * (1 + pk % 2)), F.lit("GB "), F.col("p_name")),
        )
        .otherwise(F.col("p_name"))
    )
    producto = F.concat(F.when(F.col("k1") % 17 == 0, "PC  Gamer con ").otherwise(""), title)
    line = F.col("k2") % 6
    precio_raw = (
        F.when(line == 0, F.concat(F.lit("$"), ws, F.lit(","), d))
        .when(line == 1, F.concat(F.lit("$"), ws, F.lit("."), d, F.lit(" Inc. IVA")))
        .when(line == 2, F.concat(F.when(big, F.concat(thousands, F.lit("."), rest)).otherwise(ws), F.lit(","), d))
        .when(line == 3, F.concat(F.when(big, F.concat(thousands, F.lit(","), rest)).otherwise(ws), F.lit("."), d))
        .when(line == 4, F.concat(F.lit("$"), _s(w + 500), F.lit(",00 El precio original era: $"), _s(w + 500),
                                  F.lit(",00. $"), ws, F.lit(","), d))
        .otherwise(F.lit("Consultar"))
    )
    url = F.when(F.col("k1") % 13 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("https://shop.example/p/"), _s(F.col("l_partkey"))))
    fecha = F.when(F.col("k1") % 29 == 0, F.lit("sin fecha")).otherwise(F.substring(_s(F.col("l_shipdate")), 1, 19))
    return j.select(
        "k1", "k2",
        F.col("s_name").alias("tienda"),
        F.col("n_name").alias("pais"),
        F.lit("USD").alias("moneda"),
        categoria.alias("categoria"),
        producto.alias("producto"),
        precio_raw.alias("precio_raw"),
        url.alias("url_producto"),
        fecha.alias("fecha_extraccion"),
    )


def offers_with_copies(offers: DataFrame, every: int = 7) -> DataFrame:
    """``offers`` plus a less complete copy (URL removed) of every ``every``-th order: input for deduplication."""
    # one pass: a row with its copy is an exploded pair of urls
    url = F.col("url_producto")
    urls = F.when(F.col("k1") % every == 0, F.array(url, F.lit(None).cast("string"))).otherwise(F.array(url))
    return offers.select(*[F.explode(urls).alias(c) if c == "url_producto" else c for c in offers.columns])


def read_raw_offers(spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Landed offer CSVs: header, UTF-8 (BOM dropped), quoted multi-line fields, bad files skipped.

    Each path (one store directory or file) is read on its own and the parts are unioned by column name, because a
    single ``csv()`` call binds columns by position and stores may differ in header order. Multi-line CSV is not
    splittable: land it once as parquet (``sinks.land_raw``) and scan that.
    """
    frames = []
    for p in paths:
        reader = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
                  .option("encoding", "UTF-8").option("mode", "PERMISSIVE").option("ignoreCorruptFiles", True))
        if schema is not None:
            reader = reader.schema(schema)
        frames.append(reader.csv(p).withColumn("_source_file", F.col("_metadata.file_name")))
    return union_sources(frames)


def union_sources(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by column name; columns a source lacks come back null."""
    frames = list(frames)
    if not frames:
        raise ValueError("no source frames")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def snapshot_date_from_name(file_name: Column) -> Column:
    """``name_YYYY-MM-DD.ext`` -> date (null when the name carries no date)."""
    return F.to_date(F.regexp_extract(file_name, r"(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd")


def latest_snapshot(df: DataFrame, snapshot: Column | str) -> DataFrame:
    """Rows of the newest snapshot only.

    The newest value is one global aggregate (partial per task, one row to merge) used as a scalar subquery; with a
    date-partitioned source the filter prunes the other partitions.
    """
    snap = F.col(snapshot) if isinstance(snapshot, str) else snapshot
    tagged = df.withColumn("_snap", snap)
    return tagged.filter(F.col("_snap") == tagged.agg(F.max("_snap")).scalar()).drop("_snap")
