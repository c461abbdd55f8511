"""Incremental load of the star schema (M1-M9): dimensions that keep their ids, facts by run, and a co-partitioned copy.

``load`` appends what is new to the four dimensions (``operators.keyring``) and writes the run's facts into the run's own
partition, so a load that is repeated changes nothing and a later one leaves earlier ids and facts as they are.

``bucketed`` writes facts and products as tables bucketed on the product id. A join or aggregate on that id then reads both
sides as they lie, without an exchange.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake.operators import warehouse as wh
from offerlake.operators.keyring import append_new, read_or_none
from offerlake.sinks.writers import run_path, write_run

TABLES = ("dim_tiempo", "dim_fuente", "dim_tienda", "dim_producto", "fact_precios")


def load(staged: DataFrame, out_dir: str, run_id: str, rates: DataFrame | None = None, specs: DataFrame | None = None) -> dict[str, DataFrame]:
    """Load one run's staged offers into the star at ``out_dir``; returns the five tables, the fact table over all runs.

    ``rates`` is the rate history (see ``warehouse.fact_prices``), ``specs`` the spec sheet of each canonical key.
    """
    spark = staged.sparkSession
    path = {t: f"{out_dir.rstrip('/')}/{t}" for t in TABLES}
    run_path(path["fact_precios"], run_id)  # a bad run id fails before anything is written
    sources = append_new(wh.source_rows(spark), path["dim_fuente"], "nombre_fuente", "id_fuente", run_id)
    stores = append_new(wh.store_rows(staged.select(F.col("tienda").alias("nombre_tienda"), "pais")), path["dim_tienda"], "nombre_tienda", "id_tienda", run_id)
    products = append_new(wh.product_rows(staged, specs), path["dim_producto"], "clave_canonica", "id_producto", run_id)
    write_run(wh.fact_prices(staged, products, stores, sources, rates=rates), path["fact_precios"], run_id)
    return {"dim_tiempo": _calendar(staged, path["dim_tiempo"], run_id), "dim_fuente": sources, "dim_tienda": stores, "dim_producto": products,
            "fact_precios": spark.read.parquet(path["fact_precios"])}


def _calendar(staged: DataFrame, path: str, run_id: str) -> DataFrame:
    """Days of the run that the calendar lacks are appended; a day's key is the day itself."""
    days = wh.calendar(staged, "fecha_extraccion")
    known = read_or_none(staged.sparkSession, path, days.schema)
    fresh = days if known is None else days.join(known.select("id_tiempo"), "id_tiempo", "left_anti")
    # the days are worked out before the folder changes under the anti join
    fresh.checkpoint(eager=True).write.mode("append").parquet(path)
    return staged.sparkSession.read.schema(days.schema).parquet(path)


def bucketed(spark: SparkSession, tables: Mapping[str, DataFrame], out_dir: str, buckets: int, prefix: str = "estrella") -> dict[str, str]:
    """Write facts and products bucketed and sorted on ``id_producto``; returns the names of the session's tables.

    ``buckets`` follows from the size of a bucket that a task should read. The tables are external: their files stay when the
    session ends, and another session declares them again (``CREATE TABLE ... CLUSTERED BY ... LOCATION``).
    """
    names = {}
    for t in ("fact_precios", "dim_producto"):
        names[t] = f"{prefix}_{t}"
        # one shuffle now, so that a bucket is a file or few and no later join shuffles the facts
        (tables[t].repartition(buckets, "id_producto").write.mode("overwrite").bucketBy(buckets, "id_producto").sortBy("id_producto")
         .option("path", f"{out_dir.rstrip('/')}/{names[t]}").saveAsTable(names[t]))
    return names


def prices_by_product(spark: SparkSession, names: Mapping[str, str]) -> DataFrame:
    """Offers, cheapest and dearest price per product from the bucketed tables: no exchange below the result."""
    fact, product = spark.table(names["fact_precios"]), spark.table(names["dim_producto"])
    g = fact.groupBy("id_producto").agg(F.count(F.lit(1)).alias("ofertas"), F.min("precio_usd").alias("precio_min"), F.max("precio_usd").alias("precio_max"))
    return g.hint("merge").join(product.select("id_producto", "clave_canonica", "marca", "categoria").hint("merge"), "id_producto")
