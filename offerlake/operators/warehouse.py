"""Star schema (M1-M9, J2, J3): dimensions, fact, surrogate keys and constraint checks.

Surrogate keys of one load are dense ranks of the natural key computed without a single-partition window: the rows are range-
sorted across all tasks, checkpointed (which fixes partitions and order and cuts lineage), and each row's id is its
partition's offset (a prefix sum over one count per partition) plus its position inside the partition. Loads that follow one
another keep their ids by ``operators.keyring``, which numbers new natural keys only (``plans.star``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerlake import rules
from offerlake.functions.dates import calendar_columns
from offerlake.operators.asof import join_as_of
from offerlake.session import ensure_checkpoint_dir


def with_dense_id(df: DataFrame, order: Sequence[str], id_col: str) -> DataFrame:
    """Add ``id_col`` = 1-based rank of each row by ``order`` (ascending, nulls first; ``order`` must be unique)."""
    ensure_checkpoint_dir(df.sparkSession)
    ranked = df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).checkpoint(eager=True)
    tagged = ranked.withColumns({"_pid": F.spark_partition_id(), "_mono": F.monotonically_increasing_id()})
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: the prefix sum runs on a table whose size is the partition count.
    offsets = counts.select("_pid", F.coalesce(
        F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    pos = F.col("_mono") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    out = tagged.join(F.broadcast(offsets), "_pid").withColumn(id_col, F.col("_off") + pos + 1)
    return out.select(id_col, *df.columns)


def calendar(dates: DataFrame, col: str) -> DataFrame:
    """Dense calendar from the smallest to the largest date of ``col`` with calendar attributes.

    The bounds are one global aggregate; the explode covers the date range only (days, not rows).
    ``id_tiempo`` is the ``yyyyMMdd`` smart key, so the fact can compute it from its own date without a lookup.
    """
    bounds = dates.agg(F.min(F.to_date(col)).alias("lo"), F.max(F.to_date(col)).alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("fecha"))
    d = F.col("fecha")
    return days.select(date_key(d).alias("id_tiempo"), F.date_format(d, "yyyy-MM-dd").alias("fecha"),
                       *[v.alias(k) for k, v in calendar_columns(d).items()])


def date_key(d: Column) -> Column:
    return F.date_format(d, "yyyyMMdd").cast("int")


def source_rows(spark) -> DataFrame:
    """Seeded sources plus the sources this pipeline actually reads (offers, FX, survey, specs), without ids."""
    extra = [
        ("Scraping tiendas", "Web Scraping", "Spark", "Diaria", None),
        ("Encuesta propia", "Encuesta", "Spark", "Unica", None),
    ]
    rows = [tuple(r) for r in rules.SOURCE_SEEDS] + extra
    return spark.createDataFrame(rows, "nombre_fuente string, tipo_extraccion string, tecnologia string, "
                                       "frecuencia_actualizacion string, url_o_endpoint string")


def source_dim(spark) -> DataFrame:
    """The sources with ids by name."""
    # A fixed, tiny literal table: a one-task window is the right tool here.
    return source_rows(spark).select(F.row_number().over(Window.orderBy("nombre_fuente")).cast("int").alias("id_fuente"), "*")


def store_rows(observed: DataFrame) -> DataFrame:
    """Seeded stores, plus observed stores (``nombre_tienda, pais``) not among the seeds, without ids.

    A store has one row: seen with several countries it keeps the first in alphabetical order."""
    spark = observed.sparkSession
    seeds = spark.createDataFrame([tuple(r) for r in rules.STORE_SEEDS],
                                  "nombre_tienda string, pais string, moneda_nativa string, tipo_tienda string, url_base string")
    named = observed.filter(F.col("nombre_tienda").isNotNull()).groupBy("nombre_tienda").agg(F.min("pais").alias("pais"))
    obs = named.join(F.broadcast(seeds.select("nombre_tienda")),
                                                                  "nombre_tienda", "left_anti")
    obs = obs.select("nombre_tienda", "pais", F.lit(rules.BASE_CURRENCY).alias("moneda_nativa"),
                     F.lit(rules.STORE_TYPES[0]).alias("tipo_tienda"), F.lit(None).cast("string").alias("url_base"))
    return seeds.unionByName(obs)


def store_dim(observed: DataFrame) -> DataFrame:
    """The stores with ids by name; ``keyring.append_new`` over ``store_rows`` keeps ids between loads instead."""
    return with_dense_id(store_rows(observed), ["nombre_tienda"], "id_tienda")


def brand_of(title: Column, brands: Sequence[str]) -> Column:
    """First brand (rule order) appearing as a whole word in the title, else the unknown-brand marker."""
    low = F.lower(title)
    expr = None
    for b in brands:
        cond = low.rlike("(^|[^a-z0-9])" + _re_escape(b.lower()) + "([^a-z0-9]|$)")
        expr = F.when(cond, F.lit(b)) if expr is None else expr.when(cond, F.lit(b))
    return expr.otherwise(F.lit(rules.UNKNOWN_BRAND))


def _re_escape(s: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in s)


def product_rows(staged: DataFrame, specs: DataFrame | None = None) -> DataFrame:
    """One row per canonical key, without ids: the cheapest offer's title and category, brand from the brand rules, the key's
    leading word as subcategory (the product family; null for the unclassified), and where ``specs`` (one row per
    ``clave_canonica``) knows the key, its sheet as JSON text."""
    g = staged.groupBy("clave_canonica").agg(F.min(F.struct("precio_usd", "tienda", "producto", "categoria")).alias("m"))
    sheet = F.lit(None).cast("string")
    if specs is not None:
        names = [c for c in specs.columns if c != "clave_canonica"]
        g = g.join(specs.select("clave_canonica", F.to_json(F.struct(*names)).alias("_ficha")), "clave_canonica", "left")
        sheet = F.col("_ficha")
    family = F.nullif(F.regexp_extract("clave_canonica", "^[a-z]+", 0), F.lit(""))
    return g.select(
        "clave_canonica",
        brand_of(F.col("m.producto"), rules.BRANDS).alias("marca"),
        F.upper(F.col("m.categoria")).alias("categoria"),
        F.when(F.col("clave_canonica") != rules.UNCLASSIFIED, family).alias("subcategoria"),
        F.col("m.producto").alias("modelo_raw"),
        sheet.alias("especificaciones"),
    )


def product_dim(staged: DataFrame, specs: DataFrame | None = None) -> DataFrame:
    """The products with ids by key; ``keyring.append_new`` over ``product_rows`` keeps ids between loads instead."""
    return with_dense_id(product_rows(staged, specs), ["clave_canonica"], "id_producto")


def fact_prices(staged: DataFrame, products: DataFrame, stores: DataFrame, sources: DataFrame,
                source_name: str = "Scraping tiendas", rates: DataFrame | None = None) -> DataFrame:
    """Fact rows with the four surrogate keys; money as DECIMAL(12,4), rate DECIMAL(10,6), stock default true.

    Dimension joins are left equi-joins on natural keys, so an offer without a store keeps its fact with a null key (which
    the NOT NULL check counts); Catalyst/AQE size each dimension. The fact's own id is the md5 of its natural key (store, category,
    key, price and day): no sort, no checkpoint, and the same id when a load is repeated.

    ``rates`` is the rate history ``fecha, moneda, tasa`` (units of ``moneda`` per dollar). An offer's amount is then in its own
    currency, and the rate is the newest one quoted by its date: dollars = amount / rate, null before the first quotation.
    Without a history every offer is in dollars.
    """
    src_id = sources.filter(F.col("nombre_fuente") == source_name).agg(F.max("id_fuente")).scalar()
    f = (staged
         .join(products.select("id_producto", "clave_canonica"), "clave_canonica", "left")
         .join(stores.select("id_tienda", F.col("nombre_tienda").alias("tienda")), "tienda", "left")
         .withColumn("id_fuente", src_id))
    amount = F.col("precio_usd")
    quoted, per_dollar = F.lit(None).cast("date"), F.lit(1.0)
    if rates is not None:
        day = rates.select("moneda", F.to_date("fecha").alias("fecha_tasa"), "tasa").where(F.col("moneda") != rules.BASE_CURRENCY)
        f = join_as_of(f.withColumn("_dia", F.to_date("fecha_extraccion")), day, ["moneda"], "_dia", "fecha_tasa", ["tasa"])
        base = F.col("moneda") == rules.BASE_CURRENCY
        per_dollar = F.when(base, F.lit(1.0)).otherwise(F.col("tasa"))
        quoted = F.when(base, F.col("_dia")).otherwise(F.col("fecha_tasa"))
    natural = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("~")) for c in ("tienda", "categoria", "clave_canonica")],
                          F.coalesce(amount.cast("decimal(12,4)").cast("string"), F.lit("~")), F.coalesce("fecha_extraccion", F.lit("~")))
    cols = [
        F.md5(natural).alias("id_hecho"),
        "id_producto", "id_tienda",
        date_key(F.to_date("fecha_extraccion")).alias("id_tiempo"),
        "id_fuente",
        amount.cast("decimal(12,4)").alias("precio_original"),
        F.col("moneda").alias("moneda_original"),
        per_dollar.cast("decimal(10,6)").alias("tasa_cambio_usd"),
        (amount / F.nullif(per_dollar, F.lit(0.0)) if rates is not None else amount).cast("decimal(12,4)").alias("precio_usd"),
        F.lit(True).alias("stock_disponible"),
        F.to_timestamp_ntz(F.col("fecha_extraccion")).alias("fecha_extraccion"),
        "url_producto",
    ]
    return f.select(*cols, *([quoted.alias("fecha_tasa")] if rates is not None else []))


# Enumerations checked on the dimensions. The declared source types lack the survey; it is added (see README).
CHECKED_EXTRACTION_TYPES = rules.EXTRACTION_TYPES + ["Encuesta"]
CHECKED_CATEGORIES = [c.upper() for c in rules.PRODUCT_CATEGORIES]


def constraint_rules(tiempo: DataFrame, fuente: DataFrame, tienda: DataFrame, producto: DataFrame,
                     fact: DataFrame) -> list[tuple[str, str, DataFrame, Column]]:
    return [
        ("dim_tiempo", "mes BETWEEN 1 AND 12", tiempo, F.col("mes").between(1, 12)),
        ("dim_tiempo", "trimestre BETWEEN 1 AND 4", tiempo, F.col("trimestre").between(1, 4)),
        ("dim_fuente", "tipo_extraccion IN (...)", fuente, F.col("tipo_extraccion").isin(*CHECKED_EXTRACTION_TYPES)),
        ("dim_fuente", "frecuencia_actualizacion IN (...)", fuente,
         F.col("frecuencia_actualizacion").isin(*rules.UPDATE_FREQUENCIES)),
        ("dim_tienda", "tipo_tienda IN (...)", tienda, F.col("tipo_tienda").isin(*rules.STORE_TYPES)),
        ("dim_producto", "categoria IN (...)", producto, F.col("categoria").isin(*CHECKED_CATEGORIES)),
        ("fact_precios", "precio_original > 0", fact, F.col("precio_original") > 0),
        ("fact_precios", "tasa_cambio_usd > 0", fact, F.col("tasa_cambio_usd") > 0),
        ("fact_precios", "precio_usd > 0", fact, F.col("precio_usd") > 0),
    ]


def check_rules(rules_: Sequence[tuple[str, str, DataFrame, Column]]) -> DataFrame:
    """Evaluate ``(table, rule, frame, predicate)`` rules: one aggregate per table, rows ``(tabla, regla, violaciones)``."""
    tables: dict[tuple[str, int], tuple[DataFrame, list[tuple[str, Column]]]] = {}
    for table, rule, df, pred in rules_:
        tables.setdefault((table, id(df)), (df, []))[1].append((rule, pred))
    parts = []
    for (table, _), (df, mine) in tables.items():
        counts = df.agg(*[F.count_if(~F.coalesce(pred, F.lit(False))).alias(f"_v{i}") for i, (_, pred) in enumerate(mine)])
        parts.append(counts.select(F.lit(table).alias("tabla"), F.inline(F.array(*[
            F.struct(F.lit(rule).alias("regla"), F.col(f"_v{i}").alias("violaciones")) for i, (rule, _) in enumerate(mine)]))))
    return reduce(DataFrame.unionByName, parts)


def unique_violations(df: DataFrame, table: str, key: str) -> DataFrame:
    """Null count and duplicated-value count of a column that must be NOT NULL UNIQUE."""
    nulls = df.agg(F.count_if(F.col(key).isNull()).alias("nulos"))
    dups = (df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.count_if(F.col("n") > 1)).scalar())
    return nulls.select(F.lit(table).alias("tabla"), F.lit(key).alias("columna"), "nulos", dups.alias("duplicados"))


#: Columns declared NOT NULL, per table (their generated keys included).
NOT_NULL = {
    "dim_tiempo": ["id_tiempo", "fecha", "semana_iso", "mes", "trimestre", "anio", "nombre_dia"],
    "dim_fuente": ["id_fuente", "nombre_fuente", "tipo_extraccion", "tecnologia", "frecuencia_actualizacion"],
    "dim_tienda": ["id_tienda", "nombre_tienda", "pais", "moneda_nativa", "tipo_tienda"],
    "dim_producto": ["id_producto", "clave_canonica", "marca", "categoria"],
    "fact_precios": ["id_hecho", "id_producto", "id_tienda", "id_tiempo", "id_fuente", "precio_original", "moneda_original",
                     "tasa_cambio_usd", "precio_usd", "stock_disponible", "fecha_extraccion"],
}


def null_violations(df: DataFrame, table: str) -> DataFrame:
    """Rows ``(tabla, columna, nulos)``: nulls of every NOT NULL column of ``table``, in one aggregate."""
    cols = NOT_NULL[table]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.select(F.lit(table).alias("tabla"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("columna"), F.col(c).alias("nulos")) for c in cols])))


def fk_violations(fact: DataFrame, fk: str, dim: DataFrame, pk: str, name: str) -> DataFrame:
    """Fact rows whose foreign key has no dimension row (anti join), as a count."""
    orphans = fact.select(fk).join(dim.select(F.col(pk).alias(fk)), fk, "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("huerfanos")).select(F.lit(name).alias("relacion"), "huerfanos")
