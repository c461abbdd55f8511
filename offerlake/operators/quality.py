"""Data-quality controls (A3-A11, T3, T4, U2, K5): each control is one aggregate pass producing a small result.

Counts are conditional aggregates over a single scan rather than one job per counter, and percentages use the
half-to-even rounding of the reference report.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlake import rules
from offerlake.functions.keys import add_key
from offerlake.functions.price import parse_price, rint_round
from offerlake.functions.text import collapse_ws
from offerlake.operators.dedup import completeness
from offerlake.operators.staging import computed_once, is_bundle


def category_audit(df: DataFrame, valid: Sequence[str] = rules.VALID_CATEGORIES) -> DataFrame:
    """Per landed category value: its standard form, whether that form is a master category, and the row count."""
    return df.groupBy(F.col("categoria").alias("categoria_raw")).agg(F.count(F.lit(1)).alias("filas")).select(
        "categoria_raw",
        F.upper(collapse_ws(F.col("categoria_raw"))).alias("categoria_std"),
        F.upper(collapse_ws(F.col("categoria_raw"))).isin(*valid).alias("estandar"),
        "filas",
    )


def relevance_waterfall(standardized: DataFrame) -> DataFrame:
    """Row waterfall of the staging filters in one pass: total, whole-PC listings, unpriced, priced."""
    bundle = is_bundle(F.col("producto"))
    price = parse_price(F.col("precio_raw"))
    return standardized.agg(
        F.count(F.lit(1)).alias("total_raw"),
        F.count_if(bundle).alias("bundles"),
        F.count_if(~bundle & ~F.coalesce(price > 0, F.lit(False))).alias("sin_precio"),
        F.count_if(~bundle & (price > 0)).alias("con_precio"),
    )


def cast_failures(priced: DataFrame, col: str = "precio_usd") -> DataFrame:
    return priced.agg(F.count_if(F.col(col).isNull()).alias("no_parseables"))


def cast_examples(priced: DataFrame, order: Sequence[str], keep: Sequence[str] = (), n: int = 8,
                  raw: str = "precio_raw", out: str = "precio_usd") -> DataFrame:
    """First ``n`` parsed prices in ingest order, with a ``'raw[:30]' -> value`` evidence string."""
    ex = F.format_string("'%s' -> %s", F.trim(F.substring(F.col(raw), 1, 30)), F.col(out).cast("string"))
    return (priced.filter(F.col(out).isNotNull()).orderBy(*order).limit(n)
            .select(*keep, raw, out, ex.alias("ejemplo")))


def null_profile(df: DataFrame, fields: Sequence[str] = rules.KEY_FIELDS) -> DataFrame:
    """Null percentage per key field that exists (long form ``campo, pct_nulos``), one pass."""
    present = [f for f in fields if f in df.columns]
    wide = df.agg(*[rint_round(F.avg(F.col(f).isNull().cast("double")) * 100, 2).alias(f) for f in present])
    stack = ", ".join(f"'{f}', `{f}`" for f in present)
    return wide.selectExpr(f"stack({len(present)}, {stack}) AS (campo, pct_nulos)")


def complete_row(fields: Sequence[str]) -> Column:
    cond = F.lit(True)
    for f in fields:
        cond = cond & F.col(f).isNotNull()
    return cond


def key_coverage(staged: DataFrame) -> DataFrame:
    unc = F.col("clave_canonica") == rules.UNCLASSIFIED
    return staged.agg(
        rint_round((1 - F.avg(unc.cast("int"))) * 100, 2).alias("cobertura_clave_canonica_pct"),
        F.countDistinct(F.when(~unc, F.col("clave_canonica"))).alias("claves_distintas"),
    )


def dedup_metrics(before: DataFrame, keys: Sequence[str] = rules.DEDUP_KEYS) -> DataFrame:
    """Rows before dedup, rows after it, and the difference, in one pass over the pre-dedup rows.

    Dedup keeps exactly one row per key group, so the survivors are counted as key groups: a hash aggregate with a
    partial map-side count (a hot key is one row per task before the shuffle), with no survivor struct to carry.
    """
    per_key = before.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    m = per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("antes"), F.count(F.lit(1)).alias("despues"))
    return m.select("antes", "despues", (F.col("antes") - F.col("despues")).alias("duplicados_eliminados"))


def distribution(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, most frequent first (nulls excluded, like a value count)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("registros"))
            .orderBy(F.desc("registros"), F.asc(col)))


REPORT_SCHEMA = "seccion string, clave string, valor double, texto string"


def _section(df: DataFrame, name: str, key: Column, value: Column | None = None, text: Column | None = None) -> DataFrame:
    value = F.lit(None) if value is None else value
    text = F.lit(None) if text is None else text
    return df.select(F.lit(name).alias("seccion"), key.cast("string").alias("clave"), value.cast("double").alias("valor"),
                     text.cast("string").alias("texto"))


def _counters(df: DataFrame, name: str) -> DataFrame:
    """A one-row result as rows ``(column name, value)``."""
    pairs = F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("double").alias("v")) for c in df.columns])
    return _section(df.select(F.inline(pairs)), name, F.col("k"), F.col("v"))


#: Rows of the marked table: a whole-PC listing, no amount in its text, an amount that is not positive, a price.
BUNDLE, NO_AMOUNT, NOT_POSITIVE, PRICED = "paquete", "sin_importe", "no_positivo", "con_precio"


def marked_prices(standardized: DataFrame) -> DataFrame:
    """Every standardised row with ``paquete`` (whole-PC listing) and ``precio_usd`` (relevant rows)."""
    df = computed_once(standardized, "paquete", is_bundle(F.col("producto")))
    return computed_once(df, "precio_usd", F.when(~F.col("paquete"), parse_price(F.col("precio_raw"))))


def marked(standardized: DataFrame) -> DataFrame:
    """Every standardised row with ``paquete`` (whole-PC listing), ``precio_usd`` (relevant rows) and ``clave_canonica`` (priced rows):
    what the staging filters go by, without dropping a row."""
    df = marked_prices(standardized)
    priced = F.col("precio_usd") > 0
    df = add_key(df.withColumn("_categoria", F.when(priced, F.col("categoria"))), category="_categoria").drop("_categoria")
    return computed_once(df, "clave_canonica", F.when(priced, F.col("clave_canonica")))


def key_groups(rows: DataFrame, keys: Sequence[str] = rules.DEDUP_KEYS) -> DataFrame:
    """The one pass that every counter follows from: marked rows per (class, dedup key), with rows, nulls and the title of the row
    that dedup keeps.

    Rows that staging drops have no key: they are one group per class and category. Groups aggregate on the map side.
    """
    price = F.col("precio_usd")
    kind = F.when(F.col("paquete"), BUNDLE).when(price.isNull(), NO_AMOUNT).when(price > 0, PRICED).otherwise(NOT_POSITIVE)
    priced = ~F.col("paquete") & F.coalesce(price > 0, F.lit(False))
    cols = [c for c in rows.columns if c != "paquete"]
    # dedup compares all columns in order; up to the title they decide which title stays (keys are equal in a group)
    lead = [c for c in cols[:cols.index("producto") + 1] if c not in keys]
    rank = F.struct((-completeness(cols)).alias("_neg_complete"), *[F.col(f"`{c}`") for c in lead])
    by = [F.col(k) if k == "categoria" else F.when(priced, F.col(k)).alias(k) for k in keys]
    # struct minima are aggregated by sorting: a number as the first key spares comparing texts that begin alike
    number = F.when(priced, F.xxhash64(*keys))
    return rows.groupBy(number.alias("_h"), kind.alias("clase"), *by).agg(
        F.count(F.lit(1)).alias("filas"), F.count_if(F.col("tienda").isNull()).alias("sin_tienda"),
        F.count_if(F.col("producto").isNull()).alias("sin_producto"), F.min(F.when(priced, rank))["producto"].alias("titulo"))


def _totals() -> list[Column]:
    """Sums over key groups: rows by class, survivors, their completeness."""
    kind, n = F.col("clase"), F.col("filas")
    relevant = kind != BUNDLE
    kept = kind == PRICED
    whole = kept & F.col("titulo").isNotNull()
    for k in rules.DEDUP_KEYS:
        whole = whole & F.col(k).isNotNull()
    total = lambda cond, x=n: F.coalesce(F.sum(F.when(cond, x)), F.lit(0))
    return [F.coalesce(F.sum(n), F.lit(0)).alias("crudas"), total(~relevant).alias("paquetes"), total(kind.isin(NO_AMOUNT, NOT_POSITIVE)).alias("sin_precio"),
            total(kind == NO_AMOUNT).alias("sin_importe"), total(kept).alias("con_precio"), F.count_if(kept).alias("vivas"), F.count_if(whole).alias("completas"),
            F.count_if(kept & (F.col("clave_canonica") == rules.UNCLASSIFIED)).alias("sin_clase"),
            total(relevant, F.col("sin_tienda")).alias("sin_tienda"), total(relevant, F.col("sin_producto")).alias("sin_producto"),
            total(relevant & F.col("categoria").isNull()).alias("sin_categoria")]


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, rint_round(part / F.nullif(whole, F.lit(0)) * 100, 2)).otherwise(F.lit(0.0))


def _metrics() -> dict[str, Column]:
    """Final metrics from the totals. They add up: raw - bundles - unpriced - duplicates = staged."""
    c = F.col
    return {"total_registros_raw": c("crudas"), "registros_descartados_relevancia": c("paquetes"), "registros_eliminados_nulos": c("sin_precio"),
            "registros_depurados_duplicados": c("con_precio") - c("vivas"), "total_registros_staging": c("vivas"),
            "tasa_completitud_general_pct": _share(c("completas"), c("vivas")), "tasa_error_pct": _share(c("crudas") - c("vivas"), c("crudas"))}


def metrics_of_marked(rows: DataFrame) -> DataFrame:
    """Consolidated metrics row from one pass over the marked rows."""
    return key_groups(rows).agg(*_totals()).select(*[v.alias(k) for k, v in _metrics().items()])


def _counters_of_groups(groups: DataFrame, valid: Sequence[str] = rules.VALID_CATEGORIES) -> DataFrame:
    """All counted sections of the report from the key groups: totals and the totals per store, category and canonical key in one
    grouping-sets aggregate, then one small aggregate of the report's rows."""
    by = ["tienda", "categoria", "clave_canonica"]
    sets = [[], *[[F.col(c)] for c in by]]
    level = groups.groupingSets(sets, *[F.col(c) for c in by]).agg(F.grouping_id().alias("_set"), *_totals())
    # an empty table has no total row of its own
    none = groups.sparkSession.range(1).select(*[F.lit(None).cast("string").alias(c) for c in by], F.lit(7).cast("long").alias("_set"),
                                               *[F.lit(0).cast("long").alias(c) for c in level.columns[4:]])
    level = level.select(*by, F.col("_set").cast("long").alias("_set"), *level.columns[4:]).unionByName(none)

    def row(section: str, key: Column | str, value: Column | float | None) -> Column:
        key = F.lit(key) if isinstance(key, str) else key
        value = F.lit(value) if not isinstance(value, Column) else value
        return F.struct(F.lit(section).alias("seccion"), key.cast("string").alias("clave"), value.cast("double").alias("valor"))

    c = F.col
    relevant = c("crudas") - c("paquetes")
    nulls = {"tienda": c("sin_tienda"), "categoria": c("sin_categoria"), "producto": c("sin_producto"), "precio_usd": c("sin_importe")}
    covered = F.when(c("vivas") > 0, rint_round((1 - c("sin_clase") / F.nullif(c("vivas"), F.lit(0))) * 100, 2))
    total = F.array(
        row("duplicados", "antes", c("con_precio")), row("duplicados", "despues", c("vivas")), row("duplicados", "duplicados_eliminados", c("con_precio") - c("vivas")),
        *[row("nulos_pct", k, F.when(relevant > 0, _share(v, relevant))) for k, v in nulls.items()],
        row("conversion", "no_parseables", c("sin_importe")), *[row("metricas", k, v) for k, v in _metrics().items()],
        row("clave_canonica", "cobertura_clave_canonica_pct", covered), row("clave_canonica", "claves_distintas", 0.0))
    per_store = F.array(row("tienda", c("tienda"), F.when(c("tienda").isNotNull() & (c("vivas") > 0), c("vivas"))))
    per_category = F.array(
        row("categoria", c("categoria"), F.when(c("categoria").isNotNull() & (c("vivas") > 0), c("vivas"))),
        row("categoria_no_estandar", c("categoria"), F.when(~F.coalesce(c("categoria").isin(*valid), F.lit(False)), F.lit(-1.0))))
    per_key = F.array(row("clave_canonica", "claves_distintas", F.when((c("clave_canonica") != rules.UNCLASSIFIED) & (c("vivas") > 0), 1.0)))
    made = level.select("_set", F.inline(F.when(c("_set") == 7, total).when(c("_set") == 3, per_store).when(c("_set") == 5, per_category).otherwise(per_key)))
    made = made.where((c("_set") == 7) | c("valor").isNotNull())
    out = made.groupBy("seccion", "clave").agg(F.sum("valor").alias("valor"))
    # a category outside the master list is listed without a number
    return out.select("seccion", "clave", F.when(c("seccion") != "categoria_no_estandar", c("valor")).alias("valor"), F.lit(None).cast("string").alias("texto"))


def report_of_marked(rows: DataFrame, survey: DataFrame | None = None, specs: DataFrame | None = None, order: Sequence[str] = (),
                     prices: DataFrame | None = None) -> DataFrame:
    """The whole quality report in long form: duplicates and their criterion, nulls, casts, categories outside the master list,
    the homologation map, final metrics, key coverage, distributions, survey and spec counts.

    ``rows`` is the marked table, ``survey`` the survey before imputation, ``specs`` the staged spec table. The counted sections
    read the marked rows once; the cast examples are a top-k, a second read of three columns, from ``prices`` (``marked_prices`` of
    the same rows) without making keys again.
    """
    from offerlake.operators.normalize import homologation_map
    from offerlake.operators.survey import survey_nulls

    spark = rows.sparkSession
    criterion = spark.createDataFrame([("criterio", ", ".join(rules.DEDUP_KEYS))], "k string, t string")
    examples = cast_examples(rows if prices is None else prices, order or ["producto", "tienda", "precio_raw"])
    parts = [
        _counters_of_groups(key_groups(rows)),
        _section(criterion, "duplicados", F.col("k"), text=F.col("t")),
        _section(examples, "conversion_ejemplo", F.col("precio_raw"), F.col("precio_usd"), F.col("ejemplo")),
        _section(homologation_map(spark), "homologacion", F.concat_ws(".", "campo", "fuente"), text=F.col("expresion")),
    ]
    if survey is not None:
        parts.append(_counters(survey_nulls(survey), "encuesta"))
    if specs is not None:
        parts.append(_counters(specs.agg(F.count(F.lit(1)).alias("registros")), "especificaciones"))
    return reduce(DataFrame.unionByName, parts)


def wide_report(report: DataFrame) -> DataFrame:
    """The report's metrics and key coverage as one row, counters as whole numbers."""
    names = [*_metrics(), "cobertura_clave_canonica_pct", "claves_distintas"]
    mine = report.where(F.col("seccion").isin("metricas", "clave_canonica"))
    value = {k: F.max(F.when(F.col("clave") == k, F.col("valor"))) for k in names}
    return mine.agg(*[(v if k.endswith("_pct") else v.cast("long")).alias(k) for k, v in value.items()])
