"""Exchange-rate sources and long-form conversion."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlake import rules
from offerlake.functions.fx import convert

LATEST_SCHEMA = T.StructType([
    T.StructField("amount", T.DoubleType()),
    T.StructField("base", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("rates", T.MapType(T.StringType(), T.DoubleType())),
])
HISTORY_SCHEMA = T.StructType([
    T.StructField("base", T.StringType()),
    T.StructField("start_date", T.StringType()),
    T.StructField("end_date", T.StringType()),
    T.StructField("rates", T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType()))),
])
FX_FILE_SCHEMA = T.StructType([
    T.StructField("latest", LATEST_SCHEMA),
    T.StructField("historico", HISTORY_SCHEMA),
])


def rates_table(rates: Mapping[str, float], spark) -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in rates.items()], "moneda string, tasa double")


def fallback_rates(spark) -> DataFrame:
    return rates_table(rules.FALLBACK_RATES, spark)


def latest_rates(fx_files: DataFrame) -> DataFrame:
    """``(moneda, tasa)`` from parsed FX files (``latest.rates``)."""
    return fx_files.select(F.explode("latest.rates").alias("moneda", "tasa"))


def with_fallback(latest: DataFrame, fallback: DataFrame) -> DataFrame:
    """All-or-nothing fallback: the fallback table only when no latest rate was read (a one-row count guard)."""
    n = latest.agg(F.count(F.lit(1))).scalar()
    return latest.unionByName(fallback.filter(n == 0))


def parse_history(docs: DataFrame, text: str = "doc") -> DataFrame:
    """History documents (JSON text) -> ``(fecha, base, moneda, tasa)`` long rows via two explodes (date as text)."""
    parsed = docs.select(F.from_json(F.col(text), HISTORY_SCHEMA).alias("h"))
    per_day = parsed.select(F.col("h.base").alias("base"), F.explode("h.rates").alias("fecha", "r"))
    return per_day.select("fecha", "base", F.explode("r").alias("moneda", "tasa"))


def history_window(series: DataFrame, days: int = rules.FX_HISTORY_DAYS) -> DataFrame:
    """Rows of the last ``days`` days ending at the newest date of the series."""
    newest = series.agg(F.max(F.to_date("fecha"))).scalar()
    return series.filter(F.to_date("fecha") >= F.date_sub(newest, days))


def convert_long(df: DataFrame, rates: Mapping[str, float], usd: str) -> DataFrame:
    """Long form: one row per (input row, currency), a narrow fan-out over the literal rate map (no join)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("moneda"), F.lit(float(r)).alias("tasa")) for c, r in rates.items()])
    return df.select("*", F.inline(pairs)).withColumn("precio", convert(F.col(usd), F.col("tasa")))
