"""Landed source files: exchange-rate JSON, survey CSV, spec CSV, questionnaire JSON."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlake.operators.fx import FX_FILE_SCHEMA, fallback_rates, latest_rates, with_fallback
from offerlake.sources.offers import latest_snapshot, snapshot_date_from_name

SURVEY_SCHEMA = T.StructType([
    T.StructField("id_anonimo", T.StringType()), T.StructField("fecha_respuesta", T.StringType()),
    T.StructField("ciudad", T.StringType()), T.StructField("rango_edad", T.StringType()),
    T.StructField("ocupacion", T.StringType()), T.StructField("categoria_interes", T.StringType()),
    T.StructField("presupuesto_usd", T.StringType()), T.StructField("marca_preferida", T.StringType()),
    T.StructField("canal_preferido", T.StringType()), T.StructField("tienda_habitual", T.StringType()),
    T.StructField("frecuencia_compra_anual", T.StringType()), T.StructField("importancia_precio", T.IntegerType()),
])
QUESTIONNAIRE_SCHEMA = T.StructType([
    T.StructField("titulo", T.StringType()), T.StructField("anonimo", T.BooleanType()),
    T.StructField("preguntas", T.ArrayType(T.StructType([
        T.StructField("campo", T.StringType()), T.StructField("pregunta", T.StringType()),
        T.StructField("tipo", T.StringType())]))),
])


def _newest(df: DataFrame) -> DataFrame:
    tagged = df.withColumn("_file", F.col("_metadata.file_name"))
    return latest_snapshot(tagged, snapshot_date_from_name(F.col("_file"))).drop("_file")


def read_fx_files(spark: SparkSession, path: str) -> DataFrame:
    """Newest ``*_YYYY-MM-DD.json`` FX document(s) under ``path``; malformed files give no rows (PERMISSIVE)."""
    df = (spark.read.option("multiLine", True).option("mode", "PERMISSIVE").option("ignoreCorruptFiles", True)
          .schema(FX_FILE_SCHEMA).json(path))
    return _newest(df)


def rates_from_files(spark: SparkSession, path: str) -> DataFrame:
    """``(moneda, tasa)`` from the newest FX file, or the fallback table when none could be read."""
    latest = _newest_rates(spark, path)
    return fallback_rates(spark) if latest is None else with_fallback(latest, fallback_rates(spark))


def _newest_rates(spark: SparkSession, path: str) -> DataFrame | None:
    """Rates of the newest file, None where the folder is missing; any other fault (rights, schema) is raised."""
    try:
        return latest_rates(read_fx_files(spark, path)).filter(F.col("tasa").isNotNull())
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def fx_faults(spark: SparkSession, path: str) -> DataFrame:
    """Error-log fields of a missing or unreadable rate file: one row, or none if its rates are used."""
    latest = _newest_rates(spark, path)
    schema = "fuente string, tipo_error string, descripcion string, accion_tomada string"
    kind, what = ("Fuente", "Falta la carpeta de tasas: ") if latest is None else ("Parseo", "Ningun archivo con tasas legibles: ")
    row = spark.createDataFrame([("Staging:currency", kind, what + path, "Rigen las tasas fijas")], schema)
    return row if latest is None else row.where(latest.agg(F.count(F.lit(1))).scalar() == 0)


def read_survey(spark: SparkSession, path: str) -> DataFrame:
    """Newest survey CSV (budget read as text so that bad values can be coerced, not rejected)."""
    df = spark.read.option("header", True).option("encoding", "UTF-8").schema(SURVEY_SCHEMA).csv(path)
    return _newest(df)


def read_specs(spark: SparkSession, path: str) -> DataFrame:
    """Newest spec CSV, every column as text (mixed types tolerated); ``_row`` keeps the file order."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    df = df.withColumn("_row", F.monotonically_increasing_id())
    return _newest(df)


def read_questionnaire(spark: SparkSession, path: str) -> DataFrame:
    """Questionnaire dictionary: one row per question ``(campo, pregunta, tipo)`` plus the title."""
    q = spark.read.option("multiLine", True).schema(QUESTIONNAIRE_SCHEMA).json(path)
    return q.select("titulo", "anonimo", F.posexplode("preguntas").alias("orden", "q")).select(
        "titulo", "anonimo", (F.col("orden") + 1).alias("orden"), "q.*")
