"""Writers. Every sink is a distributed DataFrame write to shared storage; nothing passes through the driver.

A run writes each table into its own partition, ``corrida=<run id>``, and replaces that partition when it runs again. So a run
that is repeated changes nothing, and no run touches what another one wrote. Reading the table's folder gives all runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake import rules
from offerlake.functions.text import clean_log_text
from offerlake.operators.keyring import RUN_ID

# Staged offer columns in export order (all six converted prices and the rates used; see README on Q19).
STAGED_EXPORT_COLUMNS = ["tienda", "pais", "moneda", "categoria", "producto", "clave_canonica", "precio_raw", "precio_usd",
                         "precio_eur", "precio_brl", "precio_mxn", "precio_gbp", "precio_cad", "precio_jpy",
                         "tasas_referencia", "url_producto", "fecha_extraccion", "fecha_staging"]


def run_path(path: str, run_id: str) -> str:
    if not RUN_ID.fullmatch(run_id):
        raise ValueError(f"a run id is made of letters, digits, dots, dashes and underscores: {run_id!r}")
    return f"{path.rstrip('/')}/corrida={run_id}"


def write_run(df: DataFrame, path: str, run_id: str, sort_by: Sequence[str | Column] | None = None, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as what run ``run_id`` knows of the table at ``path`` and read it back; ``sort_by`` gives a range-partitioned,
    globally sorted output."""
    out = df.orderBy(*sort_by) if sort_by else df
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(run_path(path, run_id))
    return df.sparkSession.read.schema(df.schema).parquet(run_path(path, run_id))


def staged_columns(df: DataFrame, columns: Sequence[str] = STAGED_EXPORT_COLUMNS) -> DataFrame:
    """The export columns in their order, those that are present, then converted prices in further currencies."""
    more = [c for c in df.columns if c.startswith("precio_") and c not in columns]
    return df.select(*[c for c in columns if c in df.columns], *more)


def write_staged(df: DataFrame, path: str, run_id: str, columns: Sequence[str] = STAGED_EXPORT_COLUMNS) -> DataFrame:
    """Staged offers of a run, partitioned by staging date as well; read back."""
    return write_run(staged_columns(df, columns), path, run_id, partition_by=["fecha_staging"] if "fecha_staging" in df.columns else [])


def error_log_rows(spark: SparkSession, rows: Sequence[tuple[str, str, str, str]], when: Column | None = None) -> DataFrame:
    """Error-log rows ``(fuente, tipo_error, descripcion, accion_tomada)``: see ``error_log_frame``."""
    df = spark.createDataFrame(list(rows), "fuente string, tipo_error string, descripcion string, accion_tomada string")
    return error_log_frame(df, when)


def error_log_frame(df: DataFrame, when: Column | None = None) -> DataFrame:
    """Log rows stamped with ``when`` (default: now). ``descripcion`` has newlines turned to spaces, is trimmed and capped at 300
    characters; ``detalle`` is the whole description as it came."""
    ts = when if when is not None else F.current_timestamp()
    return df.select(F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("timestamp"), "fuente", "tipo_error",
                     clean_log_text(F.col("descripcion"), rules.ERROR_LOG_MAX_CHARS).alias("descripcion"),
                     "accion_tomada", F.col("descripcion").alias("detalle"))


def append_error_log(df: DataFrame, path: str, run_id: str) -> None:
    """The run's part of the persistent error log; earlier runs' rows stay."""
    write_run(df.select(*rules.ERROR_LOG_COLUMNS, "detalle"), path, run_id)


def write_quality_report(report: DataFrame, path: str, run_id: str) -> None:
    """One-row quality report of a run as JSON (a single small file: the report is one row by construction)."""
    report.coalesce(1).write.mode("overwrite").json(run_path(path, run_id))
