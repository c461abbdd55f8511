"""Structured spec file staging."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlake import rules
from offerlake.functions.keys import canonical_key
from offerlake.operators.dedup import keep_first


def project_specs(df: DataFrame, column_map: Mapping[str, str] = rules.SPEC_COLUMN_MAP,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Select and rename the mapped columns that are present (backticks: names such as ``# of CPU Cores``)."""
    present = [(k, v) for k, v in column_map.items() if k in df.columns]
    return df.select(*keep, *[F.col(f"`{k}`").alias(v) for k, v in present])


def stage_specs(df: DataFrame, order: Sequence[str], column_map: Mapping[str, str] = rules.SPEC_COLUMN_MAP) -> DataFrame:
    """Projected specs without null models, one row per model (first in file order ``order``); counts as doubles."""
    keep = [c for c in order if c not in column_map]
    proj = df.select(*[F.col(f"`{k}`").alias(v) for k, v in column_map.items() if k in df.columns], *keep)
    proj = proj.dropna(subset=["modelo"])
    first = keep_first(proj, "modelo", order).drop(*keep)
    casts = {c: F.col(c).try_cast("double") for c in ("nucleos", "hilos") if c in first.columns}
    return first.withColumns(casts)


def validate_schema(df: DataFrame, name: str, required: Sequence[str] = rules.SPEC_REQUIRED_COLUMNS) -> DataFrame:
    """One row per dataset: rows, columns, missing required columns and status (rows counted in the same job)."""
    missing = [c for c in required if c not in df.columns]
    return df.agg(F.count(F.lit(1)).alias("filas")).select(
        F.lit(name).alias("dataset"),
        "filas",
        F.lit(len(df.columns)).alias("columnas"),
        F.array(*[F.lit(m) for m in missing]).cast("array<string>").alias("faltantes"),
        F.lit("VALIDO" if not missing else "ESQUEMA INVALIDO").alias("estado"),
    )


def spec_key(model: str = "modelo") -> "F.Column":
    """Canonical key of a spec model: trademark signs removed, then the CPU key rules."""
    cleaned = F.regexp_replace(F.col(model), "[™®]", "")
    return canonical_key(cleaned, F.lit("CPU"))


def specs_by_key(specs: DataFrame, order: Sequence[str]) -> DataFrame:
    """Specs keyed like offers, one row per key (first in ``order``), order columns dropped."""
    keyed = specs.withColumn("clave_canonica", spec_key()).filter(F.col("clave_canonica") != rules.UNCLASSIFIED)
    return keep_first(keyed, "clave_canonica", order).drop(*order)


def enrich_offers(offers: DataFrame, specs: DataFrame, order: Sequence[str]) -> DataFrame:
    """Left join of offers to specs on the canonical key. The spec side has one row per key (a few hundred models
    in practice): AQE broadcasts it when its measured size allows, else a sort-merge join with skew splitting."""
    return offers.join(specs_by_key(specs, order), on="clave_canonica", how="left")
