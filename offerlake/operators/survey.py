"""Survey staging.

Median imputation is a grouped exact median joined back, not a window: see ``operators.median``. The join with the per-category
result is sized by AQE at run time (broadcast when small, skew-split sort-merge otherwise).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlake import rules
from offerlake.operators.median import exact_median


def impute_budget(df: DataFrame, value: str = "presupuesto_usd", group: str = "categoria_interes") -> DataFrame:
    """Numeric coercion (bad text -> null), then null budgets take their group's exact median.

    A row whose group key is null keeps its value (nothing to impute from); an all-null group stays null.
    """
    coerced = df.withColumn(value, F.col(value).cast("string").try_cast("double"))
    medians = exact_median(coerced, group, value, "_median").drop("filas")
    joined = coerced.join(medians, on=group, how="left")
    return joined.withColumn(value, F.coalesce(F.col(value), F.col("_median"))).drop("_median").select(*df.columns)


def fill_city(df: DataFrame, col: str = "ciudad", default: str = rules.CITY_DEFAULT) -> DataFrame:
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(default)))


def stage_survey(df: DataFrame) -> DataFrame:
    return fill_city(impute_budget(df))


def survey_nulls(df: DataFrame, value: str = "presupuesto_usd", city: str = "ciudad") -> DataFrame:
    """Counts measured before imputation (one pass)."""
    return df.agg(
        F.count(F.lit(1)).alias("registros"),
        F.count_if(F.col(value).cast("string").try_cast("double").isNull()).alias("presupuesto_imputado"),
        F.count_if(F.col(city).isNull()).alias("ciudad_imputada"),
    )


def survey_ids(df: DataFrame, col: str = "id_anonimo") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("registros"), F.countDistinct(col).alias("ids_unicos"))
