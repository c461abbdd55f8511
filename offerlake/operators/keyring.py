"""Surrogate keys that stay the same between loads (M3, M4, M6).

A dimension is an append-only table: one row per natural key with the id that it got when it was first seen. A load anti-joins
its rows to the table, numbers only the new natural keys, from the largest id on, and appends them. Rows that are there are
never sorted, renumbered or rewritten, and a load that runs again finds nothing new.

Numbering is by range: only the new keys are sorted across all tasks, and a key's id is its partition's offset plus its
position there, so no window runs over one partition of rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlake.operators.warehouse import with_dense_id

RUN_ID = re.compile(r"[A-Za-z0-9._-]+")


def read_or_none(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The table at ``path``, None where there is none; any other fault is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def append_new(rows: DataFrame, path: str, natural: str, id_col: str, run_id: str) -> DataFrame:
    """Append the rows of ``rows`` whose ``natural`` key is not in the table at ``path`` yet, with the next ids; return the table.

    ``rows`` holds a natural key once; rows without one are left out (they cannot be told apart). Ids are longs from 1; new keys
    of one load are numbered in their own order. One load of a table runs at a time.
    """
    if not RUN_ID.fullmatch(run_id):
        raise ValueError(f"a run id is made of letters, digits, dots, dashes and underscores: {run_id!r}")
    spark = rows.sparkSession
    schema = T.StructType([T.StructField(id_col, T.LongType()), *rows.schema.fields, T.StructField("lote", T.StringType())])
    known = read_or_none(spark, path, schema)
    fresh = rows.where(F.col(natural).isNotNull())
    if known is not None:
        fresh = fresh.join(known.select(natural), natural, "left_anti").select(*rows.columns)
    numbered = with_dense_id(fresh, [natural], id_col)
    if known is not None:
        last = F.coalesce(known.agg(F.max(id_col)).scalar(), F.lit(0))
        numbered = numbered.withColumn(id_col, F.col(id_col) + last)
    numbered.write.mode("append").parquet(f"{path.rstrip('/')}/lote={run_id}")
    return spark.read.schema(schema).parquet(path).select(id_col, *rows.columns)
