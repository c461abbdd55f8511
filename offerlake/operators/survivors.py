"""Incremental deduplication (D1, W2): the survivor table, merged with one day's rows at a time.

The table is kept in folders by a hash of the dedup key. A day's rows are merged only with the folders whose keys they touch: those
survivors and the new rows go through the same most-complete aggregate, and the folders are replaced. The survivor is the least
row of its key in a total order, and the least of parts is the least of the whole, so day by day gives what all rows at once
give, whatever the order of days, and a day that is merged again changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlake import rules
from offerlake.operators.dedup import keep_most_complete
from offerlake.operators.keyring import read_or_none
from offerlake.session import ensure_checkpoint_dir

BUCKET = "cubo"


def bucket_of(keys: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")


def merge_day(rows: DataFrame, path: str, keys: Sequence[str] = rules.DEDUP_KEYS, buckets: int = 64, order: Sequence[str] | None = None) -> DataFrame:
    """Merge ``rows`` into the survivor table at ``path`` and return the whole table.

    ``buckets`` is fixed when the table is begun (a bucket should be what a few tasks rewrite). Ties are broken as in
    ``keep_most_complete``: by ``order``, then by every column. One merge of a table runs at a time.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    cols = rows.columns
    schema = T.StructType([*rows.schema.fields, T.StructField(BUCKET, T.IntegerType())])
    fresh = keep_most_complete(rows, keys, order).withColumn(BUCKET, bucket_of(keys, buckets))
    known = read_or_none(spark, path, schema)
    if known is not None:
        touched = [r[BUCKET] for r in fresh.select(BUCKET).distinct().collect()]  # numbers below ``buckets``
        both = fresh.select(*cols).unionByName(known.where(F.col(BUCKET).isin(touched)).select(*cols))
        fresh = keep_most_complete(both, keys, order).withColumn(BUCKET, bucket_of(keys, buckets))
    # worked out before the folders that it was read from are replaced
    done = fresh.checkpoint(eager=True)
    # the table always has its folder, also where there was nothing to merge
    done.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    return spark.read.schema(schema).parquet(path).select(*cols)
