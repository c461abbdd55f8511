"""Incremental landing of raw offer drops.

Stores drop one CSV per store per day into the raw folder. A file-source stream over the *listing* (names and sizes, no
content) with ``Trigger.AvailableNow`` picks up exactly the files not yet processed, tracked in the checkpoint under the shared
checkpoint folder. Each batch reads its files by their own headers (``sources.drops``), so stores may order and name columns as
they like, and lands parquet under ``lote=<batch>/tienda=/fecha=``. A batch that runs again overwrites its own folder, so a
failure between writing and committing lands nothing twice; files that were left out are listed under ``<out>_faltas`` the same
way. (A file without any content never reaches a batch; ``drops.manifest`` over the folder lists it.)
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake import rules
from offerlake.functions.dates import parse_any_timestamp
from offerlake.sources import drops
from offerlake.sources.offers import RAW_OFFER_COLUMNS, snapshot_date_from_name

#: Files of one batch: bounds the list of names that the driver passes on.
FILES_PER_BATCH = 10_000


def land_files(spark: SparkSession, paths: Sequence[str], out_path: str, batch: int, columns: Sequence[str] = RAW_OFFER_COLUMNS,
               aliases: Mapping[str, str] = rules.COLUMN_ALIASES) -> None:
    """Land one batch of files; running it again with the same ``batch`` replaces what it wrote."""
    faults = f"{out_path.rstrip('/')}_faltas/lote={batch}"
    drops.manifest(spark, paths).write.mode("overwrite").parquet(faults)
    name = F.regexp_extract("archivo", "[^/]*$", 0)
    dates = [snapshot_date_from_name(name)] + [F.to_date(parse_any_timestamp(F.col(c))) for c in ("fecha_extraccion",) if c in columns]
    landed = drops.offers(spark, paths, spark.read.parquet(faults), columns, aliases).withColumns(
        {"fecha": F.coalesce(*dates, F.current_date()), "archivo": name})
    landed.write.mode("overwrite").partitionBy("tienda", "fecha").parquet(f"{out_path.rstrip('/')}/lote={batch}")


def land_drops(spark: SparkSession, raw_glob: str, out_path: str, checkpoint: str, files_per_batch: int = FILES_PER_BATCH,
               columns: Sequence[str] = RAW_OFFER_COLUMNS, aliases: Mapping[str, str] = rules.COLUMN_ALIASES):
    """Start the landing stream (AvailableNow: process what is there, then stop) and return the query handle."""
    files = (spark.readStream.format("binaryFile").schema(drops.LISTING_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
             .option("pathGlobFilter", "*.csv*").load(raw_glob).select("path"))

    def land(batch: DataFrame, number: int) -> None:
        paths = [r["path"] for r in batch.collect()]  # names of at most files_per_batch files
        if paths:
            land_files(batch.sparkSession, paths, out_path, number, columns, aliases)

    return (files.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
