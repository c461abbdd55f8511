"""Raw offer files read by their own headers, and a manifest of what each file held.

Stores drop CSV files whose columns come in their own order and under their own names. All files of a batch are scanned as
one positional text table (every file is one task's, as quoted line breaks make CSV unsplittable), so a batch of any number of
files and headers is one plan:

* the *manifest* is one aggregate per file, joined to the file listing: size, header, rows, rows wider than the header;
* the *rows* take their columns from the position that their file's header gives them, by the names and aliases of the rules.

A file is taken whole or not at all, as a reader of single files would: an empty file, one that cannot be read, and one with a
row wider than its header are left out and have a fault in the manifest. A file with a header alone has no rows and a fault that
says so.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlake import rules
from offerlake.sources.offers import RAW_OFFER_COLUMNS

#: Columns that a file may have; a row with more is a fault of its file.
WIDTH = 64
LISTING_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
#: Faults in the order in which they are tested.
EMPTY, UNREADABLE, WIDER, HEADER_ONLY = "vacio", "ilegible", "fila mas ancha que la cabecera", "solo cabecera"


def list_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``archivo`` (whole path) and ``bytes`` of every CSV file below ``paths``: a listing, no content is read.

    A scan passes over empty files, so their names come from the listing that the driver holds for any read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv*").load(list(paths))
    sizes = files.select(F.col("_metadata.file_path").alias("archivo"), F.col("_metadata.file_size").alias("bytes"))
    names = spark.createDataFrame([(f,) for f in files.inputFiles()], "nombre string")
    empty = names.join(sizes, _same_file(F.col("nombre")) == _same_file(F.col("archivo")), "left_anti")
    return sizes.unionByName(empty.select(F.col("nombre").alias("archivo"), F.lit(0).cast("long").alias("bytes")))


def _same_file(path: Column) -> Column:
    """A path with one slash behind its scheme and without escapes, however it was written."""
    return F.regexp_replace(F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path), "^([A-Za-z0-9.+-]+):/+", "$1:/")


def scan(spark: SparkSession, paths: Sequence[str], width: int = WIDTH) -> DataFrame:
    """Every record of every file, headers included: ``archivo, _n`` (ascending within a file), ``_v`` (values by position) and
    ``_wide`` (the record has more than ``width`` fields)."""
    cols = [f"_c{i}" for i in range(width)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*cols, "_rest"]])
    reader = (spark.read.schema(schema).option("header", False).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8")
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_rest").option("recursiveFileLookup", True)
              .option("pathGlobFilter", "*.csv*").option("ignoreCorruptFiles", True))
    # a record with fewer fields than the schema is "corrupt" to the reader, too; one with more has a value in the last column
    return reader.csv(list(paths)).select(
        F.col("_metadata.file_path").alias("archivo"), F.monotonically_increasing_id().alias("_n"),
        F.array(*cols).alias("_v"), F.col(cols[-1]).isNotNull().alias("_wide"))


def used_width(values: Column) -> Column:
    """Position (from 1) of the last field with a value, 0 if there is none."""
    return F.coalesce(F.array_max(F.transform(values, lambda v, i: F.when(v.isNotNull(), i + 1).otherwise(0))), F.lit(0))


def manifest(spark: SparkSession, paths: Sequence[str], width: int = WIDTH) -> DataFrame:
    """One row per file: ``archivo, bytes, cabecera`` (names, trimmed, without byte-order mark), ``filas`` (data records),
    ``fila_ancha`` (fields of the widest), ``primera`` (number of the header record), ``falla`` (null for a good file)."""
    rows = scan(spark, paths, width)
    # only the first record's fields travel, one candidate per task
    files = rows.groupBy("archivo").agg(
        F.min_by("_v", "_n").alias("_head"), F.min("_n").alias("primera"), (F.count(F.lit(1)) - 1).alias("filas"),
        F.max(used_width(F.col("_v"))).alias("fila_ancha"))
    names = F.transform(F.slice("_head", 1, used_width(F.col("_head"))), lambda v: F.trim(F.translate(F.coalesce(v, F.lit("")), "\ufeff", "")))
    files = files.withColumn("cabecera", names).drop("_head")
    found = list_files(spark, paths).join(files, "archivo", "left")
    falla = (F.when(F.col("bytes") == 0, EMPTY)
             .when(F.col("cabecera").isNull() | (F.size("cabecera") == 0), UNREADABLE)
             .when((F.col("fila_ancha") > F.size("cabecera")) | (F.col("fila_ancha") >= width), WIDER)
             .when(F.col("filas") == 0, HEADER_ONLY))
    return found.select("archivo", "bytes", "cabecera", F.coalesce("filas", F.lit(0)).cast("long").alias("filas"), "fila_ancha", "primera", falla.alias("falla"))


def named_columns(columns: Sequence[str], aliases: Mapping[str, str]) -> dict[str, list[str]]:
    """Target column -> names that a header may use for it, the target's own name first."""
    return {c: [c, *[a for a, t in aliases.items() if t == c]] for c in columns}


def offers(spark: SparkSession, paths: Sequence[str], files: DataFrame, columns: Sequence[str] = RAW_OFFER_COLUMNS,
           aliases: Mapping[str, str] = rules.COLUMN_ALIASES, width: int = WIDTH) -> DataFrame:
    """Data records of the manifest's good files: ``columns`` by header name or alias (the first one with a value), other
    columns of the file by name in the map ``otros``, and ``archivo``.

    ``files`` is the manifest; it has one row per file and is joined by file, sized by Spark.
    """
    good = files.where("falla is null").select("archivo", "cabecera", "primera")
    rows = scan(spark, paths, width).join(good, "archivo").where(F.col("_n") > F.col("primera"))
    known = named_columns(columns, aliases)

    def value(name: str) -> Column:
        return F.get("_v", F.array_position("cabecera", F.lit(name)).cast("int") - 1)

    taken = [n for names in known.values() for n in names]
    # a name that a header repeats counts once, at its first place
    other = F.filter("cabecera", lambda n, i: ~n.isin(*taken) & (n != "") & (F.array_position("cabecera", n) == i + 1))
    others = F.map_from_arrays(other, F.transform(other, lambda n: F.get("_v", F.array_position("cabecera", n).cast("int") - 1)))
    return rows.select(*[F.coalesce(*[value(n) for n in names]).alias(c) for c, names in known.items()], others.alias("otros"), "archivo")


def file_faults(files: DataFrame) -> DataFrame:
    """Error-log fields of the files that were left out, one row each."""
    bad = files.where("falla is not null")
    return bad.select(
        F.lit("Staging:lectura").alias("fuente"), F.lit("Lectura").alias("tipo_error"),
        F.concat(F.regexp_extract("archivo", "[^/]*$", 0), F.lit(": "), "falla", F.lit(" ("), F.col("bytes").cast("string"), F.lit(" bytes)")).alias("descripcion"),
        F.lit("El archivo se omite").alias("accion_tomada"))
