"""Shared helpers: table access, tables written to the shared folder, packed arrays, connected components."""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch that are turned into Python objects at once, so a task's memory follows a slice, not a batch.
SLICE_ROWS = 512
#: Characters of text in one slice at most (a slice of one row may hold more).
SLICE_CHARS = 8_000_000


_HELD: dict[object, object] = {}


def held(key: object, make: Callable[[], object]) -> object:
    """What a Python worker keeps between blocks. It holds one thing at a time: a worker that goes on to another operator's
    tasks drops the former one's tables."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; a scratch one only in a local session without that setting."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not (sc.master or "").startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="offerlake-shared-")
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_of_id(col: Column) -> Column:
    """crc32 of the id written as text; a null id counts as 0."""
    return F.coalesce(F.crc32(F.encode(col.cast("string"), "UTF-8")), F.lit(0))


def slices(batch: pa.RecordBatch, text: str, rows: int = SLICE_ROWS, chars: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows bounded by rows and by characters of the text column."""
    sizes = np.diff(np.asarray(_offsets(batch.column(batch.schema.get_field_index(text)))))
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and (i - start >= rows or held + n > chars):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if start < batch.num_rows:
        yield batch.slice(start, batch.num_rows - start)


def _offsets(col: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def map_text(df: DataFrame, text: str, schema: str, fn: Callable[[pa.RecordBatch], dict[str, object]], rows: int = SLICE_ROWS,
             chars: int = SLICE_CHARS) -> DataFrame:
    """``mapInArrow`` over bounded slices: ``fn`` gets a slice and returns the new columns, which follow the old ones.

    ``schema`` names the new columns; an old column of the same name gives way.
    """
    from pyspark.sql.types import StructType

    new = StructType.fromDDL(schema)
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in new.names])
    out = StructType([*kept.schema.fields, *new.fields])
    keep = [c for c in kept.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        types = to_arrow_schema(new)
        for batch in batches:
            for part in slices(batch, text, rows, chars):
                made = fn(part)
                cols = [part.column(part.schema.get_field_index(c)) for c in keep]
                cols += [pa.array(made[f.name], type=f.type) for f in types]
                yield pa.RecordBatch.from_arrays(cols, names=[*keep, *new.names])

    return df.mapInArrow(run, out)


def pack(a: np.ndarray) -> bytes:
    """A numpy array as bytes: unsigned integers in the narrowest type, bytes of equal weight side by side, lightly deflated."""
    if a.dtype.kind == "u" and len(a):
        a = a.astype(np.min_scalar_type(a.max()))
    a = np.ascontiguousarray(a)
    raw = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b""
    return a.dtype.str.encode() + b" " + zlib.compress(raw, 1)


def unpack(b: bytes) -> np.ndarray:
    kind, _, body = bytes(b).partition(b" ")
    dtype = np.dtype(kind.decode())
    raw = np.frombuffer(zlib.decompress(body), np.uint8)
    n = len(raw) // dtype.itemsize
    return np.ascontiguousarray(raw.reshape(dtype.itemsize, n).T).view(dtype).reshape(n).copy()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a long, b long)``: rows (node, component), component the smallest node reachable.

    Alternates the large-star and the small-star step: every node hands its greater (then its smaller) neighbours to the
    smallest one it knows. Each step is a min aggregate (combined map-side, so a node with a third of all edges is one
    row per task) and an equi-join that Spark may split where it is skewed. The edge table of every round is written to
    the shared folder; rounds grow with the logarithm of the longest chain.
    """
    # both steps keep edges as (greater, smaller)
    cur = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    seen = None
    for _ in range(max_rounds):
        both = cur.select("u", "v").unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least2, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least2.select("u", F.col("m").alias("v")))
                 .where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        cur = staged(small, "cc")
        now = tuple(cur.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("u", "v") % 1000003)).first())
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = cur.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    return roots.unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
