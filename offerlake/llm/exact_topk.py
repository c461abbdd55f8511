"""Exact k best inner products of integer vectors, by norm-sorted blocks with rotated partial sums.

All vectors are cut into blocks of bounded size in descending order of length. Rotating by the eigenvectors of the second
moments (the right singular vectors of the whole table) moves most of the length into the first coordinates, so a prefix of
the rotated product plus the product of the two remaining lengths (Cauchy-Schwarz) bounds a score tightly. A block of
queries meets the longest block first, which gives every query a floor; a later block is shipped to it only if the product
of the lengths reaches some floor, and inside a block rows whose bound stays below the floor are never multiplied out.
Whatever survives is scored exactly in integers, so the rotation only decides what is skipped.

Queries and candidates meet block by block (a stated set of queries against all rows); a block is bounded, so no task or
group grows with the table. The moments are one d x d sum per task. Blocks are numbered by their heads, a length and two numbers each.

Defined cases: vectors that are null or empty, or hold a null, nan or infinite component, take no part, nor do rows without
an id; vectors of different length are compared as if filled with zeros; a repeated row counts as often as it occurs, and a
query skips only its own row; fewer than k candidates give fewer rows; equal scores go to the smaller id, equal ids to
either row. Components are clamped to 9e18, and products beyond 64 bits wrap as longs do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerlake.llm.common import staged

BLOCK, QUERY_BLOCK, STEP = 4096, 512, 512
#: Slack on floating-point bounds, as a share of the lengths' product.
SLACK = 1e-9


def usable(vec: Column) -> Column:
    ok = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & ok


def moments(df: DataFrame, vec: str, dim: int) -> np.ndarray:
    """Sum of outer products: each task hands on one d x d matrix."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for b in batches:
            x = matrix(b.column(0), dim).astype(np.float64)
            total += x.T @ x
        i, j = np.divmod(np.arange(dim * dim), dim)
        yield pa.RecordBatch.from_pydict({"i": i.astype(np.int32), "j": j.astype(np.int32), "v": total.ravel()})

    rows = df.select(vec).mapInArrow(part, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((dim, dim))
    for r in rows:
        out[r["i"], r["j"]] = r["v"]
    return out


def matrix(col: pa.ListArray, dim: int) -> np.ndarray:
    """A list column as rows of a matrix, filled with zeros."""
    sizes = np.asarray(col.value_lengths())
    flat = col.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim), flat.dtype if len(flat) else np.int64)
    ends = np.cumsum(sizes)
    for i, (a, b) in enumerate(zip(ends - sizes, ends, strict=True)):
        out[i, :b - a] = flat[a:b]
    return out


def integers(vec: Column, scale: int = 256) -> Column:
    most = 9.0e18
    return F.transform(vec, lambda x: F.floor(F.greatest(F.lit(-most), F.least(F.lit(most), x.cast("double") * scale))).cast("long"))


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer products; through doubles where those hold every partial sum."""
    if not q.size or not x.size:
        return np.zeros((len(q), len(x)), np.int64)
    if float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] < 2.0**53:
        return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    with np.errstate(over="ignore"):
        return q @ x.T


class Best:
    """The k best (score, id) of a block of queries."""

    def __init__(self, k: int, rows: np.ndarray, ids: np.ndarray, q: np.ndarray, turn: np.ndarray, head: int, floor: np.ndarray):
        self.k, self.rows, self.ids, self.q, self.head = k, rows, ids, q, head
        self.turned = q.astype(np.float64) @ turn
        self.length = np.linalg.norm(self.turned, axis=1)
        self.rest = np.linalg.norm(self.turned[:, head:], axis=1)
        self.floor = floor.astype(np.float64)
        self.found: list[list[tuple[int, int]]] = [[] for _ in ids]

    def meet(self, rows: np.ndarray, ids: np.ndarray, x: np.ndarray, turn: np.ndarray) -> int:
        """Go through one block (in descending length); returns the number of exact products."""
        turned = x.astype(np.float64) @ turn
        length = np.linalg.norm(turned, axis=1)
        rest = np.linalg.norm(turned[:, self.head:], axis=1)
        done = 0
        for s in range(0, len(ids), STEP):
            e = min(s + STEP, len(ids))
            slack = SLACK * self.length * length[s] + 1e-6
            live = np.flatnonzero(self.length * length[s] + slack >= self.floor)
            if not len(live):
                break
            bound = self.turned[live, :self.head] @ turned[s:e, :self.head].T + self.rest[live, None] * rest[None, s:e]
            ask = bound + slack[live, None] >= self.floor[live, None]
            some, cols = np.flatnonzero(ask.any(1)), np.flatnonzero(ask.any(0))
            if not len(some):
                continue
            score = _exact(self.q[live[some]], x[s:e][cols])
            done += score.size
            ask = ask[np.ix_(some, cols)]
            for a, i in enumerate(live[some].tolist()):
                hit = np.flatnonzero(ask[a] & (score[a] >= self.floor[i]) & (rows[s:e][cols] != self.rows[i]))
                if len(hit) > self.k:
                    hit = hit[np.lexsort((ids[s:e][cols][hit], -score[a][hit]))[:self.k]]
                self.found[i] = sorted([*self.found[i], *((-int(score[a][h]), int(ids[s + cols[h]])) for h in hit)])[:self.k]
                if len(self.found[i]) == self.k:
                    self.floor[i] = max(self.floor[i], -self.found[i][-1][0])
        return done


def _bucket(length: Column) -> Column:
    return F.when(length > 0, F.floor(F.log2(F.when(length > 0, length)) * 16)).otherwise(-40_000).cast("int")


def _blocks(df: DataFrame, size: int, name: str, dim: int) -> DataFrame:
    """Rows (block, ids, rows, vectors packed, largest length) in descending order of length; at most ``size`` rows each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out(t: pa.Table) -> pa.RecordBatch:
            x = matrix(t["ints"].combine_chunks(), dim)
            return pa.RecordBatch.from_pydict({"ids": pa.array([t["id"].to_pylist()], pa.list_(pa.int64())), "rows": pa.array([t["row"].to_pylist()], pa.list_(pa.int64())),
                                               "x": pa.array([np.ascontiguousarray(x, "<i8").tobytes()], pa.binary()), "longest": [t["len"][0].as_py()]})

        for b in batches:
            held.append(b)
            while sum(h.num_rows for h in held) >= size:
                t = pa.Table.from_batches(held)
                yield out(t.slice(0, size))
                held = t.slice(size).to_batches()
        if sum(h.num_rows for h in held):
            yield out(pa.Table.from_batches(held))

    parts = max(1, -(-df.count() // (4 * size)))
    dealt = df.repartitionByRange(parts, F.desc("len"), "id", "row").sortWithinPartitions(F.desc("len"), "id", "row")
    made = staged(dealt.mapInArrow(cut, "ids array<long>, rows array<long>, x binary, longest double"), name)
    # only the heads of the blocks (a length and two numbers each) are put in one line; the vectors stay where they are
    heads = made.select("longest", F.get("ids", F.lit(0)).alias("id"), F.get("rows", F.lit(0)).alias("_first"))
    numbered = heads.select("_first", (F.row_number().over(Window.orderBy(F.desc("longest"), "id", "_first")) - 1).alias("block"))
    return made.withColumn("_first", F.get("rows", F.lit(0))).join(numbered, "_first").drop("_first")


def search(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vec: str = "embedding",
           ints: Callable[[Column], Column] = integers, head_share: float = 0.9) -> DataFrame:
    """Rows (query_id, rank, vec_id, score) of every query's k best other rows."""
    good = vectors.select(F.col(vec_id).alias("id"), F.col(vec).alias("v"), is_query.alias("is_query")).where(F.col("id").isNotNull() & usable(F.col("v")))
    rows = staged(good.select("id", "is_query", ints(F.col("v")).alias("ints")).withColumn("row", F.monotonically_increasing_id())
                  .withColumn("len", F.sqrt(F.aggregate("ints", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))), "topk-rows")
    schema = "query_id long, query_row long, vec_id long, score long"
    dim = rows.agg(F.max(F.size("ints"))).first()[0]
    if not dim:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    values, turn = np.linalg.eigh(moments(rows, "ints", dim))
    turn, share = turn[:, ::-1], np.cumsum(values[::-1]) / max(values.sum(), 1e-300)
    head = int(min(max(1, np.searchsorted(share, head_share) + 1), dim))
    base = staged(_blocks(rows, BLOCK, "topk-base", dim), "topk-blocks")
    asks = _blocks(rows.where("is_query"), QUERY_BLOCK, "topk-ask", dim).select(F.col("ids").alias("qids"), F.col("rows").alias("qrows"), F.col("x").alias("qx"), F.col("longest").alias("qlongest"), F.col("block").alias("qblock"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ids, q = np.array(r["qids"], np.int64), np.frombuffer(r["qx"], "<i8").reshape(-1, dim)
                best = Best(k, np.array(r["qrows"], np.int64), ids, q, turn, head, np.array(r["floors"], np.float64))
                best.meet(np.array(r["rows"], np.int64), np.array(r["ids"], np.int64), np.frombuffer(r["x"], "<i8").reshape(-1, dim), turn)
                flat = [(int(ids[i]), r["qrows"][i], v, -s) for i, f in enumerate(best.found) for s, v in f]
                yield pa.RecordBatch.from_pydict({"query_id": pa.array([f[0] for f in flat], pa.int64()), "query_row": pa.array([f[1] for f in flat], pa.int64()),
                                                  "vec_id": pa.array([f[2] for f in flat], pa.int64()), "score": pa.array([f[3] for f in flat], pa.int64())})

    asks = staged(asks, "topk-asks")
    # every block of queries meets the longest block first; that one is a single row of at most BLOCK vectors
    longest = base.where("block = 0").select("ids", "rows", "x").first()

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, ids, x = np.array(longest["rows"], np.int64), np.array(longest["ids"], np.int64), np.frombuffer(longest["x"], "<i8").reshape(-1, dim)
        for b in batches:
            for r in b.to_pylist():
                mine = np.array(r["qids"], np.int64)
                best = Best(k, np.array(r["qrows"], np.int64), mine, np.frombuffer(r["qx"], "<i8").reshape(-1, dim), turn, head, np.full(len(mine), -np.inf))
                best.meet(rows, ids, x, turn)
                yield pa.RecordBatch.from_pydict({"qblock": pa.array([r["qblock"]], pa.int32()), "floors": pa.array([best.floor.tolist()], pa.list_(pa.float64()))})

    floors = staged(asks.select("qblock", "qids", "qrows", "qx").mapInArrow(start, "qblock int, floors array<double>"), "topk-floors")
    # a floor needs rows of at least floor / |q| length: as blocks descend in length, a block of queries is shipped to those up
    # to the last block of its length's bucket. Sixteen buckets an octave: bounded by the range of doubles, not by the rows.
    ends = base.groupBy(_bucket(F.col("longest")).alias("bucket")).agg(F.max("block").alias("last")).orderBy("bucket").collect()
    least = F.try_divide(F.array_min("floors") * (1 - 1e-9), F.col("qlongest"))
    last = F.lit(0)
    for e in sorted(ends, key=lambda e: -e["bucket"]):
        last = F.when(_bucket(least) <= e["bucket"], e["last"]).otherwise(last)
    last = F.when(least.isNull() | (least <= 0), max(e["last"] for e in ends)).otherwise(last)
    wanted = asks.select("qblock", "qlongest").join(floors, "qblock").select("qblock", F.explode(F.sequence(F.lit(0), last)).alias("block"))
    pairs = wanted.join(asks.join(floors, "qblock"), "qblock").join(base.select("block", "ids", "rows", "x"), "block")
    found = pairs.select("qblock", "qids", "qrows", "qx", "floors", "ids", "rows", "x").mapInArrow(meet, schema)
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
