"""Whiten embeddings along the leading eigenvectors of their covariance, found by spectrum slicing.

Entries become integers ``floor(scale * c) + shift``, so sums and products are exact: a task subtracts the integer mean before it
multiplies (products of what is left are small), adds up one triangular matrix, and the sum of all of them, less the exact
remainder of the mean, is ``n^2`` times the covariance, whatever the order of the rows.

The covariance is square in the dimension alone; its leading eigenpairs are found on the driver. The inertia of the shifted
covariance (signs of D in a pivoted LDL^T, Sylvester's law) counts the eigenvalues above a shift. Bisecting on these counts
isolates each leading eigenvalue in an interval; Rayleigh quotient iteration converges cubically within it; counts just below
and above the quotient certify that it is number k. An iteration that leaves its interval is started again in a narrower one.
Eigenvalues that agree to working precision are taken as one multiple eigenvalue with an orthonormal basis.

Every row is then projected in its own task, and the whitened values' covariance is summed the same way.

Defined cases: vectors that are null or empty or hold null or non-finite entries are dropped, as are those of another length than
the most frequent one (of equally frequent ones the longest). Entries beyond +-2^40 count as +-2^40. Repeated rows and null or
repeated ids stay rows of their own. Components with an eigenvalue of no more than rounding error are not returned (a single
vector, or equal ones, give no rows); nor are more than the dimension. A deviation that does not fit in a long is null. An empty
table gives an empty one. Other columns are passed through; one with the name of a result gives way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Entries beyond this count as this.
LARGEST = 2.0 ** 40
RESULTS = "component int, n long, deviation long, whitened double, explained double, identity_error double"
ROWS = 4096


def inertia(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric ``a`` are above ``shift``: positive eigenvalues of D in LDL^T of ``a - shift I``,
    with symmetric pivoting on blocks of one or two (Bunch and Kaufman's choice)."""
    a = a - shift * np.eye(len(a))
    n, k, above = len(a), 0, 0
    size = max(1e-300, float(np.abs(a).max())) if n else 1.0
    least = size * np.finfo(float).eps ** 2
    alpha = (1 + 17 ** 0.5) / 8

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        column = np.abs(a[k + 1:, k])
        r = k + 1 + int(column.argmax()) if len(column) else k
        largest = float(column.max()) if len(column) else 0.0
        two = False
        if abs(a[k, k]) < alpha * largest:
            row = np.abs(a[r, k:])
            row[r - k] = 0.0
            other = float(row.max())
            if abs(a[k, k]) * other < alpha * largest ** 2:
                if abs(a[r, r]) >= alpha * other:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    two = True
        if two:
            d = a[k:k + 2, k:k + 2]
            above += 1  # a block of two is indefinite
            c = a[k + 2:, k:k + 2]
            a[k + 2:, k + 2:] -= c @ np.linalg.solve(d, c.T)
            k += 2
        else:
            d = a[k, k] if abs(a[k, k]) > least else least
            above += d > 0
            c = a[k + 1:, k]
            a[k + 1:, k + 1:] -= np.outer(c, c / d)
            k += 1
    return above


def _quotient(a: np.ndarray, v: np.ndarray) -> float:
    return float(v @ (a @ v))


def _without(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for b in basis:
            v = v - (b @ v) * b
    size = np.linalg.norm(v)
    return v / size if size > 0 else v


def _iterate(a: np.ndarray, lo: float, hi: float, found: list[np.ndarray], start: np.ndarray) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from one step of inverse iteration at the middle of (lo, hi)."""
    one, size = np.eye(len(a)), np.abs(a).max()

    def solved(shift: float, v: np.ndarray) -> np.ndarray:
        try:
            x = np.linalg.solve(a - shift * one, v)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            x = np.linalg.solve(a - (shift + size * np.finfo(float).eps) * one, v)
        return _without(x / np.abs(x).max(), found)

    v = solved((lo + hi) / 2, solved((lo + hi) / 2, _without(start, found)))
    value = _quotient(a, v)
    for _ in range(12):
        if not lo < value < hi or np.linalg.norm(a @ v - value * v) <= 4 * np.finfo(float).eps * size:
            break
        v = solved(value, v)
        value = _quotient(a, v)
    return value, v


def leading(a: np.ndarray, wanted: int) -> list[tuple[float, np.ndarray]]:
    """The ``wanted`` largest eigenvalues of a covariance that exceed rounding error, falling, with unit eigenvectors."""
    n = len(a)
    scale = float(np.abs(a).sum(1).max()) if n else 0.0
    if scale == 0.0:
        return []
    a = a / scale
    tiny = 8 * n * np.finfo(float).eps
    counts: dict[float, int] = {}

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = inertia(a, shift)
        return counts[shift]

    out: list[tuple[float, np.ndarray]] = []
    starts = np.random.default_rng(0).normal(size=(n, n))
    while len(out) < min(wanted, above(tiny)):
        k = len(out)
        # the interval (lo, hi]: k eigenvalues above hi, more above lo; known counts narrow it
        hi = min(x for x in [*counts, 1.0 + tiny] if (counts.get(x, 0) <= k))
        lo = max(x for x in counts if counts[x] > k)
        hi = max(lo, hi)  # counts next to an eigenvalue may be off by rounding
        while above(lo) > k + 1 and hi - lo > tiny:
            middle = (lo + hi) / 2
            lo, hi = (middle, hi) if above(middle) > k else (lo, middle)
        many = above(lo) - k  # more than one: equal to working precision
        group: list[tuple[float, np.ndarray]] = []
        while len(group) < many:
            basis = [v for _, v in out + group]
            value, v = _iterate(a, lo, hi, basis, starts[k + len(group)])
            exact = float(np.linalg.norm(a @ v - value * v)) <= tiny
            sure = exact and lo - tiny <= value <= hi + tiny and (many > 1 or (above(value - tiny) == k + 1 and above(value + tiny) == k))
            if not sure:
                if hi - lo <= tiny:
                    raise ArithmeticError(f"eigenvalue {k + 1} is isolated but the iteration does not settle on it")
                middle = (lo + hi) / 2
                lo, hi = (middle, hi) if above(middle) > k else (lo, middle)
                continue
            group.append((value, v))
        out += sorted(group, key=lambda g: -g[0])
    return [(value * scale, v) for value, v in out[:wanted]]


def _entries(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1)


def _partial(df: DataFrame, schema: str, make: Callable[[np.ndarray, dict], dict], rows: Callable[[dict], Iterator[tuple]]) -> DataFrame:
    """One pass over the column ``x``: ``make`` adds a block to a task's sums, ``rows`` turns the sums into rows."""
    fields = StructType.fromDDL(schema)
    names = fields.names
    kinds = [pa.decimal128(38, 0) if f.dataType.simpleString().startswith("decimal") else pa.int32() for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                sums = make(_entries(part.column(0)), sums)
        if sums:
            whole = list(rows(sums))
            for i in range(0, len(whole), 50_000):
                cols = zip(*whole[i:i + 50_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([Decimal(int(v)) for v in c] if k != pa.int32() else c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return df.select("_x").mapInArrow(run, schema)


def _integer_sums(x: np.ndarray, sums: dict) -> dict:
    return {"n": sums.get("n", 0) + len(x), "s": sums.get("s", 0) + x.sum(0, dtype=np.int64).astype(object)}


def _products(mean: np.ndarray) -> Callable[[np.ndarray, dict], dict]:
    def add(x: np.ndarray, sums: dict) -> dict:
        y = x - mean
        most = int(np.abs(y).max(initial=0))
        if most ** 2 * len(y) < 1 << 53:  # products and sums are integers that doubles hold exactly
            d = y.astype(np.float64)
            g = (d.T @ d).astype(np.int64)
        else:
            o = y.astype(object)
            g = o.T.dot(o)
        return {"g": sums.get("g", 0) + g.astype(object)}

    return add


def _triangle(sums: dict) -> Iterator[tuple]:
    g = sums["g"]
    for i in range(len(g)):
        for j in range(i + 1):
            yield i, j, g[i, j]


class Fit:
    """Row count, per-dimension sums and eigenpairs of the covariance (double precision, numbered from 1 by falling value)."""

    def __init__(self, vectors: DataFrame, components: int):
        totals = _partial(vectors, "j int, n decimal(38,0), s decimal(38,0)", _integer_sums, lambda t: ((j, t["n"], s) for j, s in enumerate(t["s"])))
        rows = sorted(totals.groupBy("j").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())  # one row a dimension
        self.n = int(rows[0]["n"]) if rows else 0
        self.sums = [int(r["s"]) for r in rows]
        self.mean = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = np.array([(s % self.n) / self.n for s in self.sums])
        self.pairs: list[tuple[float, np.ndarray]] = []
        self.trace = 0.0
        if rows:
            d, n = len(rows), self.n
            low = [s - n * int(m) for s, m in zip(self.sums, self.mean, strict=True)]
            made = _partial(vectors, "i int, j int, g decimal(38,0)", _products(self.mean), _triangle)
            v = np.zeros((d, d))
            trace = Fraction(0)
            for r in made.groupBy("i", "j").agg(F.sum("g").alias("g")).collect():  # square in the dimension, not in the rows
                exact = Fraction(n * int(r["g"]) - low[r["i"]] * low[r["j"]], n * n)
                v[r["i"], r["j"]] = v[r["j"], r["i"]] = float(exact)
                trace += exact if r["i"] == r["j"] else 0
            self.trace = float(trace)
            self.pairs = leading(v, components)
        self.axes = np.array([w / e ** 0.5 for e, w in self.pairs]).reshape(len(self.pairs), len(rows)).T

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) - self.rest) @ self.axes

    def deviations(self, x: np.ndarray) -> list[int | None]:
        low = np.array([s - self.n * int(m) for s, m in zip(self.sums, self.mean, strict=True)], object)
        most = int(np.abs(x - self.mean).max(initial=0)) + 1
        if (most * self.n) ** 2 * x.shape[1] < 1 << 63:
            y = (x - self.mean) * self.n - low.astype(np.int64)
            return (y * y).sum(1).tolist()
        y = (x - self.mean).astype(object) * self.n - low
        return [int(v) if v < 1 << 63 else None for v in (y * y).sum(1)]


def _usable(df: DataFrame, vector: str, scale: int, shift: int) -> DataFrame:
    """Input as ``_in`` and the integer vector ``_x`` of the rows that take part."""
    v = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))
    good = F.coalesce(F.size(v) > 0, F.lit(False)) & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    inside = lambda x: F.greatest(F.least(x, F.lit(LARGEST)), F.lit(-LARGEST))
    x = F.transform(v, lambda c: F.floor(F.lit(float(scale)) * inside(c)).cast("long") + F.lit(shift).cast("long"))
    rows = df.select(F.struct("*").alias("_in"), F.when(good, x).alias("_x")).where("_x is not null")
    longest = rows.groupBy(F.size("_x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).first()
    return rows.where(F.size("_x") == longest["d"]) if longest else rows


def whiten(df: DataFrame, vector: str = "embedding", components: int = 8, scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """Per vector that takes part and component: the input's other columns, ``component, n, deviation, whitened, explained,
    identity_error``. The fit list is every such vector."""
    new = StructType.fromDDL(RESULTS)
    names = new.names
    kept = [c for c in df.columns if c != vector and c not in new.names]
    rows = _usable(df.select(*[F.col(f"`{c}`") for c in [*kept, vector]]), vector, scale, shift)
    fit = Fit(rows, components)
    k = len(fit.pairs)

    # covariance of the whitened values, centred by their own mean
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, g = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                w = fit.whitened(_entries(batch.slice(i, ROWS).column(0)))
                s += w.sum(0)
                g += w.T @ w
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(k + k * k), pa.int32()), "v": pa.array(np.concatenate([s, g.ravel()]))})

    error = 0.0
    if k:
        found = dict(rows.select("_x").mapInArrow(moments, "at int, v double").groupBy("at").agg(F.sum("v")).collect())
        v = np.array([found[i] for i in range(k + k * k)]) / fit.n
        error = float(np.abs(v[k:].reshape(k, k) - np.outer(v[:k], v[:k]) - np.eye(k)).max())
    explained = [e / fit.trace for e, _ in fit.pairs]
    schema = StructType([rows.schema["_in"], *new.fields])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows if k else 0, ROWS):
                part = batch.slice(i, ROWS)
                m = part.num_rows
                x = _entries(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, fit.n)),
                     pa.array([d for d in fit.deviations(x) for _ in range(k)], pa.int64()), pa.array(fit.whitened(x).ravel()), pa.array(np.tile(explained, m)),
                     pa.array(np.full(m * k, error))], names=["_in", *names])

    done = rows.mapInArrow(project, schema)
    return done.select(*[F.col("_in").getField(c).alias(c) for c in kept], *new.names)
