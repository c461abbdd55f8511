"""Near-duplicate vectors by a robust-pruned flat graph.

Equal vectors form one class. Centroids fitted on a bounded sample deal the classes to their ``OVERLAP`` nearest cluster
shards. Every shard builds a graph on its own: vectors are inserted in growing batches by a greedy search from the shard's
medoid, and what the search visited is pruned robustly (a candidate goes if a kept neighbour is ``ALPHA`` times closer to it),
with edges back that are pruned in turn. A vector's adjacency lists from its shards are united. On the united graph every
vector is then searched for from the medoid of each of its shards: greedily down to its nearest vectors, then expanding over
all vectors within the range until no new one turns up. The pairs are verified in double precision, recall is audited against
brute force for a bounded sample of queries, and below ``RECALL`` everything is repeated with twice the overlap. The audit takes the
lower of two figures, the share of all links and the mean share over vectors with links, so that one large group does not hide what
small ones miss. If the largest overlap still falls short, the exact way follows: one shard of all vectors, cut into chunks that
meet two by two and are compared outright.

A shard above ``SHARD_ROWS`` is cut into chunks that meet two by two, so no task holds more than two chunks. A shard hands on
each vector's partners as one list (so copies and near copies are never expanded into rows of pairs) and, for the components,
a spanning forest.

Defined cases: a vector that is null, empty, zero or holds a null, nan or infinite component links with nothing and is its own
component; vectors of different length are filled with zeros; repeated rows link with each other; a row without an id may be
linked but names no component (null, and not kept, if no member has an id); without a valid vector there are no links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlake.llm.common import components, staged

RANGE = 0.9
OVERLAP, SHARD_TARGET, SHARD_ROWS = 2, 1000, 4000
DEGREE, ROOM, BEAM, ALPHA = 24, 36, 48, 1.2
#: Rows inserted or searched for side by side.
INSERTS, STARTS = 128, 4
#: Vectors that centroids are fitted on, centroids at most, and queries of the audit.
SAMPLE, MOST_CENTROIDS, AUDIT, RECALL = 20_000, 4096, 300, 0.95
#: Largest overlap that is tried before all vectors are compared.
MOST_OVERLAP = 16
#: Edges of the graph are followed a little beyond the range.
MARGIN = 0.02


def usable(vec: Column) -> Column:
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & F.coalesce(fine, F.lit(False)) & F.exists(vec, lambda x: x != 0)


def unit_rows(lists: list, dim: int) -> np.ndarray:
    x = np.zeros((len(lists), dim))
    for i, v in enumerate(lists):
        x[i, :len(v)] = v
    x /= np.abs(x).max(1, keepdims=True)  # no length over- or underflows
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centroids(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means on a sample; the start spreads over the sample in its given order."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = (x @ c.T).argmax(1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        size = np.linalg.norm(total, axis=1)
        c[size > 0] = total[size > 0] / size[size > 0, None]
    return c


class Graph:
    """A pruned graph over the rows of ``x`` (unit vectors): ``out`` holds up to ROOM neighbours a row, filled with the row
    itself. A list that overflows is pruned to DEGREE, so most edges back cost nothing."""

    def __init__(self, x: np.ndarray):
        self.x, n = x, len(x)
        self.out = np.repeat(np.arange(n)[:, None], ROOM, 1)
        self.degree = np.zeros(n, np.int64)
        c = centroids(x, math.isqrt(n - 1) + 1)
        # the row closest to the middle of every cluster: where searches start, and what is inserted first
        self.medoids = np.unique((c @ x.T).argmax(1))

    def visit(self, q: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """Greedy best-first search from the closest medoids for many queries side by side. Returns, per query, the rows
        whose neighbours were read (filled with -1) and their closeness (filled with -inf)."""
        x, out, many = self.x, self.out, len(q)
        first = q @ x[self.medoids].T
        top = np.argsort(-first, 1, kind="stable")[:, :STARTS]
        width = top.shape[1]
        rows = np.full((many, beam), self.medoids[0])
        near = np.full((many, beam), -np.inf)
        read = np.ones((many, beam), bool)
        rows[:, :width], near[:, :width], read[:, :width] = self.medoids[top], np.take_along_axis(first, top, 1), False
        met = np.zeros((many, len(x)), bool)
        met[np.arange(many)[:, None], rows[:, :width]] = True
        seen: list[np.ndarray] = []
        close: list[np.ndarray] = []
        live = np.arange(many)
        while len(live):
            k = read[live].argmin(1)  # the closest that is not read
            u = rows[live, k]
            read[live, k] = True
            seen.append(np.full(many, -1))
            close.append(np.full(many, -np.inf))
            seen[-1][live], close[-1][live] = u, near[live, k]
            new = out[u]
            fresh = ~met[live[:, None], new]
            met[live[:, None], new] = True
            got = np.where(fresh, np.einsum("acd,ad->ac", x[new], q[live]), -np.inf)
            all_rows, all_near = np.concatenate([rows[live], new], 1), np.concatenate([near[live], got], 1)
            all_read = np.concatenate([read[live], ~fresh], 1)
            best = np.argsort(-all_near, 1, kind="stable")[:, :beam]
            rows[live], near[live] = np.take_along_axis(all_rows, best, 1), np.take_along_axis(all_near, best, 1)
            read[live] = np.take_along_axis(all_read, best, 1)
            live = live[~read[live].all(1)]
        return np.stack(seen, 1), np.stack(close, 1)

    def prune(self, u: int, rows: np.ndarray) -> None:
        """Keep the closest candidate, drop those that it is ALPHA times closer to than u is, and go on with the rest."""
        rows = rows[rows != u]
        away = 1 - self.x[rows] @ self.x[u]
        order = np.argsort(away, kind="stable")
        rows, away = rows[order], away[order]
        between = 1 - self.x[rows] @ self.x[rows].T
        open_ = np.ones(len(rows), bool)
        kept: list[int] = []
        for i in range(len(rows)):
            if open_[i]:
                kept.append(i)
                if len(kept) == DEGREE:
                    break
                open_ &= ALPHA * between[i] > away
        self.out[u] = u
        self.out[u, :len(kept)] = rows[kept]
        self.degree[u] = len(kept)

    def build(self) -> None:
        """Insert the rows in batches that double in size up to INSERTS; a batch also sees its own closest members."""
        for u in self.medoids.tolist():
            self.prune(u, self.medoids)
        todo = np.setdiff1d(np.arange(len(self.x)), self.medoids)
        s, size = 0, max(1, len(self.medoids))
        while s < len(todo):
            batch = todo[s:s + size]
            s, size = s + size, min(2 * size, INSERTS)
            seen, _ = self.visit(self.x[batch])
            mates = batch[np.argsort(-(self.x[batch] @ self.x[batch].T), 1, kind="stable")[:, 1:9]]
            for k, u in enumerate(batch.tolist()):
                rows = np.unique(np.concatenate([seen[k], mates[k]]))
                self.prune(u, rows[rows >= 0])
            for u in batch.tolist():
                for v in self.out[u, :self.degree[u]].tolist():
                    if u in self.out[v]:
                        continue
                    if self.degree[v] == ROOM:
                        self.prune(v, np.append(self.out[v], u))
                    else:
                        self.out[v, self.degree[v]] = u
                        self.degree[v] += 1

    def unite(self, lists: list[np.ndarray]) -> None:
        """Replace the adjacency by united lists (row numbers of this graph)."""
        most = max([1, *map(len, lists)])
        self.out = np.repeat(np.arange(len(self.x))[:, None], most, 1)
        for u, v in enumerate(lists):
            self.out[u, :len(v)] = v

    def within(self, least: float) -> Iterator[np.ndarray]:
        """Per row the rows at least ``least`` close: a greedy search from the medoids, then an expanding one in the range.

        The expanding search follows edges both ways: robust pruning leaves the copies of a text with little more than an edge
        to the one in their middle, which cannot point back to all of them.
        """
        x, n = self.x, len(self.x)
        a, b = np.repeat(np.arange(n), self.out.shape[1]), self.out.ravel()
        edge = np.unique(np.concatenate([a * n + b, b * n + a]))
        ends, ptr = edge % n, np.searchsorted(edge // n, np.arange(n + 1))
        for s in range(0, n, INSERTS):
            seen, close = self.visit(x[s:s + INSERTS])
            for k in range(len(seen)):
                u, q = s + k, x[s + k]
                front = np.unique(np.append(seen[k][close[k] >= least - MARGIN], u))
                met = np.zeros(n, bool)
                met[front] = True
                found = [front]
                while len(front):
                    new = np.unique(np.concatenate([ends[ptr[i]:ptr[i + 1]] for i in front.tolist()]))
                    new = new[~met[new]]
                    met[new] = True
                    front = new[x[new] @ q >= least - MARGIN]
                    found.append(front)
                rows = np.concatenate(found)
                rows = rows[x[rows] @ q >= least]
                yield rows[rows != u]


def _forest(n: int, pairs: list[np.ndarray]) -> list[tuple[int, int]]:
    up = list(range(n))

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    out = []
    for i, js in enumerate(pairs):
        for j in js.tolist():
            a, b = top(i), top(j)
            if a != b:
                up[b] = a
                out.append((i, j))
    return out


def _shards(classes: DataFrame, dim: int, size: int, overlap: int, exact: bool = False) -> DataFrame:
    """Rows (shard, node, v, members): every class in its nearest shards (``exact``: all in one), large shards cut into chunks that
    meet in pairs."""
    share = min(1.0, SAMPLE / size)
    sample = classes.where(F.pmod(F.xxhash64("node", F.lit(7)), F.lit(1_000_003)) / 1_000_003 < share).orderBy(F.xxhash64("node")).limit(SAMPLE + SAMPLE // 10)
    x = unit_rows([r["v"] for r in sample.select("v").collect()], dim)  # bounded by SAMPLE
    k = int(min(MOST_CENTROIDS, max(1, len(x) // 2), max(1, math.ceil(overlap * size / SHARD_TARGET))))
    c = np.zeros((1, dim)) if exact or not len(x) else centroids(x, k)
    most = min(overlap, len(c))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 2048):
                part = b.slice(s, 2048)
                near = np.argpartition(-(unit_rows(part.column(1).to_pylist(), dim) @ c.T), most - 1, axis=1)[:, :most]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(near.tolist(), pa.list_(pa.int32()))], names=["node", "v", "members", "shards"])

    dealt = staged(classes.select("node", "v", "members").mapInArrow(assign, "node long, v array<double>, members long, shards array<int>")
                   .select("node", "v", "members", F.explode("shards").alias("shard")), "shards")
    sizes = dealt.groupBy("shard").agg(F.ceil(F.count("*") / SHARD_ROWS).cast("int").alias("chunks"))
    cut = dealt.join(sizes, "shard").withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    name = F.concat_ws("-", "shard", F.least("own", "other"), F.greatest("own", "other"))
    return cut.select(name.alias("shard"), "node", "v", "members")


def _links(classes: DataFrame, dim: int, size: int, overlap: int, exact: bool = False) -> DataFrame:
    """Rows (node, partners: array of (node, members), forest: array of nodes)."""
    shards = staged(_shards(classes, dim, size, overlap, exact), "shard-rows")

    def load(pdf: pd.DataFrame) -> tuple[pd.DataFrame, Graph]:
        # a fixed order, unlike that of the vectors
        pdf = pdf.iloc[np.argsort(pdf["node"].to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), kind="stable")]
        return pdf, Graph(unit_rows(pdf["v"].tolist(), dim))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, graph = load(pdf)
        graph.build()
        node = pdf["node"].to_numpy()
        return pd.DataFrame({"node": node, "out": pd.Series([node[graph.out[u, :graph.degree[u]]] for u in range(len(node))], dtype=object)})

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, graph = load(pdf)
        node, members = pdf["node"].to_numpy(), pdf["members"].to_numpy()
        if exact:
            return linked(node, members, compared(graph.x))
        order = np.argsort(node)
        local = []
        for out in pdf["out"]:
            at = np.minimum(np.searchsorted(node, out, sorter=order), len(node) - 1)
            at = order[at]
            local.append(at[node[at] == out])
        graph.unite(local)
        return linked(node, members, list(graph.within(RANGE)))

    def compared(x: np.ndarray) -> list[np.ndarray]:
        out = []
        for i in range(0, len(x), 512):
            near = x[i:i + 512] @ x.T >= RANGE
            near[np.arange(len(near)), np.arange(i, i + len(near))] = False
            out += [np.flatnonzero(row) for row in near]
        return out

    def linked(node: np.ndarray, members: np.ndarray, found: list[np.ndarray]) -> pd.DataFrame:
        # a pair found from one side counts for both
        a = np.repeat(np.arange(len(node)), [len(f) for f in found])
        b = np.concatenate([*found, np.array([], np.int64)]).astype(np.int64)
        pairs = np.unique(np.concatenate([a * len(node) + b, b * len(node) + a]))
        both = np.split(pairs % len(node), np.searchsorted(pairs // len(node), np.arange(1, len(node))))
        tree: list[list[int]] = [[] for _ in node]
        for i, j in _forest(len(node), both):
            tree[i].append(int(node[j]))
        has = [i for i, p in enumerate(both) if len(p)]
        partners = [[{"node": int(node[j]), "members": int(members[j])} for j in both[i]] for i in has]
        return pd.DataFrame({"node": node[has], "partners": pd.Series(partners, dtype=object), "forest": pd.Series([tree[i] for i in has], dtype=object)})

    lists = shards.groupBy("shard").applyInPandas(build, "node long, out array<long>") if not exact else None
    # at most overlap * DEGREE neighbours (times the chunks that a vector meets)
    united = staged(lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("out"))).alias("out")), "adjacency") if not exact else None
    rows = shards if exact else shards.join(united, "node")
    found = rows.groupBy("shard").applyInPandas(search, "node long, partners array<struct<node:long,members:long>>, forest array<long>")
    return staged(found.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("partners"))).alias("partners"),
                                            F.array_distinct(F.flatten(F.collect_list("forest"))).alias("forest")), "links")


def audit(classes: DataFrame, links: DataFrame, dim: int, size: int) -> float:
    """Share of the true links of a bounded sample of vectors that were found: of all of them or by vector, whichever is lower."""
    drawn = classes.where(F.pmod(F.xxhash64("node", F.lit(11)), F.lit(1_000_003)) / 1_000_003 < min(1.0, AUDIT / size)).select("node", "v").limit(2 * AUDIT)
    rows = drawn.collect()
    if not rows:
        return 1.0
    ids, q = np.array([r["node"] for r in rows]), unit_rows([r["v"] for r in rows], dim)

    def true(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 2048):
                part = b.slice(s, 2048)
                near = (unit_rows(part.column(1).to_pylist(), dim) @ q.T >= RANGE) & (part.column(0).to_numpy()[:, None] != ids[None])
                yield pa.RecordBatch.from_pydict({"node": ids, "n": near.sum(0)})

    wanted = classes.select("node", "v").mapInArrow(true, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
    found = F.coalesce("found", F.lit(0))
    both = wanted.where("n > 0").join(links.select("node", F.size("partners").alias("found")), "node", "left").agg(
        F.sum("n").alias("n"), F.sum(found).alias("found"), F.avg(found / F.col("n")).alias("mean")).first()
    return min(both["found"] / both["n"], both["mean"]) if both["n"] else 1.0


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", overlap: int = OVERLAP, recall: float = RECALL) -> DataFrame:
    """One row per row of ``vectors``: id, n_links, component_id, kept, audited_recall."""
    rows = staged(vectors.select(F.col(vec_id).alias("id"), F.col(vec).alias("raw")).withColumn("ok", usable(F.col("raw")))
                  .select("id", F.when(F.col("ok"), F.transform("raw", lambda x: x.cast("double"))).alias("v"))
                  .withColumn("row", F.monotonically_increasing_id()), "vectors")
    good = rows.where("v is not null")
    classes = staged(good.groupBy("v").agg(F.count("*").alias("members"), F.min("row").alias("node"), F.min("id").alias("least")), "vector-classes")
    size, dim = classes.agg(F.count("*"), F.max(F.size("v"))).first()
    alone = rows.where("v is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    got = 1.0
    if size:
        while True:
            links = _links(classes, dim, size, overlap)
            got = audit(classes, links, dim, size)
            if got >= recall:
                break
            if overlap >= MOST_OVERLAP:
                links, got = _links(classes, dim, size, 1, exact=True), 1.0
                break
            overlap *= 2
        whole = components(links.select(F.col("node").alias("a"), F.explode("forest").alias("b")))
        counted = links.select("node", F.aggregate("partners", F.lit(0).cast("long"), lambda a, p: a + p["members"]).alias("near"))
        known = classes.join(counted, "node", "left").join(whole, "node", "left").withColumn("root", F.coalesce("component", "node"))
        least = known.groupBy("root").agg(F.min("least").alias("component_id"))
        known = known.join(least, "root").select("v", (F.coalesce("near", F.lit(0)) + F.col("members") - 1).alias("n_links"), "component_id")
        alone = alone.unionByName(good.select("id", "v").join(known, "v").select("id", "n_links", "component_id"))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    return alone.select(F.col("id").alias(vec_id), "n_links", "component_id", kept.alias("kept"), F.lit(float(got)).alias("audited_recall"))
