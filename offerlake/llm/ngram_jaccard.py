"""Near-duplicate documents by the Jaccard similarity of their word shingles, in size-banded tiles with bitmap signatures.

A document is the set of hashes of its five-word shingles. Documents with equal sets form one class, and classes are
compared. Comparing every class with all classes of similar size would be quadratic, so a tile holds only the classes that
share four min-hashes; ``TILES`` such keys a class leave a pair at the threshold unseen with probability
(1 - 0.75^4)^36, about one in a million, and a more similar pair far less often. Inside a tile classes are ordered by size,
and only those in the band of sizes that the threshold allows meet. Each carries a bitmap as wide as its size asks for, into
which its hashes are xor-ed: the bits in which two maps differ bound the sets' difference from below and so the overlap from
above (a wider map is folded onto a narrower one). Pairs that pass are verified by intersecting the two sorted arrays.

Only pairs that can change the components are verified: a tile hands on a spanning forest of its passing pairs, so a group of
thousands of near copies costs as many pairs as it has members. If one of these pairs turns out false, its tile is gone
through again and hands on every passing pair that the verified ones leave apart. Tiles above ``TILE_ROWS`` are cut into
chunks that meet two by two in separate tasks.

Defined cases: texts are lower-cased in A-Z and split at ASCII white space; fewer than five words make one shingle of all;
a null text or one without words has an empty set, links with nothing and is its own component; repeated rows are in one
class; rows without an id take part, but cannot name a component (null if no member has an id).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlake.llm.common import components, held, map_text, staged

WORDS = 5
#: Similarity at least NUM / DEN.
NUM, DEN = 75, 100
#: Tiles a class is in, min-hashes a tile's key joins.
TILES, JOINED = 36, 4
TILE_ROWS = 2048
BUCKET_ROWS = 20_000
KEPT_WORDS = 500_000
#: Bits of a bitmap per shingle, at least.
BITS = 4

MIX1, MIX2, STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit integers."""
    h = (h ^ (h >> np.uint64(30))) * MIX1
    h = (h ^ (h >> np.uint64(27))) * MIX2
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Ascending distinct 64-bit hashes of each text's shingles."""
    known: dict[bytes, int] = held("shingle words", dict)
    if len(known) > KEPT_WORDS:
        known.clear()
    out = []
    for t in texts:
        runs = t.encode("utf-8", "replace").lower().split()
        for w in set(runs).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, runs), np.uint64, len(runs))
        n = min(WORDS, len(h))
        if not n:
            out.append(h)
            continue
        s = np.full(len(h) - n + 1, n, np.uint64)
        for k in range(n):
            s = mixed(s * STEP + h[k:len(h) - n + 1 + k])
        out.append(np.unique(s))
    return out


def _hash_functions() -> np.ndarray:
    return mixed(np.arange(1, TILES * JOINED + 1, dtype=np.uint64) * STEP) | np.uint64(1)


def tile_keys(sets: list[np.ndarray]) -> np.ndarray:
    """Keys (sets x TILES) of non-empty sets: each joins JOINED min-hashes."""
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    flat = np.concatenate(sets)
    keys = np.zeros((len(sets), TILES), np.uint64)
    for i, a in enumerate(_hash_functions()):
        low = np.minimum.reduceat((flat * a) >> np.uint64(16), starts)
        keys[:, i // JOINED] = mixed(keys[:, i // JOINED] * STEP + low + np.uint64(i // JOINED))
    return keys


def bitmap(s: np.ndarray) -> np.ndarray:
    """Parity of the set's hashes by their last bits: 64-bit words, a power of two of them."""
    words = 1 << max(0, int(max(1, BITS * len(s) - 1)).bit_length() - 6)
    bit = (s & np.uint64(64 * words - 1)).astype(np.int64)
    odd = np.bincount(bit, minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<u8")


def sketch(docs: DataFrame, text: str) -> DataFrame:
    """Add n (size), s1 and s2 (identity of the set), tile keys and bitmap; drops the text."""

    def run(part: pa.RecordBatch) -> dict:
        sets = shingle_sets([t or "" for t in part.column(part.schema.get_field_index(text)).to_pylist()])
        full = [i for i, s in enumerate(sets) if len(s)]
        keys: list = [None] * len(sets)
        if full:
            for i, k in zip(full, tile_keys([sets[i] for i in full]).view(np.int64), strict=True):
                keys[i] = k
        return {"n": [len(s) for s in sets], "s1": identities(sets, 0), "s2": identities(sets, 1), "keys": keys,
                "map": [bitmap(s).tobytes() if len(s) else None for s in sets]}

    return map_text(docs, text, "n long, s1 long, s2 long, keys array<long>, map binary", run).drop(text)


def identities(sets: list[np.ndarray], k: int) -> list[int]:
    return [int(np.uint64(xxhash.xxh64_intdigest(s.tobytes(), seed=k)).astype(np.int64)) for s in sets]


def _fold(m: np.ndarray) -> np.ndarray:
    half = m.shape[1] // 2
    return m[:, :half] ^ m[:, half:]


def passing(sizes: np.ndarray, maps: list[bytes], label: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each member i of a tile (ascending sizes), the later members whose label differs from i's and whose bitmaps allow
    the overlap, with the number of differing bits. ``label`` may be changed between the steps."""
    width = np.array([len(m) // 8 for m in maps])
    folded: dict[int, tuple[int, np.ndarray]] = {}
    for w in np.unique(width).tolist():
        own = np.flatnonzero(width == w)
        wide = np.flatnonzero(width == 2 * w)
        a = np.frombuffer(b"".join([maps[i] for i in own]), "<u8").reshape(-1, w)
        if len(wide):
            a = np.concatenate([a, _fold(np.frombuffer(b"".join([maps[i] for i in wide]), "<u8").reshape(-1, 2 * w))])
        folded[w] = int(own[0]), a  # sizes ascend, so members of one width are neighbours, the next width follows
    for i in range(len(sizes) - 1):
        most = int(sizes[i]) * DEN // NUM
        end = int(np.searchsorted(sizes, most, "right"))
        first, a = folded[int(width[i])]
        end = min(end, first + len(a))
        js = np.flatnonzero(label[i + 1:end] != label[i]) + i + 1
        if not len(js):
            continue
        differ = np.bitwise_count(a[js - first] ^ a[i - first]).sum(1, dtype=np.int64)
        both = sizes[js] + sizes[i]
        # overlap <= (both - differ) / 2, and the threshold asks (DEN + NUM) * overlap >= NUM * both
        ok = (DEN + NUM) * ((both - differ) // 2) >= NUM * both
        if ok.any():
            yield i, js[ok], differ[ok]


def forest(sizes: np.ndarray, maps: list[bytes]) -> list[tuple[int, int]]:
    """A spanning forest of a tile's passing pairs; among pairs that join the same two parts, the closest."""
    label, out = np.arange(len(sizes)), []
    for i, js, differ in passing(sizes, maps, label):
        order = np.lexsort((js, differ, label[js]))
        parts, at = np.unique(label[js][order], return_index=True)
        out += [(i, int(j)) for j in js[order][at]]
        label[np.isin(label, parts)] = label[i]
    return out


def _tiles(tiles: DataFrame, maps: DataFrame, label: DataFrame | None) -> DataFrame:
    """Pairs (a, b, tile) that the tiles hand on. Rows of ``tiles``: tile, part, node, n, bucket."""

    again = label is not None

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["tile", "part", "n", "node"], kind="stable")
        tile, part, node, n = (pdf[c].to_numpy() for c in ("tile", "part", "node", "n"))
        own = pdf["label"].to_numpy() if again else None
        blobs = pdf["map"].tolist()
        cut = np.flatnonzero((np.diff(tile) != 0) | (np.diff(part) != 0)) + 1
        out: list[tuple[int, int, int]] = []
        for s, e in zip([0, *cut.tolist()], [*cut.tolist(), len(tile)], strict=True):
            if e - s < 2:
                continue
            if own is None:
                pairs = forest(n[s:e], blobs[s:e])
            else:
                pairs = [(i, int(j)) for i, js, _ in passing(n[s:e], blobs[s:e], own[s:e]) for j in js]
            out += [(int(node[s + i]), int(node[s + j]), int(tile[s])) for i, j in pairs]
        return pd.DataFrame(out, columns=["a", "b", "tile"], dtype="int64")

    rows = tiles.join(maps, "node")
    if label is not None:
        rows = rows.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    return rows.groupBy("bucket").applyInPandas(run, "a long, b long, tile long")


def similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (the smallest id reachable by links)."""
    source = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    rows = staged(sketch(source, "text").withColumn("row", F.monotonically_increasing_id()), "shingles")
    named = ["n", "s1", "s2"]
    classes = staged(rows.where("n > 0").groupBy(*named).agg(F.min_by("id", "row").alias("id"), F.min("id").alias("least"), F.min("row").alias("node")), "classes")
    full = rows.select(F.col("row").alias("node"), "n", "keys", "map").join(classes.select("node"), "node")
    full = staged(full, "class-sketches")
    maps = full.select("node", "map")
    entries = full.select("node", "n", F.explode("keys").alias("tile"))
    sizes = entries.groupBy("tile").agg(F.count("*").alias("members")).where("members > 1")
    chunks = F.ceil(F.col("members") / TILE_ROWS).cast("int")
    shared = entries.join(sizes, "tile").withColumn("chunks", chunks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    # chunks of a large tile meet two by two: each goes to one part per chunk
    shared = shared.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    shared = shared.withColumn("part", F.least("own", "other").cast("long") * (1 << 31) + F.greatest("own", "other"))
    shared = staged(shared.select("tile", "part", "node", "n"), "tiles")
    buckets = max(1, shared.count() // BUCKET_ROWS)
    tiles = shared.withColumn("bucket", F.pmod(F.xxhash64("tile", "part"), F.lit(buckets)))
    first = staged(_tiles(tiles, maps, None), "pairs")
    ends = classes.select("node", "id", "s1", "s2")
    checked = staged(verify(first, ends, source), "verified")
    links = checked.where("linked").select("a", "b")
    false = first.join(checked.where(~F.col("linked")).select("a", "b"), ["a", "b"]).select("tile").distinct()
    if checked.where(~F.col("linked")).limit(1).count():
        label = components(links).select("node", F.col("component").alias("label"))
        again = staged(_tiles(tiles.join(false, "tile"), maps, label).join(checked.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
        links = links.unionByName(verify(again, ends, source).where("linked").select("a", "b"))
    whole = components(links)
    roots = classes.join(whole, "node", "left").withColumn("root", F.coalesce("component", "node"))
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named_roots = roots.join(least, "root").select(*named, "component_id")
    linked = rows.where("n > 0").select("id", *named).join(named_roots, named).select("id", "n", "component_id")
    out = linked.unionByName(rows.where("n = 0").select("id", "n", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), "component_id")


def verify(pairs: DataFrame, ends: DataFrame, source: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of class nodes with ``linked``: is the exact similarity at least the threshold?

    Only the texts of classes in some pair are read on past the scan and turned into sorted arrays again.
    """
    distinct = pairs.select("a", "b").distinct()
    asked = distinct.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(ends, "node").withColumnRenamed("id", "_id")
    texts = source.join(asked, source["id"].eqNullSafe(asked["_id"])).select("node", "s1", "s2", "text")

    def arrays(part: pa.RecordBatch) -> dict:
        sets = shingle_sets([t or "" for t in part.column(part.schema.get_field_index("text")).to_pylist()])
        return {"set": [s.tobytes() for s in sets], "t1": identities(sets, 0), "t2": identities(sets, 1)}

    # an id may occur with several texts: the set must be the class's
    sets = map_text(texts, "text", "set binary, t1 long, t2 long", arrays).where("s1 = t1 and s2 = t2").select("node", "set")
    sets = staged(sets, "sets").dropDuplicates(["node"])
    both = (distinct.join(sets.select(F.col("node").alias("a"), F.col("set").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("set").alias("y")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                s, t = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                shared = len(np.intersect1d(s, t, assume_unique=True))
                linked.append(DEN * shared >= NUM * (len(s) + len(t) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long, linked boolean")


def first_of_group(component: Column, doc_id: Column) -> Column:
    """Is this the document that stands for its group?"""
    return component.eqNullSafe(doc_id)
