"""Token alignment, source mixing and whitening against brute force, with awkward rows in each."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from offerlake.llm import source_mix, spectral_whiten, token_align
from offerlake.llm.common import unpack
from offerlake.llm.queries import vocabulary

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


# ---------------------------------------------------------------- token alignment
def cuts_of(stretches):
    """shared_cuts over stretches that lie one after the other, split again."""
    a = b = np.zeros(0, np.int64)
    base = 0
    for x, y in stretches:
        a, b, base = np.concatenate([a, np.array(x) + base]), np.concatenate([b, np.array(y) + base]), base + x[-1]
    i, j = token_align.shared_cuts(a, b, np.array([len(x) for x, _ in stretches]), np.array([len(y) for _, y in stretches]))
    out, at, bt = [], 0, 0
    for x, y in stretches:
        mine = (i >= at) & (i < at + len(x))
        out.append(list(zip((i[mine] - at).tolist(), (j[mine] - bt).tolist(), strict=True)))
        at, bt = at + len(x), bt + len(y)
    return out


def test_shared_cuts_are_the_common_ends():
    rnd = random.Random(1)
    some = [([5], [1, 2, 5])]
    for _ in range(600):
        n = rnd.randint(1, 60)
        some.append(tuple(sorted(rnd.sample(range(1, n + 1), rnd.randint(1, n)) + [n + 1]) for _ in "ab"))
    want = [[(a.index(x), b.index(x)) for x in sorted(set(a) & set(b))] for a, b in some]
    assert cuts_of(some) == want
    assert [c for s in some for c in cuts_of([s])] == want


@pytest.mark.parametrize("near", ["start", "end", "none", "middle", "all"])
def test_every_candidate_end_is_tried_once(monkeypatch, near):
    n = 3000
    a = [2 * i for i in range(1, n + 1)]
    at = {"start": range(0, 20), "end": range(n - 20, n - 1), "none": [], "middle": range(n // 2, n // 2 + 20), "all": range(n)}[near]
    b = sorted({*(a[i] for i in at), *(2 * i + 1 for i in range(n - 1)), a[-1]})
    tried = Counter()
    plain = token_align.located

    def counted(ends, wanted):
        tried.update(wanted.tolist())
        return plain(ends, wanted)

    monkeypatch.setattr(token_align, "located", counted)
    assert [a[i] for i, _ in cuts_of([(a, b)])[0]] == sorted({a[i] for i in at} | {a[-1]})
    assert set(tried.values()) == {1}


ODD = [
    None, "", " ", "   ", "a", " a", "a ", "a  b", "a \n b", "a\n b", "\n\n\nx", "x\t\ty", "don't we'll  I'd", "1234567 89 3.14", "<|endoftext|> <s> </s> <unk> <0x41>",
    "x▁y", "▁", "日本語 テスト", "naïve café é", "a b 　c", "​  x", "\x1cx y\x1d z", "\x00 \x00a", "🙂🙂 🙂", "ﬁ ﬂ", "aaaaaaaa" * 40, "ab" * 3000, "x" * 70_001,
    "word " * 3000, "the the the the", "the cat", "the dog and the cat", "\r\n \r\n", "A_B-C/D", "ÀÉÎ õü", "﻿bom", "ᲊ Ꟛ", "end\x85 next",
]


def brute_alignment(texts):
    aligner = token_align.Aligner(A, B)
    docs = []
    for t in texts:
        got = None
        if t:
            a, b = aligner.a.encode(" " + t, add_special_tokens=False).ids, aligner.b.encode(t)
            in_a, in_b = [aligner.bytes_a[i] for i in a], [aligner.bytes_b[i] for i in b]
            if b"".join(in_a) == b"".join(in_b) == (" " + t).encode():
                ends_a, ends_b = np.cumsum([len(x) for x in in_a]).tolist(), np.cumsum([len(x) for x in in_b]).tolist()
                both = set(ends_a) & set(ends_b)
                place_a, place_b = {x: i for i, x in enumerate(ends_a)}, {x: i for i, x in enumerate(ends_b)}
                groups, i, j = [], 0, 0
                for x in sorted(both):
                    groups.append((a[i:place_a[x] + 1], b[j:place_b[x] + 1]))
                    i, j = place_a[x] + 1, place_b[x] + 1
                got = (len(a), len(b), groups)
        docs.append(got)
    links = [Counter((x, y) for ga, gb in d[2] for x in ga for y in gb) if d else Counter() for d in docs]
    count = Counter(p for c in links for p in c)
    top = Counter()
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = []
    for d, c in zip(docs, links, strict=True):
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in d[2])
        out.append((d[0], d[1], len(d[2]), sum(c.values()), sum(n for p, n in c.items() if count[p] == top[p[0]]), sum(n * count[p] for p, n in c.items()),
                    hashlib.sha256(text.encode()).hexdigest()))
    return out


def test_wide_groups_and_small_steps(monkeypatch):
    rnd = random.Random(7)
    texts = ODD + ["".join(rnd.choices("ab .É日", k=rnd.randint(1, 80))) for _ in range(60)]

    def figures():
        cols = token_align.figures(pa.array(texts, pa.string()), token_align.Aligner(A, B), True)
        at, times = unpack(cols["_pair_at"][0].as_py()), unpack(cols["_pair_times"][0].as_py())
        sums = np.bincount(at.astype(np.int64), times)
        return [cols[c].to_pylist() for c in (*token_align.RESULTS[:4], "groups_sha256", "groups")], *(unpack(cols[c][0].as_py()).tolist() for c in ("_pairs", "_holders")), sums.tolist()

    whole = figures()
    for name, value in (("WIDE_GROUP", 3), ("PAIRS_AT_ONCE", 50), ("ENCODED_AT_ONCE", 11)):
        monkeypatch.setattr(token_align, name, value)
    assert figures() == whole


@pytest.mark.parametrize("parts", [1, 5])
def test_alignment_equals_brute_force(spark, parts):
    rnd = random.Random(2)
    letters = "abc ÀÉ  \n 12.,'▂日"
    texts = ODD + ODD[:8] + ["".join(rnd.choices(letters, k=rnd.randint(1, 60))) for _ in range(80)]
    data = [(None if i % 11 == 0 else i // 2, t, i, "x", 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "doc_id long, text string, n_a long, _in string, _pos int").withColumns(
        {c: F.lit(7) for c in ("_block", "_text", "block", "at", "pair", "n", "best", "a", "top", "groups", "count_sum", "a.b")})
    df = df.withColumn("row", F.col("n_a")).repartition(parts)
    out = token_align.align(df, A, B, groups=True)
    assert [c for c in out.columns if c not in ("groups", *token_align.RESULTS)] == [c for c in df.columns if c not in ("groups", *token_align.RESULTS)]
    got = {r["row"]: r for r in out.collect()}
    want = brute_alignment(texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["doc_id"], r["text"], r["_in"], r["a.b"]) == (data[i][0], t, "x", 7)
        assert tuple(r[c] for c in token_align.RESULTS) == want[i], repr(t)
        assert (hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "") == want[i][-1]
    assert token_align.align(df.limit(0), A, B).count() == 0
    assert token_align.align(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), A, B).select("n_a", "groups_sha256").collect() == [(0, ""), (0, "")]


# ---------------------------------------------------------------- source mixing
def brute_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = float(sum(sizes.values())), set(names), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        above = [s for s in open_ if weight[s] * share > most * sizes[s]]
        if not above:
            target |= {s: weight[s] * share for s in open_}
            break
        for s in above:
            target[s] = float(most * sizes[s])
            left -= target[s]
            open_.remove(s)
    return target


def mix_rows(seed=3, n=900):
    rnd = random.Random(seed)
    names = ["a", "b", "é", "Z", "日", None, "", "aa", "tiny"]
    rows = []
    for i in range(n):
        s = "hot" if rnd.random() < 0.4 else rnd.choice(names)
        words = rnd.choice([0, 1, 3, 10, 40, 300])
        rows.append((i, " ".join(rnd.choices(["word", "12", "--", "çà"], k=words)) if rnd.random() > 0.05 else None, s))
    rows += [(5, "same id", "a"), (5, "same id", "a"), (None, "no id", "b"), (None, "no id", "b"), (None, None, None), (9000, "x " * 20_000, "tiny"), (9001, "", "empty"), (9002, None, "empty")]
    return rows


def test_mix_meets_targets(spark):
    rows = mix_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {c: F.lit("k") for c in ("size", "target", "_source", "_tile", "_key", "_in", "_id", "_size", "_words", "_before", "_epochs", "_budget", "_level", "weight", "a.b")}).repartition(5)
    out = source_mix.mix(df).collect()
    assert len(out) == len(rows) and out[0]["_key"] == "k" and out[0]["a.b"] == "k"
    size = lambda t: len([w for w in (t or "").split(" ") if w])
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    target = brute_targets(dict(sizes))
    taken = Counter()
    for r in out:
        s = r["source"]
        assert r["source_size"] == sizes[s] and math.isclose(r["target"], target[s], rel_tol=1e-12)
        epochs = math.floor(target[s] / sizes[s]) if sizes[s] else 0
        assert epochs * r["size"] <= r["taken"] <= min(3, epochs + 1) * r["size"]
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 0.5 + 1e-6
        epochs = target[s] // sizes[s] if sizes[s] else 0
        assert sum(1 for r in out if r["source"] == s and 0 < r["taken"] - epochs * r["size"] < r["size"]) <= 1  # one document is cut
    again = source_mix.mix(df.repartition(2).orderBy(F.rand(1))).collect()
    key = lambda r: (str(r["doc_id"]), r["size"], str(r["source"]), r["taken"])
    assert sorted(map(key, again)) == sorted(map(key, out))


def test_mix_draws_by_quality(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text"), F.lit("s").alias("source"), (F.col("id") % 2).alias("good"))
    more = spark.range(8000).select((F.col("id") + 4000).alias("doc_id"), F.lit("one").alias("text"), F.lit("z").alias("source"), F.lit(1).cast("long").alias("good"))
    out = source_mix.mix(docs.unionByName(more), weights=(1, 3), quality=F.when(F.col("good") == 1, 1.0).otherwise(0.1)).where("source = 's'")
    share = {r["good"]: r["m"] for r in out.groupBy("good").agg(F.avg((F.col("taken") > 0).cast("int")).alias("m")).collect()}
    # half of the words: 1 - exp(-t) and 1 - exp(-t / 10) add up to one at t of about 1.97
    assert abs(share[1] - 0.86) < 0.04 and abs(share[0] - 0.18) < 0.04
    default = source_mix.mix(spark.createDataFrame([(1, "plain words", "s"), (2, "1234 5678", "s")], "doc_id long, text string, source string"))
    assert [r["taken"] for r in default.orderBy("doc_id").collect()] == [2, 2]


def test_mix_of_nothing(spark):
    schema = "doc_id long, text string, source string"
    assert source_mix.mix(spark.createDataFrame([], schema)).count() == 0
    out = source_mix.mix(spark.createDataFrame([(1, None, "a"), (2, "", None)], schema)).collect()
    assert sorted((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in out) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_mix_is_native(spark):
    plan = source_mix.mix(spark.createDataFrame(mix_rows(n=20), "doc_id long, text string, source string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan and "InPandas" not in plan


# ---------------------------------------------------------------- whitening
def test_inertia_counts_eigenvalues():
    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 7, 30):
        for kind in range(4):
            a = rng.normal(size=(n, n))
            a = a + a.T if kind < 2 else a @ a.T
            if kind == 1:
                np.fill_diagonal(a, 0.0)
            if kind == 3:
                a = np.diag(np.round(rng.normal(size=n), 1))
            values = np.linalg.eigvalsh(a)
            for shift in [*(values + 1e-6), *(values - 1e-6), 0.37, -0.37]:
                if np.abs(values - shift).min() > 1e-9:
                    assert spectral_whiten.inertia(a, float(shift)) == (values > shift).sum()


@pytest.mark.parametrize("values", [[9, 5, 4, 3, 2, 1, 0.5, 0.25, 0.1, 0.0], [4, 4, 4, 1, 1, 0.5, 0.5, 0.1, 0.1, 0.1], [1] * 10, [1, 0, 0, 0, 0, 0, 0, 0, 0, 0],
                                    [1, 1 - 1e-9, 1 - 2e-9, 0.5, 0.5 - 1e-12, 1e-3, 1e-6, 1e-9, 1e-12, 0], [1e-200 * x for x in range(10)], [0] * 10])
def test_leading_pairs(values):
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.normal(size=(10, 10)))
    a = q @ np.diag(np.array(values, float)) @ q.T
    a = (a + a.T) / 2
    got = spectral_whiten.leading(a, 8)
    want = np.sort(np.array(values, float))[::-1][:8]
    top = max(values)
    assert len(got) == (want > top * 2e-14).sum() if top else not got
    for (e, v), w in zip(got, want):
        assert abs(e - w) <= 1e-12 * top and np.abs(a @ v - e * v).max() <= 1e-12 * top
    v = np.array([x for _, x in got]).reshape(len(got), 10)
    assert np.abs(v @ v.T - np.eye(len(got))).max(initial=0) < 1e-12


def test_whitening_equals_a_plain_decomposition(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 12)) * np.array([5, 4, 3, 2, 1.5, 1.2, 1, 0.8, 0.6, 0.5, 0.4, 0.3]) @ np.linalg.qr(rng.normal(size=(12, 12)))[0] + 30
    data = [(i, v.tolist()) for i, v in enumerate(x)] + [(7, x[7].tolist()), (None, x[8].tolist())]
    bad = [(900, None), (901, []), (902, [None] * 12), (903, [float("nan")] * 12), (904, [float("inf")] + [0.0] * 11), (905, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, "t", 1) for r in data + bad], "vec_id long, embedding array<double>, n string, _x int").withColumns({c: F.lit("k") for c in ("_in", "j", "g", "at", "a.b")}).repartition(4)
    out = spectral_whiten.whiten(df).collect()
    ints = np.array([[math.floor(1024 * c) + 100_000 for c in v] for _, v in data], object)
    n, total = len(ints), ints.sum(0)
    centred = (ints - np.array([t / n for t in total])).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    white = centred @ vectors / np.sqrt(values)
    deviation = [int(d) for d in ((ints * n - total) ** 2).sum(1)]
    assert len(out) == 8 * n and {r["n"] for r in out} == {n} and out[0]["_in"] == "k" and out[0]["a.b"] == "k"
    mine = {(r["vec_id"], r["component"]): r for r in out if r["vec_id"] is not None}
    for k in range(8):
        sign = 1 if mine[0, k + 1]["whitened"] * white[0, k] > 0 else -1
        for i in range(400):
            r = mine[i, k + 1]
            assert abs(r["whitened"] - sign * white[i, k]) < 1e-8 and r["deviation"] == deviation[i]
            assert abs(r["explained"] / (values[k] / (centred ** 2).sum() * n) - 1) < 1e-10
    assert max(r["identity_error"] for r in out) < 1e-9
    assert sum(r["vec_id"] == 7 for r in out) == 16 and sum(r["vec_id"] is None for r in out) == 8


def test_whitening_of_little(spark):
    make = lambda rows: spectral_whiten.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert make([]).count() == 0 and make([(1, None)]).count() == 0
    assert make([(1, [1.0, 2.0])]).count() == 0 and make([(1, [1.0, 2.0]), (2, [1.0, 2.0])]).count() == 0
    out = make([(1, [1.0, 0.0]), (2, [3.0, 0.0])]).orderBy("vec_id").collect()
    assert [(r["component"], abs(round(r["whitened"], 9)), r["explained"], r["deviation"]) for r in out] == [(1, 1.0, 1.0, 2048 ** 2)] * 2
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 5.0])], "vec_id long, embedding array<double>")
    out = spectral_whiten.whiten(huge).collect()
    assert {r["deviation"] for r in out} == {None} or all(r["deviation"] is None or r["deviation"] >= 0 for r in out)
    assert max(r["identity_error"] for r in out) < 1e-4
