"""Operators on vectors and urls, the registered queries against SQL, and the pipeline on a small awkward corpus."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMOKE
from offerlake.llm import embed_dedup, exact_topk, queries, url_filter
from offerlake.llm.common import components

TABLES = ["documents", "embeddings", "pages", "labels"]
BAD = [(1000, None), (1001, []), (1002, [float("nan"), 1.0, 0.0]), (1003, [None, 1.0, 0.0]), (1004, [float("inf"), 1.0, 0.0])]


def test_components(spark):
    rnd = random.Random(0)
    pairs = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(200, 200)] + [(rnd.randint(300, 400), rnd.randint(300, 400)) for _ in range(60)]
    up = {x: x for p in pairs for x in p}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs * 2, "a long, b long")).collect()}
    assert got == {x: top(x) for p in pairs if p[0] != p[1] for x in p}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("rows", [60, embed_dedup.SHARD_ROWS])
def test_near_vectors(spark, monkeypatch, rows):
    monkeypatch.setattr(embed_dedup, "SHARD_ROWS", rows)
    rng = np.random.default_rng(0)
    x = [v for v in rng.normal(size=(150, 12))]
    for c in (4, 30, 80):
        base = rng.normal(size=12)
        x += [base + 0.12 * rng.normal(size=12) for _ in range(c)]
    x += [x[5]] * 40 + [x[7] * 3, x[200], np.zeros(12)]
    data = [(i, v.tolist()) for i, v in enumerate(x)] + BAD + [(None, x[5].tolist()), (None, rng.normal(size=12).tolist()), (9, x[9].tolist()), (9, x[170].tolist())]
    df = spark.createDataFrame([(*r, "a", 1) for r in data], "vec_id long, embedding array<double>, node string, members int").repartition(4)
    unit = [None if v is None or not v or any(c is None or not math.isfinite(c) for c in v) or not any(v) else np.array(v) / np.linalg.norm(v) for _, v in data]
    link = [[j for j, b in enumerate(unit) if j != i and a is not None and b is not None and a @ b >= 0.9] for i, a in enumerate(unit)]
    comp = list(range(len(data)))
    for _ in data:
        new = [min([comp[i], *(comp[j] for j in js)]) for i, js in enumerate(link)]
        if new == comp:
            break
        comp = new
    least = {c: min((data[i][0] for i in range(len(data)) if comp[i] == c and data[i][0] is not None), default=None) for c in set(comp)}
    want = sorted(((d, len(js), least[c], d is not None and d == least[c]) for (d, _), js, c in zip(data, link, comp, strict=True)), key=str)
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embed_dedup.near_duplicates(df).collect()), key=str)
    assert got == want
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0
    assert [r.n_links for r in embed_dedup.near_duplicates(df.where("vec_id = 1000")).collect()] == [0]


def _topk(data, k=5):
    rows = [(i, d, [math.floor(256 * c) for c in v]) for i, (d, v) in enumerate(data) if d is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for i, d, q in rows:
        if d % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, x, strict=False)), c) for j, c, x in rows if j != i)[:k]
            out += [(d, n + 1, c, -s) for n, (s, c) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("block", [16, exact_topk.BLOCK])
def test_top_products(spark, monkeypatch, block):
    monkeypatch.setattr(exact_topk, "BLOCK", block)
    monkeypatch.setattr(exact_topk, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(1)
    x = [(rng.normal(size=6) * rng.choice([0.01, 1, 5])).tolist() for _ in range(320)]
    x[10:60] = [x[9]] * 50
    data = [(i, v) for i, v in enumerate(x)] + BAD + [(None, x[3]), (50, x[50]), (400, [0.0] * 6), (450, [1.0, 2.0]), (500, [1e6] * 6), (550, [-3e6] * 6)]
    df = spark.createDataFrame([(*r, 1) for r in data], "vec_id long, embedding array<double>, rank int").repartition(3)
    got = exact_topk.search(df, F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect())) == _topk(data)
    few = df.where("vec_id in (0, 1, 2)")
    assert exact_topk.search(few, F.col("vec_id") % 50 == 0).count() == 2
    assert exact_topk.search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_urls(spark):
    urls = [(1, "http://a.ORG/x?y#z"), (2, "https://sub.example.org/es/1"), (3, "https://example.org/en/12"), (4, "https://example.org/en/22"), (5, "ftp://x.com/fr/a"), (6, "http://y.com/de/b#c"),
            (7, None), (8, "no scheme"), (9, "http://"), (None, "http://notorg/"), (1, "http://a.ORG/x?y#z"), (12, "http://b.net?q=/fr/"), (13, "http://É.net/İ\n/ä" + "x" * 5000), (14, "http://org")]
    df = spark.createDataFrame([(*u, "h", 3) for u in urls], "page_id long, url string, host string, score int").repartition(2)
    got = {r.page_id: r for r in url_filter.judge(df.select("page_id", "url")).collect()}
    rules = {1: "org/", 2: "example.org/es/", 3: "example.org/en/1", 4: "org/", 5: "com/fr/", 6: "com/de/", 7: None, 14: None}
    assert {k: got[k].rule for k in rules} == rules
    assert [got[k].verdict for k in (1, 2, 3, 4, 5, 6)] == ["allow", "block", "block", "allow", "allow", "block"]
    assert (got[1].host, got[1].path) == ("a.org", "/x") and (got[7].host, got[8].path) == ("", "") and (got[12].host, got[12].path) == ("b.net", "")
    assert got[13].path.startswith("/İ\n/ä")
    assert url_filter.judge(df.select("page_id", "url")).count() == len(urls)
    assert all(r.verdict in ("allow", "block") for r in got.values())
    assert url_filter.judge(df.select("page_id", "url").limit(0)).count() == 0
    only = url_filter.judge(df.select("page_id", "url").where("page_id in (1, 7)")).collect()
    assert {r.verdict for r in only} == {"allow"}


def test_url_model_reads_the_whole_url(spark):
    urls = [f"http://a{i}.org/p?ref=news" for i in range(20)] + [f"http://a{i}.com/de/p?spam=1#feed" for i in range(20)]
    urls += ["http://x.net/p?ref=news", "http://x.net/p?spam=1#feed", "http://x.net/p", "ref=news", "spam=1#feed", "http://x.net/p?ref=news#feed", None]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in url_filter.judge(df).collect()}
    assert {i: r.url for i, r in got.items()} == dict(enumerate(urls))
    assert len({got[i].score for i in range(40, 47)}) == 7
    assert got[40].score > got[45].score > got[41].score and got[43].score > got[44].score


def test_url_model_is_smoothed_and_normalised(spark):
    pages = spark.read.parquet(f"{SF_SMOKE}/pages.parquet").select(F.concat(url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))).alias("t"), F.when(F.col("page_id") % 3 == 0, "block").otherwise("allow").alias("v"))
    models = url_filter.fit(pages, "t", "v")
    rows = [r.t + "$" for r in pages.collect()]
    keep = [r.v for r in pages.collect()]
    size = len(url_filter.SYMBOLS)

    def p(kind, ctx, c):
        q = 1 / size if not ctx else p(kind, ctx[1:], c)
        if ctx == "":
            q = 1 / size
        n = sum(("^" * 4 + t)[i:i + len(ctx)] == ctx for t, k in zip(rows, keep, strict=True) if k == kind for i in range(4 - len(ctx), 4 - len(ctx) + len(t)))
        m = sum(("^" * 4 + t)[i:i + len(ctx) + 1] == ctx + c for t, k in zip(rows, keep, strict=True) if k == kind for i in range(4 - len(ctx), 4 - len(ctx) + len(t)))
        return (m + url_filter.M * q) / (n + url_filter.M)

    for k, model in enumerate(models):
        for r in model.orderBy("ctx").limit(3).collect():
            assert len(r.ctx) == k and sum(r.p_allow) == pytest.approx(1) and sum(r.p_block) == pytest.approx(1)
            c = url_filter.SYMBOLS[3]
            assert r.p_block[3] == pytest.approx(p("block", r.ctx, c)) and r.p_allow[3] == pytest.approx(p("allow", r.ctx, c))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF_SMOKE)
    want = con.sql(queries.ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(want.fetchall(), key=str)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_query_covers_its_table(spark, name):
    table, key = {"op1": ("pages", "page_id"), "op13": ("embeddings", "vec_id")}.get(name.split("_")[0], ("documents", "doc_id"))
    got = queries.QUERIES[name](spark, SF_SMOKE)
    ids = {r[0] for r in spark.read.parquet(f"{SF_SMOKE}/{table}.parquet").select(key).collect()}
    assert {r[0] for r in got.select(got.columns[0]).collect()} == ids


def test_pipeline(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    text = docs.orderBy("doc_id").first().text
    odd = spark.createDataFrame([(None, text, "en", "s", 1), (None, None, None, None, None), (5000, "", "en", "s", 0), (5001, "12 34", "en", "s", 5)], docs.schema)
    docs.unionByName(odd).withColumn("_row", F.lit("x")).withColumn("n", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF_SMOKE}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    cur, sizes = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        new = stage(spark, cur, str(tmp_path))
        if name != "packing":
            assert new.columns == list(corpus_pipeline.COLUMNS)
        new.write.parquet(f"{tmp_path}/{name}")
        cur = spark.read.parquet(f"{tmp_path}/{name}")
        sizes.append(cur.count())
        if name == "secrets":
            assert not cur.where(F.col("text").rlike("AKIA[A-Z0-9]{14,}")).count()
    assert sizes[0] < docs.count() + 4 and sizes[2] < sizes[1] <= sizes[0] and sizes[3] == sizes[2]
    kept = {r.doc_id for r in spark.read.parquet(f"{tmp_path}/language").collect()}
    assert 5000 not in kept and 5001 not in kept
    bad = {r.doc_id for r in spark.read.parquet(f"{SF_SMOKE}/labels.parquet").where("quality = 0").collect()}
    assert not bad & {r.doc_id for r in spark.read.parquet(f"{tmp_path}/quality").collect()}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == sizes[-1]
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
