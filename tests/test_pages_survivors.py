"""Offers from stored pages, searches and their pages, the incremental survivor table, pruned snapshots."""

import os
import random

import pytest
from pyspark.sql import functions as F

from offerlake.operators import pages as pg
from offerlake.operators.crawl import search_visits
from offerlake.operators.dedup import keep_most_complete
from offerlake.operators.survivors import merge_day
from offerlake.sources.offers import latest_snapshot

PAGE = "tienda string, pais string, moneda string, categoria string, keyword_busqueda string, url string, html string, fecha_extraccion string"
HTML = """<html><head><style>li.product{}</style><script>document.write('<li class="product"><h2 class="t">no</h2></li>')</script></head><body>
<!-- <li class="product"><h2 class="t">no</h2></li> --><li class="menu"><a href="/m">Menu</a></li>
<LI class='first product'><a href='/p/1?a=1&amp;b=2'><h2 class="big t">Memoria <i>RAM</i>
  DDR4 &lt;16&nbsp;GB&gt;</h2></a><span class="price"><del>$ 99</del> <ins>$&amp; 80</ins></span><ul><li>uno</li><li>dos</li></ul></LI>
<li class="product"><h2 class="t">Disco 5 > 4 "x"</h2><a href="q/2#z">ver</a></li>
<li class="product"><span class="price">$ 5</span><a href="//cdn.example/3">sin nombre</a></li>
<li class="product"><h2 class="t"></h2></li>
<li class="product" data-x="a > b"><h2 class="t">Memoria al final</h2><h2 class="t">otra</h2><span class="price">7"""


def frame(spark, rows):
    df = spark.createDataFrame(rows, PAGE)
    return pg.with_selectors(df, "li.product", "h2.t, h3.title", "span.price")


def test_items_with_name_price_and_link(spark):
    df = frame(spark, [("T", "Ecuador", "USD", "RAM", "memoria ram", "https://t.example/dir/lista?s=1#x", HTML, "2026-06-30")])
    got = pg.page_offers(df, whitelist=False).orderBy("pos").collect()
    assert [(r.producto, r.precio_raw, r.url_producto) for r in got] == [
        ("Memoria RAM DDR4 <16 GB>", "$ 99 $& 80", "https://t.example/p/1?a=1&b=2"), ('Disco 5 > 4 "x"', "", "https://t.example/dir/q/2#z"),
        ("Memoria al final", "7", "")]
    assert got[0].asDict().keys() == {"pos", *pg.OFFER_COLUMNS} and got[0].tienda == "T" and got[0].fecha_extraccion == "2026-06-30"
    assert [r.producto[:7] for r in pg.page_offers(df).orderBy("pos").collect()] == ["Memoria", "Memoria"]  # the disk is no RAM


@pytest.mark.parametrize("html", [None, "", "<", "<li", "no tags", "<li class=product>", "</li></li>", "<li class=product><li class=product>" * 40, "<h2 class=t>x</h2>", "<a href=>x</a>" * 50])
def test_odd_pages_have_no_named_items(spark, html):
    assert pg.page_offers(frame(spark, [("T", None, None, "RAM", "k", "x", html, None)]), whitelist=False).count() == 0


def test_addresses(spark):
    base = "https://t.example:8080/a/b.html?x=1#y"
    cases = {"http://o.example/z": "http://o.example/z", "mailto:a@b": "mailto:a@b", "//c/d": "https://c/d", "/r": "https://t.example:8080/r", "?q=2": "https://t.example:8080/a/b.html?q=2",
             "#k": "https://t.example:8080/a/b.html?x=1#k", "n.html": "https://t.example:8080/a/n.html"}
    df = spark.createDataFrame([(base, h) for h in cases], "b string, h string")
    assert {r.h: r.u for r in df.select("h", pg.resolve_url(F.col("b"), F.col("h")).alias("u")).collect()} == cases
    assert spark.createDataFrame([("https://t.example", "n")], "b string, h string").select(pg.resolve_url(F.col("b"), F.col("h"))).first()[0] == "https://t.example/n"
    with pytest.raises(ValueError):
        pg.parse_selector("div > a")


def test_probe_names_the_first_candidate(spark):
    a = '<div class="product-small box"><p class="product-title">x</p></div>' * 2
    df = spark.createDataFrame([("https://a.example/1", a + '<b class="price">1</b>'), ("https://a.example/2", a), ("https://b.example/1", None)], "url string, html string")
    got = {(r.sitio, r.tipo, r.selector): r.paginas for r in pg.selector_probe(df).collect()}
    assert got == {("a.example", "contenedor", "div.product-small.box"): 2, ("a.example", "nombre", ".product-title"): 2, ("a.example", "precio", ".price"): 1,
                   ("a.example", "precio", ""): 1, **{("b.example", k, ""): 1 for k in ("contenedor", "nombre", "precio")}}


def test_search_visits_reasons(spark):
    seeds = spark.createDataFrame([("T", "RAM", "memoria ram", "https://t.example/?s=memoria+ram&x=1")], "tienda string, categoria string, keyword string, url string")
    u = "https://t.example/?s=memoria+ram&paged="
    rows = [(1, u + "1", 0), (2, u + "2", 3), (3, u + "3", 0), (4, u + "4", 5), (5, "https://t.example/?s=memoria+ram", 5), (6, "https://o.example/?s=memoria+ram&paged=1", 5),
            (7, "https://t.example/?s=mouse&paged=1", 5), (8, None, 5), (9, "not an address %%", 5), (10, u + "x", 1)]
    got = {r.page_id: (r["rank"], r.visitada, r.motivo) for r in search_visits(spark.createDataFrame(rows, "page_id int, url string, items int"), seeds, 5).collect()}
    lost = (None, False, "busqueda desconocida")
    assert got == {1: (1, True, None), 2: (2, True, None), 3: (3, True, None), 4: (None, False, "pagina vacia"), 5: (None, False, "sin numero de pagina"),
                   6: lost, 7: lost, 8: lost, 9: lost, 10: (None, False, "sin numero de pagina")}


def test_day_by_day_equals_all_at_once(spark, tmp_dir):
    rnd = random.Random(5)
    pick = lambda *v: rnd.choice([None, *v])
    rows = [(rnd.choice("ab"), rnd.choice(["k1", "k2", None]), pick(1.0, 2.0), pick("x", "y"), f"2026-06-{rnd.randint(1, 4):02d}") for _ in range(300)]
    schema = "tienda string, clave string, precio double, titulo string, dia string"
    df = spark.createDataFrame(rows, schema)
    keys = ["tienda", "clave", "precio"]
    want = sorted(map(str, keep_most_complete(df, keys).collect()))
    path = os.path.join(tmp_dir, "vivas")
    for day in ("2026-06-03", "2026-06-01", "2026-06-04", "2026-06-02", "2026-06-03"):
        got = merge_day(df.where(F.col("dia") == day), path, keys, 4)
    assert sorted(map(str, got.collect())) == want
    assert sorted(map(str, merge_day(df.limit(0), path, keys, 4).collect())) == want


def test_newest_snapshot_prunes_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "snap")
    days = spark.range(30).select("id", F.concat(F.lit("2026-06-1"), (F.col("id") % 3).cast("string")).alias("fecha"))
    days.write.partitionBy("fecha").parquet(path)
    df = latest_snapshot(spark.read.parquet(path), "fecha")
    assert df.count() == 10 and {str(r.fecha) for r in df.collect()} == {"2026-06-12"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = [x for x in plan.split("PartitionFilters: ")[1:]]
    assert any("fecha" in x[:200] and "ubquery" in x[:200] for x in filters), plan


LONG = "<li class='product'><h2 class='t'>Memoria RAM</h2><span class='price'>1</span><a href='/p'></a></li>"


@pytest.mark.parametrize("whitelist", [False, True])
def test_time_of_a_page_follows_its_length(spark, whitelist):
    import time
    t0 = time.perf_counter()
    assert pg.page_offers(frame(spark, [("T", None, None, "RAM", "k", "https://t.example/", LONG * 12_000, None)]), whitelist=whitelist).count() == 12_000
    assert time.perf_counter() - t0 < 15


def test_probe_counts_tags_once_for_all_candidates(spark):
    import time
    t0 = time.perf_counter()
    # a closing tag's attribute is no tag of its own
    pages = spark.range(0, 40, 1, 1).select(F.lit("https://t.example/").alias("url"), F.concat(F.lit("</a t='<li class=\"product\">'>"), F.repeat(F.lit(LONG[:-5] + "</x>"), 10_000)).alias("html"))
    got = {(r.tipo, r.selector): r.paginas for r in pg.selector_probe(pages, names=["h4", "h3.title", "h2.t"]).collect()}
    assert got == {("contenedor", "li.product"): 40, ("nombre", "h2.t"): 40, ("precio", "span.price"): 40}
    assert time.perf_counter() - t0 < 10


def test_probe_looks_up_tags_of_many_addresses_once(spark):
    # every link is another text; what is judged is its name and its classes
    tags = pg.OpeningTags([[{"etiqueta": t, "clase": k} for t, k in pg.parse_selector(c)] for c in ("li.product", "a", ".price", "bdi")])
    find = tags.pattern().findall
    page = "".join(f'<li class="product n"><a class="x" href="/p/{i}">t</a><b>x</b><SPAN title="a > b" class=price>1</span><BDI></bdi></li>' for i in range(500))
    assert [tags[t] for t in find(page) if tags[t]] == [1, 2, 4, 8] * 500
    assert len(tags) < 10
    odd = "5 < 4 <!DOCTYPE html><li class=\"product\" x=\"<a>\"></a t='<li class=\"product\">'><li class=\"product\" '<A><li\u00a0class=\"product\"><li class=\"a\" class=\"product\">"
    assert [tags[t] for t in find(odd) if tags[t]] == [1, 2]


def test_pages_are_dealt_before_their_items_are_listed(spark):
    from offerlake.sources.derived import storefront_pages
    rows = [(k1, k2, "E", "CPU", f"t{k2 % 2}", "1", None, "2026-06-30") for k1 in (1, 0, 5) for k2 in (2, 1, 1)]
    pages = storefront_pages(spark.createDataFrame(rows, "k1 long, k2 int, pais string, categoria string, producto string, precio_raw string, url_producto string, fecha_extraccion string"))
    plan = pages._jdf.queryExecution().executedPlan().toString()
    # no list is serialized for a shuffle
    assert plan.index("partial_collect_list") < plan.index("Exchange") and plan.count("Exchange") == 1
    assert {r.pagina: [x[:2] for x in r.html.split("<b>")[1:]] for r in pages.collect()} == {"0-CPU": ["t1", "t1", "t0"] * 2, "1-CPU": ["t1", "t1", "t0"]}
