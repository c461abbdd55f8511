from pyspark.sql import functions as F

from offerlake import rules
from offerlake.operators.crawl import (crawl_seeds, extract_items, item_policy, page_cap,
                                       store_filter, whitelist_filter)
from offerlake.operators.warehouse import (calendar, check_rules, fk_violations, product_dim, store_dim,
                                           unique_violations, with_dense_id)


def _stores(spark):
    names = ["Uno", "Dos", "Tres", "Cuatro", "Cinco", "Seis"]
    return spark.createDataFrame([(n, f"https://{n.lower()}.example/buscar?q={{kw}}&tipo=p") for n in names], "tienda string, url_busqueda string")


def test_seeds_and_store_filter(spark):
    seeds = crawl_seeds(_stores(spark))
    assert seeds.count() == 6 * 8
    one = crawl_seeds(store_filter(_stores(spark), "uno")).collect()
    assert len(one) == 8
    urls = {r.keyword: r.url for r in one}
    assert urls["tarjeta de video"] == "https://uno.example/buscar?q=tarjeta+de+video&tipo=p"


def test_items_and_policy(spark):
    html = ('<ul><li><a href="/a"> Ryzen 5 </a></li><li><a href="/b"></a></li>'
            '<li><a href="">Mouse X</a></li></ul>')
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    items = item_policy(extract_items(pages)).orderBy("pos").collect()
    assert [(r.pos, r.nombre, r.url_producto, r.precio_raw) for r in items] == [(1, "Ryzen 5", "/a", ""), (3, "Mouse X", "", "")]


def test_whitelist(spark):
    df = spark.createDataFrame([("Procesador Ryzen", "CPU"), ("Funda", "CPU"), ("Mouse gamer", "Periferico"),
                                ("Mouse", "Juguetes"), ("Monitor 24", " monitor ")], "producto string, categoria string")
    assert sorted(r.producto for r in whitelist_filter(df).collect()) == ["Monitor 24", "Mouse gamer", "Procesador Ryzen"]


def test_page_cap_stop_rule(spark):
    rows = [("a", 1, 0), ("a", 2, 4), ("a", 3, 4), ("a", 4, 4),   # empty first page does not stop; cap at 3
            ("b", 1, 5), ("b", 2, 0), ("b", 3, 5),                 # empty page 2 stops (visited, yields nothing)
            ("c", 7, 2)]
    df = spark.createDataFrame(rows, "s string, page int, items int")
    out = page_cap(df, ["s"], "page", "items", 3).collect()
    got = sorted((r.s, r.page) for r in out if r.visitada)
    assert got == [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 2), ("c", 7)]
    assert sorted((r.s, r.page, r.rank, r.motivo) for r in out if not r.visitada) == [
        ("a", 4, None, "tope de paginas"), ("b", 3, None, "pagina vacia")]


def test_dense_ids_match_rank(spark):
    keys = [f"k{i:04d}" for i in range(500)]
    df = spark.createDataFrame([(k,) for k in reversed(keys)], "k string").repartition(7)
    got = {r.k: r.id for r in with_dense_id(df, ["k"], "id").collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(keys))}


def test_calendar(spark):
    df = spark.createDataFrame([("2024-12-30",), ("2025-01-02",)], "d string")
    cal = {r.fecha: r for r in calendar(df, "d").collect()}
    assert sorted(cal) == ["2024-12-30", "2024-12-31", "2025-01-01", "2025-01-02"]
    r = cal["2025-01-01"]
    assert (r.id_tiempo, r.semana_iso, r.mes, r.trimestre, r.anio, r.nombre_dia) == (20250101, 1, 1, 1, 2025, "Wednesday")


def test_dims_constraints_and_fk(spark):
    staged = spark.createDataFrame(
        [("Tienda1", "Ecuador", "CPU", "ryzen 5 5600x", 100.0, "Procesador AMD Ryzen 5 5600X"),
         ("Tienda2", "Ecuador", "CPU", "ryzen 5 5600x", 90.0, "AMD Ryzen 5 5600X caja"),
         ("Tienda2", "Ecuador", "Periferico", "sin_clasificar", 9.0, "Mouse Logitech G203")],
        "tienda string, pais string, categoria string, clave_canonica string, precio_usd double, producto string")
    prod = {r.clave_canonica: r for r in product_dim(staged).collect()}
    assert prod["ryzen 5 5600x"].marca == "AMD" and prod["ryzen 5 5600x"].modelo_raw == "AMD Ryzen 5 5600X caja"
    assert prod["sin_clasificar"].marca == "Logitech" and prod["sin_clasificar"].categoria == "PERIFERICO"
    tiendas = store_dim(staged.select(F.col("tienda").alias("nombre_tienda"), "pais"))
    assert tiendas.count() == 6 + 2
    assert unique_violations(tiendas, "dim_tienda", "nombre_tienda").first().duplicados == 0
    bad = spark.createDataFrame([(0,), (13,), (5,)], "mes int")
    assert check_rules([("t", "mes", bad, F.col("mes").between(1, 12))]).first().violaciones == 2
    fact = spark.createDataFrame([(1,), (2,), (99,)], "id_producto long")
    dim = spark.createDataFrame([(1,), (2,)], "id_producto long")
    assert fk_violations(fact, "id_producto", dim, "id_producto", "fk").first().huerfanos == 1


def test_selector_extraction_storefront(spark):
    from offerlake.operators.crawl import select_items
    html = ('<ul class="products"><li class="product"><a href="/p/1"><h2 class="woocommerce-loop-product__title">'
            ' Procesador AMD Ryzen 5 &amp; cooler </h2></a><span class="price"><del>$440,00</del>\n<ins>$425,00</ins>'
            '</span></li><li class="product"><a href="/p/2"><h3 class="wd-entities-title">RTX 4060</h3></a></li>'
            '<li class="product"><span class="price">$1</span></li></ul>')
    c, n, p, u = "li.product", "h2.woocommerce-loop-product__title, h3.wd-entities-title", "span.price", "a"
    pages = spark.createDataFrame([(1, "https://shop.example/?s=procesador", html, c, n, p, u)],
                                  "page_id long, url string, html string, contenedor string, sel_nombre string, "
                                  "sel_precio string, sel_url string")
    items = item_policy(select_items(pages)).orderBy("pos").collect()
    assert [(r.pos, r.nombre, r.precio_raw, r.url_producto) for r in items] == [
        (1, "Procesador AMD Ryzen 5 & cooler", "$440,00\n$425,00", "https://shop.example/p/1"),
        (2, "RTX 4060", "", "https://shop.example/p/2")]


def test_selector_probe(spark):
    from offerlake.operators.crawl import probe_pages, probe_summary
    woo = ('<div><li class="product"><h2 class="woocommerce-loop-product__title">A</h2>'
           '<span class="price"><ins><span class="amount">$5</span></ins></span></li>'
           '<li class="product"><h3 class="product-title">B</h3><span class="price">$6</span></li></div>')
    grid = '<div class="product-grid-item"><h3 class="wd-entities-title">C</h3></div><div class="product-grid-item"></div>'
    pages = spark.createDataFrame([("https://a.example/x", woo), ("https://a.example/y", woo),
                                   ("https://b.example/x", grid), ("https://c.example/x", "<p>nothing</p>")],
                                  "url string, html string")
    per_page = {(r.sitio, r.contenedor, r.items, r.sel_nombre, r.sel_precio, r.con_nombre)
                for r in probe_pages(pages).collect()}
    assert ("a.example", "li.product", 2, "h2.woocommerce-loop-product__title", "span.price", 2) in per_page
    assert ("b.example", "div.product-grid-item", 2, "h3.wd-entities-title", None, 1) in per_page
    assert ("c.example", None, 0, None, None, 0) in per_page
    s = {r.sitio: r for r in probe_summary(probe_pages(pages)).collect()}
    assert (s["a.example"].paginas, s["a.example"].con_contenedor, s["a.example"].items_con_nombre) == (2, 2, 4)


def test_store_seen_with_two_countries_has_one_row(spark):
    from offerlake.operators.warehouse import store_dim

    seen = spark.createDataFrame([("Zeta Shop", "PE"), ("Zeta Shop", "BO"), (None, "PE")], "nombre_tienda string, pais string")
    rows = [r for r in store_dim(seen).collect() if r.nombre_tienda not in [x[0] for x in rules.STORE_SEEDS]]
    assert [(r.nombre_tienda, r.pais) for r in rows] == [("Zeta Shop", "BO")]


def test_every_fact_reaches_the_rollup(spark):
    from conftest import SF_SMOKE
    from offerlake.plans.registry import QUERIES

    assert all(r.huerfanos == 0 for r in QUERIES["fk_violations"](spark, SF_SMOKE).collect())
    total = sum(r.ofertas for r in QUERIES["star_rollup"](spark, SF_SMOKE).collect())
    facts = QUERIES["fact_precios"](spark, SF_SMOKE)
    assert total == facts.count() == facts.select("id_hecho").distinct().count()


def test_rules_of_a_table_are_one_aggregate(spark):
    a = spark.createDataFrame([(1, None), (13, 0), (None, 5)], "mes int, x int")
    b = spark.createDataFrame([(0,)], "x int")
    got = check_rules([("a", "mes", a, F.col("mes").between(1, 12)), ("b", "x", b, F.col("x") > 0), ("a", "x", a, F.col("x") > 0), ("a", "todo", a, F.lit(True))])
    assert {(r.tabla, r.regla): r.violaciones for r in got.collect()} == {("a", "mes"): 2, ("a", "x"): 2, ("a", "todo"): 0, ("b", "x"): 1}
    assert got._jdf.queryExecution().analyzed().toString().count("Aggregate [") == 2
    assert check_rules([("a", "x", a.where("false"), F.col("x") > 0)]).first().violaciones == 0
