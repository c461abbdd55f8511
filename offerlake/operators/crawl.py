"""Crawl steps re-aimed as jobs over stored tables (C1-C9): seeds, item extraction from stored pages, whitelist,
page cap with stop rule, failed fetches, run summary and selector coverage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerlake import rules
from offerlake.functions.text import clean_log_text

ITEM_PATTERN = r'<li><a href="([^"]*)">([^<]*)</a></li>'


def crawl_seeds(stores: DataFrame, keywords: Mapping[str, Sequence[str]] = rules.SEARCH_KEYWORDS,
                template: str = "url_busqueda") -> DataFrame:
    """Every store x (category, keyword) with its search URL (spaces in the keyword become ``+``).

    The keyword rules are a literal array exploded per store row (a narrow fan-out, no join).
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("categoria"), F.lit(k).alias("keyword"))
                      for c, ks in keywords.items() for k in ks])
    j = stores.select("*", F.inline(pairs))
    url = F.replace(F.col(template), F.lit("{kw}"), F.replace(F.col("keyword"), F.lit(" "), F.lit("+")))
    return j.withColumn("url", url).drop(template)


def store_filter(stores: DataFrame, name: str | None, col: str = "tienda") -> DataFrame:
    """Restrict to one store by case-insensitive name (no filter when ``name`` is None)."""
    return stores if name is None else stores.filter(F.lower(F.col(col)) == name.lower())


def extract_items(pages: DataFrame, pattern: str = ITEM_PATTERN, keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """Item blocks of stored pages -> one row per item ``(pos, url_producto, nombre)``, fields trimmed."""
    urls = F.regexp_extract_all(F.col("html"), F.lit(pattern), 1)
    names = F.regexp_extract_all(F.col("html"), F.lit(pattern), 2)
    z = pages.select(*keep, F.arrays_zip(urls.alias("u"), names.alias("n")).alias("items"))
    e = z.select(*keep, F.posexplode("items").alias("pos", "it"))
    return e.select(*keep, (F.col("pos") + 1).alias("pos"), F.trim(F.col("it.u")).alias("url_producto"),
                    F.trim(F.col("it.n")).alias("nombre"))


def item_policy(items: DataFrame) -> DataFrame:
    """No name -> drop the item; missing price or URL -> empty text."""
    out = items.filter(F.col("nombre").isNotNull() & (F.col("nombre") != ""))
    fill = {c: F.coalesce(F.col(c), F.lit("")) for c in ("precio_raw", "url_producto") if c in out.columns}
    if "precio_raw" not in out.columns:
        fill["precio_raw"] = F.lit("")
    return out.withColumns(fill)


def whitelist_match(title: Column, category: Column,
                    whitelist: Mapping[str, Sequence[str]] = rules.CATEGORY_WHITELIST) -> Column:
    """True when the lower-cased title contains a keyword of its category; unknown category -> False."""
    m = F.create_map(*[x for c, kws in whitelist.items()
                       for x in (F.lit(c.upper()), F.array(*[F.lit(k) for k in kws]))])
    kws = F.try_element_at(m, F.upper(F.trim(category)))
    low = F.lower(title)
    return F.coalesce(F.exists(kws, lambda k: F.contains(low, k)), F.lit(False))


def whitelist_filter(df: DataFrame, title: str = "producto", category: str = "categoria") -> DataFrame:
    return df.filter(whitelist_match(F.col(title), F.col(category)))


def page_cap(pages: DataFrame, search: Sequence[str], page: str, items: str, max_pages: int) -> DataFrame:
    """Every page with ``rank`` (1 to ``max_pages``, else null), ``visitada`` and ``motivo``.

    Pages of a search are visited in page order, ``max_pages`` at most, up to the first empty page after page 1: that one is
    visited, no later page is. Unvisited pages carry the reason, ``pagina vacia``, ``tope de paginas`` or, without a page number,
    ``sin numero de pagina``. A page number is taken to be unique in its search. The first pages come from a rank filter, which cuts a search to ``max_pages`` rows in
    every task before the shuffle; their array (bounded by ``max_pages``) is joined back to the pages.
    """
    order = Window.partitionBy(*search).orderBy(page)
    first = pages.select(*search, page, items).where(F.col(page).isNotNull()).withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= max_pages)
    plan = first.groupBy(*search).agg(
        F.min(F.when((F.col(items) == 0) & (F.col("_r") > 1), F.col("_r"))).alias("_stop"),
        F.array_sort(F.collect_list(page)).alias("_pages"))
    key = {c: f"_k{i}" for i, c in enumerate(search)}
    plan = plan.withColumnsRenamed(key)
    on = [F.col(c).eqNullSafe(F.col(k)) for c, k in key.items()]
    pos = F.array_position("_pages", F.col(page)).cast("int")
    found = pages.join(plan, on, "left").drop(*key.values()).withColumn("rank", F.when(pos > 0, pos))
    beyond = F.coalesce(F.element_at("_pages", F.col("_stop")) < F.col(page), F.lit(False))
    reason = (F.when(F.col(page).isNull(), F.lit("sin numero de pagina")).when(beyond, F.lit("pagina vacia"))
              .when(F.col("rank").isNull(), F.lit("tope de paginas")))
    return (found.withColumn("motivo", reason).withColumn("visitada", F.col("motivo").isNull())
            .withColumn("rank", F.when(F.col("visitada"), F.col("rank"))).drop("_stop", "_pages"))


def search_visits(pages: DataFrame, seeds: DataFrame, max_pages: int, keyword_key: str = "s", page_key: str = "paged") -> DataFrame:
    """Stored result pages (``page_id, url, items``) by the search that they belong to: ``tienda, categoria, keyword, numero`` and
    ``page_cap``'s columns per (store, category, keyword).

    Host and keyword of the page's address are matched with those of the seeds' addresses, the page number is a parameter. A page of
    no seed is kept, unvisited, as ``busqueda desconocida``. Seeds are stores times keywords; Spark sizes the join.
    """
    def parameter(key: str) -> Column:
        return F.try_parse_url("url", F.lit("QUERY"), F.lit(key))

    host = F.lower(host_of(F.col("url")))  # a URL parser knows no host with an underscore
    here = pages.select("page_id", host.alias("_host"), parameter(keyword_key).alias("_kw"), parameter(page_key).try_cast("int").alias("numero"), "items")
    mine = seeds.select("tienda", "categoria", "keyword", host.alias("_host"), parameter(keyword_key).alias("_kw"))
    capped = page_cap(here.join(mine, ["_host", "_kw"], "left").drop("_host", "_kw"), ["tienda", "categoria", "keyword"], "numero", "items", max_pages)
    known = F.col("tienda").isNotNull()
    return capped.select("page_id", "tienda", "categoria", "keyword", "numero", "items", F.when(known, F.col("rank")).alias("rank"),
                         (known & F.col("visitada")).alias("visitada"), F.when(known, F.col("motivo")).otherwise(F.lit("busqueda desconocida")).alias("motivo"))


def fetch_status(events: DataFrame) -> DataFrame:
    """A fetch log from the event table: an ``error`` event is a failed fetch (HTTP 500), others succeed (200)."""
    return events.withColumn("status", F.when(F.col("event_type") == "error", 500).otherwise(200))


def fetch_errors(fetches: DataFrame) -> DataFrame:
    """Failed fetches (status >= 400) in the error-log schema; description cleaned and capped to 300 chars, and whole as
    ``detalle``."""
    bad = fetches.filter(F.col("status") >= 400)
    desc = F.concat(F.lit("Codigo "), F.col("status").cast("string"), F.lit(" en busqueda "),
                    F.col("event_id").cast("string"), F.lit("\n props="), F.col("props"), F.lit("\n"))
    return bad.select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.concat(F.lit("tienda_"), F.col("user_id").cast("string")).alias("fuente"),
        F.lit("HTTP").alias("tipo_error"),
        clean_log_text(desc, rules.ERROR_LOG_MAX_CHARS).alias("descripcion"),
        F.lit("Consulta sin datos; siguen las demas").alias("accion_tomada"),
        desc.alias("detalle"),
    )


def run_summary(stores: DataFrame, fetches: DataFrame, store: str, run: Column, found: Column) -> DataFrame:
    """Per store of the list and run: ``OK`` when items were found, ``ERROR: n fallos`` when only failures, else ``SIN DATOS``.

    ``stores`` has column ``tienda``. A store without any fetch has one row without a run; fetches of a store that is not on
    the list are kept."""
    g = fetches.groupBy(F.col(store).alias("tienda"), run.alias("corrida")).agg(
        F.count_if(found).alias("items"), F.count_if(F.col("status") >= 400).alias("fallos"))
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("items", "fallos")}
    g = stores.select("tienda").distinct().join(g, "tienda", "full").withColumns(zero)
    estado = (F.when(F.col("items") > 0, F.lit("OK"))
              .when(F.col("fallos") > 0, F.concat(F.lit("ERROR: "), F.col("fallos").cast("string"), F.lit(" fallos")))
              .otherwise(F.lit("SIN DATOS")))
    return g.withColumn("estado", estado)


def host_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^https?://([^/?#]+)", 1)


def selector_coverage(pages: DataFrame) -> DataFrame:
    """Per site: pages, pages whose item container repeats (>= 2 items), named items (all, and among the first three of each
    page), and which name selector hit first (``title`` before ``h1``)."""
    names = F.regexp_extract_all(F.col("html"), F.lit(ITEM_PATTERN), 2)
    title = F.trim(F.regexp_extract(F.col("html"), r"<title>([^<]*)</title>", 1))
    h1 = F.trim(F.regexp_extract(F.col("html"), r"<h1>([^<]*)</h1>", 1))
    p = pages.select(host_of(F.col("url")).alias("sitio"), names.alias("items"), title.alias("t"), h1.alias("h"))
    return p.groupBy("sitio").agg(
        F.count(F.lit(1)).alias("paginas"),
        F.count_if(F.size("items") >= 2).alias("con_contenedor"),
        F.sum(F.size(F.filter("items", lambda x: F.trim(x) != ""))).cast("bigint").alias("items_con_nombre"),
        F.sum(F.size(F.filter(F.slice("items", 1, 3), lambda x: F.trim(x) != ""))).cast("bigint").alias("items_muestra"),
        F.count_if(F.col("t") != "").alias("nombre_por_title"),
        F.count_if((F.col("t") == "") & (F.col("h") != "")).alias("nombre_por_h1"),
    )


SELECTED_ITEM_SCHEMA = "page_id long, pos int, nombre string, precio_raw string, url_producto string"


def select_items(pages: DataFrame, resolve: bool = True) -> DataFrame:
    """General selector extraction over stored pages: ``pages`` has ``page_id, url, html`` and the store's selectors
    ``contenedor, sel_nombre, sel_precio, sel_url``. Each page is parsed once inside ``mapInPandas`` (Arrow batches,
    pages spread over tasks); the item rows come back as a DataFrame for the policy and whitelist steps."""
    from offerlake.functions.html_select import extract_items as extract

    def per_batch(batches):
        import pandas as pd
        for b in batches:
            rows = []
            for pid, url, html, cont, sn, sp, su in zip(b["page_id"], b["url"], b["html"], b["contenedor"],
                                                        b["sel_nombre"], b["sel_precio"], b["sel_url"]):
                for pos, name, price, href in extract(html, url, cont, sn, sp, su, resolve):
                    rows.append((pid, pos, name, price, href))
            yield pd.DataFrame(rows, columns=["page_id", "pos", "nombre", "precio_raw", "url_producto"])

    cols = ["page_id", "url", "html", "contenedor", "sel_nombre", "sel_precio", "sel_url"]
    return pages.select(*cols).mapInPandas(per_batch, SELECTED_ITEM_SCHEMA)


PROBE_SCHEMA = "sitio string, contenedor string, items int, sel_nombre string, sel_precio string, con_nombre int"


def probe_pages(pages: DataFrame, containers: Sequence[str] = rules.PROBE_CONTAINERS,
                names: Sequence[str] = rules.PROBE_NAME_SELECTORS,
                prices: Sequence[str] = rules.PROBE_PRICE_SELECTORS) -> DataFrame:
    """Per page: which candidate container/name/price selectors work (parsed HTML, ``mapInPandas``)."""
    from offerlake.functions.html_select import probe

    cont, nm, pr = list(containers), list(names), list(prices)

    def per_batch(batches):
        import pandas as pd
        for b in batches:
            rows = [(site, *probe(html, cont, nm, pr)) for site, html in zip(b["sitio"], b["html"])]
            yield pd.DataFrame(rows, columns=["sitio", "contenedor", "items", "sel_nombre", "sel_precio", "con_nombre"])

    return pages.select(host_of(F.col("url")).alias("sitio"), "html").mapInPandas(per_batch, PROBE_SCHEMA)


def probe_summary(probed: DataFrame) -> DataFrame:
    """Per site: pages probed, pages with a repeated container, and the selectors that hit most often."""
    return probed.groupBy("sitio").agg(
        F.count(F.lit(1)).alias("paginas"),
        F.count_if(F.col("contenedor").isNotNull()).alias("con_contenedor"),
        F.sum("con_nombre").cast("bigint").alias("items_con_nombre"),
        F.mode("contenedor").alias("contenedor"),
        F.mode("sel_nombre").alias("sel_nombre"),
        F.mode("sel_precio").alias("sel_precio"),
    )
