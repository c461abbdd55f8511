"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Each Spark builder takes ``(spark, data_dir)`` and returns a lazy DataFrame over the whole tables. Oracle statements
run on the same parquet tables registered as views; column names and types match the Spark result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake import rules
from offerlake.operators import compare as cmp_ops
from offerlake.operators import quality
from offerlake.operators.normalize import invalid_categories
from offerlake.operators.warehouse import NOT_NULL
from offerlake.operators.staging import convert_currencies, invalid_date_flag
from offerlake.plans import offers as chain
from offerlake.plans import oracle as o
from offerlake.sources.derived import SEGMENT_COMPONENT
from offerlake.sources.tables import Tables

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, data_dir: fn(Tables(spark, data_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


STD = o.with_ctes(o.OFFERS, o.standardized_cte())
PRICED = o.with_ctes(o.OFFERS, o.standardized_cte(), o.priced_cte())
KEYED = o.with_ctes(o.OFFERS, o.standardized_cte(), o.priced_cte(), o.keyed_cte())
STAGED = o.staged_chain("offers")
STAGED_DUP = o.staged_chain("offers_dup")


# ---------------------------------------------------------------- flagship: which store is cheapest ----------------
@register("price_compare", STAGED[:-1] + ",\n" + o.comparison_select() + "\nSELECT * FROM best")
def price_compare(t: Tables) -> DataFrame:
    return cmp_ops.order_by_saving(chain.comparison(t))


@register("price_compare_top10", STAGED[:-1] + ",\n" + o.comparison_select() + """
SELECT clave_canonica, tienda_mas_barata, precio_min_usd, precio_max_usd, ahorro_usd, ahorro_pct
FROM best ORDER BY ahorro_usd DESC, clave_canonica LIMIT 10""")
def price_compare_top10(t: Tables) -> DataFrame:
    return cmp_ops.top_savings(chain.comparison(t), 10)


# ---------------------------------------------------------------- standardisation and relevance -------------------
@register("standardize_text", STD + "SELECT k1, k2, tienda, categoria, producto, precio_raw FROM std")
def standardize_text(t: Tables) -> DataFrame:
    return chain.standardized(chain.offer_view(t)).select("k1", "k2", "tienda", "categoria", "producto", "precio_raw")


@register("invalid_categories", o.with_ctes(o.OFFERS) + f"""
SELECT DISTINCT categoria FROM offers
WHERE categoria IS NULL OR categoria NOT IN ({", ".join(o.q(c) for c in rules.VALID_CATEGORIES)})""")
def invalid_categories_q(t: Tables) -> DataFrame:
    # Audit of the landed (unstandardised) categories: which would fail the master list without standardisation.
    return invalid_categories(chain.offer_view(t))


_MIXED_CATEGORIES = """mezcla AS (
SELECT CASE WHEN p_partkey % 40 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN '  otros  ' || p_type || chr(9) WHEN p_partkey % 5 = 1 THEN ' gpu '
  WHEN p_partkey % 5 = 2 THEN 'Monitor' ELSE p_type END AS categoria FROM part)"""


@register("nonstandard_categories", "WITH " + _MIXED_CATEGORIES + f"""
SELECT DISTINCT upper({o.collapse('categoria')}) AS categoria FROM mezcla
WHERE categoria IS NULL OR upper({o.collapse('categoria')}) NOT IN ({", ".join(o.q(c) for c in rules.VALID_CATEGORIES)}) ORDER BY categoria NULLS FIRST""")
def nonstandard_categories(t: Tables) -> DataFrame:
    # After standardisation, sorted: the part types stand for categories that stores make up beside good ones and missing ones.
    from offerlake.operators.normalize import invalid_category_list, standardize
    k = F.col("p_partkey")
    mixed = (F.when(k % 40 == 0, F.lit(None).cast("string")).when(k % 5 == 0, F.concat(F.lit("  otros  "), "p_type", F.lit("\t")))
             .when(k % 5 == 1, F.lit(" gpu ")).when(k % 5 == 2, F.lit("Monitor")).otherwise(F.col("p_type")))
    return invalid_category_list(standardize(t.part.select(mixed.alias("categoria"))))


@register("category_audit", o.with_ctes(o.OFFERS) + f"""
SELECT categoria AS categoria_raw, upper({o.collapse('categoria')}) AS categoria_std,
  upper({o.collapse('categoria')}) IN ({", ".join(o.q(c) for c in rules.VALID_CATEGORIES)}) AS estandar,
  count(*) AS filas
FROM offers GROUP BY ALL""")
def category_audit(t: Tables) -> DataFrame:
    return quality.category_audit(chain.offer_view(t))


@register("relevance_filter", STD + "SELECT k1, k2, producto FROM std WHERE NOT is_bundle")
def relevance_filter(t: Tables) -> DataFrame:
    from offerlake.operators.staging import relevance_filter as rf
    return rf(chain.standardized(chain.offer_view(t))).select("k1", "k2", "producto")


@register("relevance_waterfall", PRICED.replace("WHERE NOT is_bundle", "") + """
SELECT count(*) AS total_raw, count(*) FILTER (WHERE is_bundle) AS bundles,
  count(*) FILTER (WHERE NOT is_bundle AND (precio_usd IS NULL OR precio_usd <= 0)) AS sin_precio,
  count(*) FILTER (WHERE NOT is_bundle AND precio_usd > 0) AS con_precio
FROM priced""")
def relevance_waterfall(t: Tables) -> DataFrame:
    return quality.relevance_waterfall(chain.standardized(chain.offer_view(t)))


# ---------------------------------------------------------------- casting -------------------------------------------
@register("price_cast", PRICED + "SELECT k1, k2, precio_raw, precio_usd FROM priced")
def price_cast(t: Tables) -> DataFrame:
    return chain.priced(chain.offer_view(t)).select("k1", "k2", "precio_raw", "precio_usd")


@register("cast_failures", PRICED + "SELECT count(*) FILTER (WHERE precio_usd IS NULL) AS no_parseables FROM priced")
def cast_failures(t: Tables) -> DataFrame:
    return quality.cast_failures(chain.priced(chain.offer_view(t)))


@register("cast_examples", PRICED + """
SELECT k1, k2, precio_raw, precio_usd,
  '''' || trim(substring(precio_raw, 1, 30)) || ''' -> ' || CAST(precio_usd AS VARCHAR) AS ejemplo
FROM priced WHERE precio_usd IS NOT NULL
ORDER BY k1, k2, precio_raw, tienda, producto LIMIT 8""")
def cast_examples(t: Tables) -> DataFrame:
    return quality.cast_examples(chain.priced(chain.offer_view(t)), ["k1", "k2", "precio_raw", "tienda", "producto"],
                                 keep=["k1", "k2"])


# ---------------------------------------------------------------- canonical key -------------------------------------
@register("canonical_key", KEYED + "SELECT k1, k2, categoria, producto, clave_canonica FROM keyed")
def canonical_key(t: Tables) -> DataFrame:
    return chain.staged_before_dedup(chain.offer_view(t)).select("k1", "k2", "categoria", "producto", "clave_canonica")


@register("key_coverage", STAGED + f"""
SELECT round_even((1 - avg(CAST(clave_canonica = {o.q(rules.UNCLASSIFIED)} AS INTEGER))) * 100, 2)
  AS cobertura_clave_canonica_pct, count(DISTINCT clave_canonica) FILTER (WHERE clave_canonica <> {o.q(rules.UNCLASSIFIED)})
  AS claves_distintas
FROM deduped""")
def key_coverage(t: Tables) -> DataFrame:
    return quality.key_coverage(chain.staged(chain.offer_view(t)))


# ---------------------------------------------------------------- deduplication -------------------------------------
@register("dedup_offers", STAGED_DUP + "SELECT * FROM deduped")
def dedup_offers(t: Tables) -> DataFrame:
    return chain.staged(chain.offer_view_with_copies(t))


@register("dedup_metrics", STAGED_DUP + """
SELECT (SELECT count(*) FROM keyed) AS antes, (SELECT count(*) FROM deduped) AS despues,
  (SELECT count(*) FROM keyed) - (SELECT count(*) FROM deduped) AS duplicados_eliminados""")
def dedup_metrics(t: Tables) -> DataFrame:
    return quality.dedup_metrics(chain.keyed(chain.offer_view_with_copies(t)))


_ORDER_ROWS = """filas AS (
SELECT o_custkey, o_orderpriority, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS dia FROM orders)"""


@register("dedup_by_day", "WITH " + _ORDER_ROWS + """
SELECT o_custkey, o_orderpriority, o_orderstatus, o_totalprice, dia FROM (
SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY (o_orderstatus IS NOT NULL)::INT + (o_totalprice IS NOT NULL)::INT DESC,
  o_orderstatus NULLS FIRST, o_totalprice NULLS FIRST, dia) AS rn FROM filas) WHERE rn = 1""")
def dedup_by_day(t: Tables) -> DataFrame:
    # Orders as offers of a customer and priority, merged into the survivor table in three loads, the second one twice.
    import uuid

    from offerlake.operators.survivors import merge_day
    from offerlake.session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/vivas/{uuid.uuid4().hex}"
    k = F.col("o_orderkey")
    rows = t.orders.select("o_custkey", "o_orderpriority", F.when(k % 5 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
                           F.when(k % 3 != 0, F.col("o_totalprice")).alias("o_totalprice"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("dia"))
    for third in (2, 0, 0, 1):
        kept = merge_day(rows.where(F.month("dia") % 3 == third), path, ["o_custkey", "o_orderpriority"], 8)
    return kept


# ---------------------------------------------------------------- dates ---------------------------------------------
@register("date_standardize", STD + "SELECT k1, k2, fecha_extraccion, fecha_staging FROM std")
def date_standardize(t: Tables) -> DataFrame:
    return chain.standardized(chain.offer_view(t)).select("k1", "k2", "fecha_extraccion", "fecha_staging")


@register("date_invalid_count", o.with_ctes(o.OFFERS) + f"""
SELECT count(*) FILTER (WHERE {o.date_expr('fecha_extraccion')} IS NULL) AS fechas_invalidas FROM offers""")
def date_invalid_count(t: Tables) -> DataFrame:
    return chain.offer_view(t).agg(F.count_if(invalid_date_flag()).alias("fechas_invalidas"))


# ---------------------------------------------------------------- currency ------------------------------------------
@register("fx_fanout", f"SELECT o_orderkey, o_totalprice, {o.fx_select('o_totalprice')} FROM orders")
def fx_fanout(t: Tables) -> DataFrame:
    return convert_currencies(t.orders.select("o_orderkey", "o_totalprice"), rules.FALLBACK_RATES, usd="o_totalprice")


# ---------------------------------------------------------------- quality metrics -----------------------------------
@register("null_profile", PRICED + """
SELECT 'tienda' AS campo, round_even(avg(CAST(tienda IS NULL AS DOUBLE)) * 100, 2) AS pct_nulos FROM priced
UNION ALL SELECT 'categoria', round_even(avg(CAST(categoria IS NULL AS DOUBLE)) * 100, 2) FROM priced
UNION ALL SELECT 'producto', round_even(avg(CAST(producto IS NULL AS DOUBLE)) * 100, 2) FROM priced
UNION ALL SELECT 'precio_usd', round_even(avg(CAST(precio_usd IS NULL AS DOUBLE)) * 100, 2) FROM priced""")
def null_profile(t: Tables) -> DataFrame:
    # Measured after casting and before key extraction, so clave_canonica is not yet a column (it is skipped).
    return quality.null_profile(chain.priced(chain.offer_view(t)))


_FIELDS_OK = " AND ".join(f"{f} IS NOT NULL" for f in rules.KEY_FIELDS)


@register("quality_metrics", STAGED_DUP[:-1] + f""",
m AS (
SELECT (SELECT count(*) FROM offers_dup) AS raw_n, (SELECT count(*) FROM priced) AS rel_n,
  (SELECT count(*) FILTER (WHERE NOT coalesce(precio_usd > 0, false)) FROM priced) AS unpriced,
  (SELECT count(*) FROM keyed) AS before_n, (SELECT count(*) FROM deduped) AS stg_n,
  (SELECT count(*) FILTER (WHERE {_FIELDS_OK}) FROM deduped) AS complete_n
)
SELECT raw_n AS total_registros_raw, raw_n - rel_n AS registros_descartados_relevancia,
  unpriced AS registros_eliminados_nulos, before_n - stg_n AS registros_depurados_duplicados,
  stg_n AS total_registros_staging,
  CASE WHEN stg_n > 0 THEN round_even(complete_n / stg_n * 100, 2) ELSE 0.0 END AS tasa_completitud_general_pct,
  CASE WHEN raw_n > 0 THEN round_even((raw_n - stg_n) / raw_n * 100, 2) ELSE 0.0 END AS tasa_error_pct
FROM m""")
def quality_metrics(t: Tables) -> DataFrame:
    return quality.metrics_of_marked(quality.marked(chain.standardized(chain.offer_view_with_copies(t))))


@register("dist_store", STAGED + "SELECT tienda, count(*) AS registros FROM deduped WHERE tienda IS NOT NULL GROUP BY tienda")
def dist_store(t: Tables) -> DataFrame:
    return quality.distribution(chain.staged(chain.offer_view(t)), "tienda")


@register("dist_category",
          STAGED + "SELECT categoria, count(*) AS registros FROM deduped WHERE categoria IS NOT NULL GROUP BY categoria")
def dist_category(t: Tables) -> DataFrame:
    return quality.distribution(chain.staged(chain.offer_view(t)), "categoria")


# ---------------------------------------------------------------- currency (long form, history) ---------------------
_RATES_VALUES = ", ".join(f"({o.q(c)}, CAST({float(v)!r} AS DOUBLE))" for c, v in rules.FALLBACK_RATES.items())


@register("fx_long", f"""
SELECT o_orderkey, o_totalprice, r.moneda, r.tasa, round_even(o_totalprice * r.tasa, 2) AS precio
FROM orders CROSS JOIN (VALUES {_RATES_VALUES}) AS r(moneda, tasa)""")
def fx_long(t: Tables) -> DataFrame:
    from offerlake.operators.fx import convert_long
    return convert_long(t.orders.select("o_orderkey", "o_totalprice"), rules.FALLBACK_RATES, "o_totalprice")


_FX_DAYS = f"""days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
series AS (
SELECT strftime(d, '%Y-%m-%d') AS fecha, 'USD' AS base, r.moneda,
  round_even(r.tasa * (1 + (dayofyear(d) % 10) / 1000.0), 6) AS tasa
FROM days CROSS JOIN (VALUES {_RATES_VALUES}) AS r(moneda, tasa))
"""


@register("fx_series", "WITH " + _FX_DAYS + "SELECT * FROM series")
def fx_series(t: Tables) -> DataFrame:
    from offerlake.operators.fx import parse_history
    from offerlake.sources.derived import fx_documents_from_orders
    return parse_history(fx_documents_from_orders(t.orders))


@register("fx_series_window", "WITH " + _FX_DAYS + f""", fin AS (SELECT max(CAST(fecha AS DATE)) AS f FROM series)
SELECT count(DISTINCT fecha) AS fechas, count(*) AS registros, min(fecha) AS desde, max(fecha) AS hasta
FROM series, fin WHERE CAST(fecha AS DATE) >= f - INTERVAL {rules.FX_HISTORY_DAYS} DAY""")
def fx_series_window(t: Tables) -> DataFrame:
    from offerlake.operators.fx import history_window, parse_history
    from offerlake.sources.derived import fx_documents_from_orders
    w = history_window(parse_history(fx_documents_from_orders(t.orders)))
    return w.agg(F.countDistinct("fecha").alias("fechas"), F.count(F.lit(1)).alias("registros"),
                 F.min("fecha").alias("desde"), F.max("fecha").alias("hasta"))


# ---------------------------------------------------------------- survey --------------------------------------------
_SURVEY = """survey AS (
SELECT printf('ENC-%04d', c_custkey) AS id_anonimo,
  CASE WHEN c_custkey % 33 = 0 THEN NULL ELSE n_name END AS ciudad,
  c_mktsegment AS categoria_interes,
  CASE WHEN c_custkey % 97 = 0 OR c_acctbal < 0 THEN NULL ELSE c_acctbal END AS presupuesto_usd
FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


@register("survey_impute", "WITH " + _SURVEY + """,
med AS (SELECT categoria_interes, median(presupuesto_usd) AS m FROM survey GROUP BY categoria_interes)
SELECT id_anonimo, coalesce(ciudad, 'No especificada') AS ciudad, s.categoria_interes,
  coalesce(presupuesto_usd, m) AS presupuesto_usd
FROM survey s LEFT JOIN med ON s.categoria_interes = med.categoria_interes""")
def survey_impute(t: Tables) -> DataFrame:
    from offerlake.operators.survey import stage_survey
    from offerlake.sources.derived import survey_from_customers
    return stage_survey(survey_from_customers(t.customer, t.nation))


@register("survey_nulls", "WITH " + _SURVEY + """
SELECT count(*) AS registros, count(*) FILTER (WHERE presupuesto_usd IS NULL) AS presupuesto_imputado,
  count(*) FILTER (WHERE ciudad IS NULL) AS ciudad_imputada FROM survey""")
def survey_nulls(t: Tables) -> DataFrame:
    from offerlake.operators.survey import survey_nulls as sn
    from offerlake.sources.derived import survey_from_customers
    return sn(survey_from_customers(t.customer, t.nation))


@register("survey_ids", "WITH " + _SURVEY + "SELECT count(*) AS registros, count(DISTINCT id_anonimo) AS ids_unicos FROM survey")
def survey_ids(t: Tables) -> DataFrame:
    from offerlake.operators.survey import survey_ids as si
    from offerlake.sources.derived import survey_from_customers
    return si(survey_from_customers(t.customer, t.nation))


_COMPONENTS = _SURVEY + f""", demanda AS (
SELECT * REPLACE (CASE categoria_interes {' '.join(f"WHEN {o.q(k)} THEN {o.q(v)}" for k, v in SEGMENT_COMPONENT.items())}
  ELSE categoria_interes END AS categoria_interes) FROM survey)"""


# ---------------------------------------------------------------- spec file -----------------------------------------
_SPECS = """specs AS (
SELECT p_partkey,
  CASE WHEN p_partkey % 50 = 0 THEN NULL
       WHEN p_type = 'ECONOMY' THEN 'AMD Ryzen™ ' || CAST(3 + 2 * (p_partkey % 4) AS VARCHAR) || ' '
         || CAST(5000 + 100 * (p_partkey % 40) AS VARCHAR) || 'X'
       ELSE p_name END AS modelo,
  CAST(p_size AS VARCHAR) AS nucleos,
  CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE CAST(p_size * 2 AS VARCHAR) END AS hilos,
  CAST(p_size * 5 AS VARCHAR) || ' W' AS tdp,
  CAST(p_size % 5 + 2 AS VARCHAR) || '.' || CAST(p_partkey % 10 AS VARCHAR) || ' GHz' AS clock_base,
  p_brand AS socket
FROM part)"""
_SPECS_STAGED = _SPECS + """, specs_stg AS (
SELECT modelo, TRY_CAST(nucleos AS DOUBLE) AS nucleos, TRY_CAST(hilos AS DOUBLE) AS hilos, tdp, clock_base, socket, p_partkey
FROM (SELECT *, row_number() OVER (PARTITION BY modelo ORDER BY p_partkey) AS rn FROM specs WHERE modelo IS NOT NULL)
WHERE rn = 1)"""


@register("specs_project", "WITH " + _SPECS + " SELECT modelo, nucleos, hilos, tdp, clock_base, socket FROM specs")
def specs_project(t: Tables) -> DataFrame:
    from offerlake.operators.specs import project_specs
    from offerlake.sources.derived import spec_file_from_parts
    return project_specs(spec_file_from_parts(t.part))


@register("specs_dedup", "WITH " + _SPECS_STAGED + " SELECT modelo, nucleos, hilos, tdp, clock_base, socket FROM specs_stg")
def specs_dedup(t: Tables) -> DataFrame:
    from offerlake.operators.specs import stage_specs
    from offerlake.sources.derived import spec_file_from_parts
    return stage_specs(spec_file_from_parts(t.part), ["p_partkey"])


@register("schema_validate", """
SELECT 'cpu_specs' AS dataset, count(*) AS filas, 8 AS columnas, CAST([] AS VARCHAR[]) AS faltantes, 'VALIDO' AS estado
FROM part
UNION ALL
SELECT 'cpu_specs_sin_tdp', count(*), 7, ['Default TDP'], 'ESQUEMA INVALIDO' FROM part""")
def schema_validate(t: Tables) -> DataFrame:
    from offerlake.operators.specs import validate_schema
    from offerlake.sources.derived import spec_file_from_parts
    f = spec_file_from_parts(t.part)
    return validate_schema(f, "cpu_specs").unionByName(validate_schema(f.drop("Default TDP"), "cpu_specs_sin_tdp"))


# ---------------------------------------------------------------- homologation, snapshots, unions ------------------
@register("alias_homologate", """
SELECT s_suppkey, s_name AS tienda,
  coalesce(CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'Item ' || CAST(s_suppkey AS VARCHAR) END,
           'Producto ' || CAST(s_suppkey AS VARCHAR)) AS producto,
  CAST(s_acctbal AS VARCHAR) AS precio_raw, 'https://shop.example/s/' || CAST(s_suppkey AS VARCHAR) AS url_producto,
  '2026-06-30 10:00:00' AS fecha_extraccion, CAST(NULL AS VARCHAR) AS pais, CAST(NULL AS VARCHAR) AS moneda,
  CAST(NULL AS VARCHAR) AS categoria
FROM supplier""")
def alias_homologate(t: Tables) -> DataFrame:
    from offerlake.operators.normalize import normalize_columns
    from offerlake.sources.derived import alias_offers_from_suppliers
    return normalize_columns(alias_offers_from_suppliers(t.supplier))


@register("snapshot_latest", """
SELECT event_id, user_id, event_type, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS fecha FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""")
def snapshot_latest(t: Tables) -> DataFrame:
    from offerlake.sources.offers import latest_snapshot
    latest = latest_snapshot(t.events, F.to_date("ts"))
    return latest.select("event_id", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("fecha"))


@register("store_union", o.with_ctes(o.OFFERS) + """
SELECT k1, k2, tienda, producto, fecha_extraccion, CAST(NULL AS VARCHAR) AS url_producto FROM offers WHERE k1 % 2 = 0
UNION ALL
SELECT k1, k2, tienda, producto, CAST(NULL AS VARCHAR), url_producto FROM offers WHERE k1 % 2 = 1""")
def store_union(t: Tables) -> DataFrame:
    from offerlake.sources.offers import union_sources
    v = chain.offer_view(t)
    a = v.filter(F.col("k1") % 2 == 0).select("k1", "k2", "tienda", "producto", "fecha_extraccion")
    b = v.filter(F.col("k1") % 2 == 1).select("url_producto", "producto", "tienda", "k2", "k1")
    return union_sources([a, b])


def _whitelist_sql(title: str, category: str) -> str:
    whens = " ".join(
        f"WHEN {o.q(c.upper())} THEN ({' OR '.join(f'contains(lower({title}), {o.q(k)})' for k in kws)})"
        for c, kws in rules.CATEGORY_WHITELIST.items())
    return f"coalesce(CASE upper(trim({category})) {whens} ELSE false END, false)"


@register("whitelist_filter", o.with_ctes(o.OFFERS) +
          f"SELECT k1, k2, categoria, producto FROM offers WHERE {_whitelist_sql('producto', 'categoria')}")
def whitelist_filter(t: Tables) -> DataFrame:
    from offerlake.operators.crawl import whitelist_filter as wf
    return wf(chain.offer_view(t)).select("k1", "k2", "categoria", "producto")


# ---------------------------------------------------------------- crawl over stored pages and fetch logs ----------
_KW_VALUES = ", ".join(f"({o.q(c)}, {o.q(k)})" for c, ks in rules.SEARCH_KEYWORDS.items() for k in ks)
_SEEDS = f"""seeds AS (
SELECT n_name AS tienda, kw.categoria, kw.keyword,
  replace('https://' || lower(n_name) || '.example/?s={{kw}}&post_type=product', '{{kw}}', replace(kw.keyword, ' ', '+')) AS url
FROM nation CROSS JOIN (VALUES {_KW_VALUES}) AS kw(categoria, keyword))"""


def _store_dim(t: Tables) -> DataFrame:
    return t.nation.select(
        F.col("n_name").alias("tienda"),
        F.concat(F.lit("https://"), F.lower("n_name"), F.lit(".example/?s={kw}&post_type=product")).alias("url_busqueda"))


@register("crawl_seeds", "WITH " + _SEEDS + " SELECT * FROM seeds")
def crawl_seeds(t: Tables) -> DataFrame:
    from offerlake.operators.crawl import crawl_seeds as cs
    return cs(_store_dim(t))


@register("store_filter", "WITH " + _SEEDS + " SELECT * FROM seeds WHERE lower(tienda) = 'nation_7'")
def store_filter(t: Tables) -> DataFrame:
    from offerlake.operators.crawl import crawl_seeds as cs, store_filter as sf
    return cs(sf(_store_dim(t), "Nation_7"))


_ITEM_RE = o.q(r'<li><a href="([^"]*)">([^<]*)</a></li>')
_ITEMS = f"""items AS (
SELECT page_id, CAST(pos AS INTEGER) AS pos, trim(u) AS url_producto, trim(n) AS nombre FROM (
  SELECT page_id, unnest(regexp_extract_all(html, {_ITEM_RE}, 1)) AS u, unnest(regexp_extract_all(html, {_ITEM_RE}, 2)) AS n,
    unnest(range(1, len(regexp_extract_all(html, {_ITEM_RE}, 1)) + 1)) AS pos FROM pages))"""


@register("page_items", "WITH " + _ITEMS + " SELECT page_id, pos, url_producto, nombre, '' AS precio_raw FROM items "
          "WHERE nombre IS NOT NULL AND nombre <> ''")
def page_items(t: Tables) -> DataFrame:
    from offerlake.operators.crawl import extract_items, item_policy
    return item_policy(extract_items(t.pages))


@register("page_items_selectors", "WITH " + _ITEMS + " SELECT page_id, pos, url_producto, nombre, '' AS precio_raw FROM items "
          "WHERE nombre IS NOT NULL AND nombre <> ''")
def page_items_selectors(t: Tables) -> DataFrame:
    # General selector path (parsed HTML) over the same pages: containers ``li``, name and link ``a``.
    from offerlake.operators.crawl import item_policy, select_items
    pages = t.pages.withColumns({"contenedor": F.lit("li"), "sel_nombre": F.lit("a"), "sel_precio": F.lit("span.price"),
                                 "sel_url": F.lit("a")})
    return item_policy(select_items(pages, resolve=False)).select("page_id", "pos", "url_producto", "nombre", "precio_raw")


@register("page_items_whitelisted", "WITH " + _ITEMS + f""", cats AS (
SELECT page_id, [{', '.join(o.q(c) for c in rules.CATEGORY_WHITELIST)}][page_id % {len(rules.CATEGORY_WHITELIST)} + 1] AS categoria
FROM pages)
SELECT i.page_id, pos, nombre, categoria FROM items i JOIN cats c ON i.page_id = c.page_id
WHERE nombre <> '' AND {_whitelist_sql('nombre', 'categoria')}""")
def page_items_whitelisted(t: Tables) -> DataFrame:
    from offerlake.operators.crawl import extract_items, item_policy, whitelist_filter as wf
    cats = list(rules.CATEGORY_WHITELIST)
    pages = t.pages.withColumn("categoria", F.element_at(F.array(*[F.lit(c) for c in cats]),
                                                         (F.col("page_id") % len(cats) + 1).cast("int")))
    items = item_policy(extract_items(pages, keep=("page_id", "categoria")))
    return wf(items, title="nombre").select("page_id", "pos", "nombre", "categoria")


#: Pages that a search visits at most.
SEARCH_PAGES = 3


@register("page_cap", f"""WITH pg AS (
SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS sitio, regexp_extract(url, '^https?://[^/?#]+/([^/?#]*)', 1) AS seccion, page_id,
  CAST(len(regexp_extract_all(html, {_ITEM_RE}, 2)) AS INTEGER) AS items FROM pages), rk AS (
SELECT *, CAST(row_number() OVER (PARTITION BY sitio, seccion ORDER BY page_id) AS INTEGER) AS r FROM pg), st AS (
SELECT *, min(CASE WHEN items = 0 AND r > 1 AND r <= {SEARCH_PAGES} THEN r END) OVER (PARTITION BY sitio, seccion) AS s FROM rk)
SELECT sitio, seccion, page_id, items, CASE WHEN r <= least({SEARCH_PAGES}, coalesce(s, r)) THEN r END AS rank,
  r <= least({SEARCH_PAGES}, coalesce(s, r)) AS visitada,
  CASE WHEN r > s THEN 'pagina vacia' WHEN r > {SEARCH_PAGES} THEN 'tope de paginas' END AS motivo FROM st""")
def page_cap(t: Tables) -> DataFrame:
    from offerlake.operators.crawl import ITEM_PATTERN, host_of, page_cap as pc
    pages = t.pages.select(
        host_of(F.col("url")).alias("sitio"), F.regexp_extract("url", r"^https?://[^/?#]+/([^/?#]*)", 1).alias("seccion"), "page_id",
        F.size(F.regexp_extract_all(F.col("html"), F.lit(ITEM_PATTERN), 2)).alias("items"))
    return pc(pages, ["sitio", "seccion"], "page_id", "items", SEARCH_PAGES)


_KW_LIST = [k for ks in rules.SEARCH_KEYWORDS.values() for k in ks]


@register("search_visits", "WITH " + _SEEDS + f""", pg AS (
SELECT page_id, CASE WHEN page_id % 11 = 0 THEN 0 ELSE CAST(len(regexp_extract_all(html, {_ITEM_RE}, 2)) AS INTEGER) END AS items,
  CASE WHEN page_id % 13 <> 0 THEN CAST(page_id // {25 * len(_KW_LIST)} + 1 AS INTEGER) END AS numero,
  CASE WHEN page_id % 17 <> 0 THEN n_name END AS tienda,
  [{', '.join(o.q(k) for k in _KW_LIST)}][CAST((page_id // 25) % {len(_KW_LIST)} + 1 AS INTEGER)] AS kw
FROM pages JOIN nation ON n_nationkey = page_id % 25), j AS (
SELECT pg.page_id, s.tienda, s.categoria, s.keyword, pg.numero, pg.items FROM pg LEFT JOIN seeds s ON pg.tienda = s.tienda AND pg.kw = s.keyword), rk AS (
SELECT *, CASE WHEN numero IS NOT NULL THEN CAST(row_number() OVER (PARTITION BY tienda, categoria, keyword, numero IS NULL ORDER BY numero) AS INTEGER) END AS r FROM j), st AS (
SELECT *, min(CASE WHEN items = 0 AND r > 1 AND r <= {{SEARCH_PAGES}} THEN r END) OVER (PARTITION BY tienda, categoria, keyword) AS s FROM rk)
SELECT page_id, tienda, categoria, keyword, numero, items,
  CASE WHEN tienda IS NOT NULL AND r <= least({{SEARCH_PAGES}}, coalesce(s, r)) THEN r END AS rank,
  tienda IS NOT NULL AND numero IS NOT NULL AND r <= least({{SEARCH_PAGES}}, coalesce(s, r)) AS visitada,
  CASE WHEN tienda IS NULL THEN 'busqueda desconocida' WHEN numero IS NULL THEN 'sin numero de pagina' WHEN r > s THEN 'pagina vacia'
    WHEN r > {{SEARCH_PAGES}} THEN 'tope de paginas' END AS motivo FROM st""".replace("{SEARCH_PAGES}", str(SEARCH_PAGES)))
def search_visits_q(t: Tables) -> DataFrame:
    # The stored pages as answers to the seeds' searches: store, keyword and page number follow from page_id, some without a number,
    # some of an unknown store, some empty.
    from offerlake.operators.crawl import ITEM_PATTERN, crawl_seeds as cs, search_visits
    kw = F.element_at(F.array(*[F.lit(k) for k in _KW_LIST]), (F.floor(F.col("page_id") / 25) % len(_KW_LIST) + 1).cast("int"))
    number = (F.floor(F.col("page_id") / (25 * len(_KW_LIST))) + 1).cast("string")
    host = F.when(F.col("page_id") % 17 != 0, F.lower("n_name")).otherwise("otra")
    url = F.concat(F.lit("https://"), host, F.lit(".example/?s="), F.replace(kw, F.lit(" "), F.lit("+")), F.lit("&post_type=product"),
                   F.when(F.col("page_id") % 13 != 0, F.concat(F.lit("&paged="), number)).otherwise(""))
    items = F.when(F.col("page_id") % 11 == 0, 0).otherwise(F.size(F.regexp_extract_all(F.col("html"), F.lit(ITEM_PATTERN), 2)))
    pages = t.pages.join(t.nation, F.col("n_nationkey") == F.col("page_id") % 25).select("page_id", url.alias("url"), items.alias("items"))
    return search_visits(pages, cs(_store_dim(t)), SEARCH_PAGES)


_PAGE_OFFERS = f"""listed AS (
SELECT CAST(k1 // 4 AS VARCHAR) || '-' || upper(trim(categoria)) AS pagina, 'tienda' || CAST(k1 // 4 % 50 AS VARCHAR) AS tienda,
  min(pais) OVER g AS pais, 'USD' AS moneda, upper(trim(categoria)) AS categoria, lower(trim(categoria)) AS keyword_busqueda,
  {o.collapse("producto")} || ' & m&aacute;s' AS producto, CASE WHEN precio_raw = 'Consultar' THEN '' ELSE {o.collapse("precio_raw")} END AS precio_raw,
  coalesce(url_producto, '') AS url_producto, min(fecha_extraccion) OVER g AS fecha_extraccion
FROM offers WINDOW g AS (PARTITION BY k1 // 4, upper(trim(categoria))))"""


def _storefront(t: Tables) -> DataFrame:
    from offerlake.operators.pages import with_selectors
    from offerlake.sources.derived import storefront_pages
    return with_selectors(storefront_pages(chain.offer_view(t)), "div.card, li.product", "h3.title, h2.woocommerce-loop-product__title", "span.price")


@register("page_offers", o.with_ctes(o.OFFERS, _PAGE_OFFERS) + "SELECT * FROM listed")
def page_offers_q(t: Tables) -> DataFrame:
    from offerlake.operators.pages import page_offers
    return page_offers(_storefront(t), whitelist=False, keep=("pagina",)).drop("pos")


@register("page_offers_whitelisted", o.with_ctes(o.OFFERS, _PAGE_OFFERS) + f"SELECT * FROM listed WHERE {_whitelist_sql('producto', 'categoria')}")
def page_offers_whitelisted(t: Tables) -> DataFrame:
    from offerlake.operators.pages import page_offers
    return page_offers(_storefront(t), keep=("pagina",)).drop("pos")


@register("selector_probe", o.with_ctes(o.OFFERS) + """, pg AS (
SELECT 'tienda' || CAST(k1 // 4 % 50 AS VARCHAR) || '.example' AS sitio, count(*) >= 2 AS caja, count(*) FILTER (WHERE precio_raw <> 'Consultar') > 0 AS precio
FROM offers GROUP BY k1 // 4, upper(trim(categoria)))
SELECT sitio, 'contenedor' AS tipo, CASE WHEN caja THEN 'li.product' ELSE '' END AS selector, count(*) AS paginas FROM pg GROUP BY ALL
UNION ALL SELECT sitio, 'nombre', 'h2.woocommerce-loop-product__title', count(*) FROM pg GROUP BY ALL
UNION ALL SELECT sitio, 'precio', CASE WHEN precio THEN 'span.price' ELSE '' END, count(*) FROM pg GROUP BY ALL""")
def selector_probe_q(t: Tables) -> DataFrame:
    from offerlake.operators.pages import selector_probe
    from offerlake.sources.derived import storefront_pages
    return selector_probe(storefront_pages(chain.offer_view(t)))


@register("fetch_errors", """
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, 'tienda_' || CAST(user_id AS VARCHAR) AS fuente, 'HTTP' AS tipo_error,
  substring(trim(replace('Codigo 500 en busqueda ' || CAST(event_id AS VARCHAR) || chr(10) || ' props=' || props || chr(10),
    chr(10), ' ')), 1, 300) AS descripcion,
  'Consulta sin datos; siguen las demas' AS accion_tomada,
  'Codigo 500 en busqueda ' || CAST(event_id AS VARCHAR) || chr(10) || ' props=' || props || chr(10) AS detalle
FROM events WHERE event_type = 'error'""")
def fetch_errors(t: Tables) -> DataFrame:
    from offerlake.operators.crawl import fetch_errors as fe, fetch_status
    return fe(fetch_status(t.events))


@register("crawl_summary", """
WITH g AS (SELECT 'tienda_' || CAST(user_id AS VARCHAR) AS tienda, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS corrida,
  count(*) FILTER (WHERE event_type = 'purchase') AS items, count(*) FILTER (WHERE event_type = 'error') AS fallos,
  CASE WHEN count(*) FILTER (WHERE event_type = 'purchase') > 0 THEN 'OK'
       WHEN count(*) FILTER (WHERE event_type = 'error') > 0
         THEN 'ERROR: ' || CAST(count(*) FILTER (WHERE event_type = 'error') AS VARCHAR) || ' fallos'
       ELSE 'SIN DATOS' END AS estado
FROM events GROUP BY user_id, CAST(ts AS DATE)), s AS (SELECT DISTINCT 'tienda_' || CAST(c_custkey AS VARCHAR) AS tienda FROM customer)
SELECT coalesce(s.tienda, g.tienda) AS tienda, corrida, coalesce(items, 0) AS items, coalesce(fallos, 0) AS fallos,
  coalesce(estado, 'SIN DATOS') AS estado FROM s FULL JOIN g ON s.tienda = g.tienda""")
def crawl_summary(t: Tables) -> DataFrame:
    from offerlake.operators.crawl import fetch_status, run_summary
    ev = fetch_status(t.events).withColumn("tienda", F.concat(F.lit("tienda_"), F.col("user_id").cast("string")))
    # the store list: an account per customer
    stores = t.customer.select(F.concat(F.lit("tienda_"), F.col("c_custkey").cast("string")).alias("tienda"))
    return run_summary(stores, ev, "tienda", F.date_format(F.to_date("ts"), "yyyy-MM-dd"), F.col("event_type") == "purchase")


@register("selector_coverage", f"""
WITH p AS (SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS sitio, regexp_extract_all(html, {_ITEM_RE}, 2) AS items,
  trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS t, trim(regexp_extract(html, '<h1>([^<]*)</h1>', 1)) AS h
FROM pages)
SELECT sitio, count(*) AS paginas, count(*) FILTER (WHERE len(items) >= 2) AS con_contenedor,
  CAST(sum(len(list_filter(items, lambda x: trim(x) <> ''))) AS BIGINT) AS items_con_nombre,
  CAST(sum(len(list_filter(list_slice(items, 1, 3), lambda x: trim(x) <> ''))) AS BIGINT) AS items_muestra,
  count(*) FILTER (WHERE t <> '') AS nombre_por_title, count(*) FILTER (WHERE t = '' AND h <> '') AS nombre_por_h1
FROM p GROUP BY sitio""")
def selector_coverage(t: Tables) -> DataFrame:
    from offerlake.operators.crawl import selector_coverage as sc
    return sc(t.pages)


# ---------------------------------------------------------------- enrichment joins ----------------------------------
_SPEC_KEY_HELPERS, _SPEC_KEY = o.key_columns("regexp_replace(modelo, '[™®]', '', 'g')", "'CPU'")


_SPECS_BY_KEY = _SPECS + f""", spk_h AS (
SELECT *, {_SPEC_KEY_HELPERS} FROM specs WHERE modelo IS NOT NULL), spk AS (
SELECT {_SPEC_KEY} AS clave_canonica, modelo, TRY_CAST(nucleos AS DOUBLE) AS nucleos, tdp, socket, p_partkey FROM spk_h), spk1 AS (
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY clave_canonica ORDER BY p_partkey) AS rn FROM spk
  WHERE clave_canonica <> {o.q(rules.UNCLASSIFIED)}) WHERE rn = 1)"""
_SHEETS = _SPECS_BY_KEY + """, fichas AS (
SELECT clave_canonica, '{"modelo":"' || modelo || '"' || coalesce(',"tdp":"' || tdp || '"', '') || coalesce(',"socket":"' || socket || '"', '') || '}'
  AS especificaciones FROM spk1)"""


@register("spec_enrich", STAGED[:-1] + ",\n" + _SPECS_BY_KEY + """
SELECT d.k1, d.k2, d.clave_canonica, s.modelo, s.nucleos, s.tdp, s.socket
FROM deduped d LEFT JOIN spk1 s ON d.clave_canonica = s.clave_canonica WHERE d.categoria = 'CPU'""")
def spec_enrich(t: Tables) -> DataFrame:
    from offerlake.operators.specs import enrich_offers, project_specs
    from offerlake.sources.derived import spec_file_from_parts
    specs = project_specs(spec_file_from_parts(t.part), keep=["p_partkey"]).dropna(subset=["modelo"])
    specs = specs.select("p_partkey", "modelo", F.col("nucleos").try_cast("double").alias("nucleos"), "tdp", "socket")
    offers = chain.staged(chain.offer_view(t)).filter(F.col("categoria") == "CPU").select("k1", "k2", "clave_canonica")
    return enrich_offers(offers, specs, ["p_partkey"]).select("k1", "k2", "clave_canonica", "modelo", "nucleos", "tdp",
                                                              "socket")


@register("demand_vs_price", STAGED[:-1] + ",\n" + _COMPONENTS + """, smed AS (
SELECT categoria_interes, median(presupuesto_usd) AS m FROM demanda GROUP BY categoria_interes), simp AS (
SELECT upper(s.categoria_interes) AS categoria, coalesce(presupuesto_usd, m) AS presupuesto_usd
FROM demanda s LEFT JOIN smed ON s.categoria_interes = smed.categoria_interes), dem AS (
SELECT categoria, count(*) AS respondentes, median(presupuesto_usd) AS presupuesto_mediano FROM simp GROUP BY categoria), pr AS (
SELECT categoria, count(*) AS ofertas, median(precio_usd) AS precio_mediano FROM deduped GROUP BY categoria)
SELECT categoria, respondentes, presupuesto_mediano, ofertas, precio_mediano FROM dem FULL OUTER JOIN pr USING (categoria)""")
def demand_vs_price(t: Tables) -> DataFrame:
    from offerlake.operators.median import exact_median
    from offerlake.operators.survey import stage_survey
    from offerlake.sources.derived import component_survey
    survey = stage_survey(component_survey(t.customer, t.nation)).withColumn("categoria", F.upper("categoria_interes"))
    demand = exact_median(survey, "categoria", "presupuesto_usd", "presupuesto_mediano", "respondentes")
    prices = exact_median(chain.staged(chain.offer_view(t)), "categoria", "precio_usd", "precio_mediano", "ofertas")
    return demand.join(prices, "categoria", "full").select("categoria", "respondentes", "presupuesto_mediano", "ofertas",
                                                           "precio_mediano")


# ---------------------------------------------------------------- star schema ---------------------------------------
def _values(rows, cols: str) -> str:
    def lit(v):
        return "NULL" if v is None else o.q(v)
    return "(VALUES " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows) + f") AS x({cols})"


_CAL = """SELECT CAST(strftime(f, '%Y%m%d') AS INTEGER) AS id_tiempo, strftime(f, '%Y-%m-%d') AS fecha,
  CAST(weekofyear(f) AS INTEGER) AS semana_iso, CAST(month(f) AS INTEGER) AS mes, CAST(quarter(f) AS INTEGER) AS trimestre,
  CAST(year(f) AS INTEGER) AS anio, dayname(f) AS nombre_dia
FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS f FROM b)"""
_TIEMPO_ORDERS = ("tiempo AS (WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi "
                  "FROM orders) " + _CAL + ")")
_TIEMPO = ("tiempo AS (WITH b AS (SELECT min(CAST(fecha_extraccion AS DATE)) AS lo, max(CAST(fecha_extraccion AS DATE)) AS hi "
           "FROM deduped) " + _CAL + ")")
_FUENTE_ROWS = [tuple(r) for r in rules.SOURCE_SEEDS] + [
    ("Scraping tiendas", "Web Scraping", "Spark", "Diaria", None), ("Encuesta propia", "Encuesta", "Spark", "Unica", None)]
_FUENTE = ("fuente AS (SELECT CAST(row_number() OVER (ORDER BY nombre_fuente) AS INTEGER) AS id_fuente, * FROM "
           + _values(_FUENTE_ROWS, "nombre_fuente, tipo_extraccion, tecnologia, frecuencia_actualizacion, url_o_endpoint")
           + ")")
_SEED_STORES = _values([tuple(r) for r in rules.STORE_SEEDS], "nombre_tienda, pais, moneda_nativa, tipo_tienda, url_base")


def _tienda_cte(observed_sql: str) -> str:
    return f"""tienda AS (
WITH seeds AS (SELECT * FROM {_SEED_STORES}), obs AS ({observed_sql}), u AS (
SELECT * FROM seeds UNION ALL
SELECT nombre_tienda, pais, 'USD', 'Tienda especializada', CAST(NULL AS VARCHAR) FROM obs
WHERE nombre_tienda NOT IN (SELECT nombre_tienda FROM seeds))
SELECT CAST(row_number() OVER (ORDER BY nombre_tienda) AS BIGINT) AS id_tienda, * FROM u)"""


def _brand_sql(col: str) -> str:
    from offerlake.operators.warehouse import _re_escape
    whens = " ".join(f"WHEN regexp_matches(lower({col}), {o.q('(^|[^a-z0-9])' + _re_escape(b.lower()) + '([^a-z0-9]|$)')}) "
                     f"THEN {o.q(b)}" for b in rules.BRANDS)
    return f"CASE {whens} ELSE {o.q(rules.UNKNOWN_BRAND)} END"


_PRODUCTO = f"""producto AS (
SELECT CAST(row_number() OVER (ORDER BY clave_canonica) AS BIGINT) AS id_producto, clave_canonica,
  {_brand_sql('modelo_raw')} AS marca, upper(cat) AS categoria,
  CASE WHEN clave_canonica <> {o.q(rules.UNCLASSIFIED)} THEN nullif(regexp_extract(clave_canonica, '^[a-z]+'), '') END AS subcategoria, modelo_raw,
  especificaciones
FROM (SELECT clave_canonica, arg_min(producto, (precio_usd, tienda, producto, categoria)) AS modelo_raw,
        arg_min(categoria, (precio_usd, tienda, producto, categoria)) AS cat FROM deduped GROUP BY clave_canonica)
LEFT JOIN fichas USING (clave_canonica))"""
_TIENDA_STAGED = _tienda_cte("SELECT tienda AS nombre_tienda, min(pais) AS pais FROM deduped GROUP BY tienda")
_FACT = """fact AS (
SELECT md5(concat_ws('|', coalesce(d.tienda, '~'), coalesce(d.categoria, '~'), coalesce(d.clave_canonica, '~'),
    coalesce(CAST(CAST(d.precio_usd AS DECIMAL(12,4)) AS VARCHAR), '~'), coalesce(d.fecha_extraccion, '~'))) AS id_hecho,
  p.id_producto, t.id_tienda, CAST(strftime(CAST(d.fecha_extraccion AS DATE), '%Y%m%d') AS INTEGER) AS id_tiempo,
  (SELECT id_fuente FROM fuente WHERE nombre_fuente = 'Scraping tiendas') AS id_fuente,
  CAST(d.precio_usd AS DECIMAL(12,4)) AS precio_original, d.moneda AS moneda_original,
  CAST(1.0 AS DECIMAL(10,6)) AS tasa_cambio_usd, CAST(d.precio_usd AS DECIMAL(12,4)) AS precio_usd,
  true AS stock_disponible, CAST(d.fecha_extraccion AS TIMESTAMP) AS fecha_extraccion, d.url_producto
FROM deduped d LEFT JOIN producto p ON p.clave_canonica = d.clave_canonica LEFT JOIN tienda t ON t.nombre_tienda = d.tienda)"""
_NO_SHEETS = "fichas AS (SELECT CAST(NULL AS VARCHAR) AS clave_canonica, CAST(NULL AS VARCHAR) AS especificaciones WHERE false)"
_STAR = STAGED[:-1] + ",\n" + ",\n".join([_NO_SHEETS, _TIEMPO, _FUENTE, _TIENDA_STAGED, _PRODUCTO, _FACT]) + "\n"


class _Star:
    """The star schema over the staged offers of one data directory (staged table materialised once)."""

    def __init__(self, t: Tables):
        from offerlake.operators import warehouse as wh
        from offerlake.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(t.spark)
        self.staged = chain.staged(chain.offer_view(t)).checkpoint(eager=True)
        self.tiempo = wh.calendar(self.staged, "fecha_extraccion")
        self.fuente = wh.source_dim(t.spark)
        self.tienda = wh.store_dim(self.staged.select(F.col("tienda").alias("nombre_tienda"), "pais"))
        self.producto = wh.product_dim(self.staged)
        self.fact = wh.fact_prices(self.staged, self.producto, self.tienda, self.fuente)


@register("dim_tiempo", "WITH " + _TIEMPO_ORDERS + " SELECT * FROM tiempo")
def dim_tiempo(t: Tables) -> DataFrame:
    from offerlake.operators.warehouse import calendar
    return calendar(t.orders, "o_orderdate")


@register("dim_tienda", "WITH " + _tienda_cte(
    "SELECT s_name AS nombre_tienda, min(n_name) AS pais FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY s_name")
    + " SELECT * FROM tienda")
def dim_tienda(t: Tables) -> DataFrame:
    from offerlake.operators.warehouse import store_dim
    n = t.nation.select("n_nationkey", "n_name")
    obs = t.supplier.join(n, t.supplier.s_nationkey == n.n_nationkey).select(
        F.col("s_name").alias("nombre_tienda"), F.col("n_name").alias("pais"))
    return store_dim(obs)


@register("dim_producto", STAGED[:-1] + ",\n" + _SHEETS + ",\n" + _PRODUCTO + "\nSELECT * FROM producto")
def dim_producto(t: Tables) -> DataFrame:
    from offerlake.operators.specs import project_specs, specs_by_key
    from offerlake.operators.warehouse import product_dim
    from offerlake.sources.derived import spec_file_from_parts
    sheets = project_specs(spec_file_from_parts(t.part), keep=["p_partkey"]).dropna(subset=["modelo"]).select("p_partkey", "modelo", "tdp", "socket")
    return product_dim(chain.staged(chain.offer_view(t)), specs_by_key(sheets, ["p_partkey"]))


@register("stable_store_keys", """
SELECT CAST(row_number() OVER (ORDER BY carga, nombre_tienda) AS BIGINT) AS id_tienda, nombre_tienda, carga
FROM (SELECT s_name AS nombre_tienda, min(CASE WHEN s_suppkey % 3 = 0 THEN 1 WHEN s_suppkey % 3 = 1 THEN 2 ELSE 3 END) AS carga FROM supplier GROUP BY s_name)""")
def stable_store_keys(t: Tables) -> DataFrame:
    # Three loads, each with the stores of the one before it, then the last one once more: ids never move.
    import uuid

    from offerlake.operators.keyring import append_new
    from offerlake.session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/llaves/{uuid.uuid4().hex}"
    load = F.when(F.col("s_suppkey") % 3 == 0, 1).when(F.col("s_suppkey") % 3 == 1, 2).otherwise(3)
    stores = t.supplier.groupBy(F.col("s_name").alias("nombre_tienda")).agg(F.min(load).alias("carga"))
    for n in (1, 2, 3, 3):
        known = append_new(stores.where(F.col("carga") <= n), path, "nombre_tienda", "id_tienda", f"carga-{n}")
    return known


_QUOTES = """quotes AS (
SELECT s_nationkey AS moneda, CAST(l_shipdate AS DATE) AS fecha_tasa, max(l_extendedprice) AS tasa
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_tax = 0 AND dayofmonth(l_shipdate) <= 3 GROUP BY ALL)"""


@register("rate_as_of", "WITH " + _QUOTES + """
SELECT o.o_orderkey, c.c_nationkey AS moneda, strftime(o.o_orderdate, '%Y-%m-%d') AS fecha, strftime(q.fecha_tasa, '%Y-%m-%d') AS fecha_tasa, q.tasa
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  ASOF LEFT JOIN quotes q ON q.moneda = c.c_nationkey AND CAST(o.o_orderdate AS DATE) >= q.fecha_tasa""")
def rate_as_of(t: Tables) -> DataFrame:
    # Quotations: the dearest untaxed line that a nation's suppliers ship on the first three days of a month (most days have none).
    from offerlake.operators.asof import join_as_of
    lines = t.lineitem.where((F.col("l_tax") == 0) & (F.dayofmonth("l_shipdate") <= 3)).join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    quotes = lines.groupBy(F.col("s_nationkey").alias("moneda"), F.to_date("l_shipdate").alias("fecha_tasa")).agg(F.max("l_extendedprice").alias("tasa"))
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.col("c_nationkey").alias("moneda"), F.to_date("o_orderdate").alias("fecha"))
    found = join_as_of(orders, quotes)
    return found.select("o_orderkey", "moneda", *[F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("fecha", "fecha_tasa")], "tasa")


_MONEY = ["precio_original", "tasa_cambio_usd", "precio_usd"]


def _money_as_double(df: DataFrame) -> DataFrame:
    """Registered outputs carry DECIMAL money as DOUBLE so both engines hand over the same value type."""
    return df.withColumns({c: F.col(c).cast("double") for c in _MONEY + ["precio_min", "precio_max", "precio_total"]
                           if c in df.columns})


@register("fact_precios", _STAR + "SELECT * REPLACE (CAST(precio_original AS DOUBLE) AS precio_original, "
          "CAST(tasa_cambio_usd AS DOUBLE) AS tasa_cambio_usd, CAST(precio_usd AS DOUBLE) AS precio_usd) FROM fact")
def fact_precios(t: Tables) -> DataFrame:
    return _money_as_double(_Star(t).fact)


@register("star_rollup", _STAR + """
SELECT p.categoria, ti.anio, count(*) AS ofertas, count(DISTINCT f.id_tienda) AS tiendas,
  CAST(min(f.precio_usd) AS DOUBLE) AS precio_min, CAST(max(f.precio_usd) AS DOUBLE) AS precio_max,
  CAST(CAST(sum(f.precio_usd) AS DECIMAL(22,4)) AS DOUBLE) AS precio_total
FROM fact f LEFT JOIN producto p ON f.id_producto = p.id_producto LEFT JOIN tienda s ON f.id_tienda = s.id_tienda
  LEFT JOIN tiempo ti ON f.id_tiempo = ti.id_tiempo LEFT JOIN fuente fu ON f.id_fuente = fu.id_fuente
GROUP BY p.categoria, ti.anio""")
def star_rollup(t: Tables) -> DataFrame:
    s = _Star(t)
    j = (s.fact.join(s.producto.select("id_producto", "categoria"), "id_producto", "left")
         .join(s.tienda.select("id_tienda"), "id_tienda", "left")
         .join(s.tiempo.select("id_tiempo", "anio"), "id_tiempo", "left")
         .join(s.fuente.select("id_fuente"), "id_fuente", "left"))
    return _money_as_double(j.groupBy("categoria", "anio").agg(
        F.count(F.lit(1)).alias("ofertas"), F.countDistinct("id_tienda").alias("tiendas"),
        F.min("precio_usd").alias("precio_min"), F.max("precio_usd").alias("precio_max"),
        F.sum("precio_usd").cast("decimal(22,4)").alias("precio_total")))


def _enum(vals) -> str:
    return ", ".join(o.q(v) for v in vals)


@register("check_constraints", _STAR + f"""
SELECT 'dim_tiempo' AS tabla, 'mes BETWEEN 1 AND 12' AS regla, count(*) FILTER (WHERE NOT coalesce(mes BETWEEN 1 AND 12, false)) AS violaciones FROM tiempo
UNION ALL SELECT 'dim_tiempo', 'trimestre BETWEEN 1 AND 4', count(*) FILTER (WHERE NOT coalesce(trimestre BETWEEN 1 AND 4, false)) FROM tiempo
UNION ALL SELECT 'dim_fuente', 'tipo_extraccion IN (...)', count(*) FILTER (WHERE NOT coalesce(tipo_extraccion IN ({_enum(rules.EXTRACTION_TYPES + ['Encuesta'])}), false)) FROM fuente
UNION ALL SELECT 'dim_fuente', 'frecuencia_actualizacion IN (...)', count(*) FILTER (WHERE NOT coalesce(frecuencia_actualizacion IN ({_enum(rules.UPDATE_FREQUENCIES)}), false)) FROM fuente
UNION ALL SELECT 'dim_tienda', 'tipo_tienda IN (...)', count(*) FILTER (WHERE NOT coalesce(tipo_tienda IN ({_enum(rules.STORE_TYPES)}), false)) FROM tienda
UNION ALL SELECT 'dim_producto', 'categoria IN (...)', count(*) FILTER (WHERE NOT coalesce(categoria IN ({_enum([c.upper() for c in rules.PRODUCT_CATEGORIES])}), false)) FROM producto
UNION ALL SELECT 'fact_precios', 'precio_original > 0', count(*) FILTER (WHERE NOT coalesce(precio_original > 0, false)) FROM fact
UNION ALL SELECT 'fact_precios', 'tasa_cambio_usd > 0', count(*) FILTER (WHERE NOT coalesce(tasa_cambio_usd > 0, false)) FROM fact
UNION ALL SELECT 'fact_precios', 'precio_usd > 0', count(*) FILTER (WHERE NOT coalesce(precio_usd > 0, false)) FROM fact""")
def check_constraints(t: Tables) -> DataFrame:
    from offerlake.operators.warehouse import check_rules, constraint_rules
    s = _Star(t)
    return check_rules(constraint_rules(s.tiempo, s.fuente, s.tienda, s.producto, s.fact))


def _uniq_sql(table: str, cte: str, col: str) -> str:
    return (f"SELECT '{table}' AS tabla, '{col}' AS columna, (SELECT count(*) FILTER (WHERE {col} IS NULL) FROM {cte}) AS nulos, "
            f"(SELECT count(*) FROM (SELECT {col} FROM {cte} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1)) AS duplicados")


_UNIQUE = [("dim_tiempo", "tiempo", "fecha"), ("dim_fuente", "fuente", "nombre_fuente"),
           ("dim_tienda", "tienda", "nombre_tienda"), ("dim_producto", "producto", "clave_canonica"),
           ("fact_precios", "fact", "id_hecho")]


@register("unique_notnull", _STAR + "\nUNION ALL\n".join(_uniq_sql(*u) for u in _UNIQUE))
def unique_notnull(t: Tables) -> DataFrame:
    from offerlake.operators.warehouse import unique_violations
    s = _Star(t)
    frames = {"tiempo": s.tiempo, "fuente": s.fuente, "tienda": s.tienda, "producto": s.producto, "fact": s.fact}
    out = None
    for table, cte, col in _UNIQUE:
        r = unique_violations(frames[cte], table, col)
        out = r if out is None else out.unionByName(r)
    return out


_CTE_OF = {table: cte for table, cte, _ in _UNIQUE}


_FKS = [("fact_precios.id_producto -> dim_producto", "id_producto", "producto"),
        ("fact_precios.id_tienda -> dim_tienda", "id_tienda", "tienda"),
        ("fact_precios.id_tiempo -> dim_tiempo", "id_tiempo", "tiempo"),
        ("fact_precios.id_fuente -> dim_fuente", "id_fuente", "fuente")]


@register("not_null", _STAR + "\nUNION ALL\n".join(
    f"SELECT {o.q(table)} AS tabla, {o.q(c)} AS columna, count(*) FILTER (WHERE {c} IS NULL) AS nulos FROM {_CTE_OF[table]}"
    for table, cols in NOT_NULL.items() for c in cols))
def not_null(t: Tables) -> DataFrame:
    from offerlake.operators.warehouse import null_violations
    s = _Star(t)
    frames = {"dim_tiempo": s.tiempo, "dim_fuente": s.fuente, "dim_tienda": s.tienda, "dim_producto": s.producto, "fact_precios": s.fact}
    return reduce(DataFrame.unionByName, [null_violations(frames[table], table) for table in NOT_NULL])


@register("fk_violations", _STAR + "\nUNION ALL\n".join(
    f"SELECT {o.q(n)} AS relacion, count(*) AS huerfanos FROM fact f WHERE NOT EXISTS "
    f"(SELECT 1 FROM {cte} d WHERE d.{k} = f.{k})" for n, k, cte in _FKS))
def fk_violations(t: Tables) -> DataFrame:
    from offerlake.operators.warehouse import fk_violations as fv
    s = _Star(t)
    frames = {"producto": s.producto, "tienda": s.tienda, "tiempo": s.tiempo, "fuente": s.fuente}
    out = None
    for name, key, cte in _FKS:
        r = fv(s.fact, key, frames[cte], key, name)
        out = r if out is None else out.unionByName(r)
    return out


# ---------------------------------------------------------------- unified schema over three sources ---------------
@register("unified_schema", STAGED[:-1] + ",\n" + _COMPONENTS + ",\n" + _SPECS_STAGED + """, smed AS (
SELECT categoria_interes, median(presupuesto_usd) AS m FROM demanda GROUP BY categoria_interes)
SELECT 'scraping_tiendas' AS fuente, producto, precio_usd, categoria, tienda FROM deduped
UNION ALL
SELECT 'encuesta', CAST(NULL AS VARCHAR), coalesce(presupuesto_usd, m), s.categoria_interes, CAST(NULL AS VARCHAR)
FROM demanda s LEFT JOIN smed ON s.categoria_interes = smed.categoria_interes
UNION ALL
SELECT 'archivo_specs', modelo, CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM specs_stg""")
def unified_schema(t: Tables) -> DataFrame:
    from offerlake.operators.normalize import unify_sources
    from offerlake.operators.specs import stage_specs
    from offerlake.operators.survey import stage_survey
    from offerlake.sources.derived import component_survey, spec_file_from_parts
    offers = chain.staged(chain.offer_view(t)).select("producto", "precio_usd", "categoria", "tienda")
    survey = stage_survey(component_survey(t.customer, t.nation)).select(
        F.col("presupuesto_usd").alias("precio_usd"), F.col("categoria_interes").alias("categoria"))
    specs = stage_specs(spec_file_from_parts(t.part), ["p_partkey"]).select(F.col("modelo").alias("producto"))
    u = unify_sources({"scraping_tiendas": offers, "encuesta": survey, "archivo_specs": specs})
    return u.select("fuente", "producto", "precio_usd", "categoria", "tienda")


# ---------------------------------------------------------------- the whole quality report -------------------------
def _report_row(section: str, key: str, value: str = "NULL", text: str = "NULL", tail: str = "") -> str:
    return (f"SELECT {o.q(section)} AS seccion, CAST({key} AS VARCHAR) AS clave, CAST({value} AS DOUBLE) AS valor, "
            f"CAST({text} AS VARCHAR) AS texto {tail}")


_REPORT = [
    _report_row("duplicados", "'antes'", "count(*)", tail="FROM keyed"),
    _report_row("duplicados", "'despues'", "count(*)", tail="FROM deduped"),
    _report_row("duplicados", "'duplicados_eliminados'", "(SELECT count(*) FROM keyed) - (SELECT count(*) FROM deduped)"),
    _report_row("duplicados", "'criterio'", text=o.q(", ".join(rules.DEDUP_KEYS))),
    *[_report_row("nulos_pct", o.q(c), f"round_even(avg(CAST({c} IS NULL AS DOUBLE)) * 100, 2)", tail="FROM priced")
      for c in ("tienda", "categoria", "producto", "precio_usd")],
    _report_row("conversion", "'no_parseables'", "count(*) FILTER (WHERE precio_usd IS NULL)", tail="FROM priced"),
    _report_row("conversion_ejemplo", "precio_raw", "precio_usd", "ejemplo", """FROM (
SELECT precio_raw, precio_usd, '''' || trim(substring(precio_raw, 1, 30)) || ''' -> ' || CAST(precio_usd AS VARCHAR) AS ejemplo
FROM priced WHERE precio_usd IS NOT NULL ORDER BY k1, k2, precio_raw, tienda, producto LIMIT 8)"""),
    _report_row("categoria_no_estandar", "categoria", tail="FROM (SELECT DISTINCT categoria FROM std WHERE categoria IS NULL "
                f"OR categoria NOT IN ({_enum(rules.VALID_CATEGORIES)}))"),
    *[_report_row("homologacion", o.q(f"{f}.{src}"), text=o.q(e)) for f, src, e in rules.HOMOLOGATION_MAP],
    *[_report_row("metricas", o.q(c), c, tail=f"FROM ({ORACLE['quality_metrics']})")
      for c in ("total_registros_raw", "registros_descartados_relevancia", "registros_eliminados_nulos",
                "registros_depurados_duplicados", "total_registros_staging", "tasa_completitud_general_pct", "tasa_error_pct")],
    *[_report_row("clave_canonica", o.q(c), c, tail=f"FROM ({ORACLE['key_coverage']})")
      for c in ("cobertura_clave_canonica_pct", "claves_distintas")],
    _report_row("tienda", "tienda", "count(*)", tail="FROM deduped WHERE tienda IS NOT NULL GROUP BY tienda"),
    _report_row("categoria", "categoria", "count(*)", tail="FROM deduped WHERE categoria IS NOT NULL GROUP BY categoria"),
    *[_report_row("encuesta", o.q(c), c, tail=f"FROM ({ORACLE['survey_nulls']})")
      for c in ("registros", "presupuesto_imputado", "ciudad_imputada")],
    _report_row("especificaciones", "'registros'", "count(*)", tail="FROM specs_stg"),
]


@register("quality_report_long", STAGED_DUP[:-1] + ",\n" + _SPECS_STAGED + "\n" + "\nUNION ALL\n".join(f"({x})" for x in _REPORT))
def quality_report_long(t: Tables) -> DataFrame:
    from offerlake.operators.specs import stage_specs
    from offerlake.sources.derived import spec_file_from_parts, survey_from_customers
    std = chain.standardized(chain.offer_view_with_copies(t))
    return quality.report_of_marked(quality.marked(std), survey_from_customers(t.customer, t.nation), stage_specs(spec_file_from_parts(t.part), ["p_partkey"]),
                                    order=["k1", "k2", "precio_raw", "tienda", "producto"], prices=quality.marked_prices(std))
