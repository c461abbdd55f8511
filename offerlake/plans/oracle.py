"""Independent SQL statements (DuckDB dialect) that compute the same results as the registered Spark queries.

They share no code path with the Spark operators: rules are re-expressed in SQL from the same rule data, and regular
expressions are rewritten for RE2 (``\\s`` -> ``[\\s\\p{Z}]``, ``\\w`` -> ``[\\p{L}\\p{N}_]``).
"""

from __future__ import annotations

from offerlake import rules
from offerlake.plans.offers import RUN_DATE

WS = r"[\s\p{Z}]+"


def re2(pattern: str) -> str:
    out = []
    i = 0
    in_class = False
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern):
            nxt = pattern[i + 1]
            if nxt == "s":
                out.append(r"\s\p{Z}" if in_class else r"[\s\p{Z}]")
            elif nxt == "w":
                out.append(r"\p{L}\p{N}_" if in_class else r"[\p{L}\p{N}_]")
            else:
                out.append(ch + nxt)
            i += 2
            continue
        if ch == "[" and not in_class:
            in_class = True
        elif ch == "]" and in_class:
            in_class = False
        out.append(ch)
        i += 1
    return "".join(out)


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def collapse(expr: str) -> str:
    return f"trim(regexp_replace({expr}, {q(WS)}, ' ', 'g'))"


OFFERS = """offers AS (
SELECT l.l_orderkey AS k1, l.l_linenumber AS k2, s.s_name AS tienda, n.n_name AS pais, 'USD' AS moneda,
 CASE p.p_type WHEN 'ECONOMY' THEN 'CPU' WHEN 'STANDARD' THEN 'gpu' WHEN 'PROMO' THEN 'Ram' WHEN 'SMALL' THEN ' SSD '
   WHEN 'MEDIUM' THEN 'Monitor' ELSE 'Periferico' END AS categoria,
 CASE WHEN l.l_orderkey % 17 = 0 THEN 'PC  Gamer con ' ELSE '' END ||
 CASE p.p_type WHEN 'ECONOMY' THEN 'Procesador  AMD (' || p.p_brand || ') Ryzen ' || CAST(3+2*(p.p_partkey%4) AS VARCHAR)
     || ' ' || CAST(5000+100*(p.p_partkey%40) AS VARCHAR) || 'X'
   WHEN 'STANDARD' THEN 'Tarjeta de Video RTX ' || CAST(4050+10*(p.p_partkey%6) AS VARCHAR) || ' Ti '
     || CAST(8*(1+p.p_partkey%2) AS VARCHAR) || 'GB ' || p.p_name
   ELSE p.p_name END AS producto,
 CASE l.l_linenumber % 6
   WHEN 0 THEN '$' || CAST(l.w AS VARCHAR) || ',' || l.d
   WHEN 1 THEN '$' || CAST(l.w AS VARCHAR) || '.' || l.d || ' Inc. IVA'
   WHEN 2 THEN CASE WHEN l.w >= 1000 THEN CAST(l.w // 1000 AS VARCHAR) || '.' || lpad(CAST(l.w % 1000 AS VARCHAR),3,'0')
               ELSE CAST(l.w AS VARCHAR) END || ',' || l.d
   WHEN 3 THEN CASE WHEN l.w >= 1000 THEN CAST(l.w // 1000 AS VARCHAR) || ',' || lpad(CAST(l.w % 1000 AS VARCHAR),3,'0')
               ELSE CAST(l.w AS VARCHAR) END || '.' || l.d
   WHEN 4 THEN '$' || CAST(l.w + 500 AS VARCHAR) || ',00 El precio original era: $' || CAST(l.w + 500 AS VARCHAR)
     || ',00. $' || CAST(l.w AS VARCHAR) || ',' || l.d
   ELSE 'Consultar' END AS precio_raw,
 CASE WHEN l.l_orderkey % 13 = 0 THEN NULL ELSE 'https://shop.example/p/' || CAST(l.l_partkey AS VARCHAR) END AS url_producto,
 CASE WHEN l.l_orderkey % 29 = 0 THEN 'sin fecha' ELSE substr(CAST(l.l_shipdate AS VARCHAR),1,19) END AS fecha_extraccion
FROM (SELECT *, c // 100 AS w, lpad(CAST(c % 100 AS VARCHAR),2,'0') AS d
      FROM (SELECT *, CAST(round(l_extendedprice*100) AS BIGINT) AS c FROM lineitem)) l
JOIN part p ON p.p_partkey=l.l_partkey JOIN supplier s ON s.s_suppkey=l.l_suppkey JOIN nation n ON n.n_nationkey=s.s_nationkey
)"""

OFFERS_DUP = """offers_dup AS (
SELECT * FROM offers
UNION ALL
SELECT k1, k2, tienda, pais, moneda, categoria, producto, precio_raw, CAST(NULL AS VARCHAR) AS url_producto, fecha_extraccion
FROM offers WHERE k1 % 7 = 0
)"""


def date_expr(col: str) -> str:
    fmts = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d", "%Y/%m/%d"]
    parsed = ", ".join(f"try_strptime({col}, {q(f)})" for f in fmts)
    return f"coalesce({parsed})"


def standardized_cte(src: str = "offers", name: str = "std") -> str:
    return f"""{name} AS (
SELECT k1, k2, {collapse('tienda')} AS tienda, pais, moneda, upper({collapse('categoria')}) AS categoria,
  {collapse('producto')} AS producto, {collapse('precio_raw')} AS precio_raw, url_producto,
  strftime(coalesce(CAST({date_expr('fecha_extraccion')} AS DATE), DATE {q(RUN_DATE)}), '%Y-%m-%d') AS fecha_extraccion,
  {q(RUN_DATE)} AS fecha_staging,
  coalesce(regexp_matches(producto, {q(re2(rules.BUNDLE_PATTERN))}, 'i'), false) AS is_bundle,
  {date_expr('fecha_extraccion')} IS NULL AS bad_date
FROM {src}
)"""


def price_expr(raw: str) -> str:
    actions = {
        "eu": "replace(replace(t, '.', ''), ',', '.')",
        "drop_commas": "replace(t, ',', '')",
        "comma_decimal": "replace(t, ',', '.')",
    }
    whens = " ".join(f"WHEN regexp_full_match(t, {q(p)}) THEN {actions[a]}" for p, a in rules.AMOUNT_FORMATS)
    parsed = f"TRY_CAST(CASE {whens} ELSE replace(t, ',', '') END AS DOUBLE)"
    tokens = f"regexp_extract_all({raw}, {q(rules.AMOUNT_TOKEN_PATTERN)})"
    return f"CAST(printf('%.2f', list_min(list_filter(list_transform({tokens}, lambda t: {parsed}), lambda v: v > 0))) AS DOUBLE)"


def key_columns(title: str, category: str) -> tuple[str, str]:
    """(select-list of helper columns, final key expression over them): the title is cleaned once, each pattern
    hit is a helper column, and the key is the category's first valid hit."""
    txt = collapse(f"regexp_replace(lower({title}), {q(r'\(.*?\)|\[.*?\]')}, ' ', 'g')")
    generic = ", ".join(q(g) for g in rules.GENERIC_KEYS)
    helpers = []
    branches = []
    for cat, plist in rules.KEY_PATTERNS.items():
        cands = []
        for i, p in enumerate(plist):
            h = f"_h_{cat.lower()}_{i}"
            helpers.append(f"{collapse(f'regexp_extract({txt}, {q(re2(p))}, 0)')} AS {h}")
            cands.append(f"CASE WHEN {h} <> '' AND {h} NOT IN ({generic}) AND regexp_matches({h}, '\\d') THEN {h} END")
        branches.append(f"WHEN {category} = {q(cat)} THEN coalesce({', '.join(cands)}, {q(rules.UNCLASSIFIED)})")
    key = (f"CASE WHEN {title} IS NULL OR {title} = '' THEN {q(rules.UNCLASSIFIED)} "
           f"{' '.join(branches)} ELSE {q(rules.UNCLASSIFIED)} END")
    return ", ".join(helpers), key


def priced_cte(src: str = "std", name: str = "priced") -> str:
    return f"""{name} AS (
SELECT *, {price_expr('precio_raw')} AS precio_usd FROM {src} WHERE NOT is_bundle
)"""


def fx_select(usd: str = "precio_usd") -> str:
    parts = [f"round_even({usd} * {rules.FALLBACK_RATES[c]!r}, 2) AS precio_{c.lower()}" for c in rules.FALLBACK_RATES]
    js = "{" + ",".join(f'"{c}":{float(v)!r}' for c, v in rules.FALLBACK_RATES.items()) + "}"
    return ", ".join(parts) + f", {q(js)} AS tasas_referencia"


STAGED_COLUMNS = ["k1", "k2", "tienda", "pais", "moneda", "categoria", "producto", "precio_raw", "url_producto",
                  "fecha_extraccion", "fecha_staging", "precio_usd", "clave_canonica", "precio_eur", "precio_gbp",
                  "precio_brl", "precio_mxn", "precio_cad", "precio_jpy", "tasas_referencia"]


def keyed_cte(src: str = "priced", name: str = "keyed") -> str:
    cols = ", ".join(c for c in STAGED_COLUMNS[:12])
    helpers, key = key_columns("producto", "categoria")
    return f"""{name}_h AS (
SELECT *, {helpers} FROM {src} WHERE precio_usd > 0
), {name} AS (
SELECT {cols}, {key} AS clave_canonica, {fx_select()}
FROM {name}_h
)"""


def dedup_cte(src: str = "keyed", name: str = "deduped") -> str:
    compl = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in STAGED_COLUMNS)
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in STAGED_COLUMNS)
    keys = ", ".join(rules.DEDUP_KEYS)
    cols = ", ".join(STAGED_COLUMNS)
    return f"""{name} AS (
SELECT {cols} FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ({compl}) DESC, {order}) AS rn FROM {src}
) WHERE rn = 1
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def staged_chain(src: str = "offers", dedup: bool = True) -> str:
    ctes = [OFFERS]
    if src == "offers_dup":
        ctes.append(OFFERS_DUP)
    ctes += [standardized_cte(src), priced_cte(), keyed_cte()]
    if dedup:
        ctes.append(dedup_cte())
    return with_ctes(*ctes)


def comparison_select(src: str = "deduped") -> str:
    return f"""cmp AS (
SELECT clave_canonica,
  arg_min(categoria, (precio_usd, tienda, producto, categoria)) AS categoria,
  count(DISTINCT tienda) AS tiendas_comparadas,
  arg_min(tienda, (precio_usd, tienda, producto, categoria)) AS tienda_mas_barata,
  min(precio_usd) AS pmin, max(precio_usd) AS pmax,
  arg_min(producto, (precio_usd, tienda, producto, categoria)) AS producto_min
FROM {src} WHERE clave_canonica <> {q(rules.UNCLASSIFIED)}
GROUP BY clave_canonica HAVING count(DISTINCT tienda) >= 2
), best AS (
SELECT clave_canonica, categoria, tiendas_comparadas, tienda_mas_barata,
  round_even(pmin, 2) AS precio_min_usd, round_even(pmax, 2) AS precio_max_usd, round_even(pmax - pmin, 2) AS ahorro_usd,
  CASE WHEN pmax <> 0 THEN round_even((1 - pmin / pmax) * 100, 1) ELSE 0.0 END AS ahorro_pct,
  substring(producto_min, 1, 70) AS producto_ejemplo, producto_min AS producto
FROM cmp
)"""
