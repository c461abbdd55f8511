"""Offer staging steps (V3-V10, F1, F2): each a narrow transformation, so the chain pipelines in one stage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlake import rules
from offerlake.functions.dates import parse_any_date, standardize_date
from offerlake.functions.fx import convert, rates_json, rates_map
from offerlake.functions.keys import add_key
from offerlake.functions.price import parse_price
from offerlake.functions.regex import java_regex


def is_bundle(title: Column, pattern: str = rules.BUNDLE_PATTERN) -> Column:
    """Whole-PC listing by case-insensitive Unicode regex; a null title is not a bundle."""
    return F.coalesce(title.rlike(java_regex(pattern, ignore_case=True)), F.lit(False))


def relevance_filter(df: DataFrame, pattern: str = rules.BUNDLE_PATTERN) -> DataFrame:
    """Drop whole-PC listings (the filter reaches the scan's row groups only as a post-scan predicate: regex)."""
    return df.filter(~is_bundle(F.col("producto"), pattern))


def computed_once_many(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """``computed_once`` for several columns at once (one generator, column order kept)."""
    order = df.columns + [n for n in exprs if n not in df.columns]
    keep = [F.col(f"`{c}`") for c in df.columns if c not in exprs]
    gen = df.select(*keep, F.inline(F.array(F.struct(*[e.alias(n) for n, e in exprs.items()]))))
    return gen.select(*[F.col(f"`{c}`") for c in order])


def computed_once(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """``df`` plus ``name = expr``, with ``expr`` evaluated once per row even when a later filter tests ``name``.

    Catalyst pushes a filter below the projection that defines its column by inlining the definition, so an
    expensive expression (regexes, higher-order functions) would run twice: in the filter and in the projection.
    A one-row ``inline`` generator keeps the column a generated attribute, which filters cannot be inlined through;
    it stays inside whole-stage codegen.
    """
    cols = [F.col(f"`{c}`") for c in df.columns if c != name]
    return df.select(*cols, F.inline(F.array(F.struct(expr.alias(name)))))


def add_price(df: DataFrame, raw: str = "precio_raw", out: str = "precio_usd") -> DataFrame:
    return computed_once(df, out, parse_price(F.col(raw)))


def drop_unpriced(df: DataFrame, col: str = "precio_usd") -> DataFrame:
    """Critical nulls: a row without a positive price cannot be compared (null fails ``> 0``)."""
    return df.filter(F.col(col) > 0)


def add_canonical_key(df: DataFrame, patterns: Mapping[str, Sequence[str]] = rules.KEY_PATTERNS) -> DataFrame:
    keyed = add_key(df, patterns=patterns)
    # Fence the key so the comparison's "key is classified" filter does not re-run the regexes below it.
    return computed_once(keyed, "clave_canonica", F.col("clave_canonica"))


def standardize_dates(df: DataFrame, run_date: str, col: str = "fecha_extraccion") -> DataFrame:
    """``fecha_extraccion`` to ANSI ``YYYY-MM-DD`` text (invalid -> the run date); ``fecha_staging`` = run date."""
    rd = F.to_date(F.lit(run_date))
    return df.withColumns({col: standardize_date(F.col(col), rd).cast("string"), "fecha_staging": rd.cast("string")})


def invalid_date_flag(col: str = "fecha_extraccion") -> Column:
    return parse_any_date(F.col(col)).isNull()


def convert_currencies(
    df: DataFrame,
    rates: Mapping[str, float],
    usd: str = "precio_usd",
    currencies: Sequence[str] | None = None,
) -> DataFrame:
    """``precio_<cur> = round(usd * rate, 2)`` for each rate, plus the rates used as JSON text on every row.

    The rate set is a handful of literals, so it is compiled into the projection (no join, no shuffle).
    """
    cur = list(currencies) if currencies is not None else list(rates)
    m = rates_map(rates)
    cols = {f"precio_{c.lower()}": convert(F.col(usd), F.element_at(m, F.lit(c))) for c in cur}
    cols["tasas_referencia"] = rates_json(m)
    return df.withColumns(cols)


def convert_currencies_table(df: DataFrame, rates: DataFrame, usd: str = "precio_usd", currencies: Sequence[str] | None = None) -> DataFrame:
    """Like ``convert_currencies`` but with rates from a ``(moneda, tasa)`` table (e.g. read from FX files).

    The columns are the currencies of the table, in its alphabetical order (or those asked for): a list as long as a rate file, not
    as the data. All rates come from one scalar subquery, projected once and read by field; the rates used are carried as JSON
    text. A currency that is asked for and absent gives null prices; a name that is no column name is left out of the columns, not
    of the text.
    """
    cur = list(currencies) if currencies is not None else [r["moneda"] for r in rates.select("moneda").where("moneda is not null").distinct().orderBy("moneda").collect()]
    row = rates.agg(F.struct(F.lit(1).alias("_"), *[F.max(F.when(F.col("moneda") == c, F.col("tasa"))).alias(f"r{i}") for i, c in enumerate(cur)])).scalar()
    rate = {c: F.col(f"_fx.r{i}") for i, c in enumerate(cur)}
    used = F.to_json(F.map_from_arrays(F.array(*[F.lit(c) for c in cur]), F.array(*rate.values()))) if cur else F.lit("{}")
    cols = {f"precio_{c.lower()}": convert(F.col(usd), rate[c]) for c in cur if c.isalnum()}
    cols["tasas_referencia"] = used
    return df.select("*", row.alias("_fx")).withColumns(cols).drop("_fx")
