"""Canonical product key: the homologated model that lets the same product be matched across stores.

Title -> lower case -> bracketed text removed -> whitespace collapsed. Then the category's ordered patterns are tried;
the first match that is not a generic token and holds a digit is the key, else ``sin_clasificar``. Each pattern is a
``regexp_extract`` guarded by its category and by the lack of a key so far.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerlake import rules
from offerlake.functions.regex import java_regex
from offerlake.functions.text import collapse_ws

_BRACKETS = r"\(.*?\)|\[.*?\]"
_DIGIT = java_regex(r"\d")


def strip_brackets(title: Column) -> Column:
    """Lower-cased title with ``(...)``/``[...]`` removed and whitespace collapsed."""
    return collapse_ws(without_brackets(title))


def without_brackets(title: Column) -> Column:
    low = F.lower(title)
    return F.when(title.contains("(") | title.contains("["), F.regexp_replace(low, _BRACKETS, " ")).otherwise(low)


def add_key(df, title: str = "producto", category: str = "categoria", out: str = "clave_canonica",
            patterns: Mapping[str, Sequence[str]] = rules.KEY_PATTERNS, generic: Sequence[str] = rules.GENERIC_KEYS,
            unclassified: str = rules.UNCLASSIFIED):
    """Add the canonical key column: the first valid hit of the row's category (not empty, not generic, holds a digit), else
    ``unclassified``.

    The cleaned title is projected once. Then the categories' first patterns are tried, for the rows without a key yet the second
    ones, and so on: a row runs the patterns of its own category up to the one that gives its key. ``_ktxt`` is already
    whitespace-collapsed, so trimming a hit equals collapsing and stripping it. The helper columns are dropped.
    """
    cats = list(patterns)
    step = df.withColumn("_kbare", F.when(F.col(category).isin(*cats), without_brackets(F.col(title))))
    step = step.withColumn("_ktxt", collapse_ws(F.col("_kbare")))
    key = F.lit(None).cast("string")
    for i in range(max((len(p) for p in patterns.values()), default=0)):
        step = step.withColumn(f"_k{i}", key)
        found = F.lit(None).cast("string")
        for cat, plist in patterns.items():
            if i < len(plist):
                found = F.when(F.col(f"_k{i}").isNull() & (F.col(category) == cat), F.trim(F.regexp_extract("_ktxt", java_regex(plist[i]), 0))).otherwise(found)
        step = step.withColumn(f"_h{i}", found)
        hit = F.col(f"_h{i}")
        key = F.coalesce(F.col(f"_k{i}"), F.when((hit != "") & ~hit.isin(*generic) & hit.rlike(_DIGIT), hit))
    named = F.when(F.col(title).isNull() | (F.col(title) == ""), F.lit(unclassified)).otherwise(F.coalesce(key, F.lit(unclassified)))
    helpers = [c for c in step.columns if c not in df.columns]
    return step.withColumn(out, named).drop(*helpers)


def canonical_key(
    title: Column,
    category: Column,
    patterns: Mapping[str, Sequence[str]] = rules.KEY_PATTERNS,
    generic: Sequence[str] = rules.GENERIC_KEYS,
    unclassified: str = rules.UNCLASSIFIED,
) -> Column:
    """Single-expression form of the key (for small inputs and ad-hoc use; ``add_key`` is the plan-friendly form)."""
    txt = strip_brackets(title)
    expr = None
    for cat, plist in patterns.items():
        candidates = []
        for p in plist:
            hit = F.trim(F.regexp_extract(txt, java_regex(p), 0))
            ok = (hit != "") & ~hit.isin(*generic) & hit.rlike(_DIGIT)
            candidates.append(F.when(ok, hit))
        branch = F.coalesce(*candidates, F.lit(unclassified))
        expr = F.when(category == cat, branch) if expr is None else expr.when(category == cat, branch)
    keyed = expr.otherwise(F.lit(unclassified)) if expr is not None else F.lit(unclassified)
    return F.when(title.isNull() | (title == ""), F.lit(unclassified)).otherwise(keyed)
