"""Schema homologation and text standardisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlake import rules
from offerlake.functions.text import collapse_ws


def normalize_columns(
    df: DataFrame,
    aliases: Mapping[str, str] = rules.COLUMN_ALIASES,
    canonical: Sequence[str] = rules.CANONICAL_COLUMNS,
) -> DataFrame:
    """Rename alias columns to canonical names, add absent canonical columns as null, cast them to text.

    When two aliases of one target are both present (``nombre`` and ``name``), the first non-null value in alias order
    wins, instead of producing two columns of the same name.
    """
    present = set(df.columns)
    sources: dict[str, list[str]] = {}
    for alias, target in aliases.items():
        if alias in present:
            sources.setdefault(target, []).append(alias)
    out_cols = []
    consumed = {a for lst in sources.values() for a in lst}
    for c in df.columns:
        if c in consumed:
            continue
        if c in sources:
            out_cols.append(F.coalesce(*[F.col(f"`{x}`") for x in [c] + sources.pop(c)]).alias(c))
        else:
            out_cols.append(F.col(f"`{c}`"))
    for target, alist in sources.items():
        out_cols.append(F.coalesce(*[F.col(f"`{x}`") for x in alist]).alias(target))
    out = df.select(*out_cols)
    missing = [c for c in canonical if c not in out.columns]
    out = out.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else out
    return out.withColumns({c: F.col(c).cast("string") for c in canonical})


def standardize(df: DataFrame, columns: Sequence[str] = rules.STANDARDIZED_TEXT_COLUMNS) -> DataFrame:
    """Collapse whitespace in the text columns and upper-case the category (nulls stay null)."""
    from offerlake.operators.staging import computed_once_many

    updates = {c: collapse_ws(F.col(c)) for c in columns if c in df.columns}
    if "categoria" in df.columns:
        updates["categoria"] = F.upper(updates.get("categoria", F.col("categoria")))
    # Fenced: the relevance filter that follows tests the standardised title without re-running the regex below.
    return computed_once_many(df, updates)


def invalid_categories(df: DataFrame, valid: Sequence[str] = rules.VALID_CATEGORIES) -> DataFrame:
    """Distinct observed categories outside the master list (one row each; null counts as non-standard)."""
    spark = df.sparkSession
    valid_df = spark.createDataFrame([(v,) for v in valid], "categoria string")
    observed = df.select("categoria").distinct()
    # Anti join against a fixed six-row rule table: broadcast by construction.
    return observed.join(F.broadcast(valid_df), observed.categoria.eqNullSafe(valid_df.categoria), "left_anti")


def invalid_category_list(df: DataFrame, valid: Sequence[str] = rules.VALID_CATEGORIES) -> DataFrame:
    """The non-standard categories as a sorted table (nulls first). Kept as rows, not gathered into one array: the
    number of distinct bad values is not bounded by anything in the data."""
    return invalid_categories(df, valid).orderBy(F.col("categoria").asc_nulls_first())


def homologation_map(spark) -> DataFrame:
    """Field map of the unified schema as a table ``(campo, fuente, expresion)``."""
    return spark.createDataFrame(rules.HOMOLOGATION_MAP, "campo string, fuente string, expresion string")


def unify_sources(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Each source already projected to (part of) ``producto, precio_usd, categoria, tienda``; union by name with a
    ``fuente`` column naming the origin."""
    frames = [df.withColumn("fuente", F.lit(name)) for name, df in sources.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
