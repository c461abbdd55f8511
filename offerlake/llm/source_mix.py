"""Mix sources to target weights by Efraimidis-Spirakis sampling, with DataFrame functions only.

Sources in code-point order (null last) weigh ``weights``, repeating. They share all words by weight; a target stops at ``most``
times its source's words, and the excess is shared again by weight among the others until none is above. That division has a
closed form: with sources sorted by ``most * size / weight``, the level at which the rest of the words would be shared falls
below a source's ratio from one source on; those before it are capped, the others get weight * level.

A source's target is met in complete epochs first: every document of it is taken ``floor(target / size)`` times. What is left is
selected by exponential keys: a document's key is ``-ln(u) / quality`` with u in (0, 1) from a hash of its id, so ascending keys
draw documents without replacement in proportion to their quality weights. Sizes are summed along the keys up to the budget; the
document that reaches over it gives its first words only, so a source's words differ from its target by less than one.

A source may hold a third of all rows, so no window runs over a source's documents. Keys are cut into tiles on a logarithmic
scale (a fixed number to a doubling, so a source has some thousands at most). Sizes are summed per tile on the map side, the
running total goes over a source's tiles, and only within a tile are documents sorted. Documents are shuffled once, by source and
tile, without their text.

Defined cases: a null text has no words and is taken 0 times; so is a source without words. Null ids draw from the hash of their
text. Rows that are alike in id and text get the same key and are interchangeable; further ties go by id and size. Targets of an
empty table: an empty table. Long texts are read whole. The list of sources goes through one task (one row a source). Other columns
are passed through; one with the name of a result gives way. Reruns agree: nothing depends on the order of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerlake.llm.common import staged

#: Tiles to a doubling of the key (any positive number is right).
TILES = 256
#: Least quality weight of a document.
LEAST_QUALITY = 0.05
RESULTS = ("size", "source_size", "target", "taken")


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality_of(text: Column) -> Column:
    """A document's quality weight: the share of its characters that are ASCII letters or lie beyond ASCII."""
    letters = F.length(F.regexp_replace(text, r"[^A-Za-z\x{80}-\x{10FFFF}]+", ""))
    return F.coalesce(F.greatest(letters / F.nullif(F.length(text), F.lit(0)), F.lit(LEAST_QUALITY)), F.lit(LEAST_QUALITY))


def uniform_of(doc_id: Column, text: Column, seed: str) -> Column:
    """A number strictly between 0 and 1 from 13 hexadecimal digits of a hash."""
    name = F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.concat(F.lit("~"), F.md5(F.coalesce(text, F.lit(""))))))
    return (F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(2.0 ** 52)


def targets(sources: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """``_source, source_size`` -> ``_source, source_size, target``; one row a source, so one task is enough for the ranks."""
    name = [F.col("_source") == "", F.col("_source")]  # '' stands for null
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sources.withColumn("weight", F.get(cycle, (F.row_number().over(Window.orderBy(*name)) - 1) % len(weights)))
    # capped sources come first in this order
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), *name)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    every = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum(most * F.col("source_size")).over(before), F.lit(0))
    shares = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = ranked.withColumn("_level", left / shares)
    free = F.col("weight") * F.col("_level") <= most * F.col("source_size")
    # the level of the first source that is not capped holds for all from there on; without words there is none
    reached = F.first(F.when(free, F.col("_level")), ignorenulls=True).over(every)
    target = F.least(F.col("weight") * reached, (most * F.col("source_size")).cast("double"))
    return level.select("_source", "source_size", target.alias("target"))


def mix(df: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        quality: Column | None = None, seed: str = "mix") -> DataFrame:
    """``df`` without its text, with ``size, source_size, target, taken`` (words of the document that the mix takes, repeats counted).

    ``quality`` is the document's sampling weight, a positive number (default: ``quality_of`` its text).
    """
    t, i = F.col(f"`{text}`"), F.col(f"`{doc_id}`")
    kept = [c for c in df.columns if c != text and c not in RESULTS]
    weight = quality_of(t) if quality is None else F.greatest(F.coalesce(quality.cast("double"), F.lit(0.0)), F.lit(1e-9))
    name = F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`").cast("string")), F.lit(""))
    docs = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_in") if kept else F.lit(None).alias("_in"), i.alias("_id"), name.alias("_source"),
                     words_of(t).alias("_size"), (-F.ln(uniform_of(i, t, seed)) / weight).alias("_key"))
    docs = staged(docs.withColumn("_tile", F.floor(F.log2("_key") * TILES)), "mix")  # texts are read once

    tiles = docs.groupBy("_source", "_tile").agg(F.sum("_size").alias("_words"))
    plan = targets(tiles.groupBy("_source").agg(F.sum("_words").alias("source_size")), weights, most)
    epochs = F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0))
    plan = plan.withColumn("_epochs", epochs).withColumn("_budget", F.round(F.col("target") - F.col("_epochs") * F.col("source_size")).cast("long"))
    running = F.sum("_words").over(Window.partitionBy("_source").orderBy("_tile").rowsBetween(Window.unboundedPreceding, 0))
    place = tiles.select("_source", "_tile", (running - F.col("_words")).alias("_before")).join(plan, "_source")

    here = docs.join(place, ["_source", "_tile"])
    along = Window.partitionBy("_source", "_tile").orderBy("_key", F.col("_id").isNull(), "_id", "_size").rowsBetween(Window.unboundedPreceding, 0)
    start = F.col("_before") + F.sum("_size").over(along) - F.col("_size")
    part = F.least(F.greatest(F.col("_budget") - start, F.lit(0)), F.col("_size"))
    taken = F.col("_epochs") * F.col("_size") + part
    out = [F.col("_in").getField(c).alias(c) for c in kept]
    return here.select(*out, F.col("_size").alias("size"), "source_size", "target", taken.cast("long").alias("taken"))
