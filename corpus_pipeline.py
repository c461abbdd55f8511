"""Documents to packed training sequences: quality, language, near duplicates, secrets, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame: all but the last the columns of documents. ``run`` writes each
stage's result to the shared folder and reads it back as the next one's documents. Rows are told apart by their place in the
stage's input, so null or repeated ids are kept apart; columns beyond those of documents are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake.llm import lang_id, line_crf, ngram_jaccard, packing, secret_scan
from offerlake.llm.common import crc_of_id, staged, table
from offerlake.llm.queries import vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document stays from this quality on, and if one language covers this share of its letters and its trigrams account for
#: them (``lang_id``'s score: the share, less where the text is unlike what was learned).
QUALITY, LANGUAGE = 0.7, 0.4


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the line field scores below QUALITY."""
    docs = docs.select(*COLUMNS)
    model = line_crf.fit(docs, table(spark, sf_dir, "labels"), crc_of_id(F.col("id")) % 4 != 2)
    return line_crf.score(docs, model, out="_score").where(F.col("_score") >= QUALITY).select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters, and those with a language score below LANGUAGE: mixtures, scripts and languages that
    were not learned, gibberish."""
    docs = docs.select(*COLUMNS)
    model = lang_id.fit(docs.where(crc_of_id(F.col("doc_id")) % 5 != 0))
    if not model["langs"]:  # nothing to judge by
        return docs
    labelled = lang_id.predict(docs, model, spans=False)
    return labelled.where((F.col("lang_pred") != "und") & (F.col("lang_score") >= LANGUAGE)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group: the one with the smallest id, the first of equal ones."""
    rows = staged(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()), "numbered")
    groups = ngram_jaccard.similar(rows, "_row").select("_row", "component_id").join(rows.select("_row", "doc_id"), "_row")
    first = groups.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row"))["_row"].alias("_row"))
    return rows.join(first.select("_row"), "_row", "left_semi").select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets by their kind; n_chars follows the text where it changed."""
    clean = secret_scan.redact(docs.select(*COLUMNS, F.col("text").alias("_text")))
    changed = ~F.col("text").eqNullSafe(F.col("_text"))
    n_chars = F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", n_chars).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces with their token ids."""
    packed = packing.pack_documents(docs.select("doc_id", "text"), vocabulary("word_bpe_49k.json"), ids=True)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates), ("secrets", secrets), ("packing", pack)]

#: Language models, min-hashes and the tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
