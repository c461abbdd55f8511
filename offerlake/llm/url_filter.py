"""URL filter: host and path rules first, then a character language-model ratio. DataFrame functions only.

URLs that a rule decides train two smoothed variable-order Markov models, one of the accepted and one of the rejected
URLs. A context of up to four characters is kept if at least one in ``1 / SUPPORT`` training positions follows it, so an
order has at most ``SUPPORT`` contexts, however large the corpus is. A kept context's next-character distribution is
interpolated with that of its suffix: P_k(c) = (n(c) + M * P_{k-1}(c)) / (n + M), down to the uniform distribution. A URL's
score is the sum of ln P_accept - ln P_reject over its characters, each in its longest kept context, divided by their
number. One in HELD_OUT of the rule-decided URLs, by hash, is kept from the models; the cut is calibrated on those: the one with the
best mean of both classes' hit rates.

Counting combines map-side. The model (bounded as above: 4 * SUPPORT + 1 rows of one short array) is broadcast, so scoring
moves one row per URL and no characters. Only a row number and the URL go through the model.

Defined cases: a null URL or one without ``://`` has an empty host and path and fits no rule; the model judges it by its
characters, a null one as empty by its end mark alone; repeated rows are judged each; a null page id is carried through; without training URLs of both kinds every score
is 0 and the verdict is allow; an empty table gives an empty one; equal cuts go to the lowest. Other columns are passed through, whatever
their names; one with the name of a result gives way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlake.llm.common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path prefix); the longest fitting rule wins.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Characters told apart; any other counts as ``*``. ``^`` pads the start, ``$`` ends a URL.
SYMBOLS = LOWER + "0123456789-._~/:?=&%#@+*$"
ORDER = 4
SUPPORT = 4000
#: Weight of the shorter context.
M = 4.0
#: Steps of the calibrated cut, per nat.
STEPS = 500
#: One in so many rule-decided URLs calibrates the cut.
HELD_OUT = 5


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _grams(col: Column) -> Column:
    """Every character of the text and its end mark, each with the ORDER characters before it."""
    known = F.regexp_replace(F.translate(col, UPPER, LOWER), r"(?s)[^a-z0-9\-._~/:?=&%#@+]", "*")
    padded = F.concat(F.lit("^" * ORDER), known, F.lit("$"))
    return F.transform(F.sequence(F.lit(1), F.length(col) + 1), lambda i: F.substr(padded, i, F.lit(ORDER + 1)))


def _context(gram: Column, k: int) -> Column:
    return F.substr(gram, F.lit(ORDER + 1 - k), F.lit(k))


def _symbol(gram: Column) -> Column:
    return F.instr(F.lit(SYMBOLS), F.substr(gram, F.lit(ORDER + 1), F.lit(1))) - 1


def fit(labelled: DataFrame, text: str, verdict: str) -> list[DataFrame] | None:
    """Models of orders 0 to ORDER: rows (ctx, p_allow, p_block, ratio); None if a class has no URL."""
    counts = staged(labelled.select(F.col(verdict).alias("v"), F.explode(_grams(F.col(text))).alias("g"))
                    .groupBy("g").agg(F.count_if(F.col("v") == "allow").alias("a"), F.count_if(F.col("v") == "block").alias("b")), "url-grams")
    total = counts.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    if not total["a"] or not total["b"]:
        return None
    least = (total["a"] + total["b"]) / SUPPORT
    size = len(SYMBOLS)
    models: list[DataFrame] = []
    for k in range(ORDER + 1):
        rows = (counts.groupBy(_context(F.col("g"), k).alias("ctx"), _symbol(F.col("g")).alias("s")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
                # at most one entry per symbol
                .groupBy("ctx").agg(F.map_from_entries(F.collect_list(F.struct("s", F.struct("a", "b")))).alias("n"), F.sum("a").alias("na"), F.sum("b").alias("nb"))
                .where(F.col("na") + F.col("nb") >= least))
        if k:
            shorter = models[-1].select(F.col("ctx").alias("suffix"), F.col("p_allow").alias("qa"), F.col("p_block").alias("qb"))
            rows = rows.withColumn("suffix", F.substr("ctx", F.lit(2), F.lit(ORDER))).join(shorter, "suffix")
        else:
            uniform = F.array_repeat(F.lit(1.0 / size), size)
            rows = rows.withColumns({"qa": uniform, "qb": uniform})

        def smoothed(field: str, n: str, q: str) -> Column:
            return F.transform(F.sequence(F.lit(0), F.lit(size - 1)),
                               lambda i: (F.coalesce(F.element_at("n", i)[field], F.lit(0)) + M * F.get(F.col(q), i)) / (F.col(n) + M))

        rows = rows.select("ctx", smoothed("a", "na", "qa").alias("p_allow"), smoothed("b", "nb", "qb").alias("p_block"))
        models.append(staged(rows.withColumn("ratio", F.zip_with("p_allow", "p_block", lambda a, b: F.log(a) - F.log(b))), f"url-model-{k}"))
    return models


def score(rows: DataFrame, models: list[DataFrame] | None) -> DataFrame:
    """``_row, _text`` -> ``_row, score``: the mean log ratio of the characters of ``_text``."""
    if models is None:
        return rows.select("_row", F.lit(0.0).alias("score"))
    grams = rows.select("_row", F.explode(_grams(F.col("_text"))).alias("_g"))
    for k in range(ORDER, -1, -1):
        # bounded: SUPPORT contexts an order
        model = F.broadcast(models[k].select(F.col("ctx").alias(f"_c{k}"), F.col("ratio").alias(f"_r{k}")))
        grams = grams.join(model, _context(F.col("_g"), k) == F.col(f"_c{k}"), "left")
    ratio = F.get(F.coalesce(*[F.col(f"_r{k}") for k in range(ORDER, -1, -1)]), _symbol(F.col("_g")))
    return grams.groupBy("_row").agg(F.avg(ratio).alias("score"))


def cut(scored: DataFrame, verdict: str) -> float:
    """The score from which URLs are allowed: the step with the best mean hit rate on both classes (the lowest of equals)."""
    steps = (scored.where(F.col(verdict).isNotNull())
             .groupBy(F.floor(F.greatest(F.lit(-20.0), F.least(F.lit(20.0), "score")) * STEPS).alias("at"))
             .agg(F.count_if(F.col(verdict) == "allow").alias("a"), F.count_if(F.col(verdict) == "block").alias("b")))
    # at most 40 * STEPS + 1 rows
    best = steps.selectExpr("at", "sum(a) over (order by at desc) / nullif(sum(a) over (), 0) as hit", "1 - sum(b) over (order by at desc) / nullif(sum(b) over (), 0) as kept_out").orderBy(F.desc(F.col("hit") + F.col("kept_out")), "at").first()
    return 0.0 if best is None or best["hit"] is None or best["kept_out"] is None else best["at"] / STEPS


def held_out(text: Column) -> Column:
    """Whether a rule-decided URL is kept from the models for the cut: one in HELD_OUT, by a hash of the URL."""
    return F.pmod(F.xxhash64(text), F.lit(HELD_OUT)) == 0


def judge(pages: DataFrame, url: str = "url", rules=RULES) -> DataFrame:
    """Add host, path, rule, verdict and score to ``pages``. Rules read host and path, the model reads the whole url.

    The models are fitted on four fifths of the rule-decided URLs and the cut is chosen on the rest; where a part lacks one of the
    verdicts, all of them serve instead.
    """
    results = ("host", "path", "rule", "verdict", "score")
    kept = [c for c in pages.columns if c not in results or c == url]
    base = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_in"), F.col(f"`{url}`").alias("_url"))
    rule, given = rule_of(F.col("host"), F.col("path"), rules)
    base = base.withColumns({"host": host_of(F.col("_url")), "path": path_of(F.col("_url"))})
    base = base.select("_in", "host", "path", rule.alias("rule"), given.alias("_given"), F.coalesce("_url", F.lit("")).alias("_text"))
    base = staged(base.withColumn("_row", F.monotonically_increasing_id()), "url-rows")
    decided = base.where(F.col("_given").isNotNull())
    models = fit(decided.where(~held_out(F.col("_text"))), "_text", "_given") or fit(decided, "_text", "_given")
    scores = staged(score(base.select("_row", "_text"), models), "url-scores")
    judged = base.join(scores, "_row")
    calibration = judged.where(F.col("_given").isNotNull() & held_out(F.col("_text")))
    both = calibration.agg(F.count_distinct("_given")).first()[0] == 2
    at = cut(calibration if both else judged, "_given")
    verdict = F.coalesce("_given", F.when(F.col("score") >= at, "allow").otherwise("block"))
    out = [c for c in kept if c not in results]
    return judged.select(*[F.col("_in").getField(c).alias(c) for c in out], "host", "path", "rule", verdict.alias("verdict"), "score")
