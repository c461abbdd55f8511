import pytest
from pyspark.sql import functions as F

from offerlake.functions.price import parse_amount, parse_price, rint_round

# (price text, expected USD price) — one case per number-format branch and per policy of the price rule.
CASES = [
    ("1.299,99", 1299.99),          # European: dot thousands, comma decimals
    ("1,299.99", 1299.99),          # Anglo: comma thousands, dot decimals
    ("248,99", 248.99),             # decimal comma only
    ("1,299", 1299.0),              # comma thousands, no decimals
    ("1299.99", 1299.99),           # default branch
    ("1.690", 1.69),                # default branch reads a dot-thousands number as decimals
    ("1.299.999", None),            # unparseable -> no amount
    ("0", None),                    # not positive
    ("", None),
    (None, None),
    ("Consultar", None),
    ("$440,00 \nEl precio original era: $440,00.\n$425,00\nEl precio actual es: $425,00.\nIVA INCLUIDO", 425.0),
    ("IVA 15% $300,00", 15.0),      # the smallest positive amount wins, whatever it is
    ("$1.234,56 Inc. IVA", 1234.56),
    ("7", 7.0),                     # single digit token
]


def test_price_branches(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, raw string")
    got = {r.i: r.p for r in df.select("i", parse_price(F.col("raw")).alias("p")).collect()}
    for i, (_, exp) in enumerate(CASES):
        assert got[i] == exp, (CASES[i], got[i])


def test_golden_discount_texts(spark):
    # Before/after evidence of the reference run: list price, then discounted price; the discounted one is taken.
    pairs = [(440, 425), (210, 199), (325, 315), (350, 325), (260, 245), (189, 179), (980, 950), (590, 575)]
    rows = [(f"${a},00 \nEl precio original era: ${a},00.\n${b},00\nEl precio actual es: ${b},00.\nIVA INCLUIDO", float(b))
            for a, b in pairs]
    df = spark.createDataFrame(rows, "raw string, exp double")
    assert df.filter(parse_price(F.col("raw")) != F.col("exp")).count() == 0


def test_token_parse_unparseable(spark):
    df = spark.createDataFrame([("1.2.3",), ("12,5",), ("1,234,567.5",)], "t string")
    got = [r.v for r in df.select(parse_amount(F.col("t")).alias("v")).collect()]
    assert got == [None, 12.5, 1234567.5]


@pytest.mark.parametrize("x,digits", [(0.125, 2), (2.675, 2), (1.25, 1), (1.35, 1), (12.345, 2), (0.5, 0)])
def test_half_even_rounding_matches_numpy(spark, x, digits):
    import numpy as np
    v = spark.range(1).select(rint_round(F.lit(x), digits).alias("v")).first().v
    assert v == float(np.round(x, digits))


def test_plausibility_floor(spark):
    df = spark.createDataFrame([("IVA 15% $300,00",)], "raw string")
    r = df.select(parse_price(F.col("raw")).alias("a"), parse_price(F.col("raw"), floor=20.0).alias("b")).first()
    assert (r.a, r.b) == (15.0, 300.0)


def test_rounding_equals_python_for_every_three_decimal_amount(spark):
    from offerlake.functions.price import exact_round2, parse_price

    df = spark.range(1000, 10000).selectExpr("id / 1000d as x", "concat('$', id div 1000, '.', lpad(id % 1000, 3, '0')) as raw")
    for r in df.select("x", exact_round2(F.col("x")).alias("r"), "raw").collect():
        assert r.r == round(r.x, 2), r.x
    raw = spark.createDataFrame([("$1.055,00 o 2.675", )], "raw string")
    assert raw.select(parse_price(F.col("raw")).alias("p")).first().p is not None
