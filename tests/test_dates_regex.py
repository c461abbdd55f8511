"""Dates by shape equal dates by parser; rule patterns mean in Java what they mean in Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from offerlake.functions.dates import parse_any_date, parse_any_timestamp
from offerlake.functions.regex import java_regex
from offerlake.functions.text import collapse_ws
from offerlake import rules


def test_dates_by_shape_equal_the_parser(spark):
    texts = [None, "", "2024-02-29", "2023-02-29", "2024-02-30 10:00:00", "2024-01-01 24:00:00", "2024-01-01 23:59:60", "2024-01-01T10:00:00", "2024-01-01T10:00", "2024-01-01 10:00",
             "2024/01/31", "2024/1/31", "2024-1-1", "24-01-01", "2024-13-01", "2024-00-10", " 2024-01-01", "2024-01-01 ", "2024-01-01\n", "2024-01-01 1:00", "sin fecha",
             "٢٠٢٤-٠١-٠١", "2024-01-01 10:00:00.5", "9999-12-31", "0001-01-01", "2024/01/01 10:00", "20240101"]
    rnd = random.Random(3)
    texts += ["".join(rnd.choice("0123456789-/ T:") for _ in range(rnd.randint(8, 19))) for _ in range(300)]
    texts += [f"{rnd.randint(1, 9999):04d}{s}{rnd.randint(0, 14):02d}{s}{rnd.randint(0, 33):02d}" + rnd.choice(["", f" {rnd.randint(0, 26):02d}:{rnd.randint(0, 70):02d}"]) for s in "-/" for _ in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    wrong = df.where(~parse_any_date(F.col("t")).eqNullSafe(F.to_date(parse_any_timestamp(F.col("t"))))).collect()
    assert wrong == []
    odd = ["dd/MM/yyyy", "yyyy-MM-dd"]  # no common shape: the parser's way
    assert [str(r[0]) for r in spark.createDataFrame([("31/01/2024",), ("2024-01-31",)], "t string").select(parse_any_date(F.col("t"), odd)).collect()] == ["2024-01-31"] * 2


TEXTS = ["PC  Gamer", "pc gamer", "ＰＣ gamer", "Ryzen 5 5600X", "ryzen\x855 5600", "core ultra　7 265kf", "a​b", "x\ty \n z", "RTX 4060 TI  SÚPER", "rx 9070 gráficos é", "arc b580",
         "xeon e5 1234v3", "٣ ryzen ٥ ٥٦٠٠", "ALL-IN-ONE", "all in one", "equipo gamer", "ſs K", "", " "]


@pytest.mark.parametrize("pattern", [rules.BUNDLE_PATTERN, *(p for ps in rules.KEY_PATTERNS.values() for p in ps), r"\w+", r"[\w.]+", r"\S+", r"\D+", r"[^\s]+"])
def test_patterns_match_as_in_python(spark, pattern):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = [r[0] for r in df.select(F.regexp_extract("t", java_regex(pattern), 0)).collect()]
    assert got == [m.group(0) if (m := re.search(pattern, t)) else "" for t in TEXTS]


def test_white_space_collapses_as_in_python(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    assert [r[0] for r in df.select(collapse_ws(F.col("t"))).collect()] == [re.sub(r"\s+", " ", t).strip(" ") for t in TEXTS]
