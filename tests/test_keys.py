from pyspark.sql import functions as F

from offerlake.functions.keys import canonical_key
from offerlake.operators.staging import add_canonical_key

CASES = [
    ("PROCESADOR AMD RYZEN 5 8500G AM5 3.5GHZ", "CPU", "ryzen 5 8500g"),
    ("Procesador AMD Ryzen 5 8500G con graficos", "CPU", "ryzen 5 8500g"),
    ("Procesador Intel Core i7-14700K", "CPU", "core i7-14700k"),
    ("Procesador Intel Core i7 14700K", "CPU", "core i7 14700k"),
    ("PROCESADOR INTEL CORE ULTRA 7 265KF - BASE 3.9 GHZ", "CPU", "core ultra 7 265kf"),
    ("Tarjeta de Video RTX 5070 Ti GAMING", "GPU", "rtx 5070 ti g"),     # artefact of the GPU pattern, kept
    ("ZOTAC GEFORCE RTX 5090 32GB GDDR7", "GPU", "rtx 5090 32gb"),
    ("Tarjeta rx 9070 gráficos", "GPU", "rx 9070 gráficos"),            # Unicode word characters
    ("Intel Arc B580 12GB", "GPU", "arc b580"),
    ("Procesador AMD Ryzen 7 7700 (3.8GHz) [caja]", "CPU", "ryzen 7 7700"),
    ("Ryzen 5 5600X", "CPU", "ryzen 5 5600x"),                # NBSP is whitespace
    ("Memoria RAM DDR5 16GB", "RAM", "sin_clasificar"),                  # only CPU and GPU are keyed
    ("Tarjeta RTX 4060", "CPU", "sin_clasificar"),                      # a GPU filed under CPU stays unkeyed
    (None, "CPU", "sin_clasificar"),
    ("", "GPU", "sin_clasificar"),
    ("Procesador Intel", "CPU", "sin_clasificar"),
]


def test_key_cases(spark):
    df = spark.createDataFrame([(i, t, c) for i, (t, c, _) in enumerate(CASES)], "i int, producto string, categoria string")
    got = {r.i: r.clave_canonica for r in add_canonical_key(df).collect()}
    single = {r.i: r.k for r in df.select("i", canonical_key(F.col("producto"), F.col("categoria")).alias("k")).collect()}
    for i, (_, _, exp) in enumerate(CASES):
        assert got[i] == exp, CASES[i]
        assert single[i] == exp, CASES[i]


def test_generic_and_digit_free_matches_fall_through(spark):
    patterns = {"CPU": [r"core", r"core\s*i\d"]}
    df = spark.createDataFrame([("Intel Core i5 12400",), ("Intel Core",)], "producto string").withColumn("categoria", F.lit("CPU"))
    got = [r.k for r in df.select(canonical_key(F.col("producto"), F.col("categoria"), patterns).alias("k")).collect()]
    assert got == ["core i5", "sin_clasificar"]
