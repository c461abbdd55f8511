from pyspark.sql import functions as F

from offerlake.operators.median import exact_median
from offerlake.operators.normalize import invalid_categories, normalize_columns, standardize
from offerlake.operators.survey import impute_budget, stage_survey, survey_nulls

SURVEY = "id_anonimo string, ciudad string, categoria_interes string, presupuesto_usd string"


def test_median_imputation(spark):
    rows = [
        ("1", "Quito", "CPU", "100"), ("2", "Quito", "CPU", "200"), ("3", None, "CPU", None),       # even group: 150
        ("4", "Loja", "GPU", "10"), ("5", "Loja", "GPU", "abc"), ("6", "Loja", "GPU", "30"), ("7", "Loja", "GPU", "20"),
        ("8", "Loja", "SSD", None), ("9", "Loja", "SSD", None),                                     # all null: stays null
        ("10", "Loja", None, "77"),                                                                  # null group keeps value
    ]
    df = spark.createDataFrame(rows, SURVEY)
    got = {r.id_anonimo: (r.ciudad, r.presupuesto_usd) for r in stage_survey(df).collect()}
    assert got["3"] == ("No especificada", 150.0)
    assert got["5"][1] == 20.0
    assert got["8"][1] is None and got["9"][1] is None
    assert got["10"][1] == 77.0
    n = survey_nulls(df).first()
    assert (n.registros, n.presupuesto_imputado, n.ciudad_imputada) == (10, 4, 1)
    assert impute_budget(df).columns == df.columns


def test_exact_median_of_skewed_groups(spark):
    import random
    import statistics
    rng = random.Random(7)
    groups = {"hot": [rng.choice([-3.5, 0.0, 1e-9, 2.0, 2.0000001, 7e8]) for _ in range(3000)], "even": [1.0, 2.0], "one": [-4.0],
              "wide": [rng.uniform(-1e6, 1e6) for _ in range(400)], None: [5.0, 6.0, 9.0], "tied": [3.0] * 10}
    rows = [(g, x) for g, xs in groups.items() for x in xs] + [("hot", None), ("empty", None), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    got = {r.g: (r.filas, r.mediana) for r in exact_median(df, "g", "x").collect()}
    want = {g: (len(xs), statistics.median(xs)) for g, xs in groups.items()} | {"empty": (2, None)}
    want["hot"] = (3001, want["hot"][1])
    assert got == want
    assert exact_median(df.limit(0), "g", "x").count() == 0


def test_normalize_aliases(spark):
    df = spark.createDataFrame([("S", None, "Nombre B", "$10", "u", "2026-01-01", "x")],
                               "store string, nombre string, name string, price string, url string, fecha string, extra string")
    out = normalize_columns(df)
    assert set(out.columns) == {"tienda", "producto", "precio_raw", "url_producto", "fecha_extraccion", "pais", "moneda",
                                "categoria", "extra"}
    r = out.first()
    assert (r.tienda, r.producto, r.precio_raw, r.pais) == ("S", "Nombre B", "$10", None)


def test_standardize_and_invalid_categories(spark):
    df = spark.createDataFrame([("  a\n b  c ", " gpu ", "T", "$1"), (None, "Accesorio", "T", None)],
                               "producto string, categoria string, tienda string, precio_raw string")
    s = standardize(df)
    rows = s.collect()
    assert rows[0].producto == "a b c" and rows[0].categoria == "GPU"
    assert rows[1].producto is None
    assert [r.categoria for r in invalid_categories(s).collect()] == ["ACCESORIO"]
