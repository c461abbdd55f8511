"""Stable surrogate keys, incremental star loads, rates as of a date, bucketed tables."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from offerlake.operators.asof import join_as_of
from offerlake.operators.keyring import append_new
from offerlake.plans import star

STAGED = ("tienda string, pais string, moneda string, categoria string, producto string, clave_canonica string, precio_usd double, "
          "url_producto string, fecha_extraccion string")


def staged(spark, stores, day, moneda="USD"):
    rows = []
    for i, s in enumerate(stores):
        for k, price in (("ryzen 5 5600x", 100.0 + i), ("rtx 4060", 300.0 + i), ("sin_clasificar", 5.0)):
            rows.append((s, "Ecuador", moneda, "GPU" if "rtx" in k else "CPU", f"AMD {k}", k, price, None, day))
    return spark.createDataFrame(rows, STAGED)


def test_old_ids_never_move(spark, tmp_dir):
    path = os.path.join(tmp_dir, "keys")
    make = lambda names: spark.createDataFrame([(n, len(n)) for n in names], "name string, size int").repartition(3)
    first = {r.name: r.id for r in append_new(make(["m", "c", "x"]), path, "name", "id", "one").collect()}
    assert first == {"c": 1, "m": 2, "x": 3}
    second = {r.name: r.id for r in append_new(make(["a", "m", "zz", "c"]), path, "name", "id", "two").collect()}
    assert second == first | {"a": 4, "zz": 5}
    again = {r.name: r.id for r in append_new(make(["a", "m", "zz", "c"]), path, "name", "id", "two").collect()}
    assert again == second
    rows = append_new(spark.createDataFrame([(None, 1), ("b", 1)], "name string, size int"), path, "name", "id", "three").collect()
    assert {r.name: r.id for r in rows} == second | {"b": 6} and next(r.size for r in rows if r.name == "zz") == 2
    with pytest.raises(ValueError):
        append_new(make(["q"]), path, "name", "id", "../up")


def test_loads_keep_ids_and_repeat(spark, tmp_dir):
    out = os.path.join(tmp_dir, "star")
    one = star.load(staged(spark, ["Beta", "Zeta"], "2026-06-29"), out, "2026-06-29")
    ids = lambda t, n, k: {r[n]: r[k] for r in t.collect()}
    stores, products = ids(one["dim_tienda"], "nombre_tienda", "id_tienda"), ids(one["dim_producto"], "clave_canonica", "id_producto")
    facts = {r.id_hecho for r in one["fact_precios"].collect()}
    assert len(facts) == 6 and one["dim_tiempo"].count() == 1
    day2 = staged(spark, ["Alfa", "Beta"], "2026-06-30").unionByName(spark.createDataFrame(
        [("Alfa", "Peru", "USD", "CPU", "Intel", "core i5-12400", 9.0, None, "2026-06-30")], STAGED))
    for _ in range(2):  # the second time nothing changes
        two = star.load(day2, out, "2026-06-30")
        now = ids(two["dim_tienda"], "nombre_tienda", "id_tienda")
        assert stores.items() <= now.items() and now["Alfa"] == max(stores.values()) + 1 and len(now) == len(stores) + 1
        assert two["dim_tienda"].count() == len(now)
        assert ids(two["dim_producto"], "clave_canonica", "id_producto") == products | {"core i5-12400": max(products.values()) + 1}
        all_facts = two["fact_precios"].collect()
        assert len(all_facts) == len({r.id_hecho for r in all_facts}) == 13 and facts < {r.id_hecho for r in all_facts}
        assert sorted(r.id_tiempo for r in two["dim_tiempo"].collect()) == [20260629, 20260630]
        assert all(None not in (r.id_producto, r.id_tienda, r.id_fuente) for r in all_facts)


def test_facts_take_the_rate_of_their_day(spark, tmp_dir):
    rates = spark.createDataFrame([("2026-06-01", "USD", "EUR", 0.5), ("2026-06-20", "USD", "EUR", 0.8), ("2026-06-30", "USD", "EUR", 0.9)], "fecha string, base string, moneda string, tasa double")
    rows = [("E", "Espana", m, "CPU", "AMD x", "ryzen 5 5600x", p, None, d) for m, p, d in (
        ("EUR", 50.0, "2026-05-31"), ("EUR", 51.0, "2026-06-01"), ("EUR", 52.0, "2026-06-19"), ("EUR", 53.0, "2026-06-25"), ("USD", 54.0, "2026-06-25"), ("GBP", 55.0, "2026-06-25"))]
    got = star.load(spark.createDataFrame(rows, STAGED), os.path.join(tmp_dir, "s"), "r1", rates=rates)["fact_precios"].collect()
    by = {float(r.precio_original): (None if r.tasa_cambio_usd is None else float(r.tasa_cambio_usd), None if r.precio_usd is None else float(r.precio_usd), str(r.fecha_tasa)) for r in got}
    assert by == {50.0: (None, None, "None"), 51.0: (0.5, 102.0, "2026-06-01"), 52.0: (0.5, 104.0, "2026-06-01"), 53.0: (0.8, 66.25, "2026-06-20"),
                  54.0: (1.0, 54.0, "2026-06-25"), 55.0: (None, None, "None")}


def test_as_of_equals_a_scan(spark):
    rnd = random.Random(0)
    day = lambda: dt.date(2026, 1, 1) + dt.timedelta(days=rnd.randint(0, 60)) if rnd.random() > 0.05 else None
    cur = lambda: "hot" if rnd.random() < 0.5 else rnd.choice(["a", "b", None, "none"])
    quotes = [(c, d, rnd.random()) for c, d in ((cur(), day()) for _ in range(60)) if c != "none"]
    rows = [(i, cur(), day()) for i in range(400)]
    df = join_as_of(spark.createDataFrame(rows, "i int, moneda string, fecha date"), spark.createDataFrame(quotes, "moneda string, fecha_tasa date, tasa double"))
    for r in df.collect():
        fit = [(d, t) for c, d, t in quotes if None not in (c, d, r.moneda, r.fecha) and c == r.moneda and d <= r.fecha]
        assert (r.fecha_tasa, r.tasa) == (max(fit) if fit else (None, None))
    assert df.count() == 400


def test_bucketed_facts_need_no_exchange(spark, tmp_dir):
    tables = star.load(staged(spark, ["Beta", "Zeta", "Eta"], "2026-06-29"), os.path.join(tmp_dir, "star"), "r")
    names = star.bucketed(spark, tables, os.path.join(tmp_dir, "buckets"), 4, prefix="prueba")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = star.prices_by_product(spark, names)
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    got = {r.clave_canonica: (r.ofertas, float(r.precio_min), float(r.precio_max)) for r in df.collect()}
    assert got["rtx 4060"] == (3, 300.0, 302.0) and len(got) == 3
    for n in names.values():
        spark.sql(f"DROP TABLE {n}")
