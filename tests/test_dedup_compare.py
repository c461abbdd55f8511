import random


from offerlake.operators.compare import best_prices, top_savings
from offerlake.operators.dedup import keep_first, keep_most_complete

COLS = "tienda string, categoria string, clave_canonica string, precio_usd double, producto string, url_producto string"


def test_most_complete_survives(spark):
    rows = [
        ("A", "CPU", "ryzen 5 5600x", 100.0, "p1", None),
        ("A", "CPU", "ryzen 5 5600x", 100.0, "p1", "http://u"),   # more complete: kept
        ("A", "CPU", "ryzen 5 5600x", 101.0, "p1", None),         # other price: own key
        (None, "CPU", "k", 5.0, "x", None),                        # null keys group together
        (None, "CPU", "k", 5.0, "y", None),
    ]
    out = keep_most_complete(spark.createDataFrame(rows, COLS))
    got = sorted(out.collect(), key=lambda r: (r.tienda or "", r.precio_usd, r.producto))
    assert len(got) == 3
    assert [r.url_producto for r in got if r.tienda == "A" and r.precio_usd == 100.0] == ["http://u"]
    assert [r.producto for r in got if r.tienda is None] == ["x"]   # tie: smallest row wins


def test_dedup_is_idempotent_and_order_independent(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice("ABC"), "CPU", rnd.choice(["k1", "k2", "sin_clasificar"]), float(rnd.randint(1, 5)),
             f"t{rnd.randint(0, 3)}", rnd.choice([None, "u"])) for _ in range(300)]
    a = keep_most_complete(spark.createDataFrame(rows, COLS))
    rnd.shuffle(rows)
    b = keep_most_complete(spark.createDataFrame(rows, COLS).repartition(7))
    assert sorted(a.collect()) == sorted(b.collect())
    assert sorted(keep_most_complete(a).collect()) == sorted(a.collect())


def test_keep_first(spark):
    df = spark.createDataFrame([("m", 3, "c"), ("m", 1, "a"), ("n", 2, "b")], "modelo string, _row int, v string")
    assert sorted((r.modelo, r.v) for r in keep_first(df, "modelo", ["_row"]).collect()) == [("m", "a"), ("n", "b")]


def test_best_prices(spark):
    rows = [
        ("Tienda1", "CPU", "ryzen 5 5600x", 120.0, "Procesador Ryzen 5 5600X caja", None),
        ("Tienda2", "CPU", "ryzen 5 5600x", 100.0, "RYZEN 5 5600X" + "x" * 80, None),
        ("Tienda3", "CPU", "ryzen 5 5600x", 100.0, "ryzen 5 5600x tray", None),   # tie on price: store name decides
        ("Tienda1", "GPU", "rtx 4060", 300.0, "RTX 4060", None),                  # one store only: excluded
        ("Tienda1", "GPU", "rtx 4060", 310.0, "RTX 4060 OC", None),
        ("Tienda1", "RAM", "sin_clasificar", 50.0, "DDR5", None),
        ("Tienda2", "RAM", "sin_clasificar", 40.0, "DDR5", None),
    ]
    res = best_prices(spark.createDataFrame(rows, COLS)).collect()
    assert len(res) == 1
    r = res[0]
    assert (r.clave_canonica, r.tiendas_comparadas, r.tienda_mas_barata) == ("ryzen 5 5600x", 3, "Tienda2")
    assert (r.precio_min_usd, r.precio_max_usd, r.ahorro_usd, r.ahorro_pct) == (100.0, 120.0, 20.0, 16.7)
    assert len(r.producto_ejemplo) == 70


def test_top_savings_limit(spark):
    rows = [(f"S{i % 3}", "CPU", f"k{i // 3}", float(10 + i), "t", None) for i in range(60)]
    top = top_savings(best_prices(spark.createDataFrame(rows, COLS)), 10).collect()
    assert len(top) == 10
    assert [r.ahorro_usd for r in top] == sorted([r.ahorro_usd for r in top], reverse=True)


def test_hot_key_dedup_and_compare(spark):
    # One key holds a third of all rows; results must equal a plain Python computation.
    rows = []
    for i in range(3000):
        if i % 3 == 0:
            rows.append(("S%d" % (i % 5), "CPU", "ryzen 5 5600x", float(100 + i % 7), f"t{i % 11}", None if i % 2 else "u"))
        else:
            rows.append(("S%d" % (i % 5), "GPU", f"rtx {4000 + i % 50}", float(200 + i % 13), f"g{i % 3}", "u"))
    df = spark.createDataFrame(rows, COLS).repartition(6)
    out = keep_most_complete(df).collect()
    expect = {}
    for r in rows:
        k = r[:4]
        cand = (-sum(v is not None for v in r), tuple((v is not None, v) for v in r))
        if k not in expect or cand < expect[k][0]:
            expect[k] = (cand, r)
    assert sorted(tuple(r) for r in out) == sorted(v[1] for v in expect.values())
    best = {r.clave_canonica: r for r in best_prices(keep_most_complete(df)).collect()}
    hot = [r for r in expect.values() if r[1][2] == "ryzen 5 5600x"]
    cheapest = min(hot, key=lambda v: (v[1][3], v[1][0], v[1][4]))[1]
    assert best["ryzen 5 5600x"].tienda_mas_barata == cheapest[0]
    assert best["ryzen 5 5600x"].precio_min_usd == cheapest[3]


def test_split_unclassified_option(spark):
    from offerlake.operators.dedup import keep_most_complete_offers
    rows = [("A", "RAM", "sin_clasificar", 50.0, "DDR4 8GB", None), ("A", "RAM", "sin_clasificar", 50.0, "DDR5 16GB", None),
            ("A", "CPU", "ryzen 5 5600x", 90.0, "t1", None), ("A", "CPU", "ryzen 5 5600x", 90.0, "t2", "u")]
    df = spark.createDataFrame(rows, COLS)
    assert keep_most_complete_offers(df).count() == 2
    split = keep_most_complete_offers(df, split_unclassified=True).collect()
    assert len(split) == 3 and {r.producto for r in split if r.categoria == "CPU"} == {"t2"}


def test_conversion_after_dedup_equals_conversion_before(spark):
    # staged() converts currencies after dedup; the converted columns follow from precio_usd (a dedup key), so the
    # survivors must equal dedup over already-converted rows, column for column.
    from offerlake.plans import offers as chain
    from offerlake.sources.tables import Tables
    from tests.conftest import SF_SMOKE

    view = chain.offer_view_with_copies(Tables(spark, SF_SMOKE))
    after = chain.staged(view)
    before = keep_most_complete(chain.staged_before_dedup(view))
    assert after.columns == before.columns
    assert after.count() == before.count() > 0
    assert after.exceptAll(before).count() == 0 and before.exceptAll(after).count() == 0


def test_dedup_metrics_counts_key_groups(spark):
    # Survivors are counted as key groups; with a hot key and null keys this must equal the dedup's own row count.
    from offerlake.operators.quality import dedup_metrics
    rows = [("S1", "CPU", "ryzen 5 5600x", 90.0, f"t{i % 4}", None) for i in range(300)]
    rows += [(None, "GPU", None, 10.0 + i % 3, "g", "u") for i in range(9)] + [("S2", None, "k", None, "x", None)] * 2
    df = spark.createDataFrame(rows, COLS).repartition(5)
    m = dedup_metrics(df).collect()[0]
    assert (m.antes, m.despues) == (df.count(), keep_most_complete(df).count()) == (311, 5)
    assert m.duplicados_eliminados == 306


def test_dedup_sorts_by_a_number_first(spark):
    from offerlake.operators.dedup import keep_most_complete
    rows = [("t", "CPU", "k", 0.0, "a"), ("t", "CPU", "k", -0.0, "b"), ("t", "CPU", "k", float("nan"), "c"), ("t", "CPU", "k", float("nan"), None),
            (None, "CPU", "k", 1.0, "d"), (None, "CPU", "k", 1.0, "e"), ("t", None, "k", 1.0, "f")]
    got = keep_most_complete(spark.createDataFrame(rows, "tienda string, categoria string, clave_canonica string, precio_usd double, producto string"))
    assert got.columns == ["tienda", "categoria", "clave_canonica", "precio_usd", "producto"]
    assert sorted(r.producto for r in got.collect()) == ["a", "c", "d", "f"]
    assert "Aggregate [xxhash64(" in got._jdf.queryExecution().analyzed().toString()
