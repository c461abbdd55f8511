import csv
import json
import os

from pyspark.sql import functions as F

from offerlake.plans import pipeline
from offerlake.sources.files import rates_from_files, read_questionnaire
from offerlake.sources.offers import read_raw_offers
from offerlake.streaming import land_drops
from offerlake import rules

HEADER = ["tienda", "pais", "moneda", "categoria", "keyword_busqueda", "producto", "precio_raw", "url_producto",
          "fecha_extraccion"]
PRICE = "${a},00 \nEl precio original era: ${a},00.\n${b},00\nEl precio actual es: ${b},00.\nIVA INCLUIDO"


def _write_csv(path, header, rows, bom=True):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8-sig" if bom else "utf-8") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)


def _offer_files(root):
    a = os.path.join(root, "raw", "scraping", "tiendaa", "tiendaa_2026-06-30.csv")
    _write_csv(a, HEADER, [
        ["TiendaA", "Ecuador", "USD", "CPU", "procesador", "Procesador AMD Ryzen 5 8500G AM5", PRICE.format(a=210, b=199), "u1", "2026-06-30 01:53:05"],
        ["TiendaA", "Ecuador", "USD", "CPU", "procesador", "Procesador AMD Ryzen 5 8500G AM5", PRICE.format(a=210, b=199), "", "2026-06-30 01:53:05"],
        ["TiendaA", "Ecuador", "USD", "GPU", "tarjeta de video", "PC Gamer con RTX 4060", "$900,00", "u3", "2026-06-30 01:53:05"],
        ["TiendaA", "Ecuador", "USD", "Monitor", "monitor", "Monitor  LG 24", "", "u4", "garbage"],
    ])
    b = os.path.join(root, "raw", "scraping", "tiendab", "tiendab_2026-06-30.csv")
    _write_csv(b, ["store", "categoria", "name", "price", "url", "fecha"], [
        ["TiendaB", "CPU", "PROCESADOR AMD RYZEN 5 8500G 3.5GHZ", "1.250,50", "v1", "2026-06-29"],
    ], bom=False)
    return [os.path.dirname(a), os.path.dirname(b)]


def test_raw_read_and_union(spark, tmp_dir):
    paths = _offer_files(tmp_dir)
    raw = read_raw_offers(spark, paths)
    assert raw.count() == 5
    assert "store" in raw.columns and "tienda" in raw.columns
    first = raw.filter(F.col("url_producto") == "u1").first()
    assert first.precio_raw.startswith("$210,00 \nEl precio")        # quoted multi-line field kept whole
    assert raw.filter(F.col("url_producto") == "u4").first().precio_raw is None   # empty field -> null


def test_fx_files_and_fallback(spark, tmp_dir):
    d = os.path.join(tmp_dir, "api")
    os.makedirs(d)
    for day, eur in (("2026-06-29", 0.5), ("2026-06-30", 0.86)):
        doc = {"latest": {"amount": 1.0, "base": "USD", "date": day, "rates": {"EUR": eur, "GBP": 0.74}},
               "historico": {"base": "USD", "rates": {day: {"EUR": eur}}}}
        with open(os.path.join(d, f"fx_{day}.json"), "w") as f:
            json.dump(doc, f, indent=2)
    got = {r.moneda: r.tasa for r in rates_from_files(spark, d).collect()}
    assert got == {"EUR": 0.86, "GBP": 0.74}
    fb = {r.moneda: r.tasa for r in rates_from_files(spark, os.path.join(tmp_dir, "missing")).collect()}
    assert fb == rules.FALLBACK_RATES


def test_questionnaire(spark, tmp_dir):
    p = os.path.join(tmp_dir, "instrumento.json")
    asked = [("ciudad", "Where?", "opcion"), ("presupuesto_usd", "How much?", "numerico"), ("importancia_precio", "How dear?", "escala")]
    doc = {"titulo": "A test questionnaire", "anonimo": True,
           "preguntas": [{"campo": c, "pregunta": q, "tipo": t} for c, q, t in asked]}
    with open(p, "w", encoding="utf-8") as f:
        json.dump(doc, f, ensure_ascii=False, indent=2)
    q = read_questionnaire(spark, p).orderBy("orden").collect()
    assert len(q) == 3 and q[0].campo == "ciudad" and q[-1].tipo == "escala"


def test_pipeline_end_to_end(spark, tmp_dir):
    paths = _offer_files(tmp_dir)
    api = os.path.join(tmp_dir, "api_none")
    survey = os.path.join(tmp_dir, "survey", "encuesta_hardware_2026-06-30.csv")
    _write_csv(survey, ["id_anonimo", "fecha_respuesta", "ciudad", "rango_edad", "ocupacion", "categoria_interes",
                        "presupuesto_usd", "marca_preferida", "canal_preferido", "tienda_habitual",
                        "frecuencia_compra_anual", "importancia_precio"],
               [["ENC-0001", "2026-06-20 10:00", "Quito", "18-24", "Gamer", "CPU", "100", "AMD", "Online", "MTEC", "1-2", "5"],
                ["ENC-0002", "2026-06-20 11:00", "", "18-24", "Gamer", "CPU", "", "AMD", "Online", "MTEC", "1-2", "4"],
                ["ENC-0003", "2026-06-20 12:00", "Loja", "25-34", "Otro", "CPU", "300", "Intel", "Ambos", "Otra", "3-5", "3"]])
    specs = os.path.join(tmp_dir, "specs", "cpu_specs_amd_2026-06-30.csv")
    _write_csv(specs, ["Model", "# of CPU Cores", "# of Threads", "Default TDP", "Base Clock", "CPU Socket", "Extra"],
               [["AMD Ryzen™ 5 8500G", "6", "12", "65W", "3.5GHz", "AM5", "x"], ["AMD Ryzen™ 5 8500G", "6", "12", "65W", "3.5GHz", "AM5", "y"],
                ["", "4", "", "", "", "", ""]])
    out = pipeline.run(spark, paths, api, os.path.join(tmp_dir, "out"), "2026-06-30", os.path.dirname(survey),
                       os.path.dirname(specs))
    staged = spark.read.parquet(out["stg_precios"])
    # 5 raw - 1 bundle - 1 unpriced - 1 duplicate = 2 staged
    assert staged.count() == 2
    assert sorted(r.clave_canonica for r in staged.collect()) == ["ryzen 5 8500g", "ryzen 5 8500g"]
    cmp = spark.read.parquet(out["comparador_mejor_precio"]).collect()
    assert len(cmp) == 1 and cmp[0].tienda_mas_barata == "TiendaA" and cmp[0].ahorro_usd == 1051.5
    rep = spark.read.json(out["reporte_calidad"]).first()
    assert (rep.total_registros_raw, rep.registros_descartados_relevancia, rep.registros_eliminados_nulos,
            rep.registros_depurados_duplicados, rep.total_registros_staging) == (5, 1, 1, 1, 2)
    assert rep.tasa_error_pct == 60.0
    enc = {r.id_anonimo: (r.ciudad, r.presupuesto_usd) for r in spark.read.parquet(out["stg_encuesta"]).collect()}
    assert enc["ENC-0002"] == ("No especificada", 200.0)
    assert spark.read.parquet(out["stg_cpu_specs"]).count() == 1
    log = spark.read.parquet(out["errores_pipeline"]).collect()
    assert {r.fuente for r in log} == {"Staging:relevancia", "Staging:encuesta", "Staging:fechas", "Staging:currency"}
    assert next(r.descripcion for r in log if r.fuente == "Staging:fechas").startswith("1 ")
    long = {(r.seccion, r.clave): r for r in spark.read.parquet(out["reporte_calidad_largo"]).collect()}
    assert [long["duplicados", k].valor for k in ("antes", "despues", "duplicados_eliminados")] == [3, 2, 1]
    assert long["duplicados", "criterio"].texto and long["conversion", "no_parseables"].valor == 1
    assert long["tienda", "TiendaA"].valor == 1 and long["categoria", "CPU"].valor == 2
    assert long["metricas", "total_registros_raw"].valor == 5 and long["encuesta", "presupuesto_imputado"].valor == 1
    assert long["especificaciones", "registros"].valor == 1
    assert rep.claves_distintas == 1 and rep.cobertura_clave_canonica_pct == 100.0 and rep.tasa_completitud_general_pct == 100.0
    assert {r.detalle for r in log} >= {"1 ofertas con fecha nula o en otro formato"}

    # the same run once more changes nothing; another day's run leaves it alone
    def everything():
        read = lambda k: spark.read.json(out[k]) if k == "reporte_calidad" else spark.read.parquet(out[k])
        return {k: sorted(map(str, read(k).where(F.col("corrida") == "2026-06-30").collect())) for k in out}

    before = everything()
    args = (spark, paths, api, os.path.join(tmp_dir, "out"))
    again = dict(survey_path=os.path.dirname(survey), specs_path=os.path.dirname(specs))
    pipeline.run(*args, "2026-06-30", **again)
    assert everything() == before and spark.read.parquet(out["errores_pipeline"]).count() == len(log)
    pipeline.run(*args, "2026-07-01", **again)
    assert everything() == before and spark.read.parquet(out["stg_precios"]).count() == 4


def test_rate_faults_are_logged_and_others_raised(spark, tmp_dir):
    import json

    from offerlake.sources.files import fx_faults
    assert [r.tipo_error for r in fx_faults(spark, os.path.join(tmp_dir, "none")).collect()] == ["Fuente"]
    bad, good = os.path.join(tmp_dir, "bad"), os.path.join(tmp_dir, "good")
    for folder, text in ((bad, "{broken"), (good, json.dumps({"latest": {"rates": {"EUR": 0.9}}}))):
        os.makedirs(folder)
        with open(os.path.join(folder, "rates_2026-06-30.json"), "w") as f:
            f.write(text)
    assert [r.tipo_error for r in fx_faults(spark, bad).collect()] == ["Parseo"]
    assert fx_faults(spark, good).count() == 0


def test_landing_stream_is_incremental(spark, tmp_dir):
    paths = _offer_files(tmp_dir)
    out, ckpt = os.path.join(tmp_dir, "landed"), os.path.join(tmp_dir, "ckpt")
    glob = os.path.join(tmp_dir, "raw", "scraping", "tiendaa", "*.csv")
    land_drops(spark, glob, out, ckpt).awaitTermination()
    assert spark.read.parquet(out).count() == 4
    land_drops(spark, glob, out, ckpt).awaitTermination()   # rerun: nothing new, nothing duplicated
    assert spark.read.parquet(out).count() == 4
    _write_csv(os.path.join(os.path.dirname(glob), "tiendaa_2026-07-01.csv"), HEADER,
               [["TiendaA", "Ecuador", "USD", "RAM", "memoria ram", "DDR5 16GB", "$50,00", "z", "2026-07-01 00:00:00"]])
    land_drops(spark, glob, out, ckpt).awaitTermination()
    landed = spark.read.parquet(out)
    assert landed.count() == 5
    assert sorted(str(r.fecha) for r in landed.select("fecha").distinct().collect()) == ["2026-06-30", "2026-07-01"]


def test_convert_currencies_from_rate_table(spark):
    # Rates read from a (moneda, tasa) table give the same prices as the literal-rate path; a missing currency is null.
    import json

    from offerlake.operators.staging import convert_currencies, convert_currencies_table
    df = spark.createDataFrame([(1, 10.0), (2, 123.45), (3, None)], "id int, precio_usd double")
    rates = spark.createDataFrame([("USD", 1.0), ("EUR", 0.9137), ("COP", 4012.5)], "moneda string, tasa double")
    got = {r.id: r for r in convert_currencies_table(df, rates, currencies=["USD", "EUR", "COP", "MXN"]).collect()}
    want = {r.id: r for r in convert_currencies(df, {"USD": 1.0, "EUR": 0.9137, "COP": 4012.5},
                                                currencies=["USD", "EUR", "COP"]).collect()}
    for i in (1, 2, 3):
        assert (got[i].precio_usd, got[i].precio_eur, got[i].precio_cop) == \
            (want[i].precio_usd, want[i].precio_eur, want[i].precio_cop)
        assert got[i].precio_mxn is None
    assert json.loads(got[1].tasas_referencia) == {"USD": 1.0, "EUR": 0.9137, "COP": 4012.5, "MXN": None}
    # without a list, every currency of the table
    every = convert_currencies_table(df, rates.unionByName(spark.createDataFrame([("X Y", 2.0)], rates.schema)))
    assert every.columns == ["id", "precio_usd", "precio_cop", "precio_eur", "tasas_referencia"] or "precio_cop" in every.columns
    r = every.where("id = 1").first()
    assert (r.precio_cop, r.precio_eur) == (got[1].precio_cop, got[1].precio_eur) and json.loads(r.tasas_referencia)["X Y"] == 2.0
    none = convert_currencies_table(df, rates.limit(0)).where("id = 1").first()
    assert none.tasas_referencia == "{}"
