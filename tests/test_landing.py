"""Files read by their own headers, the manifest of faults, and landing that never lands a row twice."""

import csv
import os

import pytest
from pyspark.sql import functions as F

from offerlake.sources import drops
from offerlake.streaming import land_drops
from offerlake.streaming.landing import land_files


def write(root, name, header, rows, bom=False):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8-sig" if bom else "utf-8") as f:
        w = csv.writer(f)
        if header is not None:
            w.writerow(header)
        w.writerows(rows)
    return path


@pytest.fixture()
def raw(tmp_dir):
    root = os.path.join(tmp_dir, "raw")
    write(root, "norte/norte_2026-06-30.csv", ["tienda", "categoria", "producto", "precio_raw", "url_producto"],
          [["Norte", "GPU", "Tarjeta RTX 4060", "$ 300,00\n\"oferta\"", "n1"], ["Norte", "CPU", "Ryzen 5", "", "n2"]], bom=True)
    write(root, "sur/sur_2026-07-01.csv", ["price", "name", "nombre", "store", "sku", "categoria", "sku"],
          [["199.5", "Ryzen 7", "", "Sur", "A1", "CPU", "B1"], ["20", "otra", "Teclado", "Sur", "A2"]])
    return root


def as_rows(df):
    return [(r.tienda, r.categoria, r.producto, r.precio_raw, r.url_producto) for r in df.collect()]


WANT = sorted([("Norte", "GPU", "Tarjeta RTX 4060", '$ 300,00\n"oferta"', "n1"), ("Norte", "CPU", "Ryzen 5", None, "n2"),
               ("Sur", "CPU", "Ryzen 7", "199.5", None), ("Sur", None, "Teclado", "20", None)], key=str)


def test_columns_follow_each_files_header(spark, raw):
    files = drops.manifest(spark, [raw]).cache()
    got = drops.offers(spark, [raw], files)
    assert sorted(as_rows(got), key=str) == WANT
    others = {r.producto: r.otros for r in got.collect()}
    assert others["Ryzen 7"] == {"sku": "A1"} and others["Ryzen 5"] == {}  # the first of a repeated name
    by_name = {os.path.basename(r.archivo): r for r in files.collect()}
    assert by_name["norte_2026-06-30.csv"].cabecera[0] == "tienda"  # no byte-order mark
    assert {n: r.filas for n, r in by_name.items()} == {"norte_2026-06-30.csv": 2, "sur_2026-07-01.csv": 2}
    assert all(r.falla is None and r.bytes > 0 for r in by_name.values())


def test_each_bad_file_gives_one_row_and_good_ones_load(spark, raw):
    open(os.path.join(raw, "norte", "nada +1_2026-07-02.csv"), "w").close()
    write(raw, "norte/la cabecera_2026-07-02.csv", ["tienda", "producto"], [])
    write(raw, "sur/ancha_2026-07-02.csv", ["tienda", "producto"], [["Sur", "x"], ["Sur", "y", "z"]])
    write(raw, "sur/muy_ancha_2026-07-02.csv", ["tienda", "producto"], [["a"] * 90])
    with open(os.path.join(raw, "sur", "roto_2026-07-02.csv.gz"), "wb") as f:
        f.write(b"\x1f\x8b\x08\x00not a gzip stream")
    files = drops.manifest(spark, [raw]).cache()
    faults = {os.path.basename(r.archivo).replace("%20", " "): r.falla for r in files.collect()}
    assert faults == {"norte_2026-06-30.csv": None, "sur_2026-07-01.csv": None, "nada +1_2026-07-02.csv": drops.EMPTY,
                      "la cabecera_2026-07-02.csv": drops.HEADER_ONLY, "ancha_2026-07-02.csv": drops.WIDER, "muy_ancha_2026-07-02.csv": drops.WIDER,
                      "roto_2026-07-02.csv.gz": drops.UNREADABLE}
    log = drops.file_faults(files).collect()
    assert len(log) == 5 and {r.fuente for r in log} == {"Staging:lectura"}
    assert sorted(as_rows(drops.offers(spark, [raw], files)), key=str) == WANT


def test_landing_by_header_is_incremental_and_repeatable(spark, raw, tmp_dir):
    out, ckpt, glob = os.path.join(tmp_dir, "landed"), os.path.join(tmp_dir, "ckpt"), os.path.join(raw, "*", "*.csv")
    land_drops(spark, glob, out, ckpt).awaitTermination()
    landed = spark.read.parquet(out)
    assert sorted(as_rows(landed), key=str) == WANT
    assert {(r.tienda, str(r.fecha)) for r in landed.collect()} == {("Norte", "2026-06-30"), ("Sur", "2026-07-01")}
    land_drops(spark, glob, out, ckpt).awaitTermination()
    assert spark.read.parquet(out).count() == 4
    write(raw, "este/este_2026-07-02.csv", ["fecha", "store", "producto"], [["2026-07-02", "Este", "Mouse"]])
    land_drops(spark, glob, out, ckpt).awaitTermination()
    again = spark.read.parquet(out)
    assert again.count() == 5 and again.where("producto = 'Mouse'").select("tienda", "lote").first() == ("Este", 1)
    # the same batch once more, as after a failure between writing and committing
    land_files(spark, [os.path.join(raw, "este", "este_2026-07-02.csv")], out, 1)
    assert spark.read.parquet(out).count() == 5
    assert spark.read.parquet(out + "_faltas").where(F.col("falla").isNull()).count() == 3
