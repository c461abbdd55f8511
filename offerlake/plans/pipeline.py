"""End-to-end batch run over landed files: stage offers, compare prices, stage survey and specs, report quality.

The raw files are parsed once and landed as a table; the staged table is written once; every later step reads a written table.
Each output has one partition per run (``sinks.writers``), so repeating a run replaces its own rows and nothing else.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake import rules
from offerlake.operators import quality
from offerlake.operators.compare import best_prices
from offerlake.operators.dedup import keep_most_complete
from offerlake.operators.normalize import invalid_category_list, normalize_columns
from offerlake.operators.specs import stage_specs, validate_schema
from offerlake.operators.staging import convert_currencies_table, drop_unpriced, invalid_date_flag
from offerlake.operators.survey import stage_survey, survey_nulls
from offerlake.plans.offers import standardized
from offerlake.sinks.writers import append_error_log, error_log_frame, write_quality_report, write_run, write_staged
from offerlake.sources import drops
from offerlake.sources.files import fx_faults, rates_from_files, read_specs, read_survey

OUTPUTS = ("raw_archivos", "raw_ofertas", "ofertas_clave", "stg_precios", "comparador_mejor_precio", "reporte_calidad", "errores_pipeline",
           "stg_encuesta", "stg_cpu_specs", "especificaciones_validacion", "categorias_no_estandar", "reporte_calidad_largo")


def run(spark: SparkSession, offer_paths: Sequence[str], fx_path: str, out_dir: str, run_date: str,
        survey_path: str | None = None, specs_path: str | None = None, run_id: str | None = None, run_time: str | None = None) -> dict[str, str]:
    """Run the batch and return the folder of each output.

    ``run_id`` (default: the date) names the run's partition of every output; ``run_time`` (default: midnight of the date)
    stamps report and log, so that a repeated run writes the same rows.
    """
    run_id = run_id or run_date
    now = F.to_timestamp(F.lit(run_time or f"{run_date} 00:00:00"))
    out = {k: os.path.join(out_dir, k) for k in OUTPUTS}

    files = write_run(drops.manifest(spark, offer_paths), out["raw_archivos"], run_id)
    raw = write_run(drops.offers(spark, offer_paths, files), out["raw_ofertas"], run_id).drop("otros", "archivo")
    # price and key are worked out once; bundles and unpriced rows stay, marked
    marked = write_run(quality.marked(standardized(raw, run_date)), out["ofertas_clave"], run_id)
    # Currency fan-out after dedup: the converted prices follow from the price key, so survivors are unchanged.
    keyed = drop_unpriced(marked.where("not paquete")).drop("paquete")
    staged = write_staged(convert_currencies_table(keep_most_complete(keyed), rates_from_files(spark, fx_path)), out["stg_precios"], run_id)

    write_run(best_prices(staged), out["comparador_mejor_precio"], run_id, sort_by=[F.desc("ahorro_usd"), "clave_canonica"])

    # Counters are plain aggregates, not accumulators or observed metrics: those can count a re-run stage twice
    # when an executor is lost, aggregates cannot.
    survey = read_survey(spark, survey_path) if survey_path else None
    log = [_offer_log(marked, raw), fx_faults(spark, fx_path), drops.file_faults(files)]
    if survey_path:
        write_run(stage_survey(survey), out["stg_encuesta"], run_id)
        nulls = survey_nulls(survey).filter((F.col("presupuesto_imputado") > 0) | (F.col("ciudad_imputada") > 0))
        log.append(nulls.select(
            F.lit("Staging:encuesta").alias("fuente"), F.lit("Nulo").alias("tipo_error"),
            F.format_string("sin presupuesto: %d, sin ciudad: %d", "presupuesto_imputado", "ciudad_imputada")
            .alias("descripcion"),
            F.lit("Presupuesto: mediana de su categoria; ciudad: valor por omision").alias("accion_tomada")))
    staged_specs = None
    if specs_path:
        specs = read_specs(spark, specs_path)
        check = validate_schema(specs.drop("_row"), "cpu_specs")
        write_run(check, out["especificaciones_validacion"], run_id)
        missing = [c for c in rules.SPEC_REQUIRED_COLUMNS if c not in specs.columns]
        if not missing:
            staged_specs = write_run(stage_specs(specs, ["_row"]), out["stg_cpu_specs"], run_id)
        else:
            log.append(check.select(
                F.lit("Archivo:cpu_specs").alias("fuente"), F.lit("Esquema").alias("tipo_error"),
                F.concat(F.lit("Faltan en el archivo: "), F.array_join("faltantes", ", ")).alias("descripcion"),
                F.lit("El archivo no se carga").alias("accion_tomada")))
    rows = log[0]
    for part in log[1:]:
        rows = rows.unionByName(part)
    append_error_log(error_log_frame(rows, now), out["errores_pipeline"], run_id)

    long = write_run(quality.report_of_marked(marked, survey, staged_specs), out["reporte_calidad_largo"], run_id)
    bad = write_run(invalid_category_list(marked), out["categorias_no_estandar"], run_id)
    n_bad = bad.agg(F.count(F.lit(1))).scalar()
    wide = quality.wide_report(long).withColumns({"categorias_no_estandar_n": n_bad, "fecha_ejecucion": F.date_format(now, "yyyy-MM-dd HH:mm:ss")})
    write_quality_report(wide, out["reporte_calidad"], run_id)
    return out


def _offer_log(marked: DataFrame, raw: DataFrame) -> DataFrame:
    """Log rows on whole-PC listings and on dates that do not parse, where there are any."""
    bundles = marked.agg(F.count_if("paquete").alias("n")).where("n > 0").select(
        F.lit("Staging:relevancia").alias("fuente"), F.lit("Fuera de alcance").alias("tipo_error"),
        F.concat(F.col("n").cast("string"), F.lit(" ofertas de equipos armados halladas entre los componentes")).alias("descripcion"),
        F.lit("Quedan fuera de la comparacion por producto").alias("accion_tomada"))
    dates = normalize_columns(raw).agg(F.count_if(invalid_date_flag()).alias("n")).where("n > 0").select(
        F.lit("Staging:fechas").alias("fuente"), F.lit("Formato").alias("tipo_error"),
        F.concat(F.col("n").cast("string"), F.lit(" ofertas con fecha nula o en otro formato")).alias("descripcion"),
        F.lit("Llevan la fecha del proceso").alias("accion_tomada"))
    return bundles.unionByName(dates)
