from __future__ import annotations

import threading
import time

import pytest
from pyspark.sql import functions as F

from mostrador.operators.utilisation import application_usage, executor_usage
from mostrador.plans.catalog import CATALOG
from mostrador.plans.meter import Meter
from mostrador.plans.statements import STATEMENTS
from checks.inputs import SUITE_QUESTIONS
from mostrador.plans.suite import (
    MANUAL_RUNS,
    RECORD_COLUMNS,
    RECORD_SCHEMA,
    read_records,
    records_from_runs,
    run_suite,
    timed_run,
    write_records,
)
from mostrador.sources.star import star_from_given
from tests.conftest import SMALL


def test_timed_run_counts_without_collecting(spark):
    rows, seconds = timed_run(spark.range(1234).where("id % 2 = 0"))
    assert rows == 617 and seconds > 0


def test_suite_isolates_failures(spark, tmp_path):
    star = star_from_given(spark, SMALL)

    def runner(intent):
        if intent == "ventas_por_mes":
            raise RuntimeError("se rompio")
        return CATALOG[intent].build(star)

    questions = [SUITE_QUESTIONS[0][:2], ("Cuéntame algo", "Nada"), ("Borra todo", "Peligro")]
    records = run_suite(spark, {"spark": runner}, MANUAL_RUNS[1:4], questions, str(tmp_path))
    assert sorted(read_records(spark, str(tmp_path)).collect()) == sorted(records.collect())
    assert records.columns == RECORD_COLUMNS and len(RECORD_COLUMNS) == 17
    got = {r["nombre"]: r for r in records.collect()}
    assert got["Ventas por tienda"]["estado"] == "ok" and got["Ventas por tienda"]["filas"] == 10
    assert got["Ventas por mes"]["estado"] == "error" and "se rompio" in got["Ventas por mes"]["error"]
    assert got["unidades"]["intencion"] == "cinco_productos_mas_vendidos"
    assert got["unidades"]["sql"] == STATEMENTS["cinco_productos_mas_vendidos"]
    assert got["Nada"]["error"] == "unknown_intent" and got["Nada"]["motor_resuelto"] == ""
    assert got["Peligro"]["error"] == "unsafe_question"


def test_suite_on_two_engines(spark):
    def slow(intent):
        return spark.range(3)

    records = run_suite(spark, {"hive": slow, "spark": slow}, MANUAL_RUNS[:1], [SUITE_QUESTIONS[0][:2]])
    for record in records.collect():
        assert record["motor_solicitado"] == record["motor_resuelto"] == "both"
        assert record["hive_tiempo_s"] is not None and record["spark_tiempo_s"] is not None
        assert record["filas"] == 3


def test_question_runs_reach_their_queries(spark):
    questions = [q[:2] for q in SUITE_QUESTIONS]
    records = run_suite(spark, {"spark": lambda intent: spark.range(1)}, [], questions)
    assert [r["intencion"] for r in records.collect()] == [q[2] for q in SUITE_QUESTIONS]


def test_a_failing_second_engine_leaves_no_measures(spark):
    def broken(intent):
        raise RuntimeError("no")

    rows = {"hive": lambda intent: spark.range(3), "spark": lambda intent: spark.range(5)}
    record = run_suite(spark, rows, MANUAL_RUNS[:1]).first()
    assert record["filas"] == 3
    record = run_suite(spark, {**rows, "hive": broken}, MANUAL_RUNS[:1]).first()
    assert (record["estado"], record["filas"], record["spark_tiempo_s"]) == ("error", None, None)


def test_records_from_runs_and_sinks(spark, tmp_path):
    sql = STATEMENTS["ventas_por_mes"].replace("\n", " \n ")
    runs = spark.createDataFrame(
        [("m", sql, "hive", 24.8, 50.126, 10.0, 80), ("m", sql, "spark", 6.3, 20.0, 11.5, 80),
         ("s", "SELECT 1", "spark", 1.0, None, None, 1), ("z", "SELECT 2", "hive", 0.001, 1.0, 1.0, 1),
         ("z", "SELECT 2", "spark", 2.0, 1.0, 1.0, 1)],
        "nombre string, sql string, motor string, tiempo double, cpu double, mem double, filas long",
    )
    records = records_from_runs(runs)
    got = {r["nombre"]: r for r in records.collect()}
    assert got["m"]["speedup_spark_vs_hive"] == 3.94 and got["m"]["intencion"] == "ventas_por_mes"
    assert got["m"]["hive_cpu_pct"] == 50.13 and got["m"]["motor_resuelto"] == "both"
    assert got["s"]["speedup_spark_vs_hive"] is None and got["s"]["motor_resuelto"] == "spark"
    assert got["z"]["hive_tiempo_s"] == 0.0 and got["z"]["speedup_spark_vs_hive"] is None
    for _ in range(2):  # written again after every run
        write_records(records, str(tmp_path))
    assert sorted(read_records(spark, str(tmp_path)).collect()) == sorted(records.collect())
    assert sorted(read_records(spark, str(tmp_path), "csv").collect()) == sorted(records.collect())
    table = spark.read.option("header", "true").csv(f"{tmp_path}/csv")
    assert table.columns == RECORD_COLUMNS and table.count() == 3


TEXTS = ["", "una\nlínea", "a\r\nb", "c:\\nuevo", "c:\\\nuevo\\", 'dice "sí", no', '"', "\\", "a\\\\nb", " x ", None]


def test_records_read_back_from_csv_as_written(spark, tmp_path):
    empty = dict.fromkeys(RECORD_COLUMNS)
    rows = [{**empty, "tipo": str(i), "nombre": "n", "sql": text, "error": text, "pregunta": "¿?"} for i, text in enumerate(TEXTS)]
    records = spark.createDataFrame([tuple(r.values()) for r in rows], RECORD_SCHEMA)
    write_records(records, str(tmp_path))
    lines = [line for path in tmp_path.glob("csv/*.csv") for line in path.read_bytes().split(b"\n") if line]
    assert len([x for x in lines if not x.startswith(b"tipo,")]) == len(TEXTS)  # a line each
    for kind in ("csv", "json"):
        got = {r["tipo"]: r for r in read_records(spark, str(tmp_path), kind).collect()}
        assert [got[str(i)]["sql"] for i in range(len(TEXTS))] == TEXTS, kind
        assert [got[str(i)]["error"] for i in range(len(TEXTS))] == TEXTS, kind


def test_texts_are_taken_apart_only_where_a_backslash_was_escaped(spark, tmp_path, explained):
    empty = dict.fromkeys(RECORD_COLUMNS)
    record = {**empty, "nombre": "n", "sql": "SELECT\n1"}
    write_records(spark.createDataFrame([tuple(record.values())], RECORD_SCHEMA), str(tmp_path))
    read = read_records(spark, str(tmp_path), "csv").select("sql")
    assert read.first()["sql"] == "SELECT\n1"
    text = explained(read).lower()
    assert text.index("contains(") < text.index("split(")


def test_executor_usage(spark):
    executors = spark.createDataFrame(
        [(1, 0, 1000, 2, 500, None), (1, 0, 0, 2, 500, None),
         (1, 1, 4000, 2, 500, (3 * 1048576, None)), (1, 1, 1000, 2, 1048576, None),
         (2, 1, 10, 0, 0, None), (3, 0, 0, 1, 1, None), (3, 1, 10**9, 0, 1, None)],
        "run_id long, snapshot int, totalDuration long, totalCores int, memoryUsed long, "
        "peakMemoryMetrics struct<JVMHeapMemory: long, JVMOffHeapMemory: long>",
    )
    runs = spark.createDataFrame([(1, 2.0), (2, 1.0), (3, 0.0)], "run_id long, elapsed_s double")
    got = {r["run_id"]: (r["cpu"], r["mem"]) for r in executor_usage(executors, runs).collect()}
    assert got == {1: (50.0, 4.0), 2: (None, 0.0), 3: (0.0, 0.0)}


@pytest.mark.parametrize("row, cpu, mem", [
    ((10_000, 20_480, 40, 8), 50.0, 2048.0),
    ((0, 5, 5, 8), None, None),
    ((1_000, 1, 900, 0), 100.0, 1.0),
])
def test_application_usage(spark, row, cpu, mem):
    table = spark.createDataFrame(
        [(1, *row)],
        "run_id long, elapsed_ms long, memory_seconds long, vcore_seconds long, total_cores long",
    )
    got = application_usage(table).first()
    assert (got["cpu"], got["mem"]) == (cpu, mem)


def burn(spark, rows: int, tasks: int):
    """Tasks that keep their cores busy."""
    df = spark.range(0, rows, 1, tasks).selectExpr("sum(hash(id, id + 1, id * 2, id % 7)) AS s")
    df.write.format("noop").mode("overwrite").save()


def test_meter_tells_a_busy_run_from_an_idle_one(spark):
    meter = Meter(spark)
    burn(spark, 1000, 8)  # under no tag
    with meter.run() as busy:
        burn(spark, 150_000_000, 8)
    with meter.run() as single:
        burn(spark, 30_000_000, 1)
    with meter.run() as idle:
        time.sleep(1.0)
    got = {r["run_id"]: r for r in meter.usage().collect()}
    assert set(got) == {busy, single, idle}
    assert all(0 <= r["cpu"] <= 100 and r["mem"] is not None for r in got.values())
    assert got[busy]["cpu"] > 50 > 20 > got[single]["cpu"] > got[idle]["cpu"] == 0.0
    rows = meter.snapshots().collect()
    assert {(r["run_id"], r["snapshot"]) for r in rows} == {(k, i) for k in got for i in (0, 1)}
    assert all(r["totalCores"] > 0 for r in rows)


def test_meter_leaves_out_what_others_run_at_the_same_time(spark):
    meter = Meter(spark)
    other = threading.Thread(target=burn, args=(spark, 100_000_000, 4))
    other.start()
    with meter.run() as run:
        time.sleep(0.5)
        spark.range(10).count()
        other.join()
    took = {r["snapshot"]: r["totalDuration"] for r in meter.snapshots().where(F.col("run_id") == run).collect()}
    assert took[0] == 0 and took[1] < 1000


def test_a_suite_measures_every_run(spark):
    star = star_from_given(spark, SMALL)
    runner = lambda intent: CATALOG[intent].build(star)
    for record in run_suite(spark, {"hive": runner, "spark": runner}, MANUAL_RUNS[:2]).collect():
        for engine in ("hive", "spark"):
            assert 0 < record[f"{engine}_cpu_pct"] <= 100 and record[f"{engine}_mem_mb"] >= 0
    failed = run_suite(spark, {"spark": lambda intent: 1 / 0}, MANUAL_RUNS[:1]).first()
    assert failed["spark_cpu_pct"] is None and failed["estado"] == "error"
