"""The run suite: approved queries and questions, timed, one record per run."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mostrador.functions.numbers import ratio, rounded
from mostrador.plans.meter import Meter, with_usage
from mostrador.plans.routing import route
from mostrador.plans.statements import STATEMENTS, match_catalog

# The columns of a run record, in order.
RECORD_SCHEMA = """
tipo string, nombre string, pregunta string, intencion string, motor_solicitado string,
motor_resuelto string, estado string, filas bigint, hive_tiempo_s double,
hive_cpu_pct double, hive_mem_mb double, spark_tiempo_s double, spark_cpu_pct double,
spark_mem_mb double, speedup_spark_vs_hive double, error string, sql string
"""
RECORD_COLUMNS = [column.split()[0] for column in RECORD_SCHEMA.split(",")]

# The approved queries a suite runs by name.
MANUAL_RUNS = (
    ("top_20_clientes_compras", "Top 20 clientes con mayor numero de compras"),
    ("ventas_por_tienda", "Ventas por tienda"),
    ("ventas_por_mes", "Ventas por mes"),
    ("ventas_por_dia_semana", "Ventas por dia de la semana"),
    ("top_productos_por_tienda", "Top productos por tienda"),
    ("ticket_promedio_por_cliente", "Ticket promedio por cliente"),
    ("productos_mayor_ingreso", "Productos con mayor ingreso generado"),
    ("top_clientes_gasto_total", "Top clientes por gasto total"),
    ("ranking_mensual_ventas", "Ranking mensual de ventas"),
)
Runner = Callable[[str], DataFrame]


def timed_run(df: DataFrame) -> tuple[int, float]:
    """Rows of a result and seconds to compute all of it; no row reaches the driver."""
    started = time.perf_counter()
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.format("noop").mode("overwrite").save()
    return seen.get["rows"], time.perf_counter() - started


def run_one(engine: str, runner: Runner, intent: str, meter: Meter) -> dict:
    """Fields of one run; a failure becomes a record of its own and stops nothing."""
    try:
        with meter.run() as run:
            rows, seconds = timed_run(runner(intent))
        return {"estado": "ok", "filas": rows, f"{engine}_tiempo_s": round(seconds, 2), f"{engine}_run": run}
    except Exception as error:
        return {"estado": "error", "error": str(error)}


def run_suite(
    spark: SparkSession,
    runners: Mapping[str, Runner],
    manual: Sequence[tuple[str, str]] = MANUAL_RUNS,
    questions: Sequence[tuple[str, str]] = (),
    folder: str | None = None,
) -> DataFrame:
    """Run records of the named queries and the questions on every engine given.

    ``runners`` maps an engine (``spark``, ``hive``) to a function from intent to result;
    ``questions`` are (question, name). The rows of a record are those of Hive where it ran.
    CPU and memory are those of the run's own tasks and executors. With a ``folder`` the records so far are written again after every run, so that a
    suite cut short leaves what it has measured.
    """
    asked = "both" if len(runners) > 1 else next(iter(runners))
    empty = dict.fromkeys(RECORD_COLUMNS)
    records = [
        {**empty, "tipo": "manual", "nombre": name, "pregunta": "", "intencion": intent}
        for intent, name in manual
    ]
    table = spark.createDataFrame(list(questions), "pregunta string, nombre string")
    # route() keeps no order, so records are matched to their question by its name
    routed = {row["nombre"]: row for row in route(table, F.lit(asked)).collect()}
    for question, name in questions:
        record = {**empty, "tipo": "agentic", "nombre": name, "pregunta": question}
        record |= {"intencion": routed[name]["intencion"], "error": routed[name]["error"]}
        records.append(record)
    done, meter = [], Meter(spark)
    for record in records:
        done.append(_run_record(record, asked, runners, meter))
        if folder:
            write_records(_records(spark, done, meter), folder)
    return _records(spark, done, meter)


def _run_record(record: dict, asked: str, runners: Mapping[str, Runner], meter: Meter) -> dict:
    record = {**record, "motor_solicitado": asked}
    if record["intencion"] is None:
        return {**record, "intencion": "", "motor_resuelto": "", "estado": "error", "sql": ""}
    record |= {"motor_resuelto": asked, "sql": STATEMENTS[record["intencion"]], "error": ""}
    measured: dict = {}
    for engine, runner in sorted(runners.items(), reverse=True):
        run = run_one(engine, runner, record["intencion"], meter)
        if run["estado"] == "error":
            return record | run
        measured |= run
    return record | measured


def _records(spark: SparkSession, done: Sequence[dict], meter: Meter) -> DataFrame:
    runs = [f"{engine}_run" for engine in ("hive", "spark")]
    columns = (*RECORD_COLUMNS, *runs)
    rows = [(place, *[record.get(column) for column in columns]) for place, record in enumerate(done)]
    schema = f"place int, {RECORD_SCHEMA}, {runs[0]} string, {runs[1]} string"
    records = spark.createDataFrame(rows, schema)
    for engine in ("hive", "spark"):
        records = with_usage(records, meter.usage(), engine)
    return with_speedup(records.orderBy("place"))


def with_speedup(records: DataFrame) -> DataFrame:
    """Hive over Spark seconds, both to two digits; null unless both are known."""
    return records.withColumn(
        "speedup_spark_vs_hive", ratio(F.col("hive_tiempo_s"), F.col("spark_tiempo_s"))
    ).select(RECORD_COLUMNS)


def records_from_runs(runs: DataFrame) -> DataFrame:
    """Run records from one row per run and engine.

    ``runs`` has nombre, sql, motor (hive or spark), tiempo, cpu, mem and filas. Measures
    are kept to two digits, and the speed-up is the ratio of the kept seconds. All that is
    aggregated is numbers, so groups are folded by hash before and after the shuffle.
    """
    ran = {engine: F.max(F.when(F.col("motor") == engine, 1)) for engine in ("hive", "spark")}
    measures = {"tiempo": "tiempo_s", "cpu": "cpu_pct", "mem": "mem_mb"}
    aggregates = [
        rounded(F.max(F.when(F.col("motor") == engine, F.col(name))), 2).alias(f"{engine}_{kept}")
        for engine in ("hive", "spark")
        for name, kept in measures.items()
    ]
    rows_of = [F.max(F.when(F.col("motor") == e, F.col("filas"))) for e in ("hive", "spark")]
    pivoted = runs.groupBy("nombre", "sql").agg(
        *aggregates,
        F.coalesce(*rows_of).alias("filas"),
        F.when(ran["hive"].isNotNull() & ran["spark"].isNotNull(), "both")
        .when(ran["hive"].isNotNull(), "hive")
        .when(ran["spark"].isNotNull(), "spark")
        .alias("motor_resuelto"),
    )
    named = match_catalog(pivoted).withColumns(
        {
            "tipo": F.lit("manual"),
            "pregunta": F.lit(""),
            "intencion": F.coalesce("intencion", F.lit("")),
            "motor_solicitado": F.col("motor_resuelto"),
            "estado": F.lit("ok"),
            "error": F.lit(""),
        }
    )
    return with_speedup(named)


# A record is one line of CSV: quotes are doubled, and line ends in a text are escaped.
# Null is \\N, which no escaped text is.
_CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
_TEXTS = ("nombre", "pregunta", "error", "sql")
_ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"))


def one_line_text(text: Column) -> Column:
    """A text without line ends: they, and backslashes, are escaped by a backslash."""
    for plain, escaped in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def from_one_line(text: Column) -> Column:
    """The text that one_line_text() escaped."""
    # an escaped backslash must not meet the letter after it, so a text that has one is taken apart there
    parts = F.split(text, r"\\\\", -1)
    apart = F.array_join(F.transform(parts, _with_line_ends), "\\")
    return F.when(F.contains(text, F.lit("\\\\")), apart).otherwise(_with_line_ends(text))


def _with_line_ends(text: Column) -> Column:
    for plain, escaped in _ESCAPES[1:]:
        text = F.replace(text, F.lit(escaped), F.lit(plain))
    return text


def write_records(records: DataFrame, folder: str) -> None:
    """The records as CSV with a header and as JSON lines, replacing earlier ones."""
    lines = records.withColumns({name: one_line_text(F.col(name)) for name in _TEXTS})
    lines.write.mode("overwrite").options(**_CSV).csv(f"{folder}/csv")
    records.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{folder}/json")


def read_records(spark: SparkSession, folder: str, kind: str = "json") -> DataFrame:
    """The records from their JSON or, with ``kind`` csv, from their CSV."""
    if kind == "json":
        return spark.read.schema(RECORD_SCHEMA).json(f"{folder}/json")
    lines = spark.read.schema(RECORD_SCHEMA).options(**_CSV).csv(f"{folder}/csv")
    return lines.withColumns({name: from_one_line(F.col(name)) for name in _TEXTS})
