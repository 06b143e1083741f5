"""Every registered query: a job over the given tables, decimals shown as doubles."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import DecimalType, IntegerType, StringType

from checks import inputs
from checks.inputs import spark_table
from mostrador.functions.numbers import format_amount, month_label, to_number
from mostrador.functions.rules import ENGINE_RULES, FALLBACK_RULES, INTENT_RULES, first_rule
from mostrador.functions.text import as_key, last_match, normalized, without_fence
from mostrador.operators.audit import audit
from mostrador.operators.reconcile import parity, parity_differences, reconcile, reconcile_apart
from mostrador.operators.shape import Shaped, shape, shape_once, to_json_line, typed_numbers
from mostrador.operators.totals import rank_values, roll_up, top_per_group
from mostrador.operators.utilisation import application_usage, executor_usage
from mostrador.plans import catalog
from mostrador.plans import routing as q
from mostrador.plans.adhoc import run_intent, run_sql
from mostrador.plans.ask import answer_plan, ask
from mostrador.plans.catalog import CATALOG
from mostrador.plans.planning import parse_plans, resolve_plans, resolve_requests
from mostrador.plans.statements import match_catalog, over
from mostrador.plans.suite import read_records, records_from_runs, run_suite, write_records
from mostrador.session import scratch_folder, shuffles_freed
from mostrador.sources import delimited, tables
from mostrador.sources.schemas import STAR_SCHEMAS
from mostrador.sources.star import (
    Star,
    publish_star,
    save_star,
    spread_heavy,
    star_counts,
    star_from_database,
    star_from_given,
)

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the one money type the reference engine's results share."""
    return df.select(
        [
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, DecimalType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def on_star(build: Callable[[Star], DataFrame], gaps: bool = False) -> Query:
    return lambda spark, folder: plain(build(star_from_given(spark, folder, gaps)))


def on_input(sql: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: build(spark_table(spark, folder, sql))


# --- catalog --------------------------------------------------------------------------


def item_versions(star: Star) -> DataFrame:
    """Revenue by business id, with the number of surrogate keys that share it."""
    totals = star.sales.totals(["ss_item_sk"], {"ingreso_generado": "ss_net_paid"})
    joined = totals.join(
        star.item.select("i_item_sk", "i_item_id"), F.col("ss_item_sk") == F.col("i_item_sk")
    ).withColumn("versiones", F.lit(1).cast("long"))
    return roll_up(joined, ["i_item_id"], ["versiones", "ingreso_generado"])


def latest_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = spark.read.parquet(f"{folder}/orders.parquet").select(
        "o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("fecha")
    )
    order = [F.desc("fecha"), F.asc("o_orderkey")]
    return top_per_group(orders, ["o_custkey"], order, 3, "ranking")


def largest_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select("l_suppkey", "l_quantity")
    return rank_values(lines, ["l_suppkey"], "l_quantity", 10, "ranking", "filas")


# --- questions ------------------------------------------------------------------------


def routed_by(column: Callable[[], object], name: str) -> Query:
    return on_input(
        inputs.QUESTIONS, lambda df: q.with_normalized(df).select("id", column().alias(name))
    )


def normalized_texts(df: DataFrame) -> DataFrame:
    return df.select("id", normalized(F.col("text")).alias("norm"))


def key_texts(df: DataFrame) -> DataFrame:
    return df.select("id", as_key(F.col("text")).alias("clave"))


def routed_questions(df: DataFrame) -> DataFrame:
    return q.route(df, F.col("modo")).select("id", "intencion", "motor", "error")


def resolved_modes(df: DataFrame) -> DataFrame:
    asked = q.with_normalized(df).withColumn("modo", q.request_mode(F.col("campo")))
    engine = q.resolved_engine(F.col("modo"), q.engine_tag(), F.lit("hive"))
    return asked.select("id", "modo", engine.alias("motor"))


def labelled(df: DataFrame) -> DataFrame:
    return q.with_normalized(df).select("esperada", q.rule_intent().alias("obtenida"))


def catalog_usage(df: DataFrame) -> DataFrame:
    """Approved intents with their class and the number of questions routed to each."""
    counts = q.route(df).groupBy("intencion").agg(F.count(F.lit(1)).alias("preguntas"))
    listed = catalog.intents(df.sparkSession).withColumnRenamed("motor", "clase")
    used = listed.join(counts, "intencion", "left")
    return used.select("intencion", "clase", F.coalesce("preguntas", F.lit(0)).alias("preguntas"))


def classed(df: DataFrame) -> DataFrame:
    found = q.with_normalized(df).select("id", q.intent_with_fallback().alias("intencion"))
    return q.with_class(found).select("id", "intencion", "clase")


# --- numbers and labels ---------------------------------------------------------------


def formatted(df: DataFrame) -> DataFrame:
    names = ("l_extendedprice", "margen", "casi")
    return df.select(
        "l_orderkey",
        "l_linenumber",
        *[format_amount(F.col(name)).alias(f"{name}_texto") for name in names],
    )


def month_labels(df: DataFrame) -> DataFrame:
    kinds = {"numero": IntegerType(), "digito": StringType(), "palabra": StringType()}
    return df.select(
        "o_orderkey", *[month_label(F.col(name), kind).alias(name) for name, kind in kinds.items()]
    )


# --- shaping --------------------------------------------------------------------------


def shaped(star: Star, intent: str) -> Shaped:
    result = CATALOG[intent].build(star)
    return shape(result, CATALOG[intent].order, typed_numbers(result))


def displayed(intent: str) -> Query:
    return on_star(lambda star: shaped(star, intent).display())


def charted(intent: str) -> Query:
    return on_star(lambda star: shaped(star, intent).chart())


HEADLINE = ("heroValue", "heroUnit", "heroLabel", "summary", "matched", "chartTitle")


def headline(intent: str, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> Query:
    def build(star: Star) -> DataFrame:
        result = keep(CATALOG[intent].build(star))
        return shape_once(result, CATALOG[intent].order).answer().select(*HEADLINE)

    return on_star(build)


def json_answer(star: Star) -> DataFrame:
    """A header through JSON text and back, beside each of its display rows."""
    entry = CATALOG["ranking_mensual_ventas"]
    kept = shape_once(entry.build(star), entry.order)
    answer = kept.answer(sql="ranking_mensual_ventas")
    parsed = to_json_line(answer).select(F.from_json("respuesta", answer.schema).alias("a"))
    header = parsed.select("a.heroValue", "a.matched", "a.sql", F.size("a.chart").alias("puntos")).first()
    return kept.rows().select(
        *[F.lit(value).alias(name) for name, value in header.asDict().items()],
        (F.col("pos") - 1).cast("int").alias("pos"),
        F.col("fila")[0].alias("tienda"),
        F.col("fila")[1].alias("ventas"),
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of every order, most lines first."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_orderkey")
    counted = lines.agg(F.count(F.lit(1)).alias("numero_compras"))
    named = counted.select("l_orderkey", F.concat(F.lit("P"), "l_orderkey").alias("cliente"), "numero_compras")
    return named.orderBy(F.desc("numero_compras"), "l_orderkey")


def all_rows(order: tuple[str, ...]) -> Query:
    """All display rows of a long result, in a named order or in the one it came in."""

    def build(spark: SparkSession, folder: str) -> DataFrame:
        rows = shape_once(order_lines(spark, folder), order).rows()
        return rows.select("pos", F.col("fila")[0].alias("pedido"), F.col("fila")[1].alias("lineas"))

    return build


def best_month_answer(spark: SparkSession, folder: str) -> DataFrame:
    """One question from its text to the answer's headline."""
    star = star_from_given(spark, folder)
    header, _ = ask(spark, star, "¿Qué mes tuvo la mayor facturación?")
    return header.select(*HEADLINE)


def textual_headline(spark: SparkSession, folder: str) -> DataFrame:
    """A result without a number: the sources of each language."""
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    sources = documents.groupBy("lang", "source").agg(F.max(F.lit("x")).alias("marca"))
    return shape_once(sources, ("lang", "source")).answer().select(*HEADLINE)


# --- ingest ---------------------------------------------------------------------------

LAYERS = ("texto", "parquet", "leido")


def fresh_database(spark: SparkSession, kind: str, folder: str) -> str:
    """A database for one kind of layer over one folder, its old tables dropped."""
    name = f"mostrador_{kind}_{hashlib.sha1(folder.encode()).hexdigest()[:8]}"
    tables.create_database(spark, name)
    tables.drop_tables(spark, name, STAR_SCHEMAS)
    return name


def saved_star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The star's tables, saved first: the fact is joined once, however often it is read."""
    root = scratch_folder(spark)
    save_star(star_from_given(spark, folder), root)
    return {name: spark.read.parquet(f"{root}/{name}") for name in STAR_SCHEMAS}


def star_as_text(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], str]:
    star, root = saved_star(spark, folder), scratch_folder(spark)
    for name, df in star.items():
        columns = STAR_SCHEMAS[name].fieldNames()
        delimited.write_delimited(df.select(columns), f"{root}/{name}", name == "item")
    return star, root


def text_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Each star table written as text and read back typed: rows, and rows that differ."""
    star, root = star_as_text(spark, folder)
    compared = []
    for name, df in star.items():
        back = delimited.read_delimited(spark, f"{root}/{name}", STAR_SCHEMAS[name])
        compared.append(reconcile(df, back).withColumn("tabla", F.lit(name)))
    return reduce(DataFrame.unionByName, compared)


def convert_status(spark: SparkSession, folder: str) -> DataFrame:
    """Conversion of the whole dataset, one declared table having no text folder."""
    _, root = star_as_text(spark, folder)
    schemas = {**STAR_SCHEMAS, "web_page": STAR_SCHEMAS["item"]}
    status = delimited.convert(spark, schemas, root, scratch_folder(spark))
    return status.select("tabla", "estado", "filas")


def damaged_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as text, most lines damaged by kind, converted: what the scan lost."""
    key, balance = F.col("c_custkey").cast("string"), F.col("c_acctbal").cast("decimal(12,2)").cast("string")
    kinds = [
        F.concat_ws("|", key, "c_name", balance),
        F.concat_ws("|", key, "c_name", balance, F.lit("")),  # one separator at the end
        F.concat_ws("|", key, "c_name"),
        F.concat_ws("|", key, "c_name", balance, F.lit("x")),
        F.concat_ws("|", F.lit("n"), "c_name", balance),
        F.concat_ws("|", key, F.lit(""), F.lit("1.2.3"), F.lit("")),
        F.concat_ws("|", F.lit("n")),
    ]
    root, kind = scratch_folder(spark), F.pmod("c_custkey", F.lit(len(kinds))).cast("int")
    customers = spark.read.parquet(f"{folder}/customer.parquet")
    customers.select(F.element_at(F.array(*kinds), kind + 1).alias("value")).write.text(f"{root}/clientes")
    schema = T.StructType.fromDDL("clave bigint, nombre string, saldo decimal(12,2)")
    status = delimited.convert(spark, {"clientes": schema}, root, scratch_folder(spark))
    return status.select("tabla", "estado", "filas", "ilegibles", "cortas", "largas")


def register_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Text, declared Parquet and inferred Parquet tables of the star, listed and counted."""
    _, text_root = star_as_text(spark, folder)
    parquet_root = scratch_folder(spark)
    delimited.convert(spark, STAR_SCHEMAS, text_root, parquet_root)
    layers = {kind: fresh_database(spark, kind, folder) for kind in LAYERS}
    tables.register_text(spark, layers["texto"], STAR_SCHEMAS, text_root)
    tables.register_parquet(spark, layers["parquet"], STAR_SCHEMAS, parquet_root)
    tables.register_parquet_from_files(
        spark, layers["leido"], {name: f"{parquet_root}/{name}" for name in STAR_SCHEMAS}
    )
    counted = []
    for kind, database in layers.items():
        counts = tables.count_rows(
            {name: spark.table(f"{database}.{name}") for name in STAR_SCHEMAS}
        )
        listed = tables.list_tables(spark, database)
        counted.append(listed.join(counts, "tabla").withColumn("capa", F.lit(kind)))
    return reduce(DataFrame.unionByName, counted)


def raw_vs_parquet(spark: SparkSession, folder: str) -> DataFrame:
    _, text_root = star_as_text(spark, folder)
    parquet_root = scratch_folder(spark)
    delimited.convert(spark, STAR_SCHEMAS, text_root, parquet_root)
    raw = {
        name: delimited.read_delimited(spark, f"{text_root}/{name}", schema)
        for name, schema in STAR_SCHEMAS.items()
    }
    parquet = {name: spark.read.parquet(f"{parquet_root}/{name}") for name in STAR_SCHEMAS}
    return parity(raw, parquet)


def damaged_copies(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Customers, and by name a sound copy and four damaged ones."""
    customers = spark.read.parquet(f"{folder}/customer.parquet").select(
        "c_custkey", "c_name", F.lit(None).cast("string").alias("vacia")
    )
    one = customers.where("c_custkey = 1")
    copies = {
        "igual": customers,
        "corrida": customers.select("c_custkey", F.col("vacia").alias("c_name"), F.col("c_name").alias("vacia")),
        "cambiada": customers.withColumn(
            "c_name", F.when(F.col("c_custkey") == 1, F.lit("otro")).otherwise(F.col("c_name"))
        ),
        "doblada": customers.unionByName(one),
        "faltante": customers.where("c_custkey <> 1"),
    }
    return dict.fromkeys(copies, customers), copies


def parity_faults(spark: SparkSession, folder: str) -> DataFrame:
    """Whole-table parity of customers with a sound copy and with four damaged ones."""
    return parity(*damaged_copies(spark, folder))


def parity_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The rows in which the damaged copies differ."""
    return parity_differences(*damaged_copies(spark, folder))


# stars of these checks lie in databases of their own, not in the library's default one
STAR_COPY, STAR_BY_DAY = "mostrador_estrella", "mostrador_por_dia"


def published_star(spark: SparkSession, folder: str, by_day: bool = False) -> Star:
    """The star saved as Parquet and registered under its own database."""
    database = STAR_BY_DAY if by_day else STAR_COPY
    publish_star(spark, star_from_given(spark, folder), scratch_folder(spark), database, by_day)
    return star_from_database(spark, database)


def year_by_day(spark: SparkSession, folder: str) -> DataFrame:
    """One year's sales from a fact that is laid out by day."""
    return plain(catalog.sales_of_year(published_star(spark, folder, by_day=True), 1995))


def saved_star_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return plain(catalog.sales_by_month(published_star(spark, folder)))


def tab_result(spark: SparkSession, folder: str) -> DataFrame:
    """Sales by store written as a tab-separated result and read back as text."""
    sales = catalog.sales_by_store(star_from_given(spark, folder))
    path = f"{scratch_folder(spark)}/resultado"
    sales.write.options(sep="\t", header="true", quote="").csv(path)
    return delimited.read_tab_result(spark, path)


# --- ad-hoc SQL and runs --------------------------------------------------------------

WORST_LINES = (
    "WITH perdidas AS (SELECT ss_store_sk AS tienda, MIN(ss_net_profit) AS peor, "
    "COUNT(ss_net_profit) AS lineas FROM tpcds_parquet.store_sales "
    "WHERE ss_net_profit < 0 GROUP BY ss_store_sk) "
    "SELECT s_store_name AS nombre, peor, lineas FROM perdidas, tpcds_parquet.store "
    "WHERE tienda = s_store_sk ORDER BY peor, nombre"
)


def adhoc_profit(spark: SparkSession, folder: str) -> DataFrame:
    published_star(spark, folder)
    return plain(run_sql(spark, over(WORST_LINES, STAR_COPY), STAR_COPY))


STATE_SALES = (
    "SELECT s_state AS estado, SUM(ss_net_paid) AS ventas_totales FROM tpcds_parquet.store_sales "
    "JOIN tpcds_parquet.store ON s_store_sk = ss_store_sk GROUP BY s_state "
    "ORDER BY ventas_totales DESC, estado"
)


def planned_answers(spark: SparkSession, folder: str) -> DataFrame:
    """Answers to a question with a plan of its own SQL, one with a catalog plan, one without."""
    published_star(spark, folder)
    own = {"tipo": "dinamica", "sql": f"```sql\n{STATE_SALES};\n```", "motor": "hive"}
    approved = {"tipo": "catalogo", "intencion": "Mes mayores ingresos", "motor": "hive"}
    asked = [
        ("¿Qué estado vende más?", json.dumps(own)),
        ("El mejor momento, con Spark", json.dumps(approved)),
        ("Ventas de las tiendas", None),
    ]
    answers = []
    for question, plan in asked:
        header, _, engine = answer_plan(spark, question, plan, database=STAR_COPY)
        answers.append(header.select(*HEADLINE, F.lit(engine).alias("motor")))
    return reduce(DataFrame.unionByName, answers)


# The intents that total by two keys that both grow. Their totals are nearly as many as the
# lines and are shuffled with names; the others share theirs, SQL with builder and one intent with another.
LONG_TOTALS = ("top_productos_por_tienda",)


def reconcile_sql_with_builders(spark: SparkSession, folder: str) -> DataFrame:
    """Per approved query: rows of the SQL text, and rows on which it and the builder differ."""
    with shuffles_freed(spark):
        star = published_star(spark, folder)
    compared = []
    for intent, entry in CATALOG.items():
        weigh = reconcile_apart if intent in LONG_TOTALS else reconcile
        apart = weigh(run_intent(spark, intent, STAR_COPY), entry.build(star))
        # a union of single partitions is one task: dealt, each intent is compared in a task of its own
        compared.append(apart.withColumn("intencion", F.lit(intent)).repartition(1))
    return reduce(DataFrame.unionByName, compared)


def suite_records(spark: SparkSession, folder: str) -> DataFrame:
    star = star_from_given(spark, folder)
    questions = [(question, name) for question, name, _ in inputs.SUITE_QUESTIONS]
    runners = {"spark": lambda intent: CATALOG[intent].build(star)}
    return run_suite(spark, runners, questions=questions)


def suite_run(spark: SparkSession, folder: str) -> DataFrame:
    records = suite_records(spark, folder)
    return records.select("tipo", "nombre", "intencion", "motor_resuelto", "estado", "filas")


def suite_usage(spark: SparkSession, folder: str) -> DataFrame:
    """Whether every run of a suite has its time, CPU and memory measured."""
    cpu, mem, seconds = (F.col(f"spark_{m}") for m in ("cpu_pct", "mem_mb", "tiempo_s"))
    return suite_records(spark, folder).select(
        "nombre",
        F.coalesce(seconds > 0, F.lit(False)).alias("con_tiempo"),
        F.coalesce((cpu > 0) & (cpu <= 100), F.lit(False)).alias("con_cpu"),
        F.coalesce(mem >= 0, F.lit(False)).alias("con_memoria"),
    )


def run_records(spark: SparkSession, folder: str) -> DataFrame:
    """Run records of every pair of events, written as CSV and JSON and read back."""
    path = scratch_folder(spark)
    write_records(records_from_runs(spark_table(spark, folder, inputs.RUNS)), path)
    return read_records(spark, path).drop("sql", "pregunta", "error", "tipo", "estado")


def records_in_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Records read from their CSV against those from their JSON."""
    path = scratch_folder(spark)
    write_records(records_from_runs(spark_table(spark, folder, inputs.RUNS)), path)
    return reconcile(read_records(spark, path, "csv"), read_records(spark, path))


def speedups(df: DataFrame) -> DataFrame:
    return records_from_runs(df).select(
        "nombre", "intencion", "hive_tiempo_s", "spark_tiempo_s", "speedup_spark_vs_hive"
    )


def executors_of(spark: SparkSession, folder: str) -> DataFrame:
    raw = spark_table(spark, folder, inputs.EXECUTORS)
    peak = F.struct(
        F.col("heap").alias("JVMHeapMemory"), F.col("off_heap").alias("JVMOffHeapMemory")
    )
    executors = raw.select(
        "run_id",
        "snapshot",
        F.col("total_duration").alias("totalDuration"),
        F.col("total_cores").alias("totalCores"),
        F.col("memory_used").alias("memoryUsed"),
        F.when(F.col("heap").isNotNull(), peak).alias("peakMemoryMetrics"),
    )
    return executor_usage(executors, spark_table(spark, folder, inputs.RUN_TIMES))


QUERIES: dict[str, Query] = {
    "q01_top_customers_by_lines": on_star(catalog.top_customers_by_lines),
    "q02_sales_by_store": on_star(catalog.sales_by_store),
    "q03_sales_by_month": on_star(catalog.sales_by_month),
    "q04_sales_by_weekday": on_star(catalog.sales_by_weekday),
    "q05_top_products_per_store": on_star(catalog.top_products_per_store),
    "q06_average_line_by_customer": on_star(catalog.average_line_by_customer),
    "q07_products_by_revenue": on_star(catalog.products_by_revenue),
    "q08_customers_by_spending": on_star(catalog.customers_by_spending),
    "q09_monthly_store_ranking": on_star(catalog.monthly_store_ranking),
    "q10_best_selling_products": on_star(catalog.best_selling_products),
    "q11_best_store": on_star(catalog.best_store),
    "q12_best_month": on_star(catalog.best_month),
    "q13_best_customers": on_star(catalog.best_customers),
    "q14_profit_by_state": on_star(catalog.profit_by_state),
    "ranking_spread": on_star(lambda star: catalog.monthly_store_ranking(spread_heavy(star))),
    "q15_table_counts": on_star(star_counts),
    "null_key_join": on_star(catalog.top_customers_by_lines, gaps=True),
    "null_sum": on_star(catalog.sales_by_month, gaps=True),
    "null_average": on_star(catalog.average_line_by_customer, gaps=True),
    "name_fallback": on_star(catalog.best_selling_products, gaps=True),
    "item_id_vs_sk": on_star(item_versions),
    "topn_row_number": latest_orders,
    "topn_rank_ties": largest_lines,
    "norm_text": on_input(inputs.TEXTS, normalized_texts),
    "norm_key": on_input(inputs.TEXTS, key_texts),
    "route_intent": routed_by(lambda: first_rule(F.col("norm"), INTENT_RULES), "intencion"),
    "route_fallback": routed_by(lambda: first_rule(F.col("norm"), FALLBACK_RULES), "intencion"),
    "tag_preference": routed_by(lambda: first_rule(F.col("norm"), ENGINE_RULES), "motor"),
    "screen_unsafe": routed_by(lambda: q.is_unsafe().cast("int"), "insegura"),
    "route_questions": on_input(inputs.QUESTIONS, routed_questions),
    "resolve_mode": on_input(inputs.QUESTIONS, resolved_modes),
    "route_quality": on_input(
        inputs.LABELLED_QUESTIONS,
        lambda df: q.routing_quality(labelled(df), "esperada", "obtenida"),
    ),
    "route_confusion": on_input(
        inputs.LABELLED_QUESTIONS,
        lambda df: q.routing_confusion(labelled(df), "esperada", "obtenida"),
    ),
    "catalog_usage": on_input(inputs.QUESTIONS, catalog_usage),
    "workload_class": on_input(inputs.QUESTIONS, classed),
    "audit_sql": on_input(inputs.STATEMENT_TEXTS, lambda df: audit(df).select("id", "codigo")),
    "match_catalog": on_input(
        inputs.SQL_TEXTS, lambda df: match_catalog(df).select("id", "intencion")
    ),
    "strip_fence": on_input(
        inputs.ANSWERS,
        lambda df: df.select("id", without_fence(F.col("respuesta")).alias("texto")),
    ),
    "parse_plan": on_input(inputs.PLANS, lambda df: parse_plans(df).drop("respuesta")),
    "plan_resolve": on_input(
        inputs.PLANS, lambda df: resolve_plans(parse_plans(df)).drop("respuesta")
    ),
    "resolve_requests": on_input(
        inputs.REQUESTS, lambda df: resolve_requests(df).drop("pregunta", "modo")
    ),
    "log_last_match": on_input(
        inputs.LOGS, lambda df: df.select("event_id", last_match(F.col("linea")).alias("trabajo"))
    ),
    "to_number": on_input(
        inputs.NUMBER_TEXTS,
        lambda df: df.select("event_id", to_number(F.col("texto")).alias("numero")),
    ),
    "format_number": on_input(inputs.AMOUNTS, formatted),
    "month_label": on_input(inputs.MONTHS, month_labels),
    "result_shape_store": displayed("ventas_por_tienda"),
    "result_shape_month": displayed("ventas_por_mes"),
    "result_shape_ranking": displayed("ranking_mensual_ventas"),
    "chart_store": charted("ventas_por_tienda"),
    "chart_month": charted("ventas_por_mes"),
    "headline_month": headline("ventas_por_mes"),
    "headline_products": headline("productos_mayor_ingreso"),
    "ask_best_month": best_month_answer,
    "headline_empty": headline("ventas_por_mes", lambda df: df.where("ventas_totales < 0")),
    "headline_text": textual_headline,
    "answer_json": on_star(json_answer),
    "answer_rows": all_rows(("numero_compras DESC", "l_orderkey")),
    "answer_rows_own_order": all_rows(()),
    "text_roundtrip": text_round_trip,
    "convert_status": convert_status,
    "damaged_lines": damaged_lines,
    "register_counts": register_counts,
    "raw_vs_parquet": raw_vs_parquet,
    "parity_faults": parity_faults,
    "parity_rows": parity_rows,
    "year_by_day": year_by_day,
    "saved_star_by_month": saved_star_by_month,
    "tab_result": tab_result,
    "adhoc_profit": adhoc_profit,
    "reconcile_sql_df": reconcile_sql_with_builders,
    "planned_answers": planned_answers,
    "suite_run": suite_run,
    "suite_usage": suite_usage,
    "run_records": run_records,
    "records_in_csv": records_in_csv,
    "runs_speedup": on_input(inputs.RUNS, speedups),
    "executor_usage": executors_of,
    "application_usage": on_input(inputs.APPLICATIONS, application_usage),
}

