from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.functions import PandasUDFType, pandas_udf, udtf

from checks.queries import WORST_LINES
from mostrador.operators.audit import audit, audit_text
from mostrador.plans.adhoc import is_built_in, outside_star, run_intent, run_sql
from mostrador.plans.ask import answer_plan, ask, run_plan
from mostrador.plans.catalog import CATALOG
from mostrador.plans.planning import parse_plans, resolve_plans, resolve_requests
from mostrador.plans.statements import STATEMENTS, match_catalog, over, statement
from mostrador.session import scratch_folder
from mostrador.sources.star import STAR_DATABASE, STAR_TABLES, publish_star, star_from_given
from mostrador.sources.tables import drop_tables
from tests.conftest import SMALL

CASES = [
    ("SELECT 1 FROM tpcds_parquet.store", None),
    ("  with x as (select 1) select * from tpcds_parquet.item, x \n", None),
    ("SELECT used, reuse, updated FROM tpcds_parquet.item", None),
    ("", "empty"),
    (" \n\t", "empty"),
    ("DELETE FROM tpcds_parquet.item", "not_select"),
    ("SELECT 1; SELECT 2", "several_statements"),
    ("SELECT 1 FROM tpcds_parquet.item;", "several_statements"),
    ("SELECT 1 -- x", "comment"),
    ("SELECT /* x */ 1", "comment"),
    ("SELECT 'please drop it' FROM tpcds_parquet.item", "banned_word"),
    ("SELECT (load) FROM tpcds_parquet.item", "banned_word"),
    ("SELECT 'ñuse' FROM tpcds_parquet.item", None),
    ("SELECT 1 FROM store", "no_star_table"),
    ("SELECT 1 FROM tpcds_parquet.web_sales", "foreign_table"),
    ("SELECT 1 FROM tpcds_parquet.item JOIN tpcds_parquet.reason", "foreign_table"),
]


def test_a_null_statement_is_empty(spark):
    table = spark.createDataFrame([(None,), ("  ",)], "sql string")
    assert [r["codigo"] for r in audit(table).collect()] == ["empty", "empty"]


def test_audit(spark):
    table = spark.createDataFrame([(i, sql) for i, (sql, _) in enumerate(CASES)], "i int, sql string")
    got = dict(audit(table).select("i", "codigo").collect())
    assert got == {i: code for i, (_, code) in enumerate(CASES)}


def test_approved_statements_pass_the_audit_and_cover_the_catalog(spark):
    assert set(STATEMENTS) == set(CATALOG)
    for sql in STATEMENTS.values():
        assert audit_text(spark, sql) is None
    with pytest.raises(ValueError):
        statement("nada")


def test_match_catalog_ignores_blanks_only(spark):
    sql = STATEMENTS["ventas_por_mes"]
    texts = [sql, "\n\n" + sql.replace(" ", " \t\n "), sql.lower(), sql + " x"]
    table = spark.createDataFrame(list(enumerate(texts)), "i int, sql string")
    assert dict(match_catalog(table).select("i", "intencion").collect()) == {
        0: "ventas_por_mes", 1: "ventas_por_mes", 2: None, 3: None,
    }


OWN = "SELECT s_state FROM tpcds_parquet.store"
PLANS = [
    ({"tipo": "catalogo", "intencion": "Ventas por mes", "sql": None, "motor": "Spark"},
     (STATEMENTS["ventas_por_mes"], "spark", None)),
    ({"tipo": "Dinámica", "intencion": "x", "sql": f"```sql\n{OWN};\n```", "motor": "hive"},
     (OWN, "hive", None)),
    ({"tipo": "no analitica", "motor": "x"}, (None, None, "not_analytic")),
    ({"tipo": "catalogo", "intencion": "x", "motor": "hive"}, (None, None, "unknown_intent")),
    ({"tipo": "catalogo", "intencion": "ventas_por_mes", "motor": "presto"},
     (None, None, "unknown_engine")),
    ({"tipo": "dinamica", "sql": "SELECT 1; DROP TABLE x", "motor": "hive"},
     (None, None, "sql_several_statements")),
    ({"tipo": "dinamica", "sql": "SELECT * FROM tpcds_parquet.web_sales", "motor": "spark"},
     (None, None, "sql_foreign_table")),
    ({"tipo": "dinamica", "sql": None, "motor": "spark"}, (None, None, "sql_not_select")),
    ({"tipo": "otra", "motor": "spark"}, (None, None, "unknown_kind")),
    ("no es json", (None, None, "not_json")),
    ([1, 2], (None, None, "not_json")),
    ("", (None, None, "not_json")),
]


def test_plans(spark):
    texts = [(i, p if isinstance(p, str) else json.dumps(p)) for i, (p, _) in enumerate(PLANS)]
    texts.append((len(PLANS), f"```json\n{json.dumps(PLANS[0][0])}\n```"))
    table = spark.createDataFrame(texts, "i int, respuesta string")
    got = {r["i"]: (r["sentencia"], r["motor"], r["error"])
           for r in resolve_plans(parse_plans(table)).collect()}
    expected = {i: outcome for i, (_, outcome) in enumerate(PLANS)}
    assert got == {**expected, len(PLANS): PLANS[0][1]}


@pytest.fixture(scope="module")
def published(spark):
    publish_star(spark, star_from_given(spark, SMALL), scratch_folder(spark))


def test_adhoc_runs(spark, published):
    assert run_sql(spark, WORST_LINES).columns == ["nombre", "peor", "lineas"]
    assert run_intent(spark, "diez_mejores_clientes").count() == 10


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT 1",
        "DROP TABLE tpcds_parquet.item",
        "SELECT * FROM tpcds_parquet.item, default.secreto",
        "SELECT * FROM tpcds_parquet.item, `default`.secreto",
        "SELECT * FROM tpcds_parquet.item, spark_catalog.default.secreto",
        "SELECT * FROM tpcds_parquet.item, IDENTIFIER('def' || 'ault.secreto')",
        f"SELECT * FROM tpcds_parquet.item, parquet.`{SMALL}/part.parquet`",
        "SELECT * FROM tpcds_parquet.item, mi_vista",
        "SELECT TRANSFORM(s_state) USING 'head -c 20' AS (x string) FROM tpcds_parquet.store",
        "SELECT java_method('java.lang.System', 'getProperty', 'user.home') FROM tpcds_parquet.store",
        "SELECT s_state FROM tpcds_parquet.store WHERE reflect('java.lang.Math', 'abs', 1) = '1'",
        "SELECT (SELECT try_reflect('java.lang.Math', 'abs', 1) FROM tpcds_parquet.item LIMIT 1) FROM tpcds_parquet.store",
        "SELECT * FROM tpcds_parquet.item, global_temp.ajena",
        "SELECT * FROM tpcds_parquet.item, otra_tabla",
        "SELECT * FROM tpcds_parquet.item, `tpcds_parquet`.otra_tabla",
    ],
)
def test_adhoc_stays_inside_the_star(spark, published, sql):
    spark.range(1).createOrReplaceTempView("mi_vista")
    spark.range(1).createOrReplaceGlobalTempView("ajena")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS tpcds_parquet.otra_tabla USING PARQUET LOCATION '{SMALL}/part.parquet'"
    )
    with pytest.raises(Exception) as refusal:
        run_sql(spark, sql).collect()
    assert "refused" in str(refusal.value) or "TABLE_OR_VIEW_NOT_FOUND" in str(refusal.value)


def test_adhoc_accepts(spark, published):
    literal = "SELECT 'default.' AS x, count(*) AS n FROM tpcds_parquet.store"
    assert run_sql(spark, literal).first()["n"] == 10
    named = "WITH item AS (SELECT 1 AS a) SELECT a FROM item, tpcds_parquet.store"
    assert run_sql(spark, named).count() == 10


def test_plan_to_result(spark, published):
    plan = {"tipo": "dinamica", "sql": f"{WORST_LINES};", "motor": "spark"}
    assert run_plan(spark, json.dumps(plan)).count() == 10
    plan = {"tipo": "catalogo", "intencion": "ventas por dia semana", "motor": "hive"}
    assert run_plan(spark, json.dumps(plan)).count() == 7
    with pytest.raises(ValueError, match="not_analytic"):
        run_plan(spark, '{"tipo": "no_analitica"}')


def test_requests_settle_on_an_engine(spark):
    plan = json.dumps({"tipo": "catalogo", "intencion": "ventas por mes", "motor": "hive"})
    requests = [
        ("Ventas por mes", "auto", plan, "hive", None),
        ("Ventas por mes con spark", "auto", plan, "spark", None),
        ("Ventas por mes con spark", "HIVE", plan, "hive", None),
        ("Ventas por mes", "both", plan, "both", None),
        ("Ventas por mes", None, plan, None, "unknown_mode"),
        ("Ventas por mes", "presto", "no", None, "unknown_mode"),
        ("Borra las ventas", "auto", plan, None, "unsafe_question"),
        ("Ventas por mes", "auto", "", None, "not_json"),
        (None, "auto", plan, "hive", None),
        # without a plan the rules choose the query, and its class the engine
        ("Ventas por mes", "auto", None, "spark", None),
        ("Ventas por mes con hive", "auto", None, "hive", None),
        ("Ventas por mes con hive", "both", None, "both", None),
        ("¿Qué tal?", "auto", None, None, "unknown_intent"),
        ("Borra las ventas por mes", "auto", None, None, "unsafe_question"),
        ("Ventas por mes", "presto", None, None, "unknown_mode"),
        (None, "auto", None, None, "unknown_intent"),
    ]
    schema = "id int, pregunta string, modo string, respuesta string"
    table = spark.createDataFrame([(i, *r[:3]) for i, r in enumerate(requests)], schema)
    got = {r["id"]: (r["sentencia"], r["motor"], r["error"]) for r in resolve_requests(table).collect()}
    for i, (_, _, _, engine, error) in enumerate(requests):
        assert got[i] == (None if error else STATEMENTS["ventas_por_mes"], engine, error), i


def test_plan_to_answer(spark, published):
    plan = json.dumps({"tipo": "dinamica", "sql": WORST_LINES, "motor": "hive"})
    header, rows, engine = answer_plan(spark, "¿Dónde se pierde más?", plan)
    want = run_sql(spark, WORST_LINES).collect()
    assert engine == "hive" and header.first()["sql"] == WORST_LINES
    shown = sorted(rows.collect(), key=lambda r: r["pos"])
    assert [r["fila"][0] for r in shown] == [r["nombre"] for r in want]
    with pytest.raises(ValueError, match="unknown_mode"):
        answer_plan(spark, "x", plan, "presto")


def test_question_to_answer(spark):
    star = star_from_given(spark, SMALL)
    header, rows = ask(spark, star, "¿Cuáles son los diez mejores clientes?")
    answer = header.first()
    assert answer["matched"] == rows.count() == 10 and len(answer["chart"]) == 8
    assert answer["cols"] == ["cliente", "gasto total"]
    assert answer["sql"] == STATEMENTS["diez_mejores_clientes"]
    assert answer["spark"] > 0 and answer["hive"] is None
    for question, code in [("  ", "empty_question"), ("¿Qué tal?", "unknown_intent"),
                           ("Borra los clientes", "unsafe_question")]:
        with pytest.raises(ValueError, match=code):
            ask(spark, star, question)


def test_adhoc_keeps_the_caller_settings(spark, published):
    assert run_sql(spark, WORST_LINES).sparkSession.conf.get("spark.sql.shuffle.partitions") == "8"
    assert spark.conf.get("spark.sql.runSQLOnFiles") == "true"
    assert spark.range(1).select(F.lit(1)).count() == 1


class Doubled:
    def eval(self, x: int):
        yield (2 * x,)


def test_only_built_in_calls_are_accepted(spark):
    spark.udf.register("propia", lambda x: x, "string")
    spark.udtf.register("tabla", udtf(Doubled, returnType="x int"))
    spark.udf.register("grupo", pandas_udf(lambda v: v.sum(), "double", PandasUDFType.GROUPED_AGG))
    for sql in (
        "SELECT propia('x')",
        "SELECT * FROM tabla(3)",
        "SELECT grupo(id) FROM VALUES (1), (2) AS t(id)",
        "SELECT id FROM VALUES (1) AS t(id) WHERE EXISTS (SELECT 1 WHERE propia('x') = 'x')",
        "SELECT rand()",
        "SELECT uuid()",
        "SELECT input_file_name()",
        "SELECT reflect('java.lang.Math', 'abs', 1)",
    ):
        assert outside_star(spark.sql(sql)) == "outside_call", sql
    for sql in (
        "SELECT sum(id), max_by(id, -id), percentile_approx(id, 0.5), count(DISTINCT id) FROM VALUES (1), (2) AS t(id)",
        "SELECT luhn_check('79927398713'), to_json(struct(1)), date_format(DATE'2020-01-01', 'EEEE'), mask('a1')",
        "SELECT parse_url('http://a.b/c', 'HOST'), split_part('a,b', ',', 1), rank() OVER (ORDER BY 1), sha2('x', 256)",
        "SELECT transform(array(1, 2), x -> x + 1), from_json('{\"a\": 1}', 'a int'), regexp_extract('a1', '([0-9])', 1)",
        "SELECT explode(sequence(1, 3)), current_date(), try_divide(1, 0), CAST('1' AS DECIMAL(5, 2)) DIV 2",
    ):
        assert outside_star(spark.sql(sql)) is None, sql


@pytest.mark.parametrize("name", [
    "org.apache.spark.sql.hive.HiveGenericUDTF",
    "org.apache.spark.sql.hive.HiveUDAFFunction",
    "org.apache.spark.sql.hive.HiveSimpleUDF",
    "org.apache.spark.sql.execution.aggregate.ScalaAggregator",
    "org.apache.spark.sql.catalyst.expressions.PythonUDTF",
    "org.apache.spark.sql.catalyst.expressions.PythonUDAF",
    "org.apache.spark.sql.catalyst.expressions.ScalaUDF",
    "org.apache.spark.sql.catalyst.expressions.CallMethodViaReflection",
    "org.apache.spark.sql.catalyst.expressions.ApplyFunctionExpression",
    "org.apache.spark.sql.catalyst.expressions.aggregate.V2Aggregator",
    "com.example.catalyst.expressions.Add",
])
def test_foreign_expressions_are_refused(spark, name):
    if name.startswith("org.apache.spark.sql.") and "ScalaAggregator" not in name:
        assert spark._jvm.java.lang.Class.forName(name) is not None  # the name is a real one
    assert not is_built_in(name)
    assert is_built_in("org.apache.spark.sql.catalyst.expressions.aggregate.Sum")


def test_a_star_in_another_database(spark):
    publish_star(spark, star_from_given(spark, SMALL), scratch_folder(spark), "otra_estrella")
    try:
        sql = over(WORST_LINES, "otra_estrella")
        assert "tpcds_parquet" not in sql and run_sql(spark, sql, "otra_estrella").count() == 10
        assert run_intent(spark, "ventas_por_mes", "otra_estrella").count() > 12
        for refused, database in ((WORST_LINES, "otra_estrella"), (sql, STAR_DATABASE)):
            with pytest.raises(ValueError, match="refused"):
                run_sql(spark, refused, database)
        header, _, engine = answer_plan(spark, "Ventas por mes", None, database="otra_estrella")
        assert engine == "spark" and "otra_estrella.store_sales" in header.first()["sql"]
    finally:
        drop_tables(spark, "otra_estrella", STAR_TABLES)


def test_the_audit_of_one_text_starts_no_job(spark):
    tag = "auditoria"
    spark.sparkContext.addJobTag(tag)
    try:
        assert audit_text(spark, STATEMENTS["ventas_por_mes"]) is None
        assert audit_text(spark, "SELECT 1 -- nada") == "comment"
        assert list(spark.sparkContext._jsc.sc().statusTracker().getJobIdsForTag(tag)) == []
    finally:
        spark.sparkContext.removeJobTag(tag)
