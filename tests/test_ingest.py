from __future__ import annotations

import time
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegerType, LongType, StringType

from mostrador.operators.reconcile import (
    differences,
    differing_rows,
    parity,
    parity_differences,
    reconcile,
    reconcile_apart,
    unequal_buckets,
)
from mostrador.session import FREED, scratch_folder
from mostrador.sources import delimited, tables
from mostrador.sources.together import POOL, together
from mostrador.sources.schemas import STAR_SCHEMAS, column_type, schemas_from_ddl, schemas_from_file
from tests.conftest import left_behind, shuffle_files

DDL = """
-- two tables
CREATE EXTERNAL TABLE IF NOT EXISTS uno (
    a int,
    -- a comment, with a comma
    b   decimal( 5 , 2 ),
    c date,
    d string
)
ROW FORMAT DELIMITED FIELDS TERMINATED BY '|' LOCATION 'x';
create table db.dos (k bigint, v varchar(10), m decimal, w double) USING CSV
"""


def test_schemas_from_ddl(tmp_path):
    schemas = schemas_from_ddl(DDL)
    assert list(schemas) == ["uno", "dos"]
    assert [(f.name, f.dataType, f.nullable) for f in schemas["uno"]] == [
        ("a", IntegerType(), True), ("b", DecimalType(5, 2), True), ("c", DateType(), True),
        ("d", StringType(), True),
    ]
    assert [f.dataType for f in schemas["dos"]] == [
        LongType(), StringType(), DecimalType(7, 2), StringType(),
    ]
    (tmp_path / "t.sql").write_text(DDL)
    assert schemas_from_file(str(tmp_path / "t.sql")) == schemas
    assert column_type("DECIMAL(15,2)") == DecimalType(15, 2)
    assert [len(s) for s in STAR_SCHEMAS.values()] == [5, 6, 6, 5, 8]


LINES = [
    "1|2.50|2020-01-02|x|",  # a trailing separator
    "2|||",
    "3|1.5",  # a short line
    "four|2.5|2020-13-45|y",  # an int and a date that do not parse
    "5|123456.789|2020-01-02|z",  # too large for the type
    '6|1.005|2020-01-02|say "hi"',
    "7|1|2020-01-02|w|extra|more",
]


def test_typed_scan(spark, tmp_path):
    (tmp_path / "uno").mkdir()
    (tmp_path / "uno" / "part.dat").write_text("\n".join(LINES) + "\n")
    got = delimited.read_delimited(spark, str(tmp_path / "uno"), schemas_from_ddl(DDL)["uno"])
    day = date(2020, 1, 2)
    assert [tuple(r) for r in got.collect()] == [
        (1, Decimal("2.50"), day, "x"),
        (2, None, None, None),
        (3, Decimal("1.50"), None, None),
        (None, Decimal("2.50"), None, "y"),
        (5, None, day, "z"),
        (6, Decimal("1.01"), day, 'say "hi"'),
        (7, Decimal("1.00"), day, "w"),
    ]


def test_convert_reports_each_table(spark, tmp_path):
    (tmp_path / "uno").mkdir()
    (tmp_path / "uno" / "part.dat").write_text("\n".join(LINES))
    schemas = {**schemas_from_ddl(DDL), "malo": schemas_from_ddl(DDL)["uno"]}
    (tmp_path / "malo").mkdir()
    (tmp_path / "malo" / "x.gz").write_text("not gzip")
    status = delimited.convert(spark, schemas, str(tmp_path), str(tmp_path / "out"))
    got = {r["tabla"]: (r["estado"], r["filas"]) for r in status.collect()}
    assert got == {"uno": ("ok", 7), "dos": ("omitida", None), "malo": ("error", None)}
    lost = {r["tabla"]: (r["ilegibles"], r["cortas"], r["largas"]) for r in status.collect()}
    # unreadable: an int with a date, a decimal too large; short: the third; long: the last
    assert lost == {"uno": (2, 1, 1), "dos": (None,) * 3, "malo": (None,) * 3}
    assert [r["tabla"] for r in status.collect()] == ["uno", "dos", "malo"]
    assert spark.read.parquet(str(tmp_path / "out" / "uno")).schema == schemas["uno"]
    typed = delimited.read_delimited(spark, str(tmp_path / "uno"), schemas["uno"])
    assert sorted(spark.read.parquet(str(tmp_path / "out" / "uno")).collect(), key=str) == sorted(typed.collect(), key=str)


def test_losses_with_a_column_of_the_same_name(spark, tmp_path):
    (tmp_path / "x.txt").write_text("1|a|\n|\n2\n\n3|b||\nz|c\n4|d|e\n")
    schema = schemas_from_ddl("CREATE TABLE t (_linea int, b string) USING CSV")["t"]
    seen = delimited.convert_table(spark, schema, str(tmp_path / "x.txt"), str(tmp_path / "out"))
    # an empty line is skipped, "3|b||" has one field too many, and so has "4|d|e"
    assert seen == {"filas": 6, "ilegibles": 1, "cortas": 1, "largas": 2}
    assert spark.read.parquet(str(tmp_path / "out")).columns == ["_linea", "b"]


def test_tables_are_converted_together(spark, tmp_path):
    text = "\n".join(f"{i}|{i}.5|2020-01-02|x{i}" for i in range(20_000))
    schemas = {f"t{i}": schemas_from_ddl(DDL)["uno"] for i in range(24)}
    for name in schemas:
        (tmp_path / name).mkdir()
        (tmp_path / name / "part.dat").write_text("roto" if name == "t5" else text)
    (tmp_path / "t7" / "x.gz").write_text("not gzip")
    started = time.perf_counter()
    status = delimited.convert(spark, schemas, str(tmp_path), str(tmp_path / "out"), at_once=8).collect()
    wall = time.perf_counter() - started
    assert [r["tabla"] for r in status] == list(schemas)
    assert [r["estado"] for r in status] == ["error" if n == "t7" else "ok" for n in schemas]
    assert [r["filas"] for r in status] == [{"t5": 1, "t7": None}.get(n, 20_000) for n in schemas]
    assert [r["ilegibles"] for r in status if r["tabla"] == "t5"] == [1]
    assert wall < 0.6 * sum(r["segundos"] for r in status)


def test_work_together_keeps_order_and_properties(spark):
    spark.sparkContext.setLocalProperty("mio", "7")
    seen = together(
        spark,
        lambda i: (i, spark.sparkContext.getLocalProperty("mio"), spark.sparkContext.getLocalProperty(POOL)),
        range(20),
        at_once=3,
    )
    assert seen == [(i, "7", f"mostrador-{i % 3}") for i in range(20)]
    assert spark.sparkContext.getLocalProperty(POOL) is None
    with pytest.raises(ZeroDivisionError):
        together(spark, lambda i: 1 // i, [1, 0, 2])
    with pytest.raises(ValueError):
        together(spark, str, [1], at_once=0)


def test_register_drop_and_list(spark, tmp_path):
    schema = {"uno": schemas_from_ddl(DDL)["uno"]}
    (tmp_path / "uno").mkdir()
    (tmp_path / "uno" / "part.dat").write_text("\n".join(LINES))
    delimited.convert(spark, schema, str(tmp_path), str(tmp_path / "out"))
    for name in ("prueba_t", "prueba_p", "prueba_f"):
        tables.create_database(spark, name, str(tmp_path / name))
        tables.create_database(spark, name)
    for _ in range(2):  # registering twice changes nothing
        tables.register_text(spark, "prueba_t", schema, str(tmp_path))
        tables.register_parquet(spark, "prueba_p", schema, str(tmp_path / "out"))
        tables.register_parquet_from_files(spark, "prueba_f", {"uno": str(tmp_path / "out/uno")})
    text, parquet, inferred = (spark.table(f"{d}.uno") for d in ("prueba_t", "prueba_p", "prueba_f"))
    assert text.schema == parquet.schema == inferred.schema == schema["uno"]
    assert reconcile(text, parquet).first()["solo_izquierda"] == 0
    assert reconcile(inferred, parquet).first()["solo_derecha"] == 0
    assert [r[0] for r in tables.list_tables(spark, "prueba_t").collect()] == ["uno"]
    spark.sql("CREATE TABLE prueba_t.propia AS SELECT 1 AS a")
    with pytest.raises(ValueError, match="MANAGED"):
        tables.drop_tables(spark, "prueba_t", ["uno", "propia"])
    assert spark.table("prueba_t.propia").count() == 1 and spark.table("prueba_t.uno").count() >= 0
    spark.sql("DROP TABLE prueba_t.propia")
    tables.drop_tables(spark, "prueba_t", ["uno", "nunca"])
    assert tables.list_tables(spark, "prueba_t").count() == 0
    assert (tmp_path / "uno" / "part.dat").exists()


def test_tab_result_stays_text(spark, tmp_path):
    (tmp_path / "r.tsv").write_text('mes\tventas\n1\t10.50\n2\t\n\n3\t"x"\n')
    got = delimited.read_tab_result(spark, str(tmp_path / "r.tsv"))
    assert got.dtypes == [("mes", "string"), ("ventas", "string")]
    assert [tuple(r) for r in got.collect()] == [("1", "10.50"), ("2", ""), ("3", '"x"')]


def test_sides_run_apart_reconcile_as_together_and_leave_no_shuffle(spark):
    def side(*rows):
        # folded, then ordered: two shuffles
        return spark.createDataFrame(rows, "k int, t string, n int").groupBy("k", "t").agg(F.sum("n").alias("n")).orderBy("k")

    left = side((1, "a", 1), (1, "a", 2), (2, None, 3), (None, None, None), (4, "a\nb", 5))
    right = side((1, "a", 3), (None, None, None), (2, None, 4)).unionByName(side((1, "a", 3)))
    right = right.select("n", "t", "k")  # columns pair up by name
    held = shuffle_files(spark)
    apart = reconcile_apart(left, right)
    assert left_behind(spark, held) == set()
    assert spark.conf.get(FREED) == "false"
    assert tuple(apart.first()) == tuple(reconcile(left, right).first()) == (4, 4, 2, 2)
    assert tuple(reconcile_apart(left.limit(0), left).first()) == (0, 4, 0, 4)


def test_reconcile_counts_duplicates(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k int, v string")
    right = spark.createDataFrame([("a", 1), (None, 2), ("d", 4), ("d", 4)], "v string, k int")
    assert tuple(reconcile(left, right).first()) == (4, 4, 2, 2)
    assert {tuple(r) for r in differences(left, right).collect()} == {
        (1, "a", 1), (3, "c", 1), (4, "d", -2),
    }
    empty = left.where("k < 0")
    assert tuple(reconcile(empty, empty).first()) == (0, 0, 0, 0)


def test_parity(spark):
    one = spark.range(100).withColumn("v", F.col("id") * 2)
    other = one.withColumn("v", F.when(F.col("id") == 50, 0).otherwise(F.col("v")))
    got = {
        r["tabla"]: tuple(r)[1:]
        for r in parity({"a": one, "b": one, "c": one}, {"a": one.repartition(7), "b": other}).collect()
    }
    assert got == {"a": (100, 100, True), "b": (100, 100, False), "c": (100, None, False)}


class Cluster:
    """As much of a session as a scratch folder asks for."""

    class sparkContext:
        master = "yarn"

    def __init__(self, **settings):
        self.conf = settings


def test_scratch_folder_needs_a_shared_place_on_a_cluster():
    shared = Cluster(**{"spark.checkpoint.dir": "hdfs:///shared/"})
    first, second = scratch_folder(shared), scratch_folder(shared)
    assert first.startswith("hdfs:///shared/mostrador-") and first != second
    with pytest.raises(RuntimeError):
        scratch_folder(Cluster())


def sides(spark, rows: int):
    left = spark.range(rows).select(
        "id", F.concat(F.lit("v"), F.col("id") % 7).alias("v"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("w")
    )
    changed = left.where("id <> 5").withColumn("v", F.when(F.col("id") == 11, "x").otherwise(F.col("v")))
    right = changed.unionByName(left.where("id IN (20, 20, 21)")).unionByName(left.where("id = 20"))
    return left, right


@pytest.mark.parametrize("levels, buckets", [(1, 4), (1, 4096), (2, 4096), (3, 8)])
def test_differing_rows_are_all_differences(spark, levels, buckets):
    left, right = sides(spark, 3_000)
    got = sorted(map(tuple, differing_rows(left, right.select("w", "v", "id"), levels, buckets).collect()), key=str)
    want = sorted(map(tuple, differences(left, right).collect()), key=str)
    assert got == want and len(got) == 5
    assert {r[0]: r[-1] for r in got if r[0] != 11} == {5: 1, 20: -2, 21: -1}
    assert differing_rows(left, left, levels, buckets).count() == 0
    assert differing_rows(left.limit(0), left.limit(0), levels, buckets).count() == 0


def test_only_unequal_buckets_are_shuffled(spark):
    left, right = sides(spark, 20_000)
    assert unequal_buckets(left, right, 1).count() == 5  # of 4096: the rows 5, 11 twice, 20, 21
    assert unequal_buckets(left, left, 1).count() == 0

    def shuffled(df) -> list[int]:
        df.collect()
        return shuffle_rows(df._jdf.queryExecution().executedPlan())

    sums, *rows = sorted(shuffled(differing_rows(left, right)), reverse=True)
    assert sum(rows) < 200  # rows of five buckets, against 40,000
    assert all(n == 0 for n in shuffled(differing_rows(left, left)) if n < 4096)


def shuffle_rows(plan) -> list[int]:
    """Rows written by every shuffle of a plan that has run."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return shuffle_rows(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return shuffle_rows(plan.plan())
    own = [plan.metrics().apply("shuffleRecordsWritten").value()] if kind == "ShuffleExchangeExec" else []
    children = plan.children()
    return own + [n for i in range(children.size()) for n in shuffle_rows(children.apply(i))]


def test_parity_names_the_rows(spark):
    left, right = sides(spark, 50)
    found = parity_differences({"a": left, "b": left, "solo": left.limit(2)}, {"a": right, "b": left})
    got = sorted(map(tuple, found.collect()))
    assert [g[0] for g in got] == ["a"] * 5 + ["solo"] * 2
    assert ("a", '{"id":5,"v":"v5","w":5}', 1) in got and ("a", '{"id":21,"v":"v0","w":null}', -1) in got
    assert all(g[2] == 1 for g in got if g[0] == "solo")
