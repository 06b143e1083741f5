"""The fact laid out by day: what a year reads, and that results stay as they are."""

from __future__ import annotations

import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from mostrador.plans import catalog
from mostrador.plans.adhoc import run_sql
from mostrador.session import scratch_folder
from mostrador.sources import tables
from mostrador.sources.star import (
    FIRST_DAY,
    FIRST_DAY_KEY,
    Fact,
    Star,
    publish_star,
    star_from_database,
    star_from_given,
)
from tests.conftest import SMALL

DAYS = 12  # of each year from 1994 to 1996


def day_key(day: date) -> int:
    return FIRST_DAY_KEY + (day - date.fromisoformat(FIRST_DAY)).days


@pytest.fixture(scope="module")
def small_star(spark):
    """The given star with the sales of a few days, a hot day, and sales without a day."""
    whole = star_from_given(spark, SMALL)
    keys = [day_key(date(year, 3, 1) + timedelta(d)) for year in (1994, 1995, 1996) for d in range(DAYS)]
    rows = whole.tables()["store_sales"]
    spread = F.element_at(F.array(*map(F.lit, keys)), (F.col("ss_ticket_number") % len(keys) + 1).cast("int"))
    moved = (
        F.when(F.col("ss_ticket_number") % 3 == 0, keys[DAYS + 1])
        .when(F.col("ss_ticket_number") % 50 == 1, None)
        .otherwise(spread)
    )
    sales = rows.withColumn("ss_sold_date_sk", moved.cast("int"))
    kept = spark.createDataFrame(sales.collect(), sales.schema)
    # Spark broadcasts the smaller side and prunes the other: here, too, that is the calendar
    dimensions = {**whole.dimensions(), "date_dim": whole.date_dim.where("d_year BETWEEN 1994 AND 1996")}
    return Star(lambda: Fact(kept), dimensions.__getitem__)


@pytest.fixture(scope="module")
def by_day(spark, small_star):
    folder = scratch_folder(spark)
    publish_star(spark, small_star, folder, "tienda_por_dia", by_day=True)
    return star_from_database(spark, "tienda_por_dia")


def scans(plan) -> list:
    """The file scans of a plan that has run, whatever stages AQE made of it."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return scans(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return scans(plan.plan())
    if kind == "FileSourceScanExec":
        return [plan]
    children = plan.children()
    return [scan for i in range(children.size()) for scan in scans(children.apply(i))]


def files_of_fact(df) -> int:
    df.collect()
    read = scans(df._jdf.queryExecution().executedPlan())
    return sum(s.metrics().apply("numFiles").value() for s in read if "store_sales" in s.toString())


def test_a_year_reads_the_files_of_its_days(spark, small_star, by_day, explained):
    year = catalog.sales_of_year(by_day, 1995)
    tree = explained(year)
    assert re.search(r"PartitionFilters: \[.*dynamicpruningexpression\(ss_sold_date_sk", tree)
    read, of_year = files_of_fact(year), by_day.sales.rows.where(f"ss_sold_date_sk DIV 366 = {day_key(date(1995, 3, 1)) // 366}")
    files = {r[0] for r in of_year.select(F.input_file_name()).distinct().collect()}
    assert read == len(files) < files_of_fact(by_day.sales.rows) / 2
    assert year.collect() == catalog.sales_of_year(small_star, 1995).collect() != []


def test_a_hot_day_is_written_by_several_tasks(spark, by_day):
    files = by_day.sales.rows.select("ss_sold_date_sk", F.input_file_name().alias("file")).distinct()
    most = files.groupBy("ss_sold_date_sk").count().agg(F.max("count")).first()[0]
    assert most >= 2


def test_sql_text_is_pruned_as_well(spark, small_star):
    publish_star(spark, small_star, scratch_folder(spark), by_day=True)
    sql = (
        "SELECT d_moy AS mes, SUM(ss_net_paid) AS pagado FROM tpcds_parquet.store_sales "
        "JOIN tpcds_parquet.date_dim ON d_date_sk = ss_sold_date_sk WHERE d_year = 1996 GROUP BY d_moy"
    )
    found = run_sql(spark, sql)
    assert files_of_fact(found) < files_of_fact(spark.table("tpcds_parquet.store_sales")) / 2
    want = catalog.sales_by_month(small_star).where("anio = 1996").select("mes", "ventas_totales")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect())) != []


@pytest.mark.parametrize("intent", list(catalog.CATALOG))
def test_approved_queries_give_the_same(small_star, by_day, intent):
    build = catalog.CATALOG[intent].build
    assert build(by_day).collect() == build(small_star).collect()


def test_sales_without_a_day_are_kept(small_star, by_day):
    for star in (small_star, by_day):
        assert star.sales.rows.where("ss_sold_date_sk IS NULL").count() > 0
    assert by_day.sales.rows.count() == small_star.sales.rows.count()
    assert by_day.sales.rows.schema == tables_of(small_star).schema


def tables_of(star: Star):
    return star.tables()["store_sales"]


def test_plain_folders_are_no_partitions(spark, small_star):
    folder = scratch_folder(spark)
    publish_star(spark, small_star, folder, "tienda_llana")
    assert spark.table("tienda_llana.store_sales").count() == small_star.sales.rows.count()
    assert not [c.name for c in spark.catalog.listColumns("tienda_llana.store_sales") if c.isPartition]
    tables.drop_tables(spark, "tienda_llana", ["store_sales"])
