"""Physical plans: what is read, shuffled and broadcast."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from mostrador.functions.rules import INTENT_RULES, first_rule
from mostrador.plans import catalog, routing
from mostrador.sources.star import star_from_given
from tests.conftest import SMALL, left_behind, shuffle_files


@pytest.fixture
def big_star(spark):
    """The star as Spark plans it when no table is small enough to broadcast by itself."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield star_from_given(spark, SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def operators(text: str, name: str) -> int:
    tree = text.split("\n\n")[0]
    return len(re.findall(rf"[+:]- {name}\b", tree))


def test_scan_reads_only_used_columns(big_star, explained):
    text = explained(catalog.sales_by_month(big_star))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in text


def test_store_totals_need_no_header_and_fold_before_the_shuffle(big_star, explained):
    text = explained(catalog.best_store(big_star))
    assert "o_orderkey" not in text and "n_nationkey" not in text
    assert "TakeOrderedAndProject" in text and "partial_sum(paid_cents" in text


def test_customer_totals_join_on_the_shuffle_they_have(big_star, explained):
    text = explained(catalog.customers_by_spending(big_star))
    # lines by ticket, headers by ticket, totals by customer, customers: no shuffle after
    assert operators(text, "Exchange") == 4
    assert "TakeOrderedAndProject" in text
    assert "LeftOuter" not in text  # null keys drop before the join


def test_sales_by_date_fold_by_day_before_the_calendar(big_star, explained):
    for build in (catalog.sales_by_month, catalog.sales_by_weekday, catalog.best_month):
        tree = explained(build(big_star)).split("\n\n")[0]
        calendar = tree.index("BroadcastHashJoin")
        # on the side of the sales: totals by day, and under them those by ticket
        assert len(re.findall(r"HashAggregate", tree[calendar:])) >= 3


def test_only_the_calendar_is_broadcast_by_hint(big_star, explained):
    for build in (catalog.sales_by_weekday, catalog.monthly_store_ranking):
        assert operators(explained(build(big_star)), "BroadcastExchange") == 1
    for build in (catalog.top_products_per_store, catalog.products_by_revenue):
        assert operators(explained(build(big_star)), "BroadcastExchange") == 0


def test_group_limits_run_before_the_shuffle(big_star, explained):
    for build in (catalog.monthly_store_ranking, catalog.top_products_per_store):
        assert operators(explained(build(big_star)), "WindowGroupLimit") == 2


def test_totals_get_their_names_in_tasks_that_are_not_merged(spark, big_star, explained):
    # totals are merged by their own bytes, of which names make many times as much
    dealt = r"hashpartitioning\(ss_item_sk#\d+L?, (\d+)\), REPARTITION_BY_NUM"
    text = explained(catalog.top_products_per_store(big_star))
    assert re.findall(dealt, text) == [spark.conf.get("spark.sql.shuffle.partitions")]
    # totals, totals by store, stores, by item, items, by product, by store, ranked: the join reuses it
    assert operators(text, "Exchange") == 8


def test_sql_and_builders_share_monthly_totals_and_are_compared_in_tasks_of_their_own(spark, explained):
    from checks.queries import QUERIES, STAR_COPY, published_star
    from mostrador.plans.adhoc import run_intent

    compared = explained(QUERIES["reconcile_sql_df"](spark, SMALL))
    assert compared.count("SinglePartition, REPARTITION_BY_NUM") == len(catalog.CATALOG)
    built = catalog.monthly_store_ranking(published_star(spark, SMALL))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # reuse is then seen before it runs
    try:
        text = explained(run_intent(spark, "ranking_mensual_ventas", STAR_COPY).unionByName(built))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(re.findall(r"Scan parquet \S+store_sales", text.split("\n\n")[0])) == 1


def test_long_totals_are_compared_from_stored_sides_whose_shuffles_are_gone(spark, big_star, explained):
    # big_star also keeps Spark from broadcasting: published lines and headers are shuffled
    from checks.queries import LONG_TOTALS, QUERIES

    held = shuffle_files(spark)
    compared = QUERIES["reconcile_sql_df"](spark, SMALL)
    assert left_behind(spark, held) == set()
    text = explained(compared)
    # neither side's totals by store and item are left to run in the job that compares all intents
    assert not re.search(r"hashpartitioning\(ss_store_sk#\d+L?, ss_item_sk#", text)
    assert len(re.findall(r"\) Scan parquet \nOutput \[6\]: \[s_store_id", text)) == 2 * len(LONG_TOTALS)


def test_rules_normalise_a_text_once(spark, explained):
    table = spark.read.parquet(f"{SMALL}/conversations.parquet").withColumnRenamed("text", "pregunta")
    ruled = routing.with_normalized(table).withColumn("i", first_rule(F.col("norm"), INTENT_RULES))
    text = explained(ruled.where("i IS NOT NULL").select("conv_id", "i"))
    assert text.count("octet_length") == 1
    assert "Exchange" not in text and "Python" not in text


def test_run_records_fold_by_hash(spark, explained):
    from checks import inputs
    from checks.inputs import spark_table
    from mostrador.plans.suite import records_from_runs

    text = explained(records_from_runs(spark_table(spark, SMALL, inputs.RUNS)))
    assert operators(text, "HashAggregate") == 2 and "SortAggregate" not in text


def test_nothing_runs_python_per_row(spark, explained):
    from checks.queries import QUERIES

    for name in ("route_questions", "plan_resolve", "audit_sql", "strip_fence", "format_number"):
        text = explained(QUERIES[name](spark, SMALL))
        assert "EvalPython" not in text and "MapInPandas" not in text
