"""A ticket that holds a third of all lines, joined with its header without AQE's help."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from mostrador.plans import catalog
from mostrador.sources.star import Fact, SplitFact, Star, spread_heavy, star_from_given
from tests.conftest import SMALL

SETTINGS = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def no_help(spark):
    before = {name: spark.conf.get(name) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture
def skewed(spark, no_help) -> Star:
    """The given star with a third of the lines on ticket 7, some on 8, a few on none or an unknown one."""
    star = star_from_given(spark, SMALL)
    sales = star.sales
    place = F.pmod(F.xxhash64(*sales.lines.columns), F.lit(300))
    ticket = (
        F.when(place < 100, 7).when(place < 110, 8).when(place == 110, None).when(place == 111, -5)
        .otherwise(F.col("ss_ticket_number"))
    )
    lines = sales.lines.withColumn("ss_ticket_number", ticket.cast("long"))
    return Star(lambda: SplitFact(lines, sales.open_headers, sales.ticket, sales.cents), lambda name: getattr(star, name))


def largest_share(rows) -> float:
    counts = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    return max(counts) / sum(counts)


def test_no_task_has_more_than_its_share(skewed):
    spread = spread_heavy(skewed)
    assert sorted(r[0] for r in spread.sales.spread(50).heavy.collect()) == [7, 8]
    assert sorted(r[0] for r in spread.sales.spread(5).heavy.collect()) == [7]
    assert largest_share(skewed.sales.rows) > 1 / 3
    # eight tasks, most tickets small
    assert largest_share(spread.sales.rows) < 1.5 / 8


def test_rows_and_rankings_stay_as_they_are(skewed):
    spread = spread_heavy(skewed, 50)
    assert spread.sales.rows.columns == skewed.sales.rows.columns
    assert spread.sales.rows.exceptAll(skewed.sales.rows).count() == 0
    assert spread.sales.rows.count() == skewed.sales.rows.count()
    for build in (catalog.monthly_store_ranking, catalog.sales_by_month, catalog.customers_by_spending):
        assert build(spread).collect() == build(skewed).collect()


def test_nothing_heavy_and_nothing_at_all(skewed):
    assert skewed.sales.spread(1).heavy.count() == 0
    empty = SplitFact(skewed.sales.lines.limit(0), skewed.sales.open_headers, skewed.sales.ticket)
    assert empty.spread().heavy.count() == 0 and empty.spread().rows.count() == 0
    whole = Star(lambda: Fact(skewed.sales.rows), lambda name: getattr(skewed, name))
    assert spread_heavy(whole) is whole
