"""Catalog queries against plain Python on a small star with gaps, orphans, ties, hot keys."""

from __future__ import annotations

from collections import defaultdict
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from mostrador.plans import catalog
from mostrador.plans.catalog import CATALOG
from mostrador.sources.schemas import STAR_SCHEMAS
from mostrador.sources.star import (
    FIRST_DAY_KEY,
    Fact,
    SplitFact,
    Star,
    star_from_given,
)

DAY0 = FIRST_DAY_KEY + 40000
DAYS = [(DAY0 + i, date(2009, 7, 7) + timedelta(days=i)) for i in range(90)]


def rows():
    sales = []
    for i in range(600):
        hot = i % 3 == 0  # a third of the lines on one customer, store, item and ticket
        sales.append((
            DAY0 + (0 if hot else i % 95) if i % 41 else None,  # some days outside the calendar
            1 if hot else i % 17,
            7 if hot else (None if i % 13 == 0 else i % 23),  # customers past 20 are orphans
            2 if hot else i % 6,
            1 if hot else 100 + i % 50,
            None if i % 11 == 0 else i % 9,
            None if i % 7 == 0 else Decimal(i % 400) + Decimal("0.37"),
            None if i % 5 == 0 else Decimal(i % 50) - 20,
        ))
    customers = [(k, f"C{k}", None if k % 4 == 0 else f"N{k}", None if k % 5 == 0 else "L", None)
                 for k in range(20)]
    items = [(k, f"I{k // 2}", f"desc {k // 4}", None if k % 3 else f"prod {k // 4}", "cat", "b")
             for k in range(17)]
    stores = [(k, f"S{k // 2}", f"shop {k}", "city", f"state {k % 2}", "land") for k in range(5)]
    dates = [(key, day, day.year, day.month, day.strftime("%A")) for key, day in DAYS]
    return {"store_sales": sales, "customer": customers, "item": items, "store": stores,
            "date_dim": dates}


ROWS = rows()


@pytest.fixture(scope="module")
def star(spark):
    frames = {n: spark.createDataFrame(r, STAR_SCHEMAS[n]) for n, r in ROWS.items()}
    return Star(lambda: Fact(frames["store_sales"]), frames.__getitem__)


def dicts(name):
    columns = STAR_SCHEMAS[name].fieldNames()
    return [dict(zip(columns, row)) for row in ROWS[name]]


def joined(*dimensions):
    keys = {"customer": ("ss_customer_sk", "c_customer_sk"), "item": ("ss_item_sk", "i_item_sk"),
            "store": ("ss_store_sk", "s_store_sk"), "date_dim": ("ss_sold_date_sk", "d_date_sk")}
    out = dicts("store_sales")
    for name in dimensions:
        fk, pk = keys[name]
        table = {row[pk]: row for row in dicts(name)}
        out = [{**sale, **table[sale[fk]]} for sale in out if sale[fk] in table]
    return out


def totals(sales, keys, value):
    sums = defaultdict(lambda: [0, 0])
    for sale in sales:
        group = sums[tuple(sale[k] for k in keys)]
        group[0] += 1
        group[1] += (sale[value] or 0) if value else 0
    return sums


def client(c):
    return f"{c[2] or ''} {c[3] or ''}"


CUSTOMER = ["c_customer_sk", "c_customer_id", "c_first_name", "c_last_name"]


def test_top_customers_by_lines(star):
    expected = sorted(
        ((k[0], k[1], client(k), n) for k, (n, _) in totals(joined("customer"), CUSTOMER, None).items()),
        key=lambda r: (-r[3], r[0]),
    )
    assert [tuple(r) for r in catalog.top_customers_by_lines(star, 5).collect()] == expected[:5]


def test_average_counts_missing_amounts(star):
    expected = {}
    for k, (n, total) in totals(joined("customer"), CUSTOMER, "ss_net_paid").items():
        mean = (total / n).quantize(Decimal("1.000000"), ROUND_HALF_UP)
        expected[k[0]] = (n, total, mean)
    got = {r["c_customer_sk"]: (r["numero_compras"], r["gasto_total"], r["ticket_promedio"])
           for r in catalog.average_line_by_customer(star, 100).collect()}
    assert got == expected


@pytest.mark.parametrize(
    "build, keys, measure",
    [
        (catalog.sales_by_month, ["d_year", "d_moy"], "ss_net_paid"),
        (catalog.sales_by_weekday, ["d_day_name"], "ss_net_paid"),
    ],
)
def test_sales_by_date(star, build, keys, measure):
    expected = {k: total for k, (_, total) in totals(joined("date_dim"), keys, measure).items()}
    assert {tuple(r[:-1]): r[-1] for r in build(star).collect()} == expected


def test_sales_by_store_in_order(star):
    keys = ["s_store_sk", "s_store_id", "s_store_name", "s_city", "s_country"]
    expected = sorted(
        ((*k, total) for k, (_, total) in totals(joined("store"), keys, "ss_net_paid").items()),
        key=lambda r: (-r[-1], r[0]),
    )
    assert [tuple(r) for r in catalog.sales_by_store(star).collect()] == expected


def test_top_products_per_store(star):
    keys = ["s_store_id", "s_store_name", "i_item_id", "i_product_name", "i_item_desc"]
    groups = defaultdict(list)
    for k, (_, units) in totals(joined("store", "item"), keys, "ss_quantity").items():
        groups[k[0]].append((*k[:3], k[3] or k[4], units))
    expected = set()
    for group in groups.values():
        group.sort(key=lambda r: (-r[4], r[2], r[3], r[1]))
        expected |= {(*row, i + 1) for i, row in enumerate(group[:3])}
    assert {tuple(r) for r in catalog.top_products_per_store(star, 3).collect()} == expected


def test_monthly_ranking_keeps_ties(star):
    keys = ["d_year", "d_moy", "s_store_id", "s_store_name"]
    months = defaultdict(list)
    for k, (_, total) in totals(joined("date_dim", "store"), keys, "ss_net_paid").items():
        months[k[:2]].append((*k, total))
    expected = set()
    for group in months.values():
        for row in group:
            rank = 1 + sum(other[4] > row[4] for other in group)
            if rank <= 2:
                expected.add((*row, rank))
    assert {tuple(r) for r in catalog.monthly_store_ranking(star, 2).collect()} == expected


def test_best_sellers_group_by_business_id(star):
    keys = ["i_item_id", "i_product_name", "i_item_desc"]
    expected = sorted(
        ((k[0], k[1] or k[2], units)
         for k, (_, units) in totals(joined("item"), keys, "ss_quantity").items()),
        key=lambda r: (-r[2], r[0], r[1]),
    )[:5]
    assert [tuple(r) for r in catalog.best_selling_products(star).collect()] == expected


def test_profit_by_state_can_be_negative(star):
    expected = {k[0]: t for k, (_, t) in totals(joined("store"), ["s_state"], "ss_net_profit").items()}
    assert dict(map(tuple, catalog.profit_by_state(star).collect())) == expected


def test_split_fact_equals_whole_fact(spark, star):
    """Lines and headers give what the joined table gives, for every approved query."""
    sales = star.sales.rows.drop("ss_customer_sk", "ss_sold_date_sk")
    header = star.sales.rows.groupBy("ss_ticket_number").agg(
        F.max("ss_customer_sk").alias("ss_customer_sk"),
        F.min("ss_sold_date_sk").alias("ss_sold_date_sk"),
    )
    cents = (F.col("ss_net_paid") * 100).cast("long")
    split = SplitFact(
        sales.withColumn("paid", cents), lambda: header, "ss_ticket_number", {"ss_net_paid": "paid"}
    )
    whole = Fact(split.rows.drop("paid"))
    in_parts = Star(lambda: split, star.tables().__getitem__)
    in_one = Star(lambda: whole, star.tables().__getitem__)
    for entry in CATALOG.values():
        assert entry.build(in_parts).collect() == entry.build(in_one).collect()


def test_rank_can_keep_more_rows_than_asked(spark):
    from mostrador.operators.totals import top_per_group

    df = spark.createDataFrame([("a", "x", 5), ("a", "y", 5), ("a", "z", 1)], "s string, i string, q long")
    order = [F.desc("q")]
    assert top_per_group(df, ["s"], order, 1, "r", True).count() == 2
    assert top_per_group(df, ["s"], [*order, "i"], 1, "r").count() == 1


def test_rank_of_values_counts_ties(spark):
    from mostrador.operators.totals import rank_values

    values = [("a", 5)] * 3 + [("a", 4)] * 2 + [("a", 3), ("b", 1), ("b", None)]
    df = spark.createDataFrame(values, "g string, v int")
    got = {tuple(r) for r in rank_values(df, ["g"], "v", 4, "r", "n").collect()}
    assert got == {("a", 5, 3, 1), ("a", 4, 2, 4), ("b", 1, 1, 1), ("b", None, 1, 2)}


def test_money_without_ansi_mode(spark):
    """Whole cents are summed only where an overflow raises; the results are the same."""
    folder = "/root/testdata/sf0.001"
    expected = catalog.sales_by_store(star_from_given(spark, folder)).collect()
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        star = star_from_given(spark, folder)
        assert star.sales.cents == {}
        assert [tuple(r) for r in catalog.sales_by_store(star).collect()] == [
            tuple(r) for r in expected
        ]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
