"""The approved queries as DataFrames over a star."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from mostrador.operators.totals import roll_up, top, top_per_group
from mostrador.sources.star import Star


def full_name() -> Column:
    """First and last name with one blank between, missing parts as empty text."""
    return F.concat(
        F.coalesce("c_first_name", F.lit("")), F.lit(" "), F.coalesce("c_last_name", F.lit(""))
    ).alias("cliente")


def product_name() -> Column:
    return F.coalesce("i_product_name", "i_item_desc").alias("producto")


def _by_customer(star: Star, sums: dict[str, str], count: str | None = None) -> DataFrame:
    measures = [*sums, *([count] if count else [])]
    totals = star.sales.totals(["ss_customer_sk"], sums, count)
    keys = ["c_customer_sk", "c_customer_id", "c_first_name", "c_last_name"]
    joined = totals.join(star.customer.select(*keys), F.col("ss_customer_sk") == F.col(keys[0]))
    rolled = roll_up(joined, keys, measures)
    return rolled.select("c_customer_sk", "c_customer_id", full_name(), *measures)


def _by_store(star: Star, keys: list[str], sums: dict[str, str]) -> DataFrame:
    totals = star.sales.totals(["ss_store_sk"], sums)
    store = star.store.select(*{"s_store_sk", *keys})
    joined = totals.join(store, F.col("ss_store_sk") == F.col("s_store_sk"))
    return roll_up(joined, keys, list(sums))


def _by_item(star: Star, keys: list[str], sums: dict[str, str]) -> DataFrame:
    totals = star.sales.totals(["ss_item_sk"], sums)
    item = star.item.select(*{"i_item_sk", *keys})
    joined = totals.join(item, F.col("ss_item_sk") == F.col("i_item_sk"))
    return roll_up(joined, keys, list(sums))


def _days(star: Star) -> DataFrame:
    return star.date_dim.select(
        "d_date_sk",
        F.col("d_year").alias("anio"),
        F.col("d_moy").alias("mes"),
        F.col("d_day_name").alias("dia_semana"),
    )


def _by_date(star: Star, keys: list[str], measure: str) -> DataFrame:
    """Totals by day first: the calendar meets one row per day, not the fact."""
    daily = star.sales.totals(["ss_sold_date_sk"], {measure: "ss_net_paid"})
    # said here, so that headers and lines without a day or a ticket drop at the scan
    known = daily.where(F.col("ss_sold_date_sk").isNotNull())
    joined = known.join(_days(star), F.col("ss_sold_date_sk") == F.col("d_date_sk"))
    return roll_up(joined, keys, [measure])


def top_customers_by_lines(star: Star, k: int = 20) -> DataFrame:
    counted = _by_customer(star, {}, "numero_compras")
    return top(counted, [F.desc("numero_compras"), F.asc("c_customer_sk")], k)


def sales_by_store(star: Star) -> DataFrame:
    keys = ["s_store_sk", "s_store_id", "s_store_name", "s_city", "s_country"]
    sales = _by_store(star, keys, {"ventas_totales": "ss_net_paid"})
    return sales.orderBy(F.desc("ventas_totales"), "s_store_sk")


def sales_by_month(star: Star) -> DataFrame:
    return _by_date(star, ["anio", "mes"], "ventas_totales").orderBy("anio", "mes")


def sales_of_year(star: Star, year: int) -> DataFrame:
    """Sales of one year by month and store.

    The calendar is cut to the year before the fact meets it: where the fact is laid out by
    day, only the folders of that year are read.
    """
    dated = star.sales.with_dates(_days(star).where(F.col("anio") == year))
    totals = dated.totals(["mes", "ss_store_sk"], {"ventas_totales": "ss_net_paid"})
    store = star.store.select("s_store_sk", "s_store_id", "s_store_name")
    joined = totals.join(store, F.col("ss_store_sk") == F.col("s_store_sk"))
    sales = roll_up(joined, ["mes", "s_store_id", "s_store_name"], ["ventas_totales"])
    return sales.orderBy("mes", "s_store_id", "s_store_name")


def sales_by_weekday(star: Star) -> DataFrame:
    sales = _by_date(star, ["dia_semana"], "ventas_totales")
    return sales.orderBy(F.desc("ventas_totales"), "dia_semana")


def top_products_per_store(star: Star, k: int = 10) -> DataFrame:
    units = {"cantidad_vendida": "ss_quantity"}
    totals = star.sales.totals(["ss_store_sk", "ss_item_sk"], units)
    of_stores = totals.join(
        star.store.select("s_store_sk", "s_store_id", "s_store_name"),
        F.col("ss_store_sk") == F.col("s_store_sk"),
    )
    # a given number: names make rows many times as wide as the totals by whose bytes tasks are merged
    tasks = int(totals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    joined = of_stores.repartition(tasks, "ss_item_sk").join(
        star.item.select("i_item_sk", "i_item_id", "i_product_name", "i_item_desc"),
        F.col("ss_item_sk") == F.col("i_item_sk"),
    )
    keys = ["s_store_id", "s_store_name", "i_item_id", "i_product_name", "i_item_desc"]
    per_product = roll_up(joined, keys, list(units)).select(
        "s_store_id", "s_store_name", "i_item_id", product_name(), "cantidad_vendida"
    )
    order = [F.desc("cantidad_vendida"), F.asc("i_item_id"), F.asc("producto"), F.asc("s_store_name")]
    ranked = top_per_group(per_product, ["s_store_id"], order, k, "ranking")
    return ranked.orderBy("s_store_id", "ranking")


def average_line_by_customer(star: Star, k: int = 20) -> DataFrame:
    """Mean amount per fact line; a missing amount counts as zero and as a line."""
    spent = _by_customer(star, {"gasto_total": "ss_net_paid"}, "numero_compras")
    money = spent.schema["gasto_total"].dataType
    mean = F.col("gasto_total") / F.col("numero_compras")
    if isinstance(money, DecimalType):
        # four digits more than the amounts, as an average of decimals has
        mean = mean.cast(DecimalType(min(38, money.precision - 6), money.scale + 4))
    averaged = spent.select(
        "c_customer_sk",
        "c_customer_id",
        "cliente",
        "numero_compras",
        "gasto_total",
        mean.alias("ticket_promedio"),
    )
    return top(averaged, [F.desc("ticket_promedio"), F.asc("c_customer_sk")], k)


def products_by_revenue(star: Star, k: int = 20) -> DataFrame:
    keys = ["i_item_sk", "i_item_id", "i_product_name", "i_item_desc", "i_category", "i_brand"]
    revenue = _by_item(star, keys, {"ingreso_generado": "ss_net_paid"})
    named = revenue.select(
        "i_item_sk", "i_item_id", product_name(), "i_category", "i_brand", "ingreso_generado"
    )
    return top(named, [F.desc("ingreso_generado"), F.asc("i_item_sk")], k)


def customers_by_spending(star: Star, k: int = 20) -> DataFrame:
    spent = _by_customer(star, {"gasto_total": "ss_net_paid"})
    return top(spent, [F.desc("gasto_total"), F.asc("c_customer_sk")], k)


def monthly_store_ranking(star: Star, k: int = 10) -> DataFrame:
    # renamed after they are totalled, as in the SQL form: a plan with both makes the totals once
    dated = star.sales.with_dates(star.date_dim.select("d_date_sk", "d_year", "d_moy"))
    totals = dated.totals(["d_year", "d_moy", "ss_store_sk"], {"ventas_totales": "ss_net_paid"})
    monthly = totals.withColumnsRenamed({"d_year": "anio", "d_moy": "mes"})
    joined = monthly.join(
        star.store.select("s_store_sk", "s_store_id", "s_store_name"),
        F.col("ss_store_sk") == F.col("s_store_sk"),
    )
    sales = roll_up(joined, ["anio", "mes", "s_store_id", "s_store_name"], ["ventas_totales"])
    ranked = top_per_group(
        sales, ["anio", "mes"], [F.desc("ventas_totales")], k, "ranking_mensual", True
    )
    return ranked.orderBy("anio", "mes", "ranking_mensual", "s_store_id", "s_store_name")


def best_selling_products(star: Star, k: int = 5) -> DataFrame:
    keys = ["i_item_id", "i_product_name", "i_item_desc"]
    units = _by_item(star, keys, {"cantidad_vendida": "ss_quantity"})
    named = units.select("i_item_id", product_name(), "cantidad_vendida")
    return top(named, [F.desc("cantidad_vendida"), F.asc("i_item_id"), F.asc("producto")], k)


def best_store(star: Star) -> DataFrame:
    keys = ["s_store_id", "s_store_name"]
    sales = _by_store(star, keys, {"ventas_totales": "ss_net_paid"})
    return top(sales, [F.desc("ventas_totales"), *map(F.asc, keys)], 1)


def best_month(star: Star) -> DataFrame:
    sales = _by_date(star, ["anio", "mes"], "ingresos_totales")
    return top(sales, [F.desc("ingresos_totales"), F.asc("anio"), F.asc("mes")], 1)


def best_customers(star: Star) -> DataFrame:
    return customers_by_spending(star, 10)


def profit_by_state(star: Star) -> DataFrame:
    profit = _by_store(star, ["s_state"], {"utilidad_total": "ss_net_profit"})
    return profit.orderBy(F.desc("utilidad_total"), "s_state")


@dataclass(frozen=True)
class Entry:
    """An approved query, the order of its rows, and the engine class it belongs to."""

    build: Callable[[Star], DataFrame]
    order: tuple[str, ...]
    heavy: bool = True


# The approved intents, and which of them count as light work.
CATALOG: dict[str, Entry] = {
    "top_20_clientes_compras": Entry(
        top_customers_by_lines, ("numero_compras DESC", "c_customer_sk"), heavy=False
    ),
    "ventas_por_tienda": Entry(sales_by_store, ("ventas_totales DESC", "s_store_sk")),
    "ventas_por_mes": Entry(sales_by_month, ("anio", "mes")),
    "ventas_por_dia_semana": Entry(
        sales_by_weekday, ("ventas_totales DESC", "dia_semana"), heavy=False
    ),
    "top_productos_por_tienda": Entry(top_products_per_store, ("s_store_id", "ranking")),
    "ticket_promedio_por_cliente": Entry(
        average_line_by_customer, ("ticket_promedio DESC", "c_customer_sk"), heavy=False
    ),
    "productos_mayor_ingreso": Entry(products_by_revenue, ("ingreso_generado DESC", "i_item_sk")),
    "top_clientes_gasto_total": Entry(
        customers_by_spending, ("gasto_total DESC", "c_customer_sk")
    ),
    "ranking_mensual_ventas": Entry(
        monthly_store_ranking, ("anio", "mes", "ranking_mensual", "s_store_id", "s_store_name")
    ),
    "cinco_productos_mas_vendidos": Entry(
        best_selling_products, ("cantidad_vendida DESC", "i_item_id", "producto")
    ),
    "tienda_mayores_ventas": Entry(best_store, ("ventas_totales DESC",)),
    "mes_mayores_ingresos": Entry(best_month, ("ingresos_totales DESC",)),
    "diez_mejores_clientes": Entry(best_customers, ("gasto_total DESC", "c_customer_sk")),
}

HEAVY, LIGHT = "spark", "hive"


def intents(spark: SparkSession) -> DataFrame:
    """The approved intents with the engine their class suggests: one row per query."""
    rows = [(name, HEAVY if entry.heavy else LIGHT) for name, entry in CATALOG.items()]
    return spark.createDataFrame(rows, "intencion string, motor string")
