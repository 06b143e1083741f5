"""The sales star: one fact, four dimensions, and totals of the fact by its keys.

Dimensions that grow with the business (customer, item, store) are never joined to raw
fact rows. Queries ask the fact for totals by foreign key, join the dimension to those
totals, and roll up: rows of a hot key are folded by the map-side aggregate before
anything is shuffled. The calendar has a fixed length, so it is joined first.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from mostrador.sources.schemas import STAR_SCHEMAS
from mostrador.sources.tables import (
    count_rows,
    create_database,
    drop_tables,
    register_parquet,
)

STAR_DATABASE = "tpcds_parquet"
DIMENSIONS = ("customer", "item", "store", "date_dim")
STAR_TABLES = (*DIMENSIONS, "store_sales")

# The calendar runs from 1900-01-02 (day key 2415022) over 73,049 days.
FIRST_DAY, FIRST_DAY_KEY, CALENDAR_DAYS = "1900-01-02", 2415022, 73049

DAY_KEY = "ss_sold_date_sk"
# A ticket is heavy above one in so many lines; its lines are then dealt to so many tasks.
HEAVY_PARTS, DEALS = 1_000, 256

# Marks a total that counts whole cents until settle() turns it into money.
CENTS = {"unit": "cents"}


def fold(df: DataFrame, name: str) -> Column:
    """Sum of a partial total, in the type and unit the partial total already has."""
    column = df.schema[name]
    return F.sum(name).cast(column.dataType).alias(name, metadata=column.metadata)


def settle(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Finished totals: null as zero, cents as a decimal amount."""

    def settled(name: str) -> Column:
        column = df.schema[name]
        total = F.coalesce(F.col(name), F.lit(0).cast(column.dataType))
        if column.metadata == CENTS:
            amount = total.cast(DecimalType(20, 0)) * F.lit("0.01").cast(DecimalType(2, 2))
            total = amount.cast(DecimalType(22, 2))
        return total.alias(name)

    return df.select([settled(name) if name in names else name for name in df.columns])


@dataclass(frozen=True)
class Fact:
    """A fact table that holds all its columns.

    ``cents`` names, for a money column, a whole-number column with the same amount in
    cents. Summing that is several times cheaper than summing decimals. It is for ANSI
    mode, where a sum past the range of a bigint raises an error instead of wrapping.
    """

    rows: DataFrame
    cents: Mapping[str, str] = field(default_factory=dict)

    @property
    def lines(self) -> DataFrame:
        """One row per fact row, to count them."""
        return self.rows

    def totals(
        self, keys: Sequence[str], sums: Mapping[str, str], count: str | None = None
    ) -> DataFrame:
        """One row per key combination: ``sums`` maps a new name to the column summed.

        A null adds nothing; a group of nulls only sums to null, which settle() turns
        into zero.
        """
        measures = [self._sum(column, name) for name, column in sums.items()]
        if count:
            measures.append(F.count(F.lit(1)).alias(count))
        return self.rows.groupBy(*keys).agg(*measures)

    def with_dates(self, days: DataFrame) -> Fact:
        """The fact with the columns of its day; sales without a known day drop out."""
        dated = self.rows.join(days, F.col(DAY_KEY) == F.col("d_date_sk"))
        return Fact(dated, self.cents)

    def _sum(self, column: str, name: str) -> Column:
        if column in self.cents:
            return F.sum(self.cents[column]).alias(name, metadata=CENTS)
        kind = self.rows.schema[column].dataType
        if isinstance(kind, DecimalType):
            wider = DecimalType(min(38, kind.precision + 10), kind.scale)
            return F.sum(column).cast(wider).alias(name)
        return F.sum(column).alias(name)


@dataclass(frozen=True)
class SplitFact:
    """A fact whose columns lie in two tables: lines, and one header per ticket.

    ``open_headers`` opens the headers, which totals by a line's own keys never need.
    ``heavy`` holds tickets with so many lines that they are dealt to several tasks.
    """

    lines: DataFrame
    open_headers: Callable[[], DataFrame]
    ticket: str
    cents: Mapping[str, str] = field(default_factory=dict)
    dated: bool = False
    heavy: DataFrame | None = None

    @property
    def rows(self) -> DataFrame:
        if self.heavy is None:
            joined = self.lines.join(self.open_headers(), self.ticket, "left")
        else:
            joined = self._dealt_lines().join(self._dealt_headers(), [self.ticket, "deal"], "left")
            joined = joined.drop("deal")
        return joined.where(F.col("d_date_sk").isNotNull()) if self.dated else joined

    def spread(self, parts: int = HEAVY_PARTS) -> SplitFact:
        """The fact with its heavy tickets known: those with more than one in ``parts`` lines.

        One count of the lines by ticket finds them. They are fewer than ``parts``, so they
        are brought to the driver and broadcast.
        """
        counts = self.lines.groupBy(self.ticket).agg(F.count(F.lit(1)).alias("lines"))
        whole = self.lines.count()
        found = counts.where(F.col("lines") * parts > whole).select(self.ticket).na.drop()
        spark = self.lines.sparkSession
        heavy = spark.createDataFrame(found.collect(), found.schema)
        return replace(self, heavy=F.broadcast(heavy.withColumn("is_heavy", F.lit(True))))

    def _dealt_lines(self) -> DataFrame:
        """Lines with the deal of their ticket they belong to: by their own values, 0 for most."""
        own = F.pmod(F.xxhash64(*self.lines.columns), F.lit(DEALS))
        marked = self.lines.join(self.heavy, self.ticket, "left")
        return marked.withColumn("deal", F.when(F.col("is_heavy"), own).otherwise(0)).drop("is_heavy")

    def _dealt_headers(self) -> DataFrame:
        """Headers, those of heavy tickets once for each deal."""
        marked = self.open_headers().join(self.heavy, self.ticket, "left")
        last = F.when(F.col("is_heavy"), F.lit(DEALS - 1).cast("long")).otherwise(0)
        return marked.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), last))).drop("is_heavy")

    def totals(
        self, keys: Sequence[str], sums: Mapping[str, str], count: str | None = None
    ) -> DataFrame:
        of_line = [key for key in keys if key in self.lines.columns]
        if len(of_line) == len(keys) and not self.dated:
            return Fact(self.lines, self.cents).totals(keys, sums, count)
        if of_line:
            return Fact(self.rows, self.cents).totals(keys, sums, count)
        # All keys are the ticket's own: fold the lines of a ticket first. The join
        # then reuses that shuffle and meets one row per ticket.
        per_ticket = Fact(self.lines, self.cents).totals([self.ticket], sums, count)
        joined = replace(self, lines=per_ticket).rows
        partial = [*sums, *([count] if count else [])]
        return joined.groupBy(*keys).agg(*[fold(joined, name) for name in partial])

    def with_dates(self, days: DataFrame) -> SplitFact:
        """As for a whole fact; the day is looked up once per ticket."""
        on_day = F.col(DAY_KEY) == F.col("d_date_sk")
        dated = self.open_headers().join(days, on_day, "left")
        return replace(self, open_headers=lambda: dated, dated=True)


class Star:
    """The fact and its dimensions, each opened when a query first asks for it.

    Opening a table lists its files, so a query should not pay for tables it leaves out.
    """

    def __init__(
        self, open_sales: Callable[[], Fact | SplitFact], open_table: Callable[[str], DataFrame]
    ):
        self._open_sales, self._open_table = open_sales, open_table

    @cached_property
    def sales(self) -> Fact | SplitFact:
        return self._open_sales()

    @cached_property
    def customer(self) -> DataFrame:
        return self._open_table("customer")

    @cached_property
    def item(self) -> DataFrame:
        return self._open_table("item")

    @cached_property
    def store(self) -> DataFrame:
        return self._open_table("store")

    @cached_property
    def date_dim(self) -> DataFrame:
        return self._open_table("date_dim")

    def dimensions(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in DIMENSIONS}

    def tables(self) -> dict[str, DataFrame]:
        """All five tables, the fact with the columns of the contract."""
        sales = self.sales.rows.select(STAR_SCHEMAS["store_sales"].fieldNames())
        return {**self.dimensions(), "store_sales": sales}


def spread_heavy(star: Star, parts: int = HEAVY_PARTS) -> Star:
    """The star with a fact whose heavy tickets are dealt to many tasks; a whole fact stays."""
    sales = star.sales
    if isinstance(sales, Fact):
        return star
    return Star(lambda: sales.spread(parts), lambda name: getattr(star, name))


def star_counts(star: Star) -> DataFrame:
    """Rows of each star table; those of the fact are its lines, no header is looked up."""
    return count_rows({**star.dimensions(), "store_sales": star.sales.lines})


def star_from_database(spark: SparkSession, database: str = STAR_DATABASE) -> Star:
    """The star as registered tables, columns outside the contract left in the files."""

    def table(name: str) -> DataFrame:
        return spark.table(f"{database}.{name}").select(STAR_SCHEMAS[name].fieldNames())

    return Star(lambda: Fact(table("store_sales")), table)


# --- the given tables as a star -------------------------------------------------------
#
# Each entry is a SELECT over the given tables. The given tables have no cost column: ss_net_profit stands for the
# discount granted, as a loss. Two part keys share one business id, as versions of an
# item do, and so do two supplier keys. Nation and region are grouped by their key, which
# lets Spark drop those joins for queries that take no place name from the store.

_LINES = """
SELECT ss_ticket_number, ss_item_sk, ss_store_sk, ss_quantity,
       CAST(paid_cents * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(12,2)) AS ss_net_paid,
       CAST(-given_cents * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(12,2)) AS ss_net_profit,
       paid_cents,
       -given_cents AS profit_cents
FROM (SELECT *,
             {paid_when} (list_cents * (100 - percent) + 50) DIV 100 {paid_end} AS paid_cents,
             (list_cents * percent + 50) DIV 100 AS given_cents
      FROM (SELECT l_orderkey AS ss_ticket_number,
                   l_partkey AS ss_item_sk,
                   l_suppkey AS ss_store_sk,
                   CAST(l_quantity AS INT) AS ss_quantity,
                   CAST(rint(l_extendedprice * 100) AS BIGINT) AS list_cents,
                   CAST(rint(l_discount * 100) AS BIGINT) AS percent,
                   l_returnflag
            FROM {lineitem}))
"""
_HEADERS = f"""
SELECT o_orderkey AS ss_ticket_number,
       {{customer_key}} AS ss_customer_sk,
       datediff(CAST(o_orderdate AS DATE), DATE'{FIRST_DAY}') + {FIRST_DAY_KEY}
           AS ss_sold_date_sk
FROM {{orders}}
"""
_CUSTOMER = """
SELECT c_custkey AS c_customer_sk,
       concat('C', c_custkey) AS c_customer_id,
       {first_name} AS c_first_name,
       substring_index(c_name, '#', -1) AS c_last_name,
       CAST(NULL AS STRING) AS c_email_address
FROM {customer}
"""
_ITEM = """
SELECT p_partkey AS i_item_sk,
       concat('I', p_partkey DIV 2) AS i_item_id,
       concat(p_type, ' ', p_size) AS i_item_desc,
       {product_name} AS i_product_name,
       p_type AS i_category,
       p_brand AS i_brand
FROM {part}
"""
_STORE = """
SELECT s_suppkey AS s_store_sk,
       concat('S', s_suppkey DIV 2) AS s_store_id,
       s_name AS s_store_name,
       n_name AS s_city,
       r_name AS s_state,
       n_name AS s_country
FROM {supplier}
LEFT JOIN (SELECT n_nationkey, any_value(n_name) AS n_name, any_value(n_regionkey) AS n_regionkey
           FROM {nation} GROUP BY n_nationkey) ON s_nationkey = n_nationkey
LEFT JOIN (SELECT r_regionkey, any_value(r_name) AS r_name
           FROM {region} GROUP BY r_regionkey) ON n_regionkey = r_regionkey
"""
_DATE_DIM = f"""
SELECT d_date_sk, d_date,
       year(d_date) AS d_year,
       month(d_date) AS d_moy,
       date_format(d_date, 'EEEE') AS d_day_name
FROM (SELECT CAST({FIRST_DAY_KEY} + id AS INT) AS d_date_sk,
             date_add(DATE'{FIRST_DAY}', CAST(id AS INT)) AS d_date
      FROM range({CALENDAR_DAYS}))
"""

_DIMENSIONS = {"customer": _CUSTOMER, "item": _ITEM, "store": _STORE, "date_dim": _DATE_DIM}

# With gaps, some facts and names are missing: returned lines have no amount, pending
# orders no customer, large parts no product name, one market segment no first name.
_WHOLE = {
    "paid_when": "",
    "paid_end": "",
    "customer_key": "o_custkey",
    "first_name": "substring_index(c_name, '#', 1)",
    "product_name": "p_name",
}
_GAPS = {
    "paid_when": "CASE WHEN l_returnflag <> 'R' THEN",
    "paid_end": "END",
    "customer_key": "CASE WHEN o_orderstatus <> 'P' THEN o_custkey END",
    "first_name": "CASE WHEN c_mktsegment <> 'MACHINERY' THEN substring_index(c_name, '#', 1) END",
    "product_name": "CASE WHEN p_size <= 30 THEN p_name END",
}
_CENTS = {"ss_net_paid": "paid_cents", "ss_net_profit": "profit_cents"}
GIVEN_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def _select(template: str, source: Mapping[str, str], gaps: bool) -> str:
    return template.format(**source, **(_GAPS if gaps else _WHOLE))


def star_from_given(spark: SparkSession, folder: str, gaps: bool = False) -> Star:
    """The star over a folder of the given Parquet tables."""
    source = {name: f"parquet.`{folder}/{name}.parquet`" for name in GIVEN_TABLES}

    def opened(template: str) -> DataFrame:
        return spark.sql(_select(template, source, gaps))

    def sales() -> SplitFact:
        cents = _CENTS if spark.conf.get("spark.sql.ansi.enabled") == "true" else {}
        return SplitFact(opened(_LINES), lambda: opened(_HEADERS), "ss_ticket_number", cents)

    def table(name: str) -> DataFrame:
        dimension = opened(_DIMENSIONS[name])
        # the calendar is made with a fixed number of days
        return F.broadcast(dimension) if name == "date_dim" else dimension

    return Star(sales, table)


def save_by_day(sales: DataFrame, path: str) -> None:
    """The fact with a folder per day and rows in order of day, store and ticket.

    A filter on the calendar then opens the folders of its days only. Rows go to tasks by
    ranges of all three keys, so a day that holds a third of the rows is written by many
    tasks, and few days fall into one task. Sales without a day have a folder of their own.
    """
    order = [DAY_KEY, "ss_store_sk", "ss_ticket_number"]
    # a given number: opening a folder per day is the work here, so small tasks are not merged
    tasks = int(sales.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = sales.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    placed.write.mode("overwrite").partitionBy(DAY_KEY).parquet(path)


def save_star(star: Star, root: str, by_day: bool = False) -> None:
    """The star as Parquet, one folder per table; ``by_day`` for a fact of many days' worth of files."""
    for name, df in star.tables().items():
        if by_day and name == "store_sales":
            save_by_day(df, f"{root}/{name}")
        else:
            df.write.mode("overwrite").parquet(f"{root}/{name}")


def publish_star(
    spark: SparkSession,
    star: Star,
    root: str,
    database: str = STAR_DATABASE,
    by_day: bool = False,
) -> None:
    """Save the star and register what was written, in place of an earlier star.

    SQL text then reads one fact table, and the join that makes it is paid once. ``by_day``
    lays the fact out by day, so that a year of a calendar query reads a year of files.
    """
    save_star(star, root, by_day)
    create_database(spark, database)
    drop_tables(spark, database, STAR_TABLES)
    partitions = {"store_sales": DAY_KEY} if by_day else {}
    register_parquet(spark, database, STAR_SCHEMAS, root, partitions)
