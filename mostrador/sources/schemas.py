"""Table schemas read from DDL text, and the five-table star contract."""

from __future__ import annotations

import re

from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# The columns an analyst may use, by table.
STAR_DDL = """
CREATE EXTERNAL TABLE IF NOT EXISTS customer (
    c_customer_sk bigint,
    c_customer_id string,
    c_first_name string,
    c_last_name string,
    c_email_address string
)
ROW FORMAT DELIMITED FIELDS TERMINATED BY '|';
CREATE EXTERNAL TABLE IF NOT EXISTS item (
    i_item_sk bigint,
    i_item_id string,
    i_item_desc string,
    i_product_name string,
    i_category string,
    i_brand string
)
ROW FORMAT DELIMITED FIELDS TERMINATED BY '|';
CREATE EXTERNAL TABLE IF NOT EXISTS store (
    s_store_sk bigint,
    s_store_id string,
    s_store_name string,
    s_city string,
    s_state string,
    s_country string
)
ROW FORMAT DELIMITED FIELDS TERMINATED BY '|';
CREATE EXTERNAL TABLE IF NOT EXISTS date_dim (
    d_date_sk int,
    d_date date,
    d_year int,
    d_moy int,
    d_day_name string
)
ROW FORMAT DELIMITED FIELDS TERMINATED BY '|';
CREATE EXTERNAL TABLE IF NOT EXISTS store_sales (
    ss_sold_date_sk int,
    ss_item_sk bigint,
    ss_customer_sk bigint,
    ss_store_sk bigint,
    ss_ticket_number bigint,
    ss_quantity int,
    ss_net_paid decimal(12,2),
    ss_net_profit decimal(12,2)
)
ROW FORMAT DELIMITED FIELDS TERMINATED BY '|';
"""

_PLAIN_TYPES = {"int": IntegerType(), "bigint": LongType(), "date": DateType()}
_DECIMAL = re.compile(r"decimal(?:\s*\(\s*(\d+)\s*,\s*(\d+)\s*\))?", re.I)
_TABLE = re.compile(
    r"create\s+(?:external\s+)?table\s+(?:if\s+not\s+exists\s+)?(?P<name>[\w.]+)\s*"
    r"\((?P<body>(?:[^()]|\([^()]*\))*)\)",
    re.I,
)


def column_type(text: str) -> DataType:
    """Spark type of a declared type; a bare decimal is money, anything unknown is text."""
    money = _DECIMAL.fullmatch(text.strip())
    if money:
        return DecimalType(int(money[1] or 7), int(money[2] or 2))
    return _PLAIN_TYPES.get(text.strip().lower(), StringType())


def schemas_from_ddl(ddl: str) -> dict[str, StructType]:
    """Every ``CREATE TABLE`` of a DDL script as a schema, all columns nullable."""
    without_comments = re.sub(r"--[^\n]*", "", ddl)
    schemas = {}
    for table in _TABLE.finditer(without_comments):
        # a comma inside decimal(p,s) does not end a column
        columns = re.split(r",(?![^()]*\))", table["body"])
        pairs = [column.split(None, 1) for column in columns if len(column.split(None, 1)) == 2]
        schemas[table["name"].split(".")[-1]] = StructType(
            [StructField(name, column_type(kind), True) for name, kind in pairs]
        )
    return schemas


def schemas_from_file(path: str) -> dict[str, StructType]:
    with open(path, encoding="utf-8") as script:
        return schemas_from_ddl(script.read())


STAR_SCHEMAS = schemas_from_ddl(STAR_DDL)
