"""Databases and external tables in the session catalog."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mostrador.sources.delimited import DELIMITED
from mostrador.sources.together import together


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")


def _columns(schema: StructType) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)


def register_text(
    spark: SparkSession, database: str, schemas: Mapping[str, StructType], root: str
) -> None:
    """External tables over ``|``-delimited text, one folder per table."""
    options = ", ".join(f"'{key}' '{value}'" for key, value in DELIMITED.items())
    for table, schema in schemas.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} ({_columns(schema)}) "
            f"USING CSV OPTIONS ({options}) LOCATION '{root}/{table}'"
        )


def register_parquet(
    spark: SparkSession,
    database: str,
    schemas: Mapping[str, StructType],
    root: str,
    partitions: Mapping[str, str] | None = None,
) -> None:
    """External Parquet tables with the declared columns.

    ``partitions`` names, for a table, the column whose values are its folders; the folders
    that are there become its partitions.
    """
    for table, schema in schemas.items():
        column = (partitions or {}).get(table)
        by = f" PARTITIONED BY (`{column}`)" if column else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} ({_columns(schema)}) "
            f"USING PARQUET{by} LOCATION '{root}/{table}'"
        )
        if column:
            spark.sql(f"MSCK REPAIR TABLE {database}.{table}")


def register_parquet_from_files(
    spark: SparkSession, database: str, paths: Mapping[str, str]
) -> None:
    """External Parquet tables whose columns come from the files themselves, some at once:
    finding the columns of a table is a job over the footers of its files."""

    def register(table: str) -> None:
        place = f"USING PARQUET LOCATION '{paths[table]}'"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} {place}")

    together(spark, register, paths)


def drop_tables(spark: SparkSession, database: str, tables: Iterable[str]) -> None:
    """Forget external tables; their files stay. Any other kind is refused and nothing dropped."""
    tables = [t for t in tables if spark.catalog.tableExists(f"{database}.{t}")]
    for table in tables:
        kind = spark.catalog.getTable(f"{database}.{table}").tableType
        if kind != "EXTERNAL":
            raise ValueError(f"{database}.{table} is {kind}; dropping it would delete its data")
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{table}")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}").where("NOT isTemporary").select(
        F.col("tableName").alias("tabla")
    )


def count_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One labelled row count per table, put together with UNION ALL."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias("tabla"), "filas")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
