"""Delimited text: typed scans, writes, whole-dataset conversion to Parquet."""

from __future__ import annotations

import time
from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from mostrador.sources.together import AT_ONCE, together

DELIMITED = {"sep": "|", "header": "false", "dateFormat": "yyyy-MM-dd", "quote": ""}
STATUS_SCHEMA = (
    "tabla string, estado string, filas bigint, ilegibles bigint, cortas bigint, "
    "largas bigint, segundos double, detalle string"
)


def read_delimited(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Fields by position and declared type. A field that does not parse is null,
    a missing tail is null, a field past the last declared one is dropped."""
    return spark.read.schema(schema).options(**DELIMITED).csv(path)


def write_delimited(df: DataFrame, path: str, trailing_separator: bool = False) -> None:
    """One text line per row, nulls as empty fields, no quoting."""
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in df.columns]
    if trailing_separator:
        fields.append(F.lit(""))
    df.select(F.concat_ws("|", *fields).alias("value")).write.mode("overwrite").text(path)


def read_tab_result(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated result with a header line; every value stays text."""
    return spark.read.options(sep="\t", header="true", quote="").csv(path).na.fill("")


def losses(line: Column, schema: StructType) -> dict[str, Column]:
    """Whether a line lost something in a typed scan, by kind, from its text and its columns.

    ``ilegibles``: a field has text but no value; ``cortas``: fields are missing at the end;
    ``largas``: there are fields past the last one. One separator at the end is none.
    """
    fields = F.split(line, r"\|", -1)
    found = F.size(fields) - F.when(F.element_at(fields, -1) == "", 1).otherwise(0)
    unread = [
        (F.coalesce(F.get(fields, F.lit(i)), F.lit("")) != "") & F.col(f"`{name}`").isNull()
        for i, name in enumerate(schema.fieldNames())
    ]
    declared = F.lit(len(schema))
    return {
        "ilegibles": reduce(or_, unread),
        "cortas": F.size(fields) < declared,
        "largas": F.greatest(found, F.lit(0)) > declared,
    }


def convert_table(spark: SparkSession, schema: StructType, source: str, target: str) -> dict[str, int]:
    """One table's text as a Parquet snapshot: its rows, and how many of them lost what.

    Rows are counted while they are written, so no text is read twice. Spark keeps the text
    of a line that does not fit the schema; only those lines are taken apart again.
    """
    line = "_linea"
    while line.lower() in {name.lower() for name in schema.fieldNames()}:
        line = f"_{line}"
    whole = StructType([*schema.fields, StructField(line, StringType())])
    options = {**DELIMITED, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": line}
    rows = spark.read.schema(whole).options(**options).csv(source)
    seen, damaged = Observation(), F.col(line).isNotNull()
    counts = [
        F.count(F.when(damaged & lost, 1)).alias(kind) for kind, lost in losses(F.col(line), schema).items()
    ]
    counted = rows.observe(seen, F.count(F.lit(1)).alias("filas"), *counts)
    counted.drop(line).write.mode("overwrite").parquet(target)
    return seen.get


def convert(
    spark: SparkSession,
    schemas: Mapping[str, StructType],
    text_root: str,
    parquet_root: str,
    at_once: int = AT_ONCE,
) -> DataFrame:
    """Every table's text as a Parquet snapshot, one status row per table, in their order.

    Several tables are converted at once. A table without a folder is skipped; any other
    failure is reported and the rest go on.
    """

    def status(table: str) -> tuple:
        started = time.perf_counter()
        seen: dict[str, int] = {}
        try:
            seen = convert_table(spark, schemas[table], f"{text_root}/{table}", f"{parquet_root}/{table}")
            state, detail = "ok", ""
        except AnalysisException as error:
            missing = error.getCondition() == "PATH_NOT_FOUND"
            state, detail = "omitida" if missing else "error", str(error)
        except Exception as error:  # one bad table must not stop the others
            state, detail = "error", str(error)
        counts = [seen.get(name) for name in ("filas", "ilegibles", "cortas", "largas")]
        return (table, state, *counts, time.perf_counter() - started, detail)

    return spark.createDataFrame(together(spark, status, schemas, at_once), STATUS_SCHEMA)
