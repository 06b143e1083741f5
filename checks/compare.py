"""Run registered queries on Spark and their reference SQL side by side.

    python -m checks.compare [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

GIVEN = ("region nation customer supplier part orders lineitem events documents embeddings "
         "pages benchmark labels conversations").split()


def reference(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in GIVEN:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def canonical(value):
    if isinstance(value, (float, Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else repr(number + 0.0)
    return repr(value)


def table(columns: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple(canonical(row[i]) for i in order) for row in rows
    )


def compare(spark, connection, folder: str, query, sql: str | None) -> str:
    frame = query(spark, folder)
    ours = table(frame.columns, frame.collect())
    if sql is None:
        return f"rows only: {len(ours[1])}"
    result = connection.execute(sql)
    theirs = table([column[0] for column in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return f"DIFFERENT columns {ours[0]} / {theirs[0]}"
    if ours[1] != theirs[1]:
        only_ours = sorted(set(ours[1]) - set(theirs[1]))[:2]
        only_theirs = sorted(set(theirs[1]) - set(ours[1]))[:2]
        return f"DIFFERENT {len(ours[1])}/{len(theirs[1])} rows\n  {only_ours}\n  {only_theirs}"[:1500]
    return f"equal: {len(ours[1])}"


def main() -> None:
    from checks.oracles import ORACLES
    from checks.queries import QUERIES
    from mostrador.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, connection = local_session(8), reference(folder)
    spark.sparkContext.setLogLevel("OFF")
    for name in names:
        started = time.perf_counter()
        try:
            verdict = compare(spark, connection, folder, QUERIES[name], ORACLES.get(name))
        except Exception as error:
            verdict = f"ERROR {type(error).__name__} {str(error)[:700]}"
        print(f"{name}: {verdict} ({time.perf_counter() - started:.1f} s)", flush=True)


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    main()
