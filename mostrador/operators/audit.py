"""Read-only audit of SQL text."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mostrador.functions.text import computed_once, stripped
from mostrador.sources.star import STAR_DATABASE, STAR_TABLES

# Words no statement may hold.
BANNED = ("USE", "INSERT", "UPDATE", "DELETE", "DROP", "ALTER", "CREATE", "TRUNCATE", "MERGE",
          "GRANT", "REVOKE", "LOAD", "EXPORT", "IMPORT")

_WORD_CHAR = r"[\p{L}\p{N}_]"
_BANNED_WORD = f"(?<!{_WORD_CHAR})(?:{'|'.join(BANNED)})(?!{_WORD_CHAR})"


def star_tables_named(sql: Column, database: str = STAR_DATABASE) -> Column:
    """Names written after the star database's prefix."""
    pattern = rf"{re.escape(database)}\.([a-zA-Z_][a-zA-Z0-9_]*)"
    return F.array_distinct(F.regexp_extract_all(sql, F.lit(pattern), F.lit(1)))


def _first_failure(sql: Column, database: str) -> Column:
    """Code of the first check that a trimmed statement fails, null if it fails none."""
    upper = F.upper(sql)
    allowed = F.array(*[F.lit(name) for name in STAR_TABLES])
    checks = {
        "empty": F.coalesce(sql, F.lit("")) == "",
        "not_select": ~(upper.startswith("SELECT") | upper.startswith("WITH")),
        "several_statements": sql.contains(";"),
        "comment": sql.contains("--") | sql.contains("/*"),
        "banned_word": upper.rlike(_BANNED_WORD),
        "no_star_table": ~sql.contains(f"{database}."),
        "foreign_table": F.size(F.array_except(star_tables_named(sql, database), allowed)) > 0,
    }
    return F.coalesce(*[F.when(failed, F.lit(code)) for code, failed in checks.items()])


def audit(
    statements: DataFrame,
    column: str = "sql",
    code: str = "codigo",
    database: str = STAR_DATABASE,
) -> DataFrame:
    """Adds why each statement is refused, null if it is accepted."""
    trimmed = computed_once(statements, "trimmed_sql", stripped(F.col(column)))
    failure = _first_failure(F.col("trimmed_sql"), database)
    return trimmed.withColumn(code, failure).drop("trimmed_sql")


def audit_text(spark: SparkSession, sql: str, database: str = STAR_DATABASE) -> str | None:
    """The same for one statement. The one row is local to the plan, so no job is started."""
    one = spark.sql("SELECT * FROM VALUES (:sql) AS one(sql)", {"sql": sql})
    return one.select(_first_failure(stripped(F.col("sql")), database)).first()[0]
