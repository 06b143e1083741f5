"""JSON query plans resolved to a statement and an engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mostrador.functions.text import as_key, computed_once, normalized, without_fence
from mostrador.operators.audit import audit
from mostrador.plans.catalog import intents
from mostrador.plans.routing import (
    MODES,
    UNKNOWN_MODE,
    UNSAFE,
    engine_tag,
    is_unsafe,
    resolved_engine,
    rule_intent,
    with_normalized,
)
from mostrador.plans.statements import catalog_statements

PLAN_SCHEMA = "tipo string, intencion string, sql string, motor string, _corrupt_record string"
ENGINES = ("hive", "spark")


def parse_plans(answers: DataFrame, column: str = "respuesta") -> DataFrame:
    """Adds the four plan fields and ``legible``: whether the text is one JSON object."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    plan = F.from_json(without_fence(F.col(column)), PLAN_SCHEMA, options)
    parsed = computed_once(answers, "plan", plan)
    return parsed.select(
        *answers.columns,
        F.col("plan.tipo").alias("tipo"),
        F.col("plan.intencion").alias("intencion"),
        F.col("plan.sql").alias("sql"),
        F.col("plan.motor").alias("motor"),
        (F.col("plan").isNotNull() & F.col("plan._corrupt_record").isNull()).alias("legible"),
    )


def resolve_plans(plans: DataFrame) -> DataFrame:
    """Replaces the plan fields by the statement and engine to run, or the error.

    A catalog plan takes the approved statement, a dynamic one its own audited text. The
    approved statements are a table of fixed length and are broadcast.
    """
    cleaned = plans.withColumns(
        {
            "kind": as_key(F.coalesce("tipo", F.lit(""))),
            "engine": normalized(F.coalesce("motor", F.lit(""))),
            "name": as_key(F.coalesce("intencion", F.lit(""))),
        }
    )
    own_sql = without_fence(F.coalesce("sql", F.lit("None")))
    audited = audit(computed_once(cleaned, "own_sql", own_sql), "own_sql", "own_code")
    approved = catalog_statements(plans.sparkSession).withColumnsRenamed(
        {"intencion": "approved", "sql": "approved_sql"}
    )
    matched = audited.join(F.broadcast(approved), F.col("name") == F.col("approved"), "left")
    error = (
        F.when(~F.col("legible"), "not_json")
        .when(F.col("kind") == "no_analitica", "not_analytic")
        .when(~F.col("engine").isin(*ENGINES), "unknown_engine")
        .when(F.col("kind") == "catalogo", F.when(F.col("approved").isNull(), "unknown_intent"))
        .when(F.col("kind") == "dinamica", F.concat(F.lit("sql_"), F.col("own_code")))
        .otherwise("unknown_kind")
    )
    statement = F.when(F.col("kind") == "catalogo", F.col("approved_sql")).otherwise(
        F.col("own_sql")
    )
    kept = [name for name in plans.columns if name not in ("tipo", "intencion", "sql", "motor")]
    return matched.withColumn("error", error).select(
        *[name for name in kept if name != "legible"],
        F.when(F.col("error").isNull(), statement).alias("sentencia"),
        F.when(F.col("error").isNull(), F.col("engine")).alias("motor"),
        "error",
    )


def resolve_requests(requests: DataFrame) -> DataFrame:
    """Statement, engine and error of requests (pregunta, modo, respuesta), other columns kept.

    ``respuesta`` is the text of a plan. A request without one, null, stands for a plan that
    names the approved query its question is routed to, with the engine of that query's
    class. An explicit mode wins over an engine named in the question, that over the plan's.
    A bad or null mode is reported first, then an unsafe question, then what is wrong with
    the plan; an unknown intent is a question without a plan that no rule routes.
    """
    kept = [name for name in requests.columns if name != "respuesta"]
    asked = _planned_by_rule(with_normalized(parse_plans(requests)))
    planned = resolve_plans(asked).withColumn("mode", normalized(F.coalesce("modo", F.lit(""))))
    error = (
        F.when(~F.col("mode").isin(*MODES), UNKNOWN_MODE)
        .when(is_unsafe(), UNSAFE)
        .otherwise(F.col("error"))
    )
    engine = resolved_engine(F.col("mode"), engine_tag(), F.col("motor"))
    judged = planned.withColumns({"error": error, "motor": engine})
    return judged.select(
        *kept,
        F.when(F.col("error").isNull(), F.col("sentencia")).alias("sentencia"),
        F.when(F.col("error").isNull(), F.col("motor")).alias("motor"),
        "error",
    )


def _planned_by_rule(parsed: DataFrame) -> DataFrame:
    """Fills in the plan of rows that have none, from the rules that read ``norm``."""
    bare = F.col("respuesta").isNull()
    known = intents(parsed.sparkSession).withColumnsRenamed({"intencion": "known", "motor": "suggested"})
    ruled = parsed.withColumn("rule", F.when(bare, rule_intent()))
    looked_up = ruled.join(F.broadcast(known), F.col("rule") == F.col("known"), "left")
    # the engine of a row that no rule routes says nothing: its intent is unknown
    filled = {
        "tipo": F.lit("catalogo"),
        "intencion": F.col("known"),
        "motor": F.coalesce("suggested", F.lit(ENGINES[0])),
        "legible": F.lit(True),
    }
    return looked_up.withColumns(
        {name: F.when(bare, value).otherwise(F.col(name)) for name, value in filled.items()}
    ).drop("rule", "known", "suggested")
