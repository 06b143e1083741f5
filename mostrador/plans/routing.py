"""A table of questions routed to approved queries, with the engine each one asks for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mostrador.functions.rules import (
    ENGINE_RULES,
    FALLBACK_RULES,
    INTENT_RULES,
    UNSAFE_WORDS,
    first_rule,
    has_any_word,
)
from mostrador.functions.text import computed_once, normalized, stripped
from mostrador.plans.catalog import intents

MODES = ("auto", "hive", "spark", "both")
UNKNOWN_MODE, UNSAFE, UNKNOWN_INTENT = "unknown_mode", "unsafe_question", "unknown_intent"


def with_normalized(questions: DataFrame, column: str = "pregunta") -> DataFrame:
    """Adds ``norm``, the text that the rules read."""
    return computed_once(questions, "norm", normalized(F.col(column)))


def rule_intent() -> Column:
    return first_rule(F.col("norm"), INTENT_RULES)


def intent_with_fallback() -> Column:
    return F.coalesce(rule_intent(), first_rule(F.col("norm"), FALLBACK_RULES))


def engine_tag() -> Column:
    return first_rule(F.col("norm"), ENGINE_RULES)


def is_unsafe() -> Column:
    return has_any_word(F.col("norm"), UNSAFE_WORDS)


def request_mode(engine: Column) -> Column:
    """Mode of a request field: none and ``ambos`` mean both, an unknown word means auto."""
    word = F.lower(stripped(F.coalesce(F.when(engine != "", engine), F.lit("ambos"))))
    return F.when(word == "ambos", "both").when(word.isin(*MODES), word).otherwise("auto")


def resolved_engine(mode: Column, tag: Column, suggested: Column) -> Column:
    """An explicit mode wins over the text of the question, that over the suggestion."""
    return F.coalesce(F.when(mode != "auto", mode), tag, suggested)


def route(questions: DataFrame, mode: Column | None = None) -> DataFrame:
    """Adds intencion, motor and error to a table with a ``pregunta`` column.

    One narrow stage: rules are column expressions, and the class lookup is a broadcast
    join with the catalog's fixed list of intents. A bad or null mode is reported first, then an
    unsafe question, then an unknown intent; a row with an error has no intent or engine.
    """
    asked = F.lit("auto") if mode is None else F.coalesce(normalized(mode), F.lit(""))
    tagged = with_normalized(questions).withColumns({"mode": asked})
    judged = tagged.withColumns(
        {"rule": rule_intent(), "tag": engine_tag(), "unsafe": is_unsafe()}
    )
    known = intents(questions.sparkSession).withColumnsRenamed(
        {"intencion": "known", "motor": "suggested"}
    )
    looked_up = judged.join(F.broadcast(known), F.col("rule") == F.col("known"), "left")
    error = (
        F.when(~F.col("mode").isin(*MODES), UNKNOWN_MODE)
        .when(F.col("unsafe"), UNSAFE)
        .when(F.col("known").isNull(), UNKNOWN_INTENT)
    )
    engine = resolved_engine(F.col("mode"), F.col("tag"), F.col("suggested"))
    return looked_up.withColumn("error", error).select(
        *questions.columns,
        F.when(F.col("error").isNull(), F.col("known")).alias("intencion"),
        F.when(F.col("error").isNull(), engine).alias("motor"),
        "error",
    )


def with_class(routed: DataFrame, column: str = "intencion") -> DataFrame:
    """Adds the engine class of an intent, null for an intent outside the catalog."""
    known = intents(routed.sparkSession).withColumnsRenamed(
        {"intencion": "known", "motor": "clase"}
    )
    same = F.col(column) == F.col("known")
    return routed.join(F.broadcast(known), same, "left").drop("known")


def routing_quality(routed: DataFrame, expected: str, got: str) -> DataFrame:
    """Per expected intent: questions, hits, share of hits."""
    hit = F.coalesce(F.col(got) == F.col(expected), F.lit(False)).cast("int")
    return routed.groupBy(expected).agg(
        F.count(F.lit(1)).alias("preguntas"),
        F.sum(hit).alias("aciertos"),
        F.avg(hit).alias("acierto"),
    )


def routing_confusion(routed: DataFrame, expected: str, got: str) -> DataFrame:
    """Questions per expected and found intent."""
    found = F.coalesce(F.col(got), F.lit("ninguna")).alias("obtenida")
    return routed.groupBy(F.col(expected).alias("esperada"), found).agg(
        F.count(F.lit(1)).alias("preguntas")
    )
