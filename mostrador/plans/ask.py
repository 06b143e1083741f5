"""From a question, or a JSON query plan, to an answer."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mostrador.operators.shape import shape_once
from mostrador.plans.adhoc import run_sql
from mostrador.plans.catalog import CATALOG
from mostrador.plans.planning import parse_plans, resolve_plans, resolve_requests
from mostrador.plans.routing import request_mode, route
from mostrador.plans.statements import STATEMENTS, over
from mostrador.sources.star import STAR_DATABASE, Star


def ask(
    spark: SparkSession, star: Star, question: str, engine: str = "ambos"
) -> tuple[DataFrame, DataFrame]:
    """The answer to one question: its header, of one row, and its display rows.

    The question is routed to an approved query, which runs once on Spark whatever engine
    is asked for; an unsafe or unknown question raises ValueError with the error's code.
    """
    if not question.strip():
        raise ValueError("empty_question")
    asked = spark.createDataFrame([(question, engine)], "pregunta string, pedido string")
    routed = route(asked, request_mode(F.col("pedido"))).first()
    if routed["error"]:
        raise ValueError(routed["error"])
    entry = CATALOG[routed["intencion"]]
    started = time.perf_counter()
    shaped = shape_once(entry.build(star), entry.order)
    seconds = time.perf_counter() - started
    return shaped.answer(STATEMENTS[routed["intencion"]], spark={"tiempo": seconds}), shaped.rows()


def run_plan(spark: SparkSession, answer: str, database: str = STAR_DATABASE) -> DataFrame:
    """The result of a plan given as JSON text, over the registered star.

    A plan that is not analytic, not valid or not allowed raises ValueError.
    """
    one = spark.createDataFrame([(answer,)], "respuesta string")
    plan = resolve_plans(parse_plans(one)).first()
    if plan["error"]:
        raise ValueError(plan["error"])
    return run_sql(spark, over(plan["sentencia"], database), database)


def answer_plan(
    spark: SparkSession,
    question: str,
    plan: str | None,
    engine: str = "auto",
    database: str = STAR_DATABASE,
) -> tuple[DataFrame, DataFrame, str]:
    """Header, display rows and engine of a question that a JSON plan came for.

    Without a plan the rules choose an approved query. The statement runs once on Spark,
    over the registered star, whatever engine the request settles on. A request that is
    refused raises ValueError with the error's code.
    """
    one = spark.createDataFrame(
        [(question, engine, plan)], "pregunta string, modo string, respuesta string"
    )
    resolved = resolve_requests(one).first()
    if resolved["error"]:
        raise ValueError(resolved["error"])
    statement = over(resolved["sentencia"], database)
    started = time.perf_counter()
    shaped = shape_once(run_sql(spark, statement, database))
    seconds = time.perf_counter() - started
    header = shaped.answer(statement, spark={"tiempo": seconds})
    return header, shaped.rows(), resolved["motor"]
