"""Audited SQL text run against the registered star and nothing else."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from mostrador.operators.audit import audit_text
from mostrador.plans.statements import statement
from mostrador.sources.star import STAR_DATABASE, STAR_TABLES


# Kinds of leaves that read nothing, and of nodes that reach outside the data.
_HARMLESS_LEAVES = {"OneRowRelation", "LocalRelation", "CTERelationRef", "Range"}
_OUTSIDE_NODES = {"ScriptTransformation", "View", "Command", "InsertIntoStatement"}
# Built-in expressions lie in one package. Of those there, some run code that is not built
# in, or tell of files; Invoke and StaticInvoke are as good as the class they call.
_BUILT_IN = "org.apache.spark.sql.catalyst."
_EXPRESSIONS = f"{_BUILT_IN}expressions."
_FOREIGN_CODE = re.compile(r"Reflect|Python|Pandas|ScalaUDF|ScalaUDAF|ApplyFunction|V2Aggregator|InputFile|ReadFile")


def _below(node) -> Iterator:
    """A node of the analysed plan, or an expression, and everything under it."""
    yield node
    children = node.children()
    for i in range(children.size()):
        yield from _below(children.apply(i))


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def is_built_in(name: str) -> bool:
    """Whether a class of expressions, by its full name, is Spark's own and runs nothing else."""
    return name.startswith(_EXPRESSIONS) and not _FOREIGN_CODE.search(name.rsplit(".", 1)[-1])


def _is_allowed(call) -> bool:
    """Whether a call is built in and gives the same result for the same rows."""
    kind = _kind(call)
    if not is_built_in(call.getClass().getName()) or not call.deterministic():
        return False
    if kind == "StaticInvoke":
        return call.staticObject().getName().startswith(_BUILT_IN)
    if kind == "Invoke":
        target = call.targetObject().dataType()
        return _kind(target) != "ObjectType" or target.cls().getName().startswith(_BUILT_IN)
    return True


def _plans(plan) -> Iterator:
    """The plan and the plans of its subqueries, at any depth."""
    yield plan
    inner = plan.subqueriesAll()
    for i in range(inner.size()):
        yield inner.apply(i)


def outside_star(result: DataFrame, database: str = STAR_DATABASE) -> str | None:
    """Why an analysed, not yet run, statement reaches beyond the star's tables, or None.

    Every leaf has to be one of the five tables or rows written in the statement. Scripts
    and views are refused by the kind of node that the analyser made of them, however the
    text spells them. Calls are accepted only if they are built in and deterministic: user
    functions of any kind, permanent ones too, come from elsewhere.
    """
    for plan in _plans(result._jdf.queryExecution().analyzed()):
        for node in _below(plan):
            kind = _kind(node)
            if kind in _OUTSIDE_NODES or kind.endswith("Command"):
                return "not_a_query"
            calls = node.expressions()
            for i in range(calls.size()):
                for call in _below(calls.apply(i)):
                    if not _is_allowed(call):
                        return "outside_call"
            if node.children().size() or kind in _HARMLESS_LEAVES:
                continue
            known = kind == "LogicalRelation" and node.catalogTable().isDefined()
            name = node.catalogTable().get().identifier() if known else None
            if name is None or name.table() not in STAR_TABLES or name.database().get() != database:
                return "outside_table"
    return None


def run_sql(spark: SparkSession, sql: str, database: str = STAR_DATABASE) -> DataFrame:
    """The result of one read-only statement over the star's tables in a database.

    The audit is a text check and only the first filter. The statement is analysed in a
    session of its own, without the caller's temporary views, and its plan is refused before
    anything runs if it reaches beyond the star's five tables.
    """
    code = audit_text(spark, sql, database)
    if code is not None:
        raise ValueError(f"statement refused: {code}")
    alone = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and alone.conf.isModifiable(key):
            alone.conf.set(key, value)
    alone.conf.set("spark.sql.runSQLOnFiles", "false")
    alone.catalog.setCurrentDatabase(database)
    result = alone.sql(sql)
    code = outside_star(result, database)
    if code is not None:
        raise ValueError(f"statement refused: {code}")
    return result


def run_intent(spark: SparkSession, intent: str, database: str = STAR_DATABASE) -> DataFrame:
    """The approved statement of an intent, over the registered star."""
    return run_sql(spark, statement(intent, database), database)
