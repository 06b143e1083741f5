"""Every registered query against its reference SQL, on the smallest given tables."""

from __future__ import annotations

import pytest

from checks.compare import compare, reference
from checks.oracles import ORACLES
from checks.queries import QUERIES
from tests.conftest import SMALL

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def connection():
    return reference(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    verdict = compare(spark, connection, SMALL, QUERIES[name], ORACLES.get(name))
    assert verdict.startswith(("equal", "rows only")), verdict


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns == [
        "anio", "mes", "s_store_id", "s_store_name", "ventas_totales", "ranking_mensual",
    ]
