from __future__ import annotations

import random
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, DoubleType, IntegerType, StringType

from mostrador.functions.numbers import (
    format_amount,
    month_label,
    number_or_null,
    ratio,
    readable,
    rounded,
    to_number,
)


def column(spark, values, kind, make):
    table = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [row[1] for row in sorted(table.select("i", make(F.col("v"))).collect())]


def plain_amount(x):
    if abs(x - int(x)) < 0.005:
        return f"{int(x):,}".replace(",", " ")
    return f"{x:,.2f}".replace(",", " ")


def test_format_amount(spark):
    rng = random.Random(1)
    values = [1234567.0, 2.004, 3.999, 1234.565, -0.001, -1234.5, 0.125, 0.0, -0.3, 999.995, 1e12]
    values += [rng.choice([1, -1]) * round(rng.expovariate(1) * 10 ** rng.randrange(7), rng.randrange(5))
               for _ in range(2000)]
    values += [k + d for k in range(60) for d in (0.005, 0.0049999, 0.125, 0.375, -0.005)]
    assert column(spark, values, "double", format_amount) == [plain_amount(v) for v in values]


def test_to_number(spark):
    texts = ["1", " 2.5 ", "-3e2", "1_000", "_1", "1__0", "1_", ".5", "5.", ".", "abc", "", None, "1d",
             "0x10", "+7", "1e", "inf", "-Infinity", "\t8\n", "1 2", "1,5"]

    def plain(text):
        try:
            return float(text)
        except (TypeError, ValueError):
            return None

    expected = [plain(t) for t in texts]
    got = column(spark, texts, "string", lambda v: number_or_null(v, StringType()))
    assert got == expected
    zeroed = column(spark, texts, "string", lambda v: to_number(v, StringType()))
    assert zeroed == [x if x is not None else 0.0 for x in expected]


def test_only_numbers_are_numbers(spark):
    assert column(spark, [Decimal("1.50"), None], "decimal(5,2)",
                  lambda v: number_or_null(v, DecimalType(5, 2))) == [1.5, None]
    dates = spark.sql("SELECT DATE'2020-01-01' AS d")
    assert dates.select(number_or_null(F.col("d"), DateType())).first()[0] is None


def test_rounding_like_python(spark):
    rng = random.Random(2)
    values = [0.25, 0.35, 2.675, 0.125, 1.005, -0.25, 1853.05] + [rng.uniform(-9, 9) for _ in range(500)]
    values += [k / 8 for k in range(-40, 40)]
    for digits in (1, 2):
        got = column(spark, values, "double", lambda v: rounded(v, digits))
        assert got == [round(v, digits) for v in values]


def test_rounded_keeps_what_is_not_finite(spark):
    got = column(spark, [float("inf"), float("-inf"), float("nan"), None, 2.345], "double", lambda v: rounded(v, 2))
    assert str(got) == "[inf, -inf, nan, None, 2.35]" or str(got) == "[inf, -inf, nan, None, 2.34]"


def test_ratio(spark):
    pairs = [(24.8, 6.3), (1.0, 0.0), (0.0, 2.0), (None, 1.0), (1.0, None)]
    table = spark.createDataFrame(pairs, "a double, b double")
    assert [r[0] for r in table.select(ratio(F.col("a"), F.col("b"))).collect()] == [
        3.94, None, None, None, None,
    ]


def test_month_label(spark):
    assert column(spark, [1, 12, 0, 13, None], "int", lambda v: month_label(v, IntegerType())) == [
        "Enero", "Diciembre", "0", "13", "None",
    ]
    assert column(spark, [" 3 ", "3.0", "x", None], "string",
                  lambda v: month_label(v, StringType())) == ["Marzo", "3.0", "x", "None"]
    assert column(spark, [4.7], "double", lambda v: month_label(v, DoubleType())) == ["Abril"]


def test_readable():
    assert readable("s_store_name") == "tienda"
    assert readable("numero_compras") == "numero de compras"
    assert readable("otra_columna_x") == "otra columna x"
