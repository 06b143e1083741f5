from __future__ import annotations

import json

from pyspark.sql import functions as F

from mostrador.operators.shape import (
    label_column,
    metric_column,
    numeric_columns,
    shape,
    shape_once,
    to_json_line,
    typed_numbers,
)

STORES = [("S1", "Norte", 1234567.0), ("S2", "Sur", 12.5), ("S3", None, None)]
SCHEMA = "s_store_id string, s_store_name string, ventas_totales double"


def test_metric_and_label_choice():
    assert metric_column(["a", "gasto_total", "ventas_totales"], ["gasto_total", "ventas_totales"]) == "ventas_totales"
    assert metric_column(["mis_ventas_totales_x", "z"], ["mis_ventas_totales_x", "z"]) == "mis_ventas_totales_x"
    assert metric_column(["ventas_totales", "z", "y"], ["z", "y"]) == "y"
    assert metric_column(["a"], []) is None
    assert label_column(["anio", "mes", "ventas_totales"], "ventas_totales") == "mes"
    assert label_column(["x", "y"], "x") == "y"
    assert label_column(["x"], "x") == "x"


def test_numeric_columns_look_at_the_first_ten_rows(spark):
    rows = [(i, str(i) if i < 5 else "x", "x" if i < 10 else "1", None if i < 6 else i, str(i))
            for i in range(40)]
    df = spark.createDataFrame(rows, "a int, half string, late string, gaps int, text string")
    assert numeric_columns(df, ["a"]) == ["a", "half", "text"]
    assert numeric_columns(df.where("a < 0"), ["a"]) == []
    assert numeric_columns(df.where("a = 6"), ["a"]) == ["a", "gaps", "text"]
    assert typed_numbers(df) == ["a", "gaps"]


def test_display_and_chart(spark):
    shaped = shape(spark.createDataFrame(STORES, SCHEMA), ["ventas_totales DESC"])
    assert [tuple(r) for r in shaped.display().collect()] == [
        ("Norte", "1 234 567"), ("Sur", "12.50"), ("None", "0"),
    ]
    assert shaped.display().columns == ["tienda", "ventas totales"]
    assert [tuple(r) for r in shaped.chart().collect()] == [
        (1, "Norte", 1234567.0, "1 234 567"), (2, "Sur", 12.5, "12.50"), (3, "None", 0.0, "0"),
    ]


def test_answer(spark):
    shaped = shape_once(spark.createDataFrame(STORES, SCHEMA), ["ventas_totales DESC"])
    line = to_json_line(shaped.answer("SELECT 1", spark={"tiempo": 6.3, "cpu": 12.34})).first()[0]
    assert json.loads(line) == {
        "heroValue": "1 234 567",
        "heroUnit": "ventas totales",
        "heroLabel": "Norte - valor principal",
        "summary": "La consulta devolvio 3 filas. El valor principal corresponde a Norte, "
                   "con 1 234 567 en ventas totales.",
        "sql": "SELECT 1",
        "hive": None, "spark": 6.3, "hive_cpu": None, "hive_mem": None,
        "spark_cpu": 12.3, "spark_mem": None,
        "matched": 3,
        "cols": ["tienda", "ventas totales"],
        "chartTitle": "ventas totales por tienda",
        "chart": [
            {"label": "Norte", "value": 1234567.0, "valueFmt": "1 234 567"},
            {"label": "Sur", "value": 12.5, "valueFmt": "12.50"},
            {"label": "None", "value": 0.0, "valueFmt": "0"},
        ],
    }


def rows(shaped):
    return [r["fila"] for r in sorted(shaped.rows().collect(), key=lambda r: r["pos"])]


def test_chart_has_eight_points_and_rows_are_whole(spark):
    df = spark.range(500).selectExpr("concat('p', id) AS producto", "id AS cantidad_vendida")
    shaped = shape(df, ["cantidad_vendida DESC"])
    answer = shaped.answer().first()
    assert [p["label"] for p in answer["chart"]] == [f"p{i}" for i in range(499, 491, -1)]
    assert [r[0] for r in rows(shaped)] == [f"p{i}" for i in range(499, -1, -1)]
    assert answer["matched"] == 500 and "rows" not in answer
    assert shaped.display().count() == 500


def test_stored_result_keeps_its_own_order(spark):
    df = spark.range(100_000).selectExpr("concat('p', id) AS producto", "id AS cantidad_vendida")
    shaped = shape_once(df.repartition(7).orderBy(F.desc("cantidad_vendida")))
    answer = shaped.answer().first()
    numbered = shaped.rows().selectExpr("pos", "fila[0] AS producto")
    assert numbered.where("producto <> concat('p', 100000 - pos)").count() == 0
    assert numbered.agg(F.min("pos"), F.max("pos"), F.count_distinct("pos")).first() == (1, 100_000, 100_000)
    assert answer["heroValue"] == "99 999" and answer["cols"] == ["producto", "cantidad vendida"]


def test_no_rows(spark):
    shaped = shape(spark.createDataFrame([], SCHEMA))
    answer = shaped.answer().first()
    assert (answer["heroValue"], answer["heroLabel"], answer["matched"]) == ("-", "Sin resultados", 0)
    assert answer["cols"] == ["s_store_id", "s_store_name", "ventas_totales"]
    assert rows(shaped) == [] and answer["chart"] == []
    assert shaped.chart().count() == 0


def test_no_metric(spark):
    df = spark.createDataFrame([("b", "x", "z"), ("a", "y", "z")], "uno string, dos string, tres string")
    shaped = shape(df, ["uno"])
    answer = shaped.answer().first()
    assert (answer["heroValue"], answer["heroLabel"]) == ("a", "Resultado textual")
    assert answer["cols"] == ["uno", "dos"] and rows(shaped) == [["a", "y"], ["b", "x"]]
    assert answer["chart"] == [] and answer["chartTitle"] == "Resultados"


def test_result_of_texts(spark):
    """A result whose values are all text, as a command-line client returns it."""
    rows = [("1", "Ventas", "10.5"), ("2", "Otros", "7")]
    shaped = shape(spark.createDataFrame(rows, "mes string, que string, ventas_totales string"), ["mes"])
    assert [tuple(r) for r in shaped.display().collect()] == [("Enero", "10.50"), ("Febrero", "7")]


def test_single_column(spark):
    shaped = shape(spark.createDataFrame([(5,)], "total int"))
    assert rows(shaped) == [["5", "5"]]
    assert shaped.display().columns == ["total", "total 2"]
