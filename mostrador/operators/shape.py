"""Any result as a labelled answer: display columns, chart points, headline, JSON."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from mostrador.functions.numbers import (
    as_text,
    format_amount,
    month_label,
    number_or_null,
    readable,
    to_number,
)
from mostrador.session import scratch_folder

# Columns preferred as metric and as label, in order, and the row counts
# that decide a column's kind and fill a chart.
METRIC_HINTS = (
    "ventas_totales",
    "ingresos_totales",
    "ingreso_generado",
    "gasto_total",
    "ticket_promedio",
    "cantidad_vendida",
    "numero_compras",
)
LABEL_HINTS = (
    "producto",
    "cliente",
    "store_name",
    "tienda",
    "dia_semana",
    "mes",
    "i_item_id",
    "s_store_id",
    "c_customer_id",
)
SAMPLE_ROWS, CHART_POINTS = 10, 8

# The place of a stored row in a result that names no order of its own.
POSITION = "_posicion"

# The fields of an answer's header, in order. So are the sentences of its
# summary. The display rows are a table beside the header, at every size.
ANSWER_SCHEMA_ORDER = (
    "heroValue",
    "heroUnit",
    "heroLabel",
    "summary",
    "sql",
    "hive",
    "spark",
    "hive_cpu",
    "hive_mem",
    "spark_cpu",
    "spark_mem",
    "matched",
    "cols",
    "chartTitle",
    "chart",
)


def typed_numbers(result: DataFrame) -> list[str]:
    """Columns of a numeric type. Enough where numbers are never null, as in approved
    queries, and found without running anything."""
    return [field.name for field in result.schema if isinstance(field.dataType, NumericType)]


def numeric_columns(result: DataFrame, order: Sequence[str] = ()) -> list[str]:
    """Columns that are numbers in at least half of the first ten rows."""
    first = _ordered(result, order).limit(SAMPLE_ROWS)
    counted = [
        F.count(number_or_null(F.col(f"`{f.name}`"), f.dataType)).alias(f"n{i}")
        for i, f in enumerate(result.schema)
    ]
    row = first.agg(F.count(F.lit(1)).alias("rows"), *counted).first()
    if not row["rows"]:
        return []
    needed = max(1, row["rows"] // 2)
    return [name for i, name in enumerate(result.columns) if row[f"n{i}"] >= needed]


def _hinted(columns: Sequence[str], hints: Sequence[str]) -> str | None:
    """Of the columns whose name holds a hint, the one with the earliest hint, then the first."""
    found = [
        (rank, place)
        for place, name in enumerate(columns)
        for rank, hint in enumerate(hints)
        if hint in name
    ]
    return columns[min(found)[1]] if found else None


def metric_column(columns: Sequence[str], numeric: Sequence[str]) -> str | None:
    """The numeric column that is hinted at, or else the last one; None without any."""
    eligible = [name for name in columns if name in set(numeric)]
    return _hinted(eligible, METRIC_HINTS) or next(reversed(eligible), None)


def label_column(columns: Sequence[str], metric: str | None) -> str:
    """The column beside the metric that is hinted at, or else the first; at worst the metric."""
    others = [name for name in columns if name != metric]
    return _hinted(others, LABEL_HINTS) or [*others, *columns][0]


def sort_key(text: str) -> Column:
    """``name`` or ``name DESC`` as a sort column."""
    name, _, direction = text.partition(" ")
    return F.desc(name) if direction.upper() == "DESC" else F.asc(name)


def _ordered(result: DataFrame, order: Sequence[str]) -> DataFrame:
    return result.orderBy(*map(sort_key, order)) if order else result


@dataclass(frozen=True)
class Shaped:
    """A result with its metric and label chosen. ``metric`` is None if nothing is numeric.

    A DataFrame has no row order of its own: ``order`` are the sort keys of the query
    (``name`` or ``name DESC``) and decide which row is first.
    """

    result: DataFrame
    order: tuple[str, ...]
    metric: str | None
    label: str | None

    @property
    def _names(self) -> list[str]:
        return [name for name in self.result.columns if name != POSITION]

    def _shown(self) -> list[Column]:
        schema = self.result.schema
        if self.metric is None:
            names = self._names[:2]
            return [as_text(F.col(f"`{name}`")) for name in names]
        label = F.col(f"`{self.label}`")
        if self.label == "mes":
            label = month_label(label, schema["mes"].dataType)
        return [as_text(label), format_amount(self._number())]

    def _number(self) -> Column:
        return to_number(F.col(f"`{self.metric}`"), self.result.schema[self.metric].dataType)

    @property
    def columns(self) -> list[str]:
        """Headings of the display table."""
        if self.metric is None:
            return self._names[:2]
        return [readable(self.label), readable(self.metric)]

    def display(self) -> DataFrame:
        """Label and formatted metric of every row, in the query's order."""
        names = _distinct(self.columns)
        shown = [value.alias(name) for value, name in zip(self._shown(), names)]
        return _ordered(self.result, self.order).select(*shown)

    def _head(self) -> DataFrame:
        """One row: the first rows as an ordered array of at most ``CHART_POINTS``."""
        value = F.lit(None).cast("double") if self.metric is None else self._number()
        first = _ordered(self.result, self.order).limit(CHART_POINTS)
        # the ids follow the sorted order
        row = F.struct(
            F.monotonically_increasing_id().alias("id"),
            F.array(*self._shown()).alias("shown"),
            value.alias("value"),
        )
        return first.select(row.alias("row")).agg(F.array_sort(F.collect_list("row")).alias("head"))

    def chart(self) -> DataFrame:
        """Up to eight points: position, label, number, formatted number."""
        points = self._head().select(F.posexplode("head").alias("at", "row"))
        if self.metric is None:
            points = points.where(F.lit(False))
        return points.select(
            (F.col("at") + 1).alias("pos"),
            F.get("row.shown", F.lit(0)).alias("label"),
            "row.value",
            F.get("row.shown", F.lit(1)).alias("valueFmt"),
        )

    def rows(self) -> DataFrame:
        """Every display row as (pos, fila), numbered from one in the query's order.

        Rows are numbered where they were written: by how many rows the tasks before theirs
        wrote, and by their own place. The running count sees one row per writing task.
        """
        if POSITION not in self.result.columns:
            return replace(self, result=stored(self.result, self.order), order=(POSITION,)).rows()
        task = F.shiftright(POSITION, 33)
        written = self.result.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n"))
        before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
        starts = written.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
        shown = self.result.select(
            task.alias("task"),
            F.col(POSITION).bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
            F.array(*self._shown()).alias("fila"),
        )
        numbered = shown.join(starts, "task")
        return numbered.select((F.col("start") + F.col("place") + 1).alias("pos"), "fila")

    def answer(
        self,
        sql: str = "",
        hive: dict[str, float] | None = None,
        spark: dict[str, float] | None = None,
    ) -> DataFrame:
        """The answer's header as one row of fixed size; rows() are its other part.

        ``hive`` and ``spark`` hold tiempo, cpu, mem. The row count reads the result a
        second time, which is why an answer is best made from a stored result: see
        shape_once().
        """
        head = self._head().select("head", F.lit(0).cast("long").alias("matched"))
        counted = self.result.agg(F.count(F.lit(1)).alias("matched")).select(
            F.lit(None).cast(head.schema["head"].dataType).alias("head"), "matched"
        )
        whole = head.unionByName(counted).agg(
            F.max("head").alias("head"), F.max("matched").alias("matched")
        )
        return self._answer_row(whole, sql, hive or {}, spark or {})

    def _answer_row(self, whole: DataFrame, sql: str, hive: dict, spark: dict) -> DataFrame:
        empty = F.col("matched") == 0
        first = F.get("head", F.lit(0))["shown"]
        if self.metric is None:
            hero, unit = F.get(first, F.lit(0)), ""
            hero_label, title = F.lit("Resultado textual"), "Resultados"
            chart = F.slice("head", 1, 0)
            summary = F.format_string(
                "La consulta devolvio %d filas, pero no se detecto una metrica numerica "
                "para graficar.",
                "matched",
            )
        else:
            label, hero = F.get(first, F.lit(0)), F.get(first, F.lit(1))
            unit = readable(self.metric)
            hero_label = F.concat(label, F.lit(" - valor principal"))
            title = f"{unit} por {readable(self.label)}"
            chart = F.col("head")
            summary = F.concat(
                F.format_string("La consulta devolvio %d filas. ", "matched"),
                F.lit("El valor principal corresponde a "), label, F.lit(", con "), hero,
                F.lit(f" en {unit}."),
            )
        points = F.transform(
            chart,
            lambda row: F.struct(
                F.get(row["shown"], F.lit(0)).alias("label"),
                row["value"].alias("value"),
                F.get(row["shown"], F.lit(1)).alias("valueFmt"),
            ),
        )

        def measure(run: dict, name: str, digits: int | None) -> Column:
            value = run.get(name)
            if value is not None and digits is not None:
                value = round(value, digits)
            return F.lit(value).cast("double")

        def text_or(fallback: str, value: Column | str) -> Column:
            value = F.lit(value) if isinstance(value, str) else value
            return F.when(empty, F.lit(fallback)).otherwise(value)

        no_rows = "La consulta se ejecuto correctamente, pero no devolvio filas."
        all_columns = F.array(*[F.lit(name) for name in self._names])
        shown_columns = F.array(*[F.lit(name) for name in self.columns])
        fields = {
            "heroValue": text_or("-", hero),
            "heroUnit": text_or("", unit),
            "heroLabel": text_or("Sin resultados", hero_label),
            "summary": text_or(no_rows, summary),
            "sql": F.lit(sql),
            "hive": measure(hive, "tiempo", None),
            "spark": measure(spark, "tiempo", None),
            "hive_cpu": measure(hive, "cpu", 1),
            "hive_mem": measure(hive, "mem", 1),
            "spark_cpu": measure(spark, "cpu", 1),
            "spark_mem": measure(spark, "mem", 1),
            "matched": F.col("matched"),
            "cols": F.when(empty, all_columns).otherwise(shown_columns),
            "chartTitle": text_or("Sin datos para graficar", title),
            "chart": points,
        }
        return whole.select([fields[name].alias(name) for name in ANSWER_SCHEMA_ORDER])


def _distinct(names: Sequence[str]) -> list[str]:
    return [n if n not in names[:i] else f"{n} {i + 1}" for i, n in enumerate(names)]


def shape(
    result: DataFrame, order: Sequence[str] = (), numeric: Sequence[str] | None = None
) -> Shaped:
    """Choose metric and label. ``numeric`` names the numeric columns where they are known;
    otherwise the query runs once for its first ten rows."""
    if numeric is None:
        numeric = numeric_columns(result, order)
    names = [name for name in result.columns if name != POSITION]
    metric = metric_column(names, numeric)
    label = label_column(names, metric) if metric else None
    return Shaped(result, tuple(order), metric, label)


def stored(result: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """The result written once in its order, every row with its place in it, and read again."""
    spark = result.sparkSession
    path = f"{scratch_folder(spark)}/resultado"
    placed = _ordered(result, order).withColumn(POSITION, F.monotonically_increasing_id())
    placed.write.parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def shape_once(result: DataFrame, order: Sequence[str] = ()) -> Shaped:
    """Run the query once into the shared scratch folder and shape what was written.

    Looking at the first rows, counting and numbering then read the small result, not the
    fact, and a lost executor costs no second run of the query. A result that names no order
    keeps the one it has.
    """
    return shape(stored(result, order), (POSITION,))


def to_json_line(answer: DataFrame) -> DataFrame:
    """An answer as JSON text; fields without a value are kept as null."""
    everything = F.struct(*answer.columns)
    return answer.select(
        F.to_json(everything, {"ignoreNullFields": "false"}).alias("respuesta")
    )

