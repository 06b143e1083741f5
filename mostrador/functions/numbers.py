"""Numbers and labels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, NumericType, StringType

# Texts that Python's float() takes: digits may hold single underscores.
_DIGITS = r"[0-9](?:_?[0-9])*"
_FLOAT = (
    rf"(?Ui)^[\s\x1c-\x1f]*[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?"
    rf"|inf|infinity|nan)[\s\x1c-\x1f]*$"
)
_INTEGER = rf"(?U)^[\s\x1c-\x1f]*[+-]?{_DIGITS}[\s\x1c-\x1f]*$"
_NOISE = r"(?U)[\s\x1c-\x1f_]"
# Above this a double has no fraction and a bigint may be too small.
_WHOLE_FROM = 9.0e15

# Fixed values.
MONTHS = (
    "Enero",
    "Febrero",
    "Marzo",
    "Abril",
    "Mayo",
    "Junio",
    "Julio",
    "Agosto",
    "Septiembre",
    "Octubre",
    "Noviembre",
    "Diciembre",
)
READABLE = {
    "s_store_name": "tienda",
    "s_store_id": "tienda",
    "i_item_id": "producto",
    "producto": "producto",
    "cliente": "cliente",
    "d_day_name": "dia",
    "dia_semana": "dia",
    "mes": "mes",
    "ventas_totales": "ventas totales",
    "ingresos_totales": "ingresos totales",
    "ingreso_generado": "ingreso generado",
    "gasto_total": "gasto total",
    "ticket_promedio": "ticket promedio",
    "cantidad_vendida": "cantidad vendida",
    "numero_compras": "numero de compras",
}


def number_or_null(value: Column, kind: DataType) -> Column:
    """The value as a double if it is a number or reads as one."""
    if isinstance(kind, (NumericType, BooleanType)):
        return value.cast("double")
    if not isinstance(kind, StringType):
        return F.lit(None).cast("double")
    plain = F.regexp_replace(value, _NOISE, "")
    unsigned = F.regexp_replace(plain, r"^[+-](?=(?i)nan$)", "")
    return F.when(value.rlike(_FLOAT), unsigned.try_cast("double"))


def to_number(value: Column, kind: DataType = StringType()) -> Column:
    """As number_or_null, with 0.0 for everything else."""
    return F.coalesce(number_or_null(value, kind), F.lit(0.0))


def format_amount(number: Column) -> Column:
    """Blank between thousands; no decimals if the value is whole to within 0.005."""
    # beyond the range of whole doubles there is no fraction left to test
    small = F.abs(number) < _WHOLE_FROM
    whole = F.when(small, number).cast("bigint")
    near_whole = F.coalesce(F.abs(number - whole) < 0.005, ~small)
    grouped = (
        F.when(near_whole & small, F.format_number(whole, 0))
        .when(near_whole, F.format_number(number, 0))
        .otherwise(F.format_number(number, 2))
    )
    return F.translate(grouped, ",", " ")


def rounded(number: Column, digits: int) -> Column:
    """Rounding of the exact binary value, ties to even, as Python's round() does.

    An infinite or undefined number stays as it is.
    """
    pattern = F.lit("0." + "0" * digits)
    text = F.call_function("format_number", number, pattern)
    return F.coalesce(text.try_cast("double"), number.cast("double"))


def ratio(dividend: Column, divisor: Column) -> Column:
    """Quotient to two digits; null if either side is null or zero."""
    usable = (dividend != 0) & (divisor != 0)
    return F.when(usable, rounded(F.try_divide(dividend, divisor), 2))


def as_text(value: Column) -> Column:
    """Text of a value; a null is shown as None."""
    return F.coalesce(value.cast("string"), F.lit("None"))


def month_label(month: Column, kind: DataType) -> Column:
    """Spanish month name of 1 to 12; any other value as its text."""
    if isinstance(kind, StringType):
        number = F.when(
            month.rlike(_INTEGER), F.regexp_replace(month, _NOISE, "").try_cast("int")
        )
    elif isinstance(kind, NumericType):
        number = month.try_cast("int")
    else:
        number = F.lit(None).cast("int")
    names = F.array(*[F.lit(name) for name in MONTHS])
    named = F.when(number.between(1, 12), F.get(names, number - 1))
    return F.coalesce(named, as_text(month))


def readable(column: str) -> str:
    return READABLE.get(column, column.replace("_", " "))
