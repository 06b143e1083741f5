"""Ordered word rules over normalised text, and the rule tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

Groups = Sequence[Sequence[str]]
Rules = Sequence[tuple[str, Groups]]

# Each intent with its groups of words, in order. A rule holds if every
# group has a word that occurs in the text; the first rule that holds names the intent.
DAYS = ("dia", "dias", "lunes", "martes", "miercoles", "jueves", "viernes", "sabado", "domingo",
        "fin de semana")
SHOPS = ("tienda", "tiendas", "local", "locales")
GOODS = ("producto", "productos", "articulo", "articulos")
CLIENTS = ("cliente", "clientes")
INTENT_RULES: Rules = (
    ("ventas_por_dia_semana", (DAYS, ("venta", "ventas", "vende", "vendio", "vendieron"))),
    ("ranking_mensual_ventas", (("ranking mensual", "por cada mes"),)),
    ("ranking_mensual_ventas", (("ranking", "ordenadas", "ordenado"), ("mes", "mensual"), SHOPS)),
    ("cinco_productos_mas_vendidos",
     (("5", "cinco", "top 5"), GOODS, ("vendido", "vendidos", "unidades", "cantidad"))),
    ("diez_mejores_clientes",
     (("10", "diez", "top 10"), CLIENTS,
      ("mejor", "mejores", "valioso", "valiosos", "gasto", "gastaron", "dinero"))),
    ("productos_mayor_ingreso",
     (GOODS, ("ingreso", "ingresos", "dinero", "plata", "facturacion", "monto", "generaron",
              "aportaron"))),
    ("top_20_clientes_compras",
     (("20", "veinte", "primeros 20"), CLIENTS, ("compra", "compras", "compraron", "hicieron"))),
    ("top_20_clientes_compras",
     (("veces", "cantidad de compras", "numero de compras"), (*CLIENTS, "compraron"))),
    ("ticket_promedio_por_cliente",
     (("ticket", "promedio", "medio", "monto promedio"), (*CLIENTS, "compra", "paga", "gasta"))),
    ("top_productos_por_tienda",
     (("por tienda", "por cada tienda", "cada tienda", "en cada tienda", "por local",
       "cada local"), (*GOODS, "lideres"))),
    ("top_clientes_gasto_total",
     (CLIENTS, ("gasto", "gastaron", "dinero", "monto total", "comprado", "ingresos",
                "valiosos"))),
    ("mes_mayores_ingresos",
     (("mes", "mensual"), ("mayor", "mas fuerte", "mas dinero", "facturacion", "ingreso",
                           "ingresos"))),
    ("ventas_por_mes", (("mes", "mensual", "mes a mes"), ("venta", "ventas", "vendio"))),
    ("tienda_mayores_ventas",
     (SHOPS, ("mayor", "mas vendio", "numero uno", "mayores ventas", "mayor ingreso"))),
    ("ventas_por_tienda",
     (SHOPS, ("venta", "ventas", "vendio", "vendido", "total vendido", "comparar"))),
)

# The patterns tried after the rules, all words of one must occur.
FALLBACK_PATTERNS = (
    ("cinco_productos_mas_vendidos", ("cinco", "productos", "mas", "vendidos")),
    ("diez_mejores_clientes", ("diez", "mejores", "clientes")),
    ("tienda_mayores_ventas", ("tienda", "mayores", "ventas")),
    ("tienda_mayores_ventas", ("tienda", "mayor", "ventas")),
    ("mes_mayores_ingresos", ("mes", "mayores", "ingresos")),
    ("mes_mayores_ingresos", ("mes", "mayor", "ingreso")),
    ("ranking_mensual_ventas", ("ranking", "mensual", "ventas")),
    ("top_productos_por_tienda", ("top", "productos", "tienda")),
    ("ticket_promedio_por_cliente", ("ticket", "promedio", "cliente")),
    ("productos_mayor_ingreso", ("productos", "mayor", "ingreso")),
    ("productos_mayor_ingreso", ("productos", "ingreso", "generado")),
    ("top_clientes_gasto_total", ("clientes", "gasto", "total")),
    ("top_20_clientes_compras", ("top", "20", "clientes", "compras")),
    ("top_20_clientes_compras", ("clientes", "mayor", "numero", "compras")),
    ("ventas_por_dia_semana", ("ventas", "dia", "semana")),
    ("ventas_por_mes", ("ventas", "mes")),
    ("ventas_por_tienda", ("ventas", "tienda")),
)
FALLBACK_RULES: Rules = tuple(
    (intent, tuple((word,) for word in words)) for intent, words in FALLBACK_PATTERNS
)

# Engine preferences written in a question.
ENGINE_RULES: Rules = (
    ("both", (("hive y spark", "spark y hive", "ambos motores", "los dos motores", "en ambos",
               "con ambos", "comparar hive", "comparacion entre hive", "both"),)),
    ("spark", (("spark",),)),
    ("hive", (("hive",),)),
)

# Words that make a question unsafe.
UNSAFE_WORDS = ("borra", "borrar", "elimina", "eliminar", "drop", "delete", "truncate", "alter",
                "create", "insert", "update", "merge", "grant", "revoke", "load", "export",
                "import")


def shortest(words: Iterable[str]) -> list[str]:
    """The words that no other word of the group is part of; the rest add no match."""
    words = list(dict.fromkeys(words))
    return [w for w in words if not any(other != w and other in w for other in words)]


def first_rule(text: Column, rules: Rules) -> Column:
    """Name of the first rule that holds for a normalised text, null if none does."""

    def holds(groups: Groups) -> Column:
        return reduce(and_, [reduce(or_, map(text.contains, shortest(g))) for g in groups])

    return F.coalesce(*[F.when(holds(groups), F.lit(name)) for name, groups in rules])


def has_any_word(text: Column, words: Sequence[str]) -> Column:
    """Whether a normalised text has one of the words as a whole token."""
    return text.rlike(f"(?:^| )(?:{'|'.join(words)})(?: |$)")
