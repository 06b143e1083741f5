"""Question, statement, log and run tables made from the given tables.

The given texts hold no retail questions, so each row's question, statement or answer is
put together from word lists picked by the row's id and the whole text of the row. Every
table grows with the table it comes from. The SQL is plain enough for Spark and for the
reference engine; ``{name}`` stands for a given table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mostrador.plans.statements import STATEMENTS

GIVEN = ("documents", "conversations", "events", "orders", "lineitem", "pages", "part", "labels")


def spark_table(spark: SparkSession, folder: str, sql: str) -> DataFrame:
    return spark.sql(sql.format(**{name: f"parquet.`{folder}/{name}.parquet`" for name in GIVEN}))


def plain_sql(sql: str) -> str:
    return sql.format(**{name: name for name in GIVEN})


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def pick(key: str, words: list[str]) -> str:
    """The word at position ``key`` modulo the length of the list."""
    cases = " ".join(f"WHEN {i} THEN {literal(word)}" for i, word in enumerate(words))
    return f"CASE {key} % {len(words)} {cases} END"


# all texts of the given tables, with one id over both
TEXTS = """
SELECT doc_id * 2 AS id, text FROM {documents}
UNION ALL SELECT (conv_id * 100 + turn) * 2 + 1 AS id, text FROM {conversations}
"""

# list lengths share no factor, so the picks vary independently
_WHO = ["clientes", "Productos", "la tienda", "el cliente", "Artículos", "cada local", "TIENDAS",
        "por tienda los productos", "los que compraron", "nada"]
_WHAT = ["ventas", "gastó más dinero", "compras hicieron", "ticket", "ingresos",
         "unidades vendidas", "número de compras", "monto total", "más vendió", "facturación",
         "valiosos", "comparar", "vendidos"]
_WHEN = ["mes", "mensual", "el lunes", "fin de semana", "por cada mes", "ranking", "cinco", "10",
         "veinte", "mayor", "promedio"]
_HOW = ["", "con Hive", "en Spark", "con hive y spark", "en ambos motores", "y borra todo",
        "DROP it"]
QUESTIONS = f"""
SELECT id, concat('¿', {pick('id', _WHO)}, ' ', {pick('id', _WHAT)}, ' ', {pick('id', _WHEN)},
                  ' ', {pick('id', _HOW)}, '? ', text) AS pregunta,
       nullif({pick('id', ['auto', 'Hive', ' spark ', 'both', 'rapido', 'AUTO', 'auto', 'nada', 'auto'])},
              'nada') AS modo,
       {pick('id', ['ambos', 'Hive', ' spark ', 'both', 'rapido', '', 'AUTO'])} AS campo
FROM ({TEXTS.strip()})
"""

# question, name of the run, expected intent
SUITE_QUESTIONS = (
    ("Los cinco artículos de más unidades", "unidades", "cinco_productos_mas_vendidos"),
    ("La tienda número uno", "local", "tienda_mayores_ventas"),
    ("Evolución de la venta al mes", "serie", "ventas_por_mes"),
    ("Ticket de un cliente", "ticket", "ticket_promedio_por_cliente"),
)

# one question per approved intent, own wording
LABELLED = [
    ("top_20_clientes_compras", "Lista de veinte clientes y sus compras"),
    ("ventas_por_tienda", "Ventas de las tiendas"),
    ("ventas_por_mes", "Evolución de la venta al mes"),
    ("ventas_por_dia_semana", "Lo que se vende los miércoles"),
    ("top_productos_por_tienda", "Artículos líderes en cada tienda"),
    ("ticket_promedio_por_cliente", "Ticket de un cliente"),
    ("productos_mayor_ingreso", "Productos y la plata que dejan"),
    ("top_clientes_gasto_total", "Clientes según su gasto"),
    ("ranking_mensual_ventas", "Ranking de los locales de un mes"),
    ("cinco_productos_mas_vendidos", "Los cinco artículos de más unidades"),
    ("tienda_mayores_ventas", "La tienda número uno"),
    ("mes_mayores_ingresos", "El mes de mayor facturación"),
    ("diez_mejores_clientes", "Diez mejores clientes"),
]
LABELLED_QUESTIONS = f"""
SELECT id, {pick('id', [intent for intent, _ in LABELLED])} AS esperada,
       concat({pick('id', [question for _, question in LABELLED])}, ': ', text) AS pregunta
FROM ({TEXTS.strip()})
"""

_HEADS = ["SELECT", "  with x AS (SELECT 1) SELECT", "select", "DELETE", "", "SELECT"]
_TABLES = ["store_sales", "customer", "item", "store", "date_dim", "web_sales", "inventory"]
_TAILS = ["", "", ";", " -- fin", " /* fin */", " WHERE accion = 'update'", "", "",
          " WHERE causes = 'reuse'", " JOIN tpcds_parquet.reason", ""]
STATEMENT_TEXTS = f"""
SELECT id,
       CASE WHEN id % 13 = 12 THEN '   '
            ELSE concat({pick('id', _HEADS)}, ' ''', replace(text, '''', ' '), ''' AS nota FROM ',
                        {pick('id', ['tpcds_parquet.'] * 4 + [''])}, {pick('id', _TABLES)},
                        {pick('id', _TAILS)})
       END AS sql
FROM ({TEXTS.strip()})
"""

# approved statements laid out differently, some of them with the row's text after it
SQL_TEXTS = f"""
SELECT id,
       concat(replace({pick('id', list(STATEMENTS.values()))}, ' ',
                      CASE id % 3 WHEN 0 THEN ' ' WHEN 1 THEN concat(chr(10), '  ')
                                  ELSE chr(9) END),
              CASE WHEN id % 5 = 4 THEN concat(' ', text) ELSE '  ' END) AS sql
FROM ({TEXTS.strip()})
"""

ANSWERS = f"""
SELECT id,
       CASE id % 8
         WHEN 0 THEN concat('```sql', chr(10), text, chr(10), '```')
         WHEN 1 THEN concat('```', chr(13), chr(10), text)
         WHEN 2 THEN concat(text, ';')
         WHEN 3 THEN concat('  ', text, ' ; ;', chr(10))
         WHEN 4 THEN concat('```', text, '```')
         WHEN 5 THEN concat(chr(10), '```sql', chr(10), text, ';;', chr(10), '```  ')
         WHEN 6 THEN concat('x ```', text)
         ELSE '```' END AS respuesta
FROM ({TEXTS.strip()})
"""

_KINDS = ["catalogo", "Dinámica", "no_analitica", "otra", "dinamica"]
_ENGINES = ["hive", "Spark", "presto", "spark"]
_BODY = "translate(text, concat(chr(92), chr(34), chr(10), chr(13), chr(9)), '     ')"
PLANS = f"""
SELECT id,
       CASE WHEN id % 11 = 10 THEN text
            WHEN id % 17 = 16 THEN '[1, 2]'
            ELSE concat(CASE WHEN id % 6 = 1 THEN concat('```json', chr(10)) ELSE '' END,
                        '{{{{"tipo":"', {pick('id', _KINDS)},
                        '","intencion":"', {pick('id', [*STATEMENTS, 'Ventas por MES', 'x', 'otra'])},
                        '","sql":', CASE WHEN id % 7 = 0 THEN 'null' ELSE concat(
                            '"SELECT ''', replace({_BODY}, '''', ' '),
                            ''' FROM tpcds_parquet.', {pick('id', _TABLES)}, '"') END,
                        ',"motor":"', {pick('id', _ENGINES)}, '"}}}}',
                        CASE WHEN id % 6 = 1 THEN concat(chr(10), '```') ELSE '' END)
       END AS respuesta
FROM ({TEXTS.strip()})
"""

# questions with a plan, but for every third
REQUESTS = f"""
SELECT q.id, pregunta, modo, CASE WHEN q.id % 3 <> 0 THEN respuesta END AS respuesta
FROM ({QUESTIONS.strip()}) q JOIN ({PLANS.strip()}) p ON q.id = p.id
"""

LOGS = """
SELECT event_id,
       concat('INFO ', event_type,
              CASE WHEN event_id % 3 > 0 THEN concat(' application_', user_id, '_', event_id)
                   ELSE ' application_' END,
              CASE WHEN event_id % 3 = 2 THEN concat(' killed application_9_', user_id, ' x')
                   ELSE ' done' END, props) AS linea
FROM {events}
"""

NUMBER_TEXTS = """
SELECT event_id,
       CASE event_id % 8
         WHEN 0 THEN CAST(value AS VARCHAR(40))
         WHEN 1 THEN concat('  ', CAST(value AS VARCHAR(40)), ' ')
         WHEN 2 THEN concat('1_', CAST(event_id AS VARCHAR(40)))
         WHEN 3 THEN event_type
         WHEN 4 THEN concat('-', CAST(user_id AS VARCHAR(40)), 'e2')
         WHEN 5 THEN concat(CAST(user_id AS VARCHAR(40)), 'd')
         WHEN 6 THEN concat('.', CAST(user_id AS VARCHAR(40)))
         ELSE concat('_', CAST(event_id AS VARCHAR(40))) END AS texto
FROM {events}
"""

AMOUNTS = """
SELECT l_orderkey, l_linenumber, l_extendedprice,
       l_extendedprice * l_discount - 1000 * l_tax AS margen,
       CAST(l_quantity AS DOUBLE) + l_discount / 20 AS casi
FROM {lineitem}
"""

MONTHS = """
SELECT o_orderkey, CAST(month(o_orderdate) AS INT) AS numero,
       concat(' ', substr(o_orderpriority, 1, 1), ' ') AS digito, o_orderpriority AS palabra
FROM {orders}
"""

RUNS = f"""
SELECT CASE WHEN event_type = 'signup' THEN concat('sola ', event_id)
            ELSE concat('consulta ', CAST(floor(event_id / 2) AS BIGINT)) END AS nombre,
       {pick('CAST(floor(event_id / 2) AS BIGINT)', [*STATEMENTS.values(), 'SELECT 1'])} AS sql,
       CASE event_id % 2 WHEN 0 THEN 'hive' ELSE 'spark' END AS motor,
       CASE WHEN event_id % 10 = 7 THEN 0.001 ELSE value END AS tiempo,
       value / 7 AS cpu, value * 3.3 AS mem, user_id AS filas
FROM {{events}}
"""

# one executor per line: the run is the order, the lines of flag N are the snapshot after
EXECUTORS = """
SELECT l_orderkey AS run_id,
       CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS snapshot,
       CAST(floor(l_extendedprice) AS BIGINT) AS total_duration,
       CASE WHEN l_linenumber = 1 THEN 0 ELSE l_linenumber END AS total_cores,
       CAST(floor(l_quantity * 1000003) AS BIGINT) AS memory_used,
       CASE WHEN l_linestatus = 'F' THEN CAST(floor(l_extendedprice * 1001) AS BIGINT) END AS heap,
       CASE WHEN l_linestatus = 'F' AND l_returnflag <> 'R' THEN l_partkey * 1009 END AS off_heap
FROM {lineitem}
"""
RUN_TIMES = """
SELECT o_orderkey AS run_id,
       CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE o_totalprice / 1000 END AS elapsed_s
FROM {orders}
"""
APPLICATIONS = """
SELECT o_orderkey AS run_id,
       CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE CAST(floor(o_totalprice) AS BIGINT) END
           AS elapsed_ms,
       o_custkey * 517 AS memory_seconds,
       o_custkey % 900 AS vcore_seconds,
       o_custkey % 5 AS total_cores
FROM {orders}
"""
