"""Reference SQL for each registered query, written over the given tables alone.

The star is spelled out again here, with decimals where the Spark side counts cents and
with plain joins where it totals first. Money is shown as double.
"""

from __future__ import annotations

from checks import inputs
from checks.inputs import literal, plain_sql
from checks.queries import LAYERS
from mostrador.functions.numbers import MONTHS
from mostrador.functions.rules import ENGINE_RULES, FALLBACK_RULES, INTENT_RULES, UNSAFE_WORDS
from mostrador.operators.audit import BANNED
from mostrador.plans.catalog import CATALOG
from mostrador.plans.statements import STATEMENTS
from checks.inputs import SUITE_QUESTIONS
from mostrador.plans.suite import MANUAL_RUNS

# --- star -----------------------------------------------------------------------------

_PAID = (
    "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) "
    "* (CAST(1 AS DECIMAL(3,2)) - CAST(l_discount AS DECIMAL(3,2))) AS DECIMAL(12,2))"
)


def star(gaps: bool = False) -> str:
    paid = f"CASE WHEN l_returnflag <> 'R' THEN {_PAID} END" if gaps else _PAID
    customer = "CASE WHEN o_orderstatus <> 'P' THEN o_custkey END" if gaps else "o_custkey"
    first = "split_part(c_name, '#', 1)"
    first = f"CASE WHEN c_mktsegment <> 'MACHINERY' THEN {first} END" if gaps else first
    product = "CASE WHEN p_size <= 30 THEN p_name END" if gaps else "p_name"
    return f"""WITH sales AS (
  SELECT l_partkey AS item_sk, l_suppkey AS store_sk, {customer} AS customer_sk,
         CAST(o_orderdate AS DATE) AS sold, CAST(l_quantity AS INT) AS quantity,
         {paid} AS paid,
         -CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(3,2))
               AS DECIMAL(12,2)) AS profit
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
), customers AS (
  SELECT c_custkey AS c_customer_sk, 'C' || c_custkey AS c_customer_id,
         {first} AS c_first_name, split_part(c_name, '#', 2) AS c_last_name
  FROM customer
), items AS (
  SELECT p_partkey AS i_item_sk, 'I' || (p_partkey // 2) AS i_item_id,
         p_type || ' ' || p_size AS i_item_desc, {product} AS i_product_name,
         p_type AS i_category, p_brand AS i_brand
  FROM part
), stores AS (
  SELECT s_suppkey AS s_store_sk, 'S' || (s_suppkey // 2) AS s_store_id,
         s_name AS s_store_name, n_name AS s_city, r_name AS s_state, n_name AS s_country
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
)
"""


STAR, STAR_WITH_GAPS = star(), star(gaps=True)
_CLIENT = "coalesce(c_first_name, '') || ' ' || coalesce(c_last_name, '') AS cliente"
_CUSTOMER_KEYS = "c_customer_sk, c_customer_id, c_first_name, c_last_name"
_FROM_CUSTOMERS = "FROM sales JOIN customers ON customer_sk = c_customer_sk"
_FROM_STORES = "FROM sales JOIN stores ON store_sk = s_store_sk"
_FROM_ITEMS = "FROM sales JOIN items ON item_sk = i_item_sk"
_PAID_SUM = "sum(coalesce(paid, 0))"


def money(expression: str, name: str) -> str:
    return f"CAST({expression} AS DOUBLE) AS {name}"


def by_lines(cte: str) -> str:
    return f"""{cte} SELECT c_customer_sk, c_customer_id, {_CLIENT},
       CAST(count(*) AS BIGINT) AS numero_compras
{_FROM_CUSTOMERS} GROUP BY {_CUSTOMER_KEYS}
ORDER BY numero_compras DESC, c_customer_sk LIMIT 20"""


def by_store() -> str:
    keys = "s_store_sk, s_store_id, s_store_name, s_city, s_country"
    return (
        f"{STAR} SELECT {keys}, {money(_PAID_SUM, 'ventas_totales')} {_FROM_STORES} "
        f"GROUP BY {keys}"
    )


def by_month(cte: str, name: str = "ventas_totales") -> str:
    return f"""{cte} SELECT CAST(year(sold) AS INT) AS anio, CAST(month(sold) AS INT) AS mes,
       {money(_PAID_SUM, name)}
FROM sales WHERE sold IS NOT NULL GROUP BY 1, 2"""


def average(cte: str) -> str:
    # the mean to six digits, half up, in whole numbers: exact where a double is not
    mean = "(2 * CAST(total * 100 AS HUGEINT) * 10000 + numero_compras) // (2 * numero_compras)"
    return f"""{cte}, spent AS (
  SELECT c_customer_sk, c_customer_id, {_CLIENT}, count(*) AS numero_compras, {_PAID_SUM} AS total
  {_FROM_CUSTOMERS} GROUP BY {_CUSTOMER_KEYS})
SELECT c_customer_sk, c_customer_id, cliente, CAST(numero_compras AS BIGINT) AS numero_compras,
       {money('total', 'gasto_total')}, CAST({mean} AS DOUBLE) / 1000000 AS ticket_promedio
FROM spent ORDER BY ticket_promedio DESC, c_customer_sk LIMIT 20"""


def revenue(limit: str = "LIMIT 20") -> str:
    return f"""{STAR} SELECT i_item_sk, i_item_id, coalesce(i_product_name, i_item_desc) AS producto,
       i_category, i_brand, {money(_PAID_SUM, 'ingreso_generado')}
{_FROM_ITEMS} GROUP BY i_item_sk, i_item_id, i_product_name, i_item_desc, i_category, i_brand
ORDER BY {_PAID_SUM} DESC, i_item_sk {limit}"""


def spending(k: int) -> str:
    return f"""{STAR} SELECT c_customer_sk, c_customer_id, {_CLIENT}, {money(_PAID_SUM, 'gasto_total')}
{_FROM_CUSTOMERS} GROUP BY {_CUSTOMER_KEYS}
ORDER BY {_PAID_SUM} DESC, c_customer_sk LIMIT {k}"""


RANKING = f"""{STAR}, monthly AS (
  SELECT CAST(year(sold) AS INT) AS anio, CAST(month(sold) AS INT) AS mes,
         s_store_id, s_store_name, {_PAID_SUM} AS total
  {_FROM_STORES} WHERE sold IS NOT NULL GROUP BY 1, 2, 3, 4),
ranked AS (SELECT *, rank() OVER (PARTITION BY anio, mes ORDER BY total DESC) AS r FROM monthly)
SELECT anio, mes, s_store_id, s_store_name, {money('total', 'ventas_totales')},
       CAST(r AS INT) AS ranking_mensual
FROM ranked WHERE r <= 10"""

PRODUCTS_PER_STORE = f"""{STAR}, per_product AS (
  SELECT s_store_id, s_store_name, i_item_id, coalesce(i_product_name, i_item_desc) AS producto,
         CAST(sum(coalesce(quantity, 0)) AS BIGINT) AS cantidad_vendida
  FROM sales JOIN stores ON store_sk = s_store_sk JOIN items ON item_sk = i_item_sk
  GROUP BY s_store_id, s_store_name, i_item_id, i_product_name, i_item_desc),
ranked AS (SELECT *, CAST(row_number() OVER (
    PARTITION BY s_store_id
    ORDER BY cantidad_vendida DESC, i_item_id, producto, s_store_name) AS INT) AS ranking
  FROM per_product)
SELECT * FROM ranked WHERE ranking <= 10"""


def units(cte: str) -> str:
    return f"""{cte} SELECT i_item_id, coalesce(i_product_name, i_item_desc) AS producto,
       CAST(sum(coalesce(quantity, 0)) AS BIGINT) AS cantidad_vendida
{_FROM_ITEMS} GROUP BY i_item_id, i_product_name, i_item_desc
ORDER BY cantidad_vendida DESC, i_item_id, producto LIMIT 5"""


def counts(rows: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {literal(table)} AS tabla, CAST(({sql}) AS BIGINT) AS filas"
        for table, sql in rows.items()
    )


# the calendar has a fixed length
STAR_COUNTS = {
    "customer": "SELECT count(*) FROM customer",
    "item": "SELECT count(*) FROM part",
    "store": "SELECT count(*) FROM supplier",
    "date_dim": "SELECT 73049",
    "store_sales": "SELECT count(*) FROM lineitem",
}

# --- text -----------------------------------------------------------------------------

_STRIP = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def normalized(text: str) -> str:
    return f"trim(regexp_replace(strip_accents(lower({text})), '[^a-z0-9]+', ' ', 'g'))"


def stripped(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '^{_STRIP}+', ''), '{_STRIP}+$', '')"


def unfenced(text: str) -> str:
    lines = f"regexp_split_to_array({stripped(text)}, '{_ENDS}')"
    body = f"""(SELECT CASE WHEN len(b) > 0 AND starts_with(b[-1], '```')
                       THEN array_to_string(b[:-2], chr(10)) ELSE array_to_string(b, chr(10)) END
                FROM (SELECT {lines}[2:] AS b))"""
    inner = (
        f"CASE WHEN starts_with({stripped(text)}, '```') THEN {body} ELSE {stripped(text)} END"
    )
    return stripped(f"rtrim({stripped(inner)}, ';')")


def first_rule(rules, text: str = "norm") -> str:
    def group(words) -> str:
        return "(" + " OR ".join(f"contains({text}, {literal(w)})" for w in words) + ")"

    cases = " ".join(
        f"WHEN {' AND '.join(map(group, groups))} THEN {literal(name)}" for name, groups in rules
    )
    return f"CASE {cases} END"


_UNSAFE = " OR ".join(f"contains(' ' || norm || ' ', ' {word} ')" for word in UNSAFE_WORDS)
_HEAVY = ", ".join(literal(name) for name, entry in CATALOG.items() if entry.heavy)


def engine_class(intent: str) -> str:
    return f"CASE WHEN {intent} IN ({_HEAVY}) THEN 'spark' WHEN {intent} IS NOT NULL THEN 'hive' END"


def questions(columns: str, source: str = inputs.QUESTIONS) -> str:
    # materialised, or the text would be normalised again for every word looked up
    return (
        f"WITH normed AS MATERIALIZED (SELECT *, {normalized('pregunta')} AS norm "
        f"FROM ({plain_sql(source)})) SELECT {columns} FROM normed"
    )


ROUTED = f"""WITH asked AS MATERIALIZED (
  {questions(f"*, {first_rule(INTENT_RULES)} AS rule, {first_rule(ENGINE_RULES)} AS tag, "
             f"({_UNSAFE}) AS unsafe, {normalized('modo')} AS m")}
),
judged AS (SELECT *, CASE WHEN m IS NULL OR m NOT IN ('auto', 'hive', 'spark', 'both') THEN 'unknown_mode'
                          WHEN unsafe THEN 'unsafe_question'
                          WHEN rule IS NULL THEN 'unknown_intent' END AS error FROM asked)
SELECT id, CASE WHEN error IS NULL THEN rule END AS intencion,
       CASE WHEN error IS NOT NULL THEN NULL WHEN m <> 'auto' THEN m
            ELSE coalesce(tag, {engine_class('rule')}) END AS motor, error
FROM judged"""

USAGE = f"""WITH asked AS MATERIALIZED ({questions(f"{first_rule(INTENT_RULES)} AS rule, ({_UNSAFE}) AS unsafe")}),
listed AS (SELECT unnest([{', '.join(map(literal, CATALOG))}]) AS intencion)
SELECT intencion, {engine_class('intencion')} AS clase,
       CAST(count(rule) AS BIGINT) AS preguntas
FROM listed LEFT JOIN asked ON rule = intencion AND NOT unsafe GROUP BY intencion"""

_ALLOWED = "['customer', 'item', 'store', 'date_dim', 'store_sales']"


def audit_code(statement: str) -> str:
    """A scalar CASE over one statement; the statement is trimmed in a subquery."""
    banned = rf"(^|[^\p{{L}}\p{{N}}_])({'|'.join(BANNED)})([^\p{{L}}\p{{N}}_]|$)"
    names = r"regexp_extract_all(s, 'tpcds_parquet\.([a-zA-Z_][a-zA-Z0-9_]*)', 1)"
    return f"""(SELECT CASE WHEN s IS NULL OR s = '' THEN 'empty'
       WHEN NOT (starts_with(upper(s), 'SELECT') OR starts_with(upper(s), 'WITH'))
         THEN 'not_select'
       WHEN contains(s, ';') THEN 'several_statements'
       WHEN contains(s, '--') OR contains(s, '/*') THEN 'comment'
       WHEN regexp_matches(upper(s), '{banned}') THEN 'banned_word'
       WHEN NOT contains(s, 'tpcds_parquet.') THEN 'no_star_table'
       WHEN len([n FOR n IN {names} IF NOT list_contains({_ALLOWED}, n)]) > 0
         THEN 'foreign_table' END
FROM (SELECT {stripped(statement)} AS s))"""


APPROVED = ", ".join(f"({literal(name)}, {literal(sql)})" for name, sql in STATEMENTS.items())


def one_line(text: str) -> str:
    return f"trim(regexp_replace({text}, '{_STRIP}+', ' ', 'g'))"


MATCHED = f"""WITH approved(intencion, approved_sql) AS (VALUES {APPROVED})
SELECT id, intencion FROM (SELECT id, {one_line('sql')} AS line FROM ({plain_sql(inputs.SQL_TEXTS)}))
LEFT JOIN approved ON line = {one_line('approved_sql')}"""

_PLAN_FIELDS = ("tipo", "intencion", "sql", "motor")
PARSED = f"""SELECT id, {', '.join(f"CASE WHEN legible THEN json_extract_string(j, '$.{f}') END AS {f}"
                                   for f in _PLAN_FIELDS)}, legible
FROM (SELECT id, j, coalesce(json_valid(j) AND json_type(CASE WHEN json_valid(j) THEN j END)
                             = 'OBJECT', FALSE) AS legible
      FROM (SELECT id, {unfenced('respuesta')} AS j FROM ({plain_sql(inputs.PLANS)})))"""

RESOLVED = f"""WITH approved(approved, approved_sql) AS (VALUES {APPROVED}),
plans AS (SELECT id, legible, coalesce(sql, 'None') AS own,
                 replace({normalized("coalesce(tipo, '')")}, ' ', '_') AS kind,
                 {normalized("coalesce(motor, '')")} AS engine,
                 replace({normalized("coalesce(intencion, '')")}, ' ', '_') AS name
          FROM ({PARSED})),
judged AS (SELECT *, {unfenced('own')} AS own_sql,
  CASE WHEN NOT legible THEN 'not_json'
       WHEN kind = 'no_analitica' THEN 'not_analytic'
       WHEN engine NOT IN ('hive', 'spark') THEN 'unknown_engine'
       WHEN kind = 'catalogo' THEN CASE WHEN approved IS NULL THEN 'unknown_intent' END
       WHEN kind = 'dinamica' THEN 'sql_' || {audit_code(unfenced('own'))}
       ELSE 'unknown_kind' END AS error
  FROM plans LEFT JOIN approved ON approved = name)
SELECT id, CASE WHEN error IS NULL THEN
              CASE WHEN kind = 'catalogo' THEN approved_sql ELSE own_sql END END AS sentencia,
       CASE WHEN error IS NULL THEN engine END AS motor, error
FROM judged"""

_ASKED = questions(
    f"id, {first_rule(INTENT_RULES)} AS rule, {first_rule(ENGINE_RULES)} AS tag, "
    f"({_UNSAFE}) AS unsafe, {normalized('modo')} AS m"
)
REQUESTED = f"""WITH approved(n, approved_sql) AS (VALUES {APPROVED}),
asked AS MATERIALIZED ({_ASKED}), planned AS MATERIALIZED ({RESOLVED}),
both_kinds AS (SELECT a.id, m, tag, CASE WHEN a.id % 3 = 0 THEN approved_sql ELSE sentencia END AS s,
    CASE WHEN a.id % 3 = 0 THEN {engine_class('rule')} ELSE motor END AS own,
    CASE WHEN m IS NULL OR m NOT IN ('auto', 'hive', 'spark', 'both') THEN 'unknown_mode'
         WHEN unsafe THEN 'unsafe_question'
         WHEN a.id % 3 = 0 THEN CASE WHEN rule IS NULL THEN 'unknown_intent' END
         ELSE error END AS e
  FROM asked a JOIN planned USING (id) LEFT JOIN approved ON rule = n)
SELECT id, CASE WHEN e IS NULL THEN s END AS sentencia,
       CASE WHEN e IS NOT NULL THEN NULL WHEN m <> 'auto' THEN m ELSE coalesce(tag, own) END AS motor,
       e AS error FROM both_kinds"""

# --- numbers and shaping --------------------------------------------------------------


def amount(x: str) -> str:
    return f"""CASE WHEN abs({x} - trunc({x})) < 0.005
       THEN replace(format('{{:,}}', CAST(trunc({x}) AS BIGINT)), ',', ' ')
       ELSE replace(format('{{:,.2f}}', {x}), ',', ' ') END"""


def rounded(x: str, digits: int) -> str:
    return f"CAST(printf('%.{digits}f', CAST({x} AS DOUBLE)) AS DOUBLE)"


_MONTH_NAMES = ", ".join(literal(name) for name in MONTHS)


def month_name(month: str) -> str:
    return f"[{_MONTH_NAMES}][{month}]"


_FLOAT = r"^\s*[+-]?([0-9](_?[0-9])*\.?([0-9](_?[0-9])*)?|\.[0-9](_?[0-9])*)(e[+-]?[0-9]+)?\s*$"
SHOWN_STORES = f"""SELECT s_store_name AS label, ventas_totales AS value,
       {amount('ventas_totales')} AS fmt,
       row_number() OVER (ORDER BY ventas_totales DESC, s_store_sk) AS pos FROM ({by_store()})"""
SHOWN_MONTHS = f"""SELECT {month_name('mes')} AS label, ventas_totales AS value,
       {amount('ventas_totales')} AS fmt, row_number() OVER (ORDER BY anio, mes) AS pos
FROM ({by_month(STAR)})"""
SHOWN_PRODUCTS = f"""SELECT producto AS label, ingreso_generado AS value,
       {amount('ingreso_generado')} AS fmt,
       row_number() OVER (ORDER BY ingreso_generado DESC, i_item_sk) AS pos FROM ({revenue()})"""

SHOWN_BEST_MONTH = f"""SELECT {month_name('mes')} AS label, {amount('ingresos_totales')} AS fmt,
       1 AS pos
FROM ({by_month(STAR, 'ingresos_totales')}) ORDER BY ingresos_totales DESC, anio, mes LIMIT 1"""

ANSWER_ROWS = f"""SELECT first_value(ventas) OVER (ORDER BY pos) AS "heroValue",
       CAST(count(*) OVER () AS BIGINT) AS matched, 'ranking_mensual_ventas' AS sql, 8 AS puntos,
       CAST(pos - 1 AS INT) AS pos, tienda, ventas
FROM (SELECT s_store_name AS tienda, {amount('ventas_totales')} AS ventas,
             row_number() OVER (
               ORDER BY anio, mes, ranking_mensual, s_store_id, s_store_name) AS pos
      FROM ({RANKING}))"""


ORDER_ROWS = """SELECT row_number() OVER (ORDER BY n DESC, l_orderkey) AS pos,
       'P' || l_orderkey AS pedido, CAST(n AS VARCHAR) AS lineas
FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey)"""


def chart(shown: str) -> str:
    return f'SELECT CAST(pos AS INT) AS pos, label, value, fmt AS "valueFmt" FROM ({shown}) WHERE pos <= 8'


def headline(shown: str, metric: str, label: str) -> str:
    return f"""SELECT fmt AS "heroValue", '{metric}' AS "heroUnit",
       label || ' - valor principal' AS "heroLabel",
       'La consulta devolvio ' || n || ' filas. El valor principal corresponde a ' || label
         || ', con ' || fmt || ' en {metric}.' AS summary,
       CAST(n AS BIGINT) AS matched, '{metric} por {label}' AS "chartTitle"
FROM (SELECT *, count(*) OVER () AS n FROM ({shown})) WHERE pos = 1"""


HEADLINE_TEXT = """SELECT lang AS "heroValue", '' AS "heroUnit", 'Resultado textual' AS "heroLabel",
       'La consulta devolvio ' || n || ' filas, pero no se detecto una metrica numerica para graficar.'
         AS summary, CAST(n AS BIGINT) AS matched, 'Resultados' AS "chartTitle"
FROM (SELECT lang, source, count(*) OVER () AS n FROM documents GROUP BY lang, source
      ORDER BY lang, source LIMIT 1)"""
HEADLINE_EMPTY = f"""SELECT '-' AS "heroValue", '' AS "heroUnit", 'Sin resultados' AS "heroLabel",
       'La consulta se ejecuto correctamente, pero no devolvio filas.' AS summary,
       CAST(count(*) AS BIGINT) AS matched, 'Sin datos para graficar' AS "chartTitle"
FROM ({by_month(STAR)}) WHERE ventas_totales < 0"""

# --- runs -----------------------------------------------------------------------------

_ENGINE_MEASURES = ", ".join(
    f"{rounded(f'max(CASE WHEN motor = {literal(engine)} THEN {name} END)', 2)} AS {engine}_{kept}"
    for engine in ("hive", "spark")
    for name, kept in (("tiempo", "tiempo_s"), ("cpu", "cpu_pct"), ("mem", "mem_mb"))
)
RECORDS = f"""WITH approved(intencion, approved_sql) AS (VALUES {APPROVED}),
pairs AS (SELECT nombre, sql, {_ENGINE_MEASURES},
                 coalesce(max(CASE WHEN motor = 'hive' THEN filas END),
                          max(CASE WHEN motor = 'spark' THEN filas END)) AS filas,
                 CASE WHEN count(DISTINCT motor) > 1 THEN 'both' ELSE max(motor) END AS motor
          FROM ({plain_sql(inputs.RUNS)}) GROUP BY nombre, sql),
records AS (SELECT nombre, coalesce(intencion, '') AS intencion, motor AS motor_solicitado,
                   motor AS motor_resuelto, CAST(filas AS BIGINT) AS filas,
                   hive_tiempo_s, hive_cpu_pct, hive_mem_mb, spark_tiempo_s, spark_cpu_pct,
                   spark_mem_mb,
                   CASE WHEN hive_tiempo_s <> 0 AND spark_tiempo_s <> 0
                        THEN {rounded('hive_tiempo_s / spark_tiempo_s', 2)} END
                     AS speedup_spark_vs_hive
            FROM pairs LEFT JOIN approved ON {one_line('sql')} = {one_line('approved_sql')})
"""
EXECUTOR_USAGE = f"""WITH per_snapshot AS (
  SELECT run_id, snapshot, sum(total_duration) AS busy, greatest(sum(total_cores), 1) AS cores,
         sum(CASE WHEN heap IS NOT NULL THEN heap + coalesce(off_heap, 0) ELSE memory_used END)
           AS bytes
  FROM ({plain_sql(inputs.EXECUTORS)}) GROUP BY run_id, snapshot)
SELECT t.run_id,
       CASE WHEN a.run_id IS NULL OR b.run_id IS NULL THEN NULL WHEN t.elapsed_s <= 0 THEN 0.0
            ELSE least(100.0, {rounded('((a.busy - b.busy) / (t.elapsed_s * 1000.0 * a.cores)) * 100.0', 1)})
       END AS cpu,
       {rounded('a.bytes / 1048576.0', 1)} AS mem
FROM ({plain_sql(inputs.RUN_TIMES)}) t
JOIN (SELECT DISTINCT run_id FROM per_snapshot) any_run ON any_run.run_id = t.run_id
LEFT JOIN per_snapshot a ON a.run_id = t.run_id AND a.snapshot = 1
LEFT JOIN per_snapshot b ON b.run_id = t.run_id AND b.snapshot = 0"""
APPLICATION_USAGE = f"""SELECT run_id,
       CASE WHEN elapsed_ms > 0 THEN least(100.0,
         {rounded('(vcore_seconds / (elapsed_ms / 1000.0)) / greatest(total_cores, 1) * 100.0', 1)})
       END AS cpu,
       CASE WHEN elapsed_ms > 0 THEN {rounded('memory_seconds / (elapsed_ms / 1000.0)', 1)} END
         AS mem
FROM ({plain_sql(inputs.APPLICATIONS)})"""

# rows of each approved query, for the checks that only count them
CATALOG_SQL = {
    "top_20_clientes_compras": by_lines(STAR),
    "ventas_por_tienda": by_store(),
    "ventas_por_mes": by_month(STAR),
    "ventas_por_dia_semana": f"{STAR} SELECT DISTINCT dayname(sold) FROM sales",
    "top_productos_por_tienda": PRODUCTS_PER_STORE,
    "ticket_promedio_por_cliente": average(STAR),
    "productos_mayor_ingreso": revenue(),
    "top_clientes_gasto_total": spending(20),
    "ranking_mensual_ventas": RANKING,
    "cinco_productos_mas_vendidos": units(STAR),
    "tienda_mayores_ventas": "SELECT 1 FROM lineitem LIMIT 1",
    "mes_mayores_ingresos": "SELECT 1 FROM lineitem LIMIT 1",
    "diez_mejores_clientes": spending(10),
}


def row_count(intent: str) -> str:
    return f"CAST((SELECT count(*) FROM ({CATALOG_SQL[intent]})) AS BIGINT) AS filas"


_SUITE = [("manual", name, intent) for intent, name in MANUAL_RUNS] + [
    ("agentic", name, intent) for _, name, intent in SUITE_QUESTIONS
]
SUITE = " UNION ALL ".join(
    f"SELECT {literal(kind)} AS tipo, {literal(name)} AS nombre, {literal(intent)} AS intencion, "
    f"'spark' AS motor_resuelto, 'ok' AS estado, {row_count(intent)}"
    for kind, name, intent in _SUITE
)
RECONCILED = " UNION ALL ".join(
    f"SELECT {literal(intent)} AS intencion, {row_count(intent)}" for intent in CATALOG_SQL
)


def same_on_both_sides(rows: str, key: str) -> str:
    return (
        f"SELECT {key}, filas AS filas_izquierda, filas AS filas_derecha, "
        f"CAST(0 AS BIGINT) AS solo_izquierda, CAST(0 AS BIGINT) AS solo_derecha FROM ({rows})"
    )



PARITY_FAULTS = """WITH n AS (SELECT count(*) AS filas FROM customer)
SELECT tabla, filas AS filas_texto, filas + mas AS filas_parquet, igual AS coinciden FROM n,
  (VALUES ('igual', 0, TRUE), ('corrida', 0, FALSE), ('cambiada', 0, FALSE), ('doblada', 1, FALSE),
          ('faltante', -1, FALSE)) AS t(tabla, mas, igual)"""

PARITY_ROWS = """WITH c AS (SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS id, '"' || c_name || '"' AS name FROM customer),
f AS (SELECT k, '{"c_custkey":' || id || ',"c_name":' || name || ',"vacia":null}' AS sound,
             '{"c_custkey":' || id || ',"c_name":null,"vacia":' || name || '}' AS moved FROM c)
SELECT 'corrida' AS tabla, sound AS fila, CAST(1 AS BIGINT) AS sobra FROM f
UNION ALL SELECT 'corrida', moved, -1 FROM f
UNION ALL SELECT 'cambiada', sound, 1 FROM f WHERE k = 1
UNION ALL SELECT 'cambiada', '{"c_custkey":1,"c_name":"otro","vacia":null}', -1
UNION ALL SELECT 'doblada', sound, -1 FROM f WHERE k = 1
UNION ALL SELECT 'faltante', sound, 1 FROM f WHERE k = 1"""

YEAR = f"""{STAR} SELECT CAST(month(sold) AS INT) AS mes, s_store_id, s_store_name, {money(_PAID_SUM, 'ventas_totales')}
{_FROM_STORES} WHERE year(sold) = 1995 GROUP BY 1, 2, 3"""

SHOWN_STATES = f"""SELECT estado AS label, {amount('ventas_totales')} AS fmt, row_number() OVER (ORDER BY exact DESC, estado) AS pos
FROM ({STAR} SELECT s_state AS estado, {_PAID_SUM} AS exact, {money(_PAID_SUM, 'ventas_totales')} {_FROM_STORES} GROUP BY s_state)"""
PLANNED = " UNION ALL ".join(
    f"SELECT *, '{engine}' AS motor FROM ({headline(shown, metric, label)})"
    for shown, metric, label, engine in (
        (SHOWN_STATES, "ventas totales", "estado", "hive"),
        (SHOWN_BEST_MONTH, "ingresos totales", "mes", "spark"),
        (SHOWN_STORES, "ventas totales", "tienda", "spark"),
    )
)

ORACLES: dict[str, str] = {
    "q01_top_customers_by_lines": by_lines(STAR),
    "q02_sales_by_store": by_store(),
    "q03_sales_by_month": by_month(STAR),
    "q04_sales_by_weekday": (
        f"{STAR} SELECT dayname(sold) AS dia_semana, {money(_PAID_SUM, 'ventas_totales')} "
        "FROM sales WHERE sold IS NOT NULL GROUP BY 1"
    ),
    "q05_top_products_per_store": PRODUCTS_PER_STORE,
    "q06_average_line_by_customer": average(STAR),
    "q07_products_by_revenue": revenue(),
    "q08_customers_by_spending": spending(20),
    "q09_monthly_store_ranking": RANKING,
    "q10_best_selling_products": units(STAR),
    "q11_best_store": (
        f"{STAR} SELECT s_store_id, s_store_name, {money(_PAID_SUM, 'ventas_totales')} "
        f"{_FROM_STORES} GROUP BY s_store_id, s_store_name "
        f"ORDER BY {_PAID_SUM} DESC, s_store_id, s_store_name LIMIT 1"
    ),
    "q12_best_month": (
        f"SELECT * FROM ({by_month(STAR, 'ingresos_totales')}) "
        "ORDER BY ingresos_totales DESC, anio, mes LIMIT 1"
    ),
    "q13_best_customers": spending(10),
    "q14_profit_by_state": (
        f"{STAR} SELECT s_state, {money('sum(coalesce(profit, 0))', 'utilidad_total')} "
        f"{_FROM_STORES} GROUP BY s_state"
    ),
    "ranking_spread": RANKING,
    "q15_table_counts": counts(STAR_COUNTS),
    "null_key_join": by_lines(STAR_WITH_GAPS),
    "null_sum": by_month(STAR_WITH_GAPS),
    "null_average": average(STAR_WITH_GAPS),
    "name_fallback": units(STAR_WITH_GAPS),
    "item_id_vs_sk": (
        f"{STAR} SELECT i_item_id, CAST(count(DISTINCT i_item_sk) AS BIGINT) AS versiones, "
        f"{money(_PAID_SUM, 'ingreso_generado')} {_FROM_ITEMS} GROUP BY i_item_id"
    ),
    "topn_row_number": (
        "SELECT * FROM (SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS fecha, "
        "CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) "
        "AS INT) AS ranking FROM orders) WHERE ranking <= 3"
    ),
    "topn_rank_ties": (
        "SELECT l_suppkey, l_quantity, ranking, CAST(count(*) AS BIGINT) AS filas "
        "FROM (SELECT l_suppkey, l_quantity, CAST(rank() OVER (PARTITION BY l_suppkey "
        "ORDER BY l_quantity DESC) AS INT) AS ranking FROM lineitem) WHERE ranking <= 10 "
        "GROUP BY ALL"
    ),
    "norm_text": f"SELECT id, {normalized('text')} AS norm FROM ({plain_sql(inputs.TEXTS)})",
    "norm_key": (
        f"SELECT id, replace({normalized('text')}, ' ', '_') AS clave "
        f"FROM ({plain_sql(inputs.TEXTS)})"
    ),
    "route_intent": questions(f"id, {first_rule(INTENT_RULES)} AS intencion"),
    "route_fallback": questions(f"id, {first_rule(FALLBACK_RULES)} AS intencion"),
    "tag_preference": questions(f"id, {first_rule(ENGINE_RULES)} AS motor"),
    "screen_unsafe": questions(f"id, CAST(({_UNSAFE}) AS INT) AS insegura"),
    "route_questions": ROUTED,
    "resolve_mode": (
        "SELECT id, modo, CASE WHEN modo <> 'auto' THEN modo ELSE coalesce(tag, 'hive') END AS motor "
        "FROM (SELECT id, tag, CASE WHEN c IN ('ambos', '') THEN 'both' "
        "WHEN c IN ('auto', 'hive', 'spark', 'both') THEN c ELSE 'auto' END AS modo FROM ("
        + questions(f"id, {first_rule(ENGINE_RULES)} AS tag, lower(trim(campo)) AS c")
        + "))"
    ),
    "route_quality": (
        "SELECT esperada, CAST(count(*) AS BIGINT) AS preguntas, "
        "CAST(sum(hit) AS BIGINT) AS aciertos, sum(hit) / count(*) AS acierto FROM ("
        + questions(
            f"esperada, CAST(coalesce({first_rule(INTENT_RULES)} = esperada, FALSE) AS INT) AS hit",
            inputs.LABELLED_QUESTIONS,
        )
        + ") GROUP BY esperada"
    ),
    "route_confusion": (
        "SELECT esperada, obtenida, CAST(count(*) AS BIGINT) AS preguntas FROM ("
        + questions(
            f"esperada, coalesce({first_rule(INTENT_RULES)}, 'ninguna') AS obtenida",
            inputs.LABELLED_QUESTIONS,
        )
        + ") GROUP BY esperada, obtenida"
    ),
    "catalog_usage": USAGE,
    "workload_class": (
        f"SELECT id, intencion, {engine_class('intencion')} AS clase FROM ("
        + questions(
            f"id, coalesce({first_rule(INTENT_RULES)}, {first_rule(FALLBACK_RULES)}) AS intencion"
        )
        + ")"
    ),
    "audit_sql": (
        f"SELECT id, {audit_code('sql')} AS codigo FROM ({plain_sql(inputs.STATEMENT_TEXTS)})"
    ),
    "match_catalog": MATCHED,
    "strip_fence": (
        f"SELECT id, {unfenced('respuesta')} AS texto FROM ({plain_sql(inputs.ANSWERS)})"
    ),
    "parse_plan": PARSED,
    "plan_resolve": RESOLVED,
    "resolve_requests": REQUESTED,
    "log_last_match": (
        r"SELECT event_id, regexp_extract_all(linea, 'application_\d+_\d+')[-1] AS trabajo "
        f"FROM ({plain_sql(inputs.LOGS)})"
    ),
    "to_number": (
        f"SELECT event_id, CASE WHEN regexp_matches(texto, '{_FLOAT}') "
        "THEN CAST(replace(trim(texto), '_', '') AS DOUBLE) ELSE 0.0 END AS numero "
        f"FROM ({plain_sql(inputs.NUMBER_TEXTS)})"
    ),
    "format_number": (
        "SELECT l_orderkey, l_linenumber, "
        + ", ".join(
            f"{amount(name)} AS {name}_texto" for name in ("l_extendedprice", "margen", "casi")
        )
        + f" FROM ({plain_sql(inputs.AMOUNTS)})"
    ),
    "month_label": (
        f"SELECT o_orderkey, {month_name('numero')} AS numero, "
        f"coalesce({month_name('CAST(trim(digito) AS INT)')}, digito) AS digito, palabra "
        f"FROM ({plain_sql(inputs.MONTHS)})"
    ),
    "result_shape_store": f'SELECT label AS tienda, fmt AS "ventas totales" FROM ({SHOWN_STORES})',
    "result_shape_month": f'SELECT label AS mes, fmt AS "ventas totales" FROM ({SHOWN_MONTHS})',
    "result_shape_ranking": (
        f'SELECT s_store_name AS tienda, {amount("ventas_totales")} AS "ventas totales" '
        f"FROM ({RANKING})"
    ),
    "chart_store": chart(SHOWN_STORES),
    "chart_month": chart(SHOWN_MONTHS),
    "headline_month": headline(SHOWN_MONTHS, "ventas totales", "mes"),
    "headline_products": headline(SHOWN_PRODUCTS, "ingreso generado", "producto"),
    "ask_best_month": headline(SHOWN_BEST_MONTH, "ingresos totales", "mes"),
    "answer_json": ANSWER_ROWS,
    "answer_rows": ORDER_ROWS,
    "answer_rows_own_order": ORDER_ROWS,
    "headline_empty": HEADLINE_EMPTY,
    "headline_text": HEADLINE_TEXT,
    "text_roundtrip": same_on_both_sides(counts(STAR_COUNTS), "tabla"),
    "convert_status": (
        f"SELECT tabla, 'ok' AS estado, filas FROM ({counts(STAR_COUNTS)}) "
        "UNION ALL SELECT 'web_page', 'omitida', NULL"
    ),
    "damaged_lines": (
        "SELECT 'clientes' AS tabla, 'ok' AS estado, count(*) AS filas, "
        "count(*) FILTER (c_custkey % 7 IN (4, 5, 6)) AS ilegibles, "
        "count(*) FILTER (c_custkey % 7 IN (2, 6)) AS cortas, "
        "count(*) FILTER (c_custkey % 7 = 3) AS largas FROM customer"
    ),
    "register_counts": (
        f"SELECT tabla, filas, unnest([{', '.join(map(literal, LAYERS))}]) AS capa "
        f"FROM ({counts(STAR_COUNTS)})"
    ),
    "raw_vs_parquet": (
        "SELECT tabla, filas AS filas_texto, filas AS filas_parquet, TRUE AS coinciden "
        f"FROM ({counts(STAR_COUNTS)})"
    ),
    "parity_faults": PARITY_FAULTS,
    "parity_rows": PARITY_ROWS,
    "year_by_day": YEAR,
    "saved_star_by_month": by_month(STAR),
    "tab_result": (
        "SELECT CAST(s_store_sk AS VARCHAR) AS s_store_sk, s_store_id, s_store_name, s_city, "
        "s_country, printf('%.2f', ventas_totales) AS ventas_totales "
        f"FROM ({by_store()})"
    ),
    "adhoc_profit": (
        f"{STAR} SELECT s_store_name AS nombre, {money('min(profit)', 'peor')}, "
        f"count(profit) AS lineas {_FROM_STORES} WHERE profit < 0 GROUP BY s_store_sk, s_store_name"
    ),
    "reconcile_sql_df": same_on_both_sides(RECONCILED, "intencion"),
    "planned_answers": PLANNED,
    "suite_run": SUITE,
    "suite_usage": f"SELECT nombre, TRUE AS con_tiempo, TRUE AS con_cpu, TRUE AS con_memoria FROM ({SUITE})",
    "run_records": f"{RECORDS} SELECT * FROM records",
    "records_in_csv": (
        f"{RECORDS} SELECT count(*) AS filas_izquierda, count(*) AS filas_derecha, "
        "CAST(0 AS BIGINT) AS solo_izquierda, CAST(0 AS BIGINT) AS solo_derecha FROM records"
    ),
    "runs_speedup": (
        f"{RECORDS} SELECT nombre, intencion, hive_tiempo_s, spark_tiempo_s, "
        "speedup_spark_vs_hive FROM records"
    ),
    "executor_usage": EXECUTOR_USAGE,
    "application_usage": APPLICATION_USAGE,
}
