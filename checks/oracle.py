"""SQL for DuckDB that answers the registered queries independently."""

from __future__ import annotations

from checks.adapters import CATALOGUE

HOUR, DAY = 3_600_000, 86_400_000


def _complete(*columns: str) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in columns)


C_COLUMNS = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
O_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
             "o_orderpriority")
L_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
             "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
             "l_shipdate")

MONEY = "DECIMAL(15,2)"
PRICE = f"CAST(l_extendedprice AS {MONEY})"
REBATE = f"(1 - CAST(l_discount AS {MONEY}))"
SURTAX = f"(1 + CAST(l_tax AS {MONEY}))"
NET = f"{PRICE} * {REBATE}"
GROSS = f"{NET} * {SURTAX}"
ROW_NET = f"CAST(extended_price AS {MONEY}) * (1 - CAST(discount AS {MONEY}))"


def _cents(amount: str) -> str:
    return f"CAST(ROUND({amount}, 2) AS DOUBLE)"


BASE = f"""
WITH c AS (SELECT c_custkey AS customer_id, c_name AS name, c_nationkey AS nation_key,
                  c_acctbal, c_mktsegment
           FROM customer WHERE {_complete(*C_COLUMNS)}),
     o AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
                  o_totalprice AS total_price, CAST(o_orderdate AS DATE) AS order_date,
                  o_orderpriority
           FROM orders WHERE {_complete(*O_COLUMNS)}),
     l AS (SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_quantity AS quantity,
                  l_extendedprice AS extended_price, l_discount AS discount, l_tax AS tax,
                  l_returnflag AS return_flag, l_linestatus AS line_status,
                  CAST(l_shipdate AS DATE) AS ship_date,
                  CAST(l_shipdate AS DATE) - l_linenumber AS commit_date,
                  CAST(l_shipdate AS DATE) + l_linenumber AS receipt_date
           FROM lineitem WHERE {_complete(*L_COLUMNS)}),
     e AS (SELECT r_regionkey AS region_key, c.nation_key, c.customer_id, c.name, c.c_acctbal,
                  c.c_mktsegment, o.order_id, o.status, o.total_price, o.order_date,
                  o.o_orderpriority, l.line_number, l.quantity, l.extended_price, l.discount,
                  l.tax, l.return_flag, l.line_status, l.ship_date, l.commit_date,
                  l.receipt_date, n_name AS nation_name, r_name AS region_name
           FROM c LEFT JOIN o ON o.customer_id = c.customer_id
                  LEFT JOIN l ON l.order_id = o.order_id
                  LEFT JOIN nation ON n_nationkey = c.nation_key
                  LEFT JOIN region ON r_regionkey = n_regionkey)"""

WIDE = BASE + f""",
     v AS (SELECT customer_id, order_id, name, nation_name AS nation,
                  region_name AS region, status, CAST(total_price AS {MONEY}) AS total_price,
                  order_date, line_number, CAST(quantity AS {MONEY}) AS quantity,
                  CAST(extended_price AS {MONEY}) AS extended_price,
                  CAST(discount AS {MONEY}) AS discount, CAST(tax AS {MONEY}) AS tax,
                  return_flag, line_status, ship_date, commit_date, receipt_date
           FROM e WHERE order_id IS NOT NULL AND line_number IS NOT NULL),
     w AS (SELECT * FROM v QUALIFY ROW_NUMBER() OVER (
             PARTITION BY customer_id, order_id, line_number
             ORDER BY name DESC, nation DESC, region DESC, status DESC, total_price DESC,
                      order_date DESC, quantity DESC, extended_price DESC, discount DESC,
                      tax DESC, return_flag DESC, line_status DESC, ship_date DESC,
                      commit_date DESC, receipt_date DESC) = 1)"""


def _wide_rows(relation: str) -> str:
    return f"""
SELECT customer_id, order_id, name, nation, region, status,
       CAST(total_price AS DOUBLE) AS total_price, CAST(order_date AS VARCHAR) AS order_date,
       line_number, CAST(quantity AS DOUBLE) AS quantity,
       CAST(extended_price AS DOUBLE) AS extended_price, CAST(discount AS DOUBLE) AS discount,
       CAST(tax AS DOUBLE) AS tax, return_flag, line_status,
       CAST(ship_date AS VARCHAR) AS ship_date, CAST(commit_date AS VARCHAR) AS commit_date,
       CAST(receipt_date AS VARCHAR) AS receipt_date
FROM {relation}"""


def _flat_rows(where: str = "") -> str:
    return BASE + f"""
SELECT customer_id, name, nation_name AS nation, region_name AS region, order_id, status,
       total_price, CAST(order_date AS VARCHAR) AS order_date, line_number, quantity,
       extended_price, discount, tax, return_flag, line_status,
       CAST(ship_date AS VARCHAR) AS ship_date, CAST(commit_date AS VARCHAR) AS commit_date,
       CAST(receipt_date AS VARCHAR) AS receipt_date
FROM e {where}"""


DETAIL = BASE + """
SELECT customer_id, name, nation_name AS nation, region_name AS region, order_id, status,
       total_price, CAST(order_date AS VARCHAR) AS order_date, line_number, quantity,
       extended_price, discount, return_flag, line_status,
       CAST(ship_date AS VARCHAR) AS ship_date
FROM e"""

LOCATED = """customer JOIN nation ON c_nationkey = n_nationkey
     JOIN region ON n_regionkey = r_regionkey"""
LINES = "JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey"

ORDER_REVENUE = f"""SELECT c_custkey AS customer_id, c_name AS name, o_orderkey AS order_id,
       SUM({GROSS}) AS revenue
FROM customer {LINES} GROUP BY ALL"""

D3 = f"""SELECT customer_id, status, COUNT(*) AS order_count,
       CAST(COALESCE(SUM(price), 0) AS DOUBLE) AS total_value
FROM (SELECT DISTINCT customer_id, order_id, status, CAST(total_price AS {MONEY}) AS price
      FROM e) GROUP BY customer_id, status"""

D5 = f"""SELECT customer_id, name, COUNT(*) AS total_orders,
       {_cents(f"COALESCE(SUM({ROW_NET}), 0)")} AS total_revenue
FROM e GROUP BY customer_id, name"""

K2 = f"""SELECT customer_id, COUNT(*) AS line_count,
       {_cents("COALESCE(SUM(extended_price * (1 - discount)), 0)")} AS revenue
FROM w GROUP BY customer_id"""

K3 = """SELECT customer_id, COUNT(DISTINCT order_id) AS unique_orders, COUNT(*) AS total_lines
FROM w GROUP BY customer_id"""

K4 = """SELECT customer_id, flag AS return_flag,
       CAST(COUNT(*) FILTER (return_flag = flag) AS BIGINT) AS matching_lines,
       CAST(COALESCE(SUM(quantity) FILTER (return_flag = flag), 0) AS DECIMAL(25,2)) AS quantity
FROM w, (SELECT UNNEST(['R', 'A', 'N']) AS flag) GROUP BY customer_id, flag"""

K5 = """SELECT customer_id, order_id,
       SUM(extended_price * (1 - discount) * (1 + tax)) AS revenue
FROM w GROUP BY customer_id, order_id"""

K5_TOTAL = f"""SELECT customer_id, COUNT(*) AS orders, {_cents("SUM(revenue)")} AS grand_total
FROM ({K5}) GROUP BY customer_id"""

PARAMETERS = """p AS (
  SELECT event_id AS sample_id, user_id * 10 + event_id % 11 AS customer_id,
         (['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'])[event_id % 5 + 1] AS region,
         (['R', 'A', 'N'])[event_id % 3 + 1] AS return_flag,
         user_id * 10 AS region_start, user_id * 10 + 100 AS region_end,
         user_id * 10 + event_id % 11 AS revenue_start,
         user_id * 10 + event_id % 11 + 10 AS revenue_end
  FROM events)"""

WIDE_START = "user_id * 10 + event_id % 11 - 5"
WIDE_END = f"""CASE WHEN event_id % 50 = 0 THEN {WIDE_START} - 1 - event_id % 7
               ELSE {WIDE_START} + CAST(10 ** (event_id % 9) AS BIGINT) - 1 END"""


def _wide_ranges(sql: str) -> str:
    """A statement with ranges of one id up to a hundred million."""
    return sql.replace(PARAMETERS, PARAMETERS.replace("p AS (", "q AS (", 1) + f""",
     w2 AS (SELECT event_id AS sample_id, {WIDE_START} AS low, {WIDE_END} AS high FROM events),
     p AS (SELECT q.* REPLACE (low AS region_start, high AS region_end, low AS revenue_start,
                               high AS revenue_end) FROM q JOIN w2 USING (sample_id))""")


BATCH = "WITH " + PARAMETERS
BATCH_BASE = BASE + ", " + PARAMETERS
BATCH_WIDE = WIDE + ", " + PARAMETERS

R1 = f"""SELECT c_custkey AS customer_id, c_name AS name, n_name AS nation, r_name AS region
FROM {LOCATED}"""

R2_SUMMARY = f"""SELECT c_custkey AS customer_id, COUNT(*) AS line_count,
       {_cents(f"SUM({NET})")} AS revenue
FROM {LOCATED} {LINES} GROUP BY c_custkey"""

R3 = f"""SELECT o_custkey AS customer_id, o_orderstatus AS status, COUNT(*) AS order_count,
       CAST(SUM(CAST(o_totalprice AS {MONEY})) AS DOUBLE) AS total_value
FROM orders GROUP BY ALL"""

BATCH_COUNT = """SELECT sample_id, p.region, region_start, region_end,
       COUNT(h.customer_id) AS customers
FROM p LEFT JOIN h ON h.region = p.region
     AND h.customer_id BETWEEN p.region_start AND p.region_end
GROUP BY ALL"""


def _looked_up(answers: str, *columns: str, filled: bool = False) -> str:
    wanted = [f"COALESCE({c}, 0) AS {c}" if filled else c for c in columns]
    return f"""SELECT sample_id, p.customer_id, {', '.join(wanted)},
       a.customer_id IS NOT NULL AS found
FROM p LEFT JOIN ({answers}) a ON a.customer_id = p.customer_id"""


LOG = """WITH g AS (
  SELECT epoch_us(ts) // 1000 AS start_ms, CAST(FLOOR(value * 10) AS BIGINT) AS elapsed,
         event_type AS label, event_id % 20 = 0 AS failed,
         CASE WHEN event_id % 20 <> 0 THEN '200' WHEN user_id % 3 = 0 THEN '500'
              WHEN user_id % 3 = 1 THEN '502' ELSE '503' END AS response_code,
         CASE WHEN event_id % 20 <> 0 THEN 'OK' WHEN user_id % 3 = 0 THEN 'Internal Server Error'
              WHEN user_id % 3 = 1 THEN 'Bad Gateway' ELSE 'Service Unavailable' END
           AS response_message,
         'Group ' || event_type AS thread_group,
         CAST(length(props) AS BIGINT) AS bytes, CAST(length(event_type) AS BIGINT) AS sent_bytes,
         CAST(1 + user_id % 5 AS INTEGER) AS all_threads,
         CASE WHEN event_id % 7 <> 0 THEN CAST(FLOOR(value * 5) AS BIGINT) END AS latency, CAST(FLOOR(value) AS BIGINT) AS connect
  FROM events),
x AS (SELECT *, start_ms + elapsed AS end_ms FROM g),
t AS (SELECT *, FALSE AS is_total FROM x
      UNION ALL SELECT * REPLACE ('Total' AS label), TRUE FROM x)"""


def _bucket(width: int, instant: str = "end_ms") -> str:
    return f"{instant} - {instant} % {width} AS bucket_ms"


def _rank(p: str) -> str:
    """Interpolated value at position p * (n + 1) / 1000 of the sorted list xs."""
    position = f"{p} * (n + 1)"
    return f"""CAST(CASE WHEN {position} // 1000 < 1 THEN xs[1]
       WHEN {position} // 1000 >= n THEN xs[n]
       ELSE xs[{position} // 1000] + CAST({position} % 1000 AS DOUBLE) / 1000
            * (xs[{position} // 1000 + 1] - xs[{position} // 1000]) END AS DOUBLE)"""


PERCENTILES = f"""{_rank("500")} AS median, {_rank("900")} AS p90, {_rank("950")} AS p95,
       {_rank("990")} AS p99"""

ROLLUP = """SELECT label, COUNT(*) AS samples, CAST(SUM(elapsed) AS BIGINT) AS total_ms,
       MIN(elapsed) AS min_ms, MAX(elapsed) AS max_ms, COUNT(*) FILTER (failed) AS errors,
       CAST(printf('%.1f', SUM(elapsed) / COUNT(*)) AS DOUBLE) AS avg_ms,
       CAST(printf('%.1f', COUNT(*) FILTER (failed) / COUNT(*) * 100) AS DOUBLE) AS error_pct,
       CAST(printf('%.2f', COUNT(*) / (SUM(elapsed) / 1000)) AS DOUBLE) AS busy_rate
FROM x GROUP BY label"""

TOTALS = """SELECT label, CAST(is_total AS TINYINT) AS is_total, COUNT(*) AS samples,
       COUNT(*) FILTER (failed) AS errors,
       COUNT(*) FILTER (failed) / COUNT(*) * 100 AS error_pct,
       SUM(elapsed) / COUNT(*) AS mean_ms, MIN(elapsed) AS min_ms, MAX(elapsed) AS max_ms,
       COUNT(*) / ((MAX(end_ms) - MIN(start_ms)) / 1000) AS wall_rate,
       SUM(bytes) / 1024 / ((MAX(end_ms) - MIN(start_ms)) / 1000) AS received_kb_rate,
       SUM(sent_bytes) / 1024 / ((MAX(end_ms) - MIN(start_ms)) / 1000) AS sent_kb_rate
FROM t GROUP BY label, is_total"""

TOTAL_PERCENTILES = f"""SELECT label, is_total, {PERCENTILES}
FROM (SELECT label, CAST(is_total AS TINYINT) AS is_total,
             list(elapsed ORDER BY elapsed) AS xs, COUNT(*) AS n
      FROM t GROUP BY label, is_total)"""

ERRORS = "response_code || '/' || response_message AS error"

_rows = ", ".join(
    f"('{q}', '{title}', '{system}', '{label}', {str(differs).upper()})"
    for q, title, system, label, differs in CATALOGUE)

COMPARISON = f""", s AS ({ROLLUP}),
q AS (SELECT * FROM (VALUES {_rows}) AS v(query_id, title, system, label, differs)),
b AS (SELECT q.*, s.* EXCLUDE (label),
             COUNT(avg_ms) OVER (PARTITION BY query_id) AS known,
             MIN(avg_ms) OVER (PARTITION BY query_id) AS low,
             MAX(avg_ms) OVER (PARTITION BY query_id) AS high
      FROM q LEFT JOIN s ON s.label = q.label)
SELECT * EXCLUDE (known, low, high), samples IS NOT NULL AS has_data,
       COALESCE(known > 1 AND avg_ms = low, FALSE) AS is_best,
       COALESCE(known > 1 AND avg_ms = high AND avg_ms <> low, FALSE) AS is_worst,
       CASE WHEN samples IS NOT NULL
            THEN GREATEST(avg_ms / GREATEST(1.0, high) * 100, 2.0) END AS scale_pct
FROM b"""


def _median_by_load(value: str) -> str:
    return LOG + f""",
y AS (SELECT *, {_bucket(HOUR)} FROM x),
r AS (SELECT bucket_ms, COUNT(*) * 1000 / {HOUR} AS rate FROM y GROUP BY bucket_ms)
SELECT rate, failed, {_rank("500")} AS median_{value}
FROM (SELECT rate, failed, list({value} ORDER BY {value}) AS xs, COUNT(*) AS n
      FROM y JOIN r USING (bucket_ms) WHERE {value} IS NOT NULL GROUP BY rate, failed)"""


def _document_shape(drop_empty: bool) -> str:
    orders = "COUNT(DISTINCT order_id)" if drop_empty else "GREATEST(COUNT(DISTINCT order_id), 1)"
    lines = "COUNT(line_number)" if drop_empty else "COUNT(*)"
    return BASE + f""",
     h AS (SELECT customer_id, SUM(CAST(total_price AS {MONEY})) AS order_value
           FROM o GROUP BY customer_id)
SELECT e.customer_id, name, nation_name AS nation, region_name AS region,
       CAST({orders} AS INTEGER) AS order_elements, CAST({lines} AS INTEGER) AS line_elements,
       CAST(COALESCE(ANY_VALUE(order_value), 0) AS DOUBLE) AS order_value,
       CAST(COALESCE(SUM(CAST(extended_price AS {MONEY})), 0) AS DOUBLE) AS line_value,
       MIN(order_id) AS first_order
FROM e LEFT JOIN h ON h.customer_id = e.customer_id GROUP BY ALL"""


def _json_field(name: str, kind: str) -> str:
    text = {"text": f"'\"' || {name} || '\"'",
            "date": f"'\"' || CAST({name} AS VARCHAR) || '\"'",
            "time": f"'\"' || CAST({name} AS VARCHAR) || 'T00:00:00.000\"'",
            "number": f"CAST({name} AS VARCHAR)"}[kind]
    return f"COALESCE('\"{name}\":' || {text}, '')"


_JSON = [("customer_id", "number"), ("name", "text"), ("nation", "text"), ("region", "text"),
         ("order_id", "number"), ("status", "text"), ("total_price", "number"),
         ("order_date", "time"), ("line_number", "number"), ("quantity", "number"),
         ("extended_price", "number"), ("discount", "number"), ("return_flag", "text"),
         ("line_status", "text"), ("ship_date", "time")]

SAMPLE = BASE + f""",
     f AS (SELECT *, nation_name AS nation, region_name AS region,
                  ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY
                    order_id NULLS FIRST, line_number NULLS FIRST, quantity NULLS FIRST,
                    extended_price NULLS FIRST, discount NULLS FIRST, return_flag NULLS FIRST,
                    line_status NULLS FIRST, ship_date NULLS FIRST) AS position FROM e)
SELECT customer_id, CAST(position AS INTEGER) AS position,
       '{{' || array_to_string(list_filter([{', '.join(_json_field(*f) for f in _JSON)}],
                                           lambda part: part <> ''), ',') || '}}' AS document
FROM f WHERE position <= 3"""


_LINE_JSON = [("line_number", "number"), ("quantity", "number"), ("extended_price", "number"),
              ("discount", "number"), ("tax", "number"), ("return_flag", "text"),
              ("line_status", "text"), ("ship_date", "time"), ("commit_date", "time"),
              ("receipt_date", "time")]


def _json_object(fields, *more: str) -> str:
    parts = ", ".join([_json_field(*f) for f in fields] + list(more))
    return f"'{{' || array_to_string(list_filter([{parts}], lambda part: part <> ''), ',') || '}}'"


DOCUMENT_TEXT = BASE + f""",
     lj AS (SELECT *, nation_name AS nation, region_name AS region,
                   {_json_object(_LINE_JSON)} AS line FROM e),
     oj AS (SELECT customer_id, name, nation, region,
                   {_json_object(_JSON[4:8], "'\"lineitems\":[' || lines || ']'")} AS json
            FROM (SELECT customer_id, name, nation, region, order_id, status, total_price,
                         order_date, string_agg(line, ',') AS lines FROM lj GROUP BY ALL)),
     dj AS (SELECT customer_id,
                   {_json_object(_JSON[:4], "'\"orders\":[' || string_agg(json, ',') || ']'")}
                     AS json
            FROM oj GROUP BY customer_id, name, nation, region)
SELECT customer_id, CAST(strlen(json) AS INTEGER) AS document_bytes,
       'document exceeds the size limit' AS reason
FROM dj WHERE strlen(json) > 16384"""

SHOWN = f"""SELECT customer_id, order_id, {_cents('revenue')} AS revenue,
       ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY order_id) AS position
FROM ({K5})"""


def statements() -> dict[str, str]:
    found = {
        "clean_customer": BASE + " SELECT * FROM c",
        "clean_orders": BASE + """
SELECT * REPLACE (CAST(order_date AS VARCHAR) AS order_date) FROM o""",
        "clean_lineitem": BASE + _LINES_AS_TEXT + " FROM l",
        "located_customers": BASE + """
SELECT customer_id, name, n_name AS nation_name, r_name AS region_name
FROM c LEFT JOIN nation ON n_nationkey = nation_key
       LEFT JOIN region ON r_regionkey = n_regionkey""",
        "enriched_rows": BASE + """
SELECT * REPLACE (CAST(order_date AS VARCHAR) AS order_date,
                  CAST(ship_date AS VARCHAR) AS ship_date,
                  CAST(commit_date AS VARCHAR) AS commit_date,
                  CAST(receipt_date AS VARCHAR) AS receipt_date) FROM e""",
        "staged_lineitem": """
SELECT * REPLACE (CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate),
       CAST(CAST(l_shipdate AS DATE) - l_linenumber AS VARCHAR) AS l_commitdate,
       CAST(CAST(l_shipdate AS DATE) + l_linenumber AS VARCHAR) AS l_receiptdate
FROM lineitem""",
        "wide_conform": WIDE + _wide_rows("v"),
        "wide_upsert": WIDE + _wide_rows("w"),
        "wide_clustered": WIDE + _wide_rows("w"),
        "wide_sink": WIDE + _wide_rows("w"),
        "wide_after_empty_load": WIDE + _wide_rows("w"),
        "wide_killed_load": WIDE + _wide_rows("w"),
        "wide_partial_load": WIDE + _wide_rows("""(SELECT * REPLACE (
            CASE WHEN order_id % 3 = 0 THEN 'Z' ELSE status END AS status) FROM w)"""),
        "document_shape": _document_shape(False),
        "document_shape_without_empty": _document_shape(True),
        "document_converted": _flat_rows(),
        "document_shape_in_pieces": _document_shape(False),
        "document_marks": BASE + """
SELECT customer_id, 1 AS firsts, COUNT(*) <= 20 AS whole, TRUE AS bounded FROM e
GROUP BY customer_id""",
        # The second order of an id has the greater status and price, so the first one shows.
        "document_repeated_orders": BASE + D3,
        "document_repeated_orders_in_pieces": BASE + D3,
        "document_load_counts": f"""
SELECT CAST(a AS BIGINT) AS attempted, CAST(a - r AS BIGINT) AS inserted,
       CAST(r AS BIGINT) AS rejected
FROM (SELECT (SELECT COUNT(*) FROM customer WHERE {_complete(*C_COLUMNS)}) AS a,
             (SELECT COUNT(*) FROM ({DOCUMENT_TEXT.replace("16384", "8192")})) AS r)""",
        "document_rejects": DOCUMENT_TEXT,
        "document_sink": DETAIL,
        "unwind_keep_empty": _flat_rows(),
        "unwind_drop_empty": _flat_rows("WHERE order_id IS NOT NULL AND line_number IS NOT NULL"),
        "pipeline_counts": _PIPELINE,
        "r1_customer": R1,
        "r2_detail": f"""
SELECT c_custkey AS customer_id, c_name AS name, n_name AS nation, r_name AS region,
       o_orderkey AS order_id, o_orderstatus AS status,
       CAST(CAST(o_totalprice AS {MONEY}) AS DOUBLE) AS total_price,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date, l_linenumber AS line_number,
       CAST(CAST(l_quantity AS {MONEY}) AS DOUBLE) AS quantity,
       CAST({PRICE} AS DOUBLE) AS extended_price,
       CAST(CAST(l_discount AS {MONEY}) AS DOUBLE) AS discount,
       CAST(CAST(l_tax AS {MONEY}) AS DOUBLE) AS tax, l_returnflag AS return_flag,
       l_linestatus AS line_status, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_date
FROM {LOCATED} {LINES}""",
        "r2_summary": R2_SUMMARY,
        "r3_status": R3,
        "r4_region": f"""SELECT c_custkey AS customer_id, c_name AS name, r_name AS region
FROM {LOCATED} WHERE r_name = 'ASIA'""",
        "r4_count": f"""
SELECT r_name AS region, COUNT(*) AS customers FROM {LOCATED} GROUP BY r_name""",
        "r5_revenue": f"SELECT * REPLACE ({_cents('revenue')} AS revenue) FROM ({ORDER_REVENUE})",
        "r5_top": f"""SELECT * REPLACE ({_cents('revenue')} AS revenue) FROM ({ORDER_REVENUE})
ORDER BY ROUND(revenue, 2) DESC, order_id LIMIT 5""",
        "r5_total": f"""SELECT COUNT(*) AS orders, {_cents('SUM(revenue)')} AS grand_total
FROM ({ORDER_REVENUE})""",
        "d1_customer": BASE + """
SELECT DISTINCT customer_id, name, nation_name AS nation, region_name AS region FROM e""",
        "d2_detail": DETAIL,
        "d2_count": BASE + " SELECT customer_id, COUNT(*) AS row_count FROM e GROUP BY customer_id",
        "d2_sample": SAMPLE,
        "d3_status": BASE + D3,
        "d4_region": BASE + """
SELECT DISTINCT customer_id, name, region_name AS region FROM e WHERE region_name = 'ASIA'""",
        "d4_count": BASE + """
SELECT region_name AS region, COUNT(DISTINCT customer_id) AS customers FROM e GROUP BY 1""",
        "d5_revenue": BASE + D5,
        "k1_customer": WIDE + """
SELECT customer_id, name, nation, region FROM w
QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY order_id, line_number) = 1""",
        "k2_detail": WIDE + _wide_rows("w"),
        "k2_summary": WIDE + K2,
        "k2_sample": WIDE + """
SELECT customer_id, order_id, line_number, status, CAST(position AS INTEGER) AS position
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY order_id, line_number)
             AS position FROM w) WHERE position <= 3""",
        "k3_orders": WIDE + K3,
        "k4_flags": WIDE + f"""
SELECT customer_id, return_flag, matching_lines, CAST(quantity AS DOUBLE) AS total_quantity
FROM ({K4})""",
        "k5_revenue": WIDE + f" SELECT * REPLACE ({_cents('revenue')} AS revenue) FROM ({K5})",
        "k5_total": WIDE + K5_TOTAL,
        "k5_first": WIDE + f"""
SELECT customer_id, CAST(position AS INTEGER) AS position, order_id, {_cents('revenue')} AS revenue
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY order_id) AS position
      FROM ({K5})) WHERE position <= 5""",
        "text_found": BATCH + f"""
SELECT sample_id, CASE WHEN a.customer_id IS NULL
         THEN 'Customer ' || p.customer_id || ' not found'
         ELSE 'Customer found: id=' || p.customer_id || ', name=' || name || ', nation=' || nation
              || ', region=' || a.region END AS response
FROM p LEFT JOIN ({R1}) a ON a.customer_id = p.customer_id""",
        "text_range": BATCH + f""", h AS ({R1}), a AS ({BATCH_COUNT})
SELECT sample_id, 'Region=' || region || ', Range=[' || region_start || '-' || region_end
       || ']: Found ' || customers || ' customers' AS response FROM a""",
        "text_lines": WIDE + """
SELECT 'Customer ' || customer_id || ': ' || COUNT(*) || ' order-lines, revenue='
       || CAST(CAST(ROUND(SUM(extended_price * (1 - discount)), 2) AS DECIMAL(34,2)) AS VARCHAR)
       AS response
FROM w GROUP BY customer_id""",
        "text_flags": WIDE + f"""
SELECT 'Customer ' || customer_id || ', return_flag=' || return_flag || ': ' || matching_lines
       || ' matching lines, total_qty=' || CAST(quantity AS VARCHAR) AS response
FROM ({K4})""",
        "text_distinct": WIDE + f"""
SELECT 'Customer ' || customer_id || ': ' || unique_orders || ' unique orders, ' || total_lines
       || ' total line items' AS response FROM ({K3})""",
        "text_status": f"""
SELECT customer_id, '  Status: ' || status || ', Count: ' || order_count || ', Total: '
       || CAST(total_value AS VARCHAR) AS response FROM ({R3})""",
        "text_revenue": WIDE + f""", k AS ({K5_TOTAL}), i AS ({SHOWN})
SELECT k.customer_id,
       'Customer ' || k.customer_id || ': ' || ANY_VALUE(orders) || ' orders' || chr(10)
       || string_agg('  Order ' || order_id || ': '
                     || CAST(CAST(revenue AS DECIMAL(34,2)) AS VARCHAR), chr(10) ORDER BY position)
       || chr(10) || 'Grand Total Revenue: '
       || CAST(CAST(ANY_VALUE(grand_total) AS DECIMAL(34,2)) AS VARCHAR) AS response
FROM k JOIN i ON i.customer_id = k.customer_id WHERE position <= 5 GROUP BY k.customer_id""",
        "batch_r1": BATCH + _looked_up(R1, "name", "nation", "a.region"),
        "batch_r2": BATCH + _looked_up(R2_SUMMARY, "line_count", "revenue", filled=True),
        "batch_r3": BATCH + f"""
SELECT sample_id, p.customer_id, status, order_count, total_value
FROM p JOIN ({R3}) a ON a.customer_id = p.customer_id""",
        "batch_r4": BATCH + f", h AS ({R1}) {BATCH_COUNT}",
        "batch_r5": BATCH + f"""
SELECT sample_id, revenue_start, revenue_end, COUNT(order_id) AS orders,
       {_cents("COALESCE(SUM(revenue), 0)")} AS grand_total
FROM p LEFT JOIN ({ORDER_REVENUE}) a ON a.customer_id BETWEEN revenue_start AND revenue_end
GROUP BY ALL""",
        "batch_r5_top": BATCH + f"""
SELECT sample_id, CAST(place AS INTEGER) AS place, customer_id, name, order_id, revenue
FROM (SELECT sample_id, a.customer_id, name, order_id, {_cents('revenue')} AS revenue,
             ROW_NUMBER() OVER (PARTITION BY sample_id
                                ORDER BY ROUND(a.revenue, 2) DESC, order_id) AS place
      FROM p JOIN ({ORDER_REVENUE}) a ON a.customer_id BETWEEN revenue_start AND revenue_end)
WHERE place <= 5""",
        "batch_d1": BATCH_BASE + " " + _looked_up(
            """SELECT DISTINCT customer_id, name, nation_name AS nation, region_name AS region
               FROM e""", "name", "nation", "a.region"),
        "d2_lookup": f"SELECT * FROM ({DETAIL}) WHERE customer_id = 7",
        "k2_lookup": f"SELECT * FROM ({WIDE + _wide_rows('w')}) WHERE customer_id = 7",
        "stored_batch_d2": BATCH_BASE + " " + _looked_up(
            "SELECT customer_id, COUNT(*) AS row_count FROM e GROUP BY customer_id",
            "row_count", filled=True),
        "stored_batch_k2": BATCH_WIDE + " " + _looked_up(K2, "line_count", "revenue", filled=True),
        "batch_d2": BATCH_BASE + " " + _looked_up(
            "SELECT customer_id, COUNT(*) AS row_count FROM e GROUP BY customer_id",
            "row_count", filled=True),
        "batch_d3": BATCH_BASE + f"""
SELECT sample_id, p.customer_id, status, order_count, total_value
FROM p JOIN ({D3}) a ON a.customer_id = p.customer_id""",
        "batch_d4": BATCH_BASE + f""",
     h AS (SELECT DISTINCT customer_id, region_name AS region FROM e) {BATCH_COUNT}""",
        "batch_d5": BATCH_BASE + f"""
SELECT sample_id, customer_id, name, total_revenue, total_orders
FROM p JOIN ({D5}) a ON a.customer_id BETWEEN revenue_start AND revenue_end""".replace(
            "SELECT sample_id, customer_id", "SELECT sample_id, a.customer_id"),
        "batch_k1": BATCH_WIDE + " " + _looked_up(
            "SELECT DISTINCT customer_id, name, nation, region FROM w",
            "name", "nation", "a.region"),
        "batch_k2": BATCH_WIDE + " " + _looked_up(K2, "line_count", "revenue", filled=True),
        "batch_k3": BATCH_WIDE + " " + _looked_up(K3, "unique_orders", "total_lines", filled=True),
        "batch_k4": BATCH_WIDE + f"""
SELECT sample_id, p.customer_id, p.return_flag, COALESCE(matching_lines, 0) AS matching_lines,
       CAST(COALESCE(quantity, 0) AS DOUBLE) AS total_quantity, a.customer_id IS NOT NULL AS found
FROM p LEFT JOIN ({K4}) a ON a.customer_id = p.customer_id AND a.return_flag = p.return_flag""",
        "batch_k5": BATCH_WIDE + " " + _looked_up(K5_TOTAL, "orders", "grand_total", filled=True),
        "log_rollup": LOG + ROLLUP,
        "log_csv_rollup": LOG + ROLLUP,
        "log_csv_messages": LOG + """
SELECT 'said "' || response_message || '",' || chr(10) || 'went on' AS response_message, failed,
       COUNT(*) AS samples
FROM x GROUP BY ALL""",
        "log_totals": LOG + TOTALS,
        "log_percentiles": LOG + f"""
SELECT label, {PERCENTILES}
FROM (SELECT label, list(elapsed ORDER BY elapsed) AS xs, COUNT(*) AS n FROM x GROUP BY label)""",
        "log_statistics": LOG + f"""
SELECT * FROM ({TOTALS}) JOIN ({TOTAL_PERCENTILES}) USING (label, is_total)""",
        "log_error_types": LOG + f"""
SELECT {ERRORS}, COUNT(*) AS errors,
       COUNT(*) * CAST(100 AS DOUBLE) / (SELECT COUNT(*) FROM x WHERE failed) AS pct_of_errors,
       COUNT(*) * CAST(100 AS DOUBLE) / (SELECT COUNT(*) FROM x) AS pct_of_samples
FROM x WHERE failed GROUP BY 1""",
        "log_top_errors": LOG + f"""
SELECT label, error, errors, CAST(place AS INTEGER) AS place
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY label ORDER BY errors DESC, error) AS place
      FROM (SELECT label, {ERRORS}, COUNT(*) AS errors FROM x WHERE failed GROUP BY 1, 2))
WHERE place <= 5""",
        "log_apdex": LOG + """
SELECT *, (satisfied + tolerating / 2) / samples AS apdex
FROM (SELECT label, CAST(is_total AS TINYINT) AS is_total, COUNT(*) AS samples,
             COUNT(*) FILTER (NOT failed AND elapsed <= 500) AS satisfied,
             COUNT(*) FILTER (NOT failed AND elapsed > 500 AND elapsed <= 1500) AS tolerating
      FROM t GROUP BY label, is_total)""",
        "log_bands": LOG + """
SELECT band, name, COUNT(elapsed) AS samples
FROM (VALUES (0, '<= 500 ms'), (1, '> 500 ms and <= 1500 ms'), (2, '> 1500 ms'), (3, 'error'))
     AS b(band, name)
LEFT JOIN x ON band = CASE WHEN failed THEN 3 WHEN elapsed <= 500 THEN 0
                           WHEN elapsed <= 1500 THEN 1 ELSE 2 END
GROUP BY band, name""",
        "log_outcome_share": LOG + """
SELECT COUNT(*) FILTER (NOT failed) / COUNT(*) * 100 AS ok_pct,
       COUNT(*) FILTER (failed) / COUNT(*) * 100 AS ko_pct FROM x""",
        "log_histogram": LOG + """
SELECT label, elapsed // 100 * 100 AS from_ms, COUNT(*) AS samples FROM x GROUP BY 1, 2""",
        "log_percentile_curve": LOG + """
SELECT label, k / 10 AS percentile, CAST(xs[LEAST(k * n // 1000 + 1, n)] AS DOUBLE) AS elapsed
FROM (SELECT label, list(elapsed ORDER BY elapsed) AS xs, COUNT(*) AS n FROM x GROUP BY label),
     (SELECT UNNEST(range(0, 1001)) AS k)""",
        "log_means_over_time": LOG + f"""
SELECT label, {_bucket(HOUR)}, AVG(elapsed) AS mean_elapsed, AVG(latency) AS mean_latency,
       AVG(connect) AS mean_connect FROM x GROUP BY 1, 2""",
        "log_percentiles_over_time": LOG + f"""
SELECT bucket_ms, CAST(xs[1] AS DOUBLE) AS min_ms, CAST(xs[n] AS DOUBLE) AS max_ms, {PERCENTILES}
FROM (SELECT {_bucket(DAY)}, list(elapsed ORDER BY elapsed) AS xs, COUNT(*) AS n
      FROM x WHERE NOT failed GROUP BY 1)""",
        "log_hits_over_time": LOG + f"""
SELECT {_bucket(HOUR, 'start_ms')}, COUNT(*) / 3600 AS rate FROM x GROUP BY 1""",
        "log_codes_over_time": LOG + f"""
SELECT response_code, {_bucket(HOUR)}, COUNT(*) / 3600 AS rate FROM x GROUP BY 1, 2""",
        "log_transactions_over_time": LOG + f"""
SELECT label, failed, {_bucket(HOUR)}, COUNT(*) / 3600 AS rate FROM x GROUP BY 1, 2, 3""",
        "log_total_over_time": LOG + f"""
SELECT failed, {_bucket(HOUR)}, COUNT(*) / 3600 AS rate FROM x GROUP BY 1, 2""",
        "log_threads_over_time": LOG + f"""
SELECT thread_group, {_bucket(HOUR)}, AVG(all_threads) AS mean_threads FROM x GROUP BY 1, 2""",
        "log_elapsed_by_threads": LOG + """
SELECT label, all_threads, AVG(elapsed) AS mean_elapsed FROM x GROUP BY 1, 2""",
        "log_elapsed_by_mean_threads": LOG + """
SELECT label, AVG(all_threads) AS mean_threads, AVG(elapsed) AS mean_elapsed FROM x GROUP BY 1""",
        "log_bytes_over_time": LOG + f"""
SELECT {_bucket(HOUR)}, SUM(bytes) / 3600 AS received_rate, SUM(sent_bytes) / 3600 AS sent_rate
FROM x GROUP BY 1""",
        "log_median_by_load": _median_by_load("elapsed"),
        "log_latency_by_load": _median_by_load("latency"),
        "log_comparison": LOG + COMPARISON,
        "log_comparison_sink": LOG + COMPARISON,
    }
    def two(amount: str) -> str:
        return f"CAST(CAST({amount} AS DECIMAL(34,2)) AS VARCHAR)"

    def head(p: str) -> str:
        return f"""'Revenue for customers ' || ANY_VALUE({p}.revenue_start) || '-'
       || ANY_VALUE({p}.revenue_end) || ':' || chr(10)"""

    found["text_rows"] = f"""
SELECT customer_id, 'Customer ' || customer_id || ': Found ' || ANY_VALUE(row_count)
       || ' order-lineitem rows.' || chr(10) || 'Sample:' || chr(10)
       || string_agg(document || chr(10), '' ORDER BY position) AS response
FROM ({SAMPLE}) s JOIN ({found["d2_count"]}) n USING (customer_id) GROUP BY customer_id"""
    found["text_customers"] = f"""
SELECT sample_id, {head("p")} || string_agg('  ' || name || ': revenue='
         || {two("total_revenue")} || ', items=' || total_orders || chr(10), ''
         ORDER BY total_revenue DESC, customer_id)
       || 'Total customers: ' || COUNT(*) AS response
FROM ({found["batch_d5"]}) a
JOIN (SELECT event_id AS sample_id, user_id * 10 + event_id % 11 AS revenue_start,
             user_id * 10 + event_id % 11 + 10 AS revenue_end FROM events) p USING (sample_id)
GROUP BY sample_id"""
    found["text_orders"] = f"""
SELECT sample_id, {head("r")} || string_agg('  ' || name || ', order ' || order_id
         || ': ' || {two("revenue")} || chr(10), '' ORDER BY place)
       || 'Total orders: ' || ANY_VALUE(orders) || ', Grand Total: '
       || {two("ANY_VALUE(grand_total)")} AS response
FROM ({found["batch_r5_top"]}) t JOIN ({found["batch_r5"]}) r USING (sample_id)
GROUP BY sample_id"""
    for name in ("batch_r4", "batch_d4"):
        found[f"{name}_wide"] = _wide_ranges(found[name])
    found["batch_r5_wide"] = _wide_ranges(BATCH + f""", a AS (
  SELECT customer_id, COUNT(order_id) AS orders, SUM(revenue) AS revenue
  FROM ({ORDER_REVENUE}) GROUP BY customer_id)
SELECT sample_id, revenue_start, revenue_end, CAST(COALESCE(SUM(orders), 0) AS BIGINT) AS orders,
       {_cents("COALESCE(SUM(revenue), 0)")} AS grand_total
FROM p LEFT JOIN a ON a.customer_id BETWEEN revenue_start AND revenue_end GROUP BY ALL""")
    found["batch_parameters"] = _BATCH_PARAMETERS
    counted = """b AS (SELECT *, greatest(length(bin(elapsed)) - 8, 0) AS s FROM x),
     m AS (SELECT label, failed, end_ms, CAST((elapsed >> s << s) + ((1::BIGINT << s) - 1) // 2
                                              AS BIGINT) AS elapsed FROM b)"""
    found["log_stored_percentiles"] = LOG + f""", {counted}
SELECT label, {PERCENTILES}
FROM (SELECT label, list(elapsed ORDER BY elapsed) AS xs, COUNT(*) AS n FROM m GROUP BY label)"""
    found["log_stored_mornings"] = LOG + f""", {counted}
SELECT failed, {PERCENTILES}
FROM (SELECT failed, list(elapsed ORDER BY elapsed) AS xs, COUNT(*) AS n FROM m
      WHERE (end_ms - end_ms % 60000) % {DAY} < {DAY // 2} GROUP BY failed)"""
    found["document_converted_dates"] = BASE + """
SELECT DISTINCT customer_id, order_id,
       strftime(CAST(order_date AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS order_date
FROM e WHERE order_id IS NOT NULL"""
    found["wide_clustered_order"] = WIDE + " SELECT DISTINCT customer_id, 0 AS misplaced FROM w"
    found["r5_top_order"] = f"""
SELECT CAST(ROW_NUMBER() OVER (ORDER BY revenue DESC, order_id) - 1 AS INTEGER) AS place,
       customer_id, order_id, revenue
FROM (SELECT customer_id, order_id, {_cents('revenue')} AS revenue FROM ({ORDER_REVENUE}))
ORDER BY place LIMIT 50"""
    found["d5_first_order"] = BASE + f"""
SELECT CAST(ROW_NUMBER() OVER (ORDER BY total_revenue DESC, customer_id) - 1 AS INTEGER) AS place,
       customer_id, total_revenue, total_orders FROM ({D5}) ORDER BY place LIMIT 50"""
    found["collection_load_counts"] = found["document_load_counts"]
    found["collection_rejects"] = found["document_rejects"]
    found["collection_status"] = found["d3_status"]
    found["r2_lookup"] = f"SELECT * FROM ({found['r2_detail']}) WHERE customer_id = 7"
    return found


# The ids of a lookup: its number times a fixed multiplier, by the fixed modulus 2 ** 40.
_BATCH_PARAMETERS = """
WITH m AS (SELECT MAX(c_custkey) AS n FROM customer),
     i AS (SELECT UNNEST(RANGE(COUNT(*))) AS sample_id FROM customer),
     s AS (SELECT sample_id, n, sample_id * 2654435761 % 1099511627776 AS spread FROM i, m),
     d AS (SELECT sample_id, spread % n + 1 AS customer_id,
                  (['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'])[sample_id % 5 + 1]
                    AS region, (['R', 'A', 'N'])[sample_id % 3 + 1] AS return_flag,
                  spread % GREATEST(n - 1000, 1) + 1 AS region_start,
                  spread % GREATEST(n - 50, 1) + 1 AS revenue_start FROM s)
SELECT *, region_start + 100 AS region_end, revenue_start + 10 AS revenue_end FROM d"""

_LINES_AS_TEXT = """
SELECT * REPLACE (CAST(ship_date AS VARCHAR) AS ship_date,
                  CAST(commit_date AS VARCHAR) AS commit_date,
                  CAST(receipt_date AS VARCHAR) AS receipt_date)"""

# The sources of this run have no commit and receipt dates of their own, so the pipeline
# reads what was staged before it.
_PIPELINE = WIDE + """
SELECT d.customer_id, row_count, line_count
FROM (SELECT customer_id, COUNT(*) AS row_count FROM e GROUP BY customer_id) d
LEFT JOIN (SELECT customer_id, COUNT(*) AS line_count FROM w GROUP BY customer_id) k
  ON k.customer_id = d.customer_id"""
