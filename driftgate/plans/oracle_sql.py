"""DuckDB twins of the registered queries, for the cross-engine check.

Each entry is one SQL statement over the driver tables (registered as views
under their own names).  The pipeline part -- conform, the six orders rules,
first-occurrence UNIQUE -- is spelled out in CTEs so the check covers the
whole path from the raw tables, not only the last aggregate.

Rounding twins: averages and shares use the same integer half-up as
``functions.rounding``; totals are exact decimals rounded to 2 places.
"""

from __future__ import annotations

from ..sources.driver_tables import CLEAN_ORDERS_SQL, FEED_SQL, RAW_ORDERS_SQL

AS_OF = "DATE '2001-08-01'"


def hu(num: str, den: str) -> str:
    """round_half_up(num / den, 2) for non-negative integers, as DOUBLE."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return f"(CASE WHEN {d} <> 0 THEN CAST(({n} * 200 + {d}) // (2 * {d}) AS DOUBLE) / 100.0 END)"


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS HUGEINT)"


def money(x: str) -> str:
    return f"CAST(ROUND({x}, 2) AS DOUBLE)"


REV = "price * quantity"

RULE_NAMES = [
    "order_id_not_null",
    "order_id_unique",
    "price_positive",
    "quantity_positive",
    "order_date_not_null",
    "customer_id_not_null",
]

PIPELINE_CTES = f"""
raw_orders AS ({RAW_ORDERS_SQL}),
typed AS (
  SELECT order_id, customer_id, product_name, quantity,
         TRY_CAST(price AS DECIMAL(10,2)) AS price,
         TRY_CAST(order_date AS DATE) AS order_date,
         status, region, shipping_method,
         order_date AS order_date_text,
         _ingest_ts,
         ROW_NUMBER() OVER (PARTITION BY order_id
                            ORDER BY _l_partkey, _l_suppkey, _l_shipdate, _l_extendedprice, _l_quantity) AS _rn
  FROM raw_orders),
flags AS (
  SELECT *,
         order_id IS NOT NULL AS p1,
         _rn = 1 AS p2,
         COALESCE(price >= 0, false) AS p3,
         COALESCE(quantity >= 1, false) AS p4,
         order_date IS NOT NULL AS p5,
         customer_id IS NOT NULL AS p6
  FROM typed),
flagged AS (
  SELECT *, p1 AND p2 AND p3 AND p4 AND p5 AND p6 AS is_valid,
         concat_ws(',', {", ".join(f"CASE WHEN NOT p{i + 1} THEN '{n}' END" for i, n in enumerate(RULE_NAMES))}) AS failed_rules
  FROM flags),
quarantine_orders AS (
  SELECT order_id, customer_id, product_name, quantity, price, order_date_text AS order_date,
         status, region, shipping_method, _ingest_ts AS quarantine_timestamp, failed_rules
  FROM flagged WHERE NOT is_valid)"""

CLEAN_CTE = f"clean_orders AS ({CLEAN_ORDERS_SQL})"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _clean(body: str) -> str:
    return _with(CLEAN_CTE) + body


def _quar(body: str) -> str:
    return _with(PIPELINE_CTES) + body


BUSINESS = "order_id, customer_id, product_name, quantity, CAST(price AS DOUBLE) AS price, order_date, status, region, shipping_method"

ORACLE: dict[str, str] = {
    # ---- pipeline operators over raw_orders --------------------------------
    "validated_rows": _quar(f"SELECT {BUSINESS} FROM flagged WHERE is_valid"),
    "quarantined_rows": _quar(
        "SELECT order_id, customer_id, product_name, quantity, CAST(price AS DOUBLE) AS price, order_date, "
        "status, region, shipping_method, quarantine_timestamp, failed_rules FROM quarantine_orders"
    ),
    "rule_results": _quar(
        "SELECT rule_name, column_name, failed_count = 0 AS passed, failed_count, total_count, "
        "CASE WHEN total_count > 0 THEN CAST(failed_count AS DOUBLE) / CAST(total_count AS DOUBLE) * 100.0 ELSE 0.0 END AS failure_percentage, "
        "'error' AS severity FROM ("
        + " UNION ALL ".join(
            f"SELECT '{n}' AS rule_name, '{c}' AS column_name, CAST(count_if(NOT p{i + 1}) AS BIGINT) AS failed_count, CAST(count(*) AS BIGINT) AS total_count FROM flagged"
            for i, (n, c) in enumerate(
                zip(RULE_NAMES, ["order_id", "order_id", "price", "quantity", "order_date", "customer_id"])
            )
        )
        + ")"
    ),
}

_RAW_COLS = ["order_id", "customer_id", "product_name", "quantity", "price", "order_date", "status", "region", "shipping_method"]
_NULL_OF = {c: (f"({c} IS NULL OR isnan({c}))" if c == "price" else f"{c} IS NULL") for c in _RAW_COLS}

_METRICS_CORE = _quar(
    f"""SELECT total_records, valid_records, invalid_records, duplicate_records, total_null_cells,
       CASE WHEN total_records > 0 THEN {hu(
           f"valid_records * {40 * len(_RAW_COLS)} + (total_records - duplicate_records) * {30 * len(_RAW_COLS)} + (total_records * {len(_RAW_COLS)} - total_null_cells) * 30",
           f"total_records * {len(_RAW_COLS)}")} ELSE 0.0 END AS data_quality_score
FROM (
  SELECT (SELECT CAST(count(*) AS BIGINT) FROM flagged) AS total_records,
         (SELECT CAST(count_if(is_valid) AS BIGINT) FROM flagged) AS valid_records,
         (SELECT CAST(count_if(NOT is_valid) AS BIGINT) FROM flagged) AS invalid_records,
         (SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT {", ".join(_RAW_COLS)} FROM raw_orders)) AS BIGINT) FROM raw_orders) AS duplicate_records,
         (SELECT CAST({" + ".join(f"count_if({_NULL_OF[c]})" for c in _RAW_COLS)} AS BIGINT) FROM raw_orders) AS total_null_cells
)"""
)

ORACLE["quality_metrics"] = _METRICS_CORE
ORACLE["null_counts"] = _quar(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count_if({_NULL_OF[c]}) AS BIGINT) AS null_count FROM raw_orders" for c in _RAW_COLS
    )
)
ORACLE["quality_alerts"] = (
    "WITH m AS ("
    + _METRICS_CORE
    + """)
SELECT alert_type, severity, metric_value, threshold_value FROM (
  SELECT 'INVALID_RECORDS_THRESHOLD_EXCEEDED' AS alert_type, 'ERROR' AS severity,
         CAST(invalid_records AS DOUBLE) / CAST(total_records AS DOUBLE) * 100.0 AS metric_value, 5.0 AS threshold_value
  FROM m WHERE total_records > 0 AND CAST(invalid_records AS DOUBLE) / CAST(total_records AS DOUBLE) * 100.0 > 5.0
  UNION ALL
  SELECT 'DUPLICATE_RECORDS_THRESHOLD_EXCEEDED', 'WARNING',
         CAST(duplicate_records AS DOUBLE) / CAST(total_records AS DOUBLE) * 100.0, 2.0
  FROM m WHERE total_records > 0 AND CAST(duplicate_records AS DOUBLE) / CAST(total_records AS DOUBLE) * 100.0 > 2.0
  UNION ALL
  SELECT 'LOW_QUALITY_SCORE', 'ERROR', data_quality_score, 85.0 FROM m WHERE data_quality_score < 85.0)"""
)
ORACLE["rescued_values"] = _quar(
    """SELECT 'order_date' AS column_name, order_date_text AS raw_value, CAST(count(*) AS BIGINT) AS cells
FROM typed WHERE order_date IS NULL AND order_date_text IS NOT NULL GROUP BY order_date_text
UNION ALL
SELECT 'price', CAST(r.price AS VARCHAR), CAST(count(*) AS BIGINT)
FROM raw_orders r WHERE r.price IS NOT NULL AND TRY_CAST(r.price AS DECIMAL(10,2)) IS NULL GROUP BY r.price"""
)

# Inference twin: first type whose pattern every non-NULL value matches.
_INT = r"^[+-]?[0-9]+$"
_DBL = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TS = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?$"


def _infer_sql(v: str) -> str:
    def miss(cond: str) -> str:
        return f"count_if({v} IS NOT NULL AND NOT COALESCE({cond}, false)) = 0"

    return (
        f"CASE WHEN count({v}) = 0 THEN 'string' "
        f"WHEN {miss(f'regexp_matches({v}, {chr(39)}{_INT}{chr(39)}) AND TRY_CAST({v} AS BIGINT) BETWEEN -2147483648 AND 2147483647')} THEN 'int' "
        f"WHEN {miss(f'regexp_matches({v}, {chr(39)}{_INT}{chr(39)}) AND TRY_CAST({v} AS BIGINT) IS NOT NULL')} THEN 'bigint' "
        f"WHEN {miss(f'regexp_matches({v}, {chr(39)}{_DBL}{chr(39)})')} THEN 'double' "
        f"WHEN {miss(f'regexp_matches({v}, {chr(39)}{_DATE}{chr(39)}) AND TRY_CAST({v} AS DATE) IS NOT NULL')} THEN 'date' "
        f"WHEN {miss(f'regexp_matches({v}, {chr(39)}{_TS}{chr(39)}) AND TRY_CAST({v} AS TIMESTAMP) IS NOT NULL')} THEN 'timestamp' "
        f"WHEN {miss(f'lower({v}) IN ({chr(39)}true{chr(39)}, {chr(39)}false{chr(39)})')} THEN 'boolean' "
        "ELSE 'string' END"
    )


_REG_TYPES = {
    "order_id": "string",
    "customer_id": "string",
    "product_name": "string",
    "quantity": "int",
    "price": "decimal(10,2)",
    "order_date": "date",
    "status": "string",
    "region": "string",
    "shipping_method": "string",
}
ORACLE["schema_drift_by_batch"] = _with(
    PIPELINE_CTES,
    "text_batch AS (SELECT CAST(_ingest_ts AS DATE) AS batch, "
    + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _RAW_COLS)
    + " FROM raw_orders)",
    "inferred AS (SELECT batch, " + ", ".join(f"{_infer_sql(c)} AS t_{c}" for c in _RAW_COLS) + " FROM text_batch GROUP BY batch)",
) + " UNION ALL ".join(
    f"SELECT batch, 'datatype_change' AS change_type, '{c}' AS column_name, '{t}' AS old_type, t_{c} AS new_type "
    f"FROM inferred WHERE t_{c} <> '{t}'"
    for c, t in _REG_TYPES.items()
)

# ---- the query book ----------------------------------------------------------
ORACLE.update(
    {
        "clean_count": _clean("SELECT CAST(count(*) AS BIGINT) AS total_clean_records FROM clean_orders"),
        "count_by_day": _clean(
            "SELECT year, month, day, CAST(count(*) AS BIGINT) AS record_count FROM clean_orders "
            "GROUP BY year, month, day ORDER BY year DESC, month DESC, day DESC"
        ),
        "quarantine_count": _quar("SELECT CAST(count(*) AS BIGINT) AS total_quarantined_records FROM quarantine_orders"),
        "quality_summary": _quar(
            "SELECT 'Clean Records' AS category, CAST(count_if(is_valid) AS BIGINT) AS count FROM flagged "
            "UNION ALL SELECT 'Quarantined Records' AS category, CAST(count(*) AS BIGINT) AS count FROM quarantine_orders"
        ),
        "null_check": _clean(
            "SELECT CAST(count(*) AS BIGINT) AS total_records, "
            + ", ".join(f"CAST(count(*) - count({c}) AS BIGINT) AS null_{c}" for c in ("order_id", "customer_id", "price", "order_date"))
            + " FROM clean_orders"
        ),
        "duplicate_ids": _clean(
            "SELECT order_id, CAST(count(*) AS BIGINT) AS occurrence_count FROM clean_orders GROUP BY order_id "
            "HAVING count(*) > 1 ORDER BY occurrence_count DESC, order_id"
        ),
        "revenue_by_day": _clean(
            f"SELECT order_date, CAST(count(DISTINCT order_id) AS BIGINT) AS total_orders, CAST(SUM(quantity) AS BIGINT) AS total_items, "
            f"{money(f'SUM({REV})')} AS total_revenue FROM clean_orders WHERE status = 'completed' "
            "GROUP BY order_date ORDER BY order_date DESC"
        ),
        "revenue_by_region": _clean(
            f"SELECT region, CAST(count(DISTINCT order_id) AS BIGINT) AS total_orders, "
            f"CAST(count(DISTINCT customer_id) AS BIGINT) AS unique_customers, {money(f'SUM({REV})')} AS total_revenue, "
            f"{hu(cents(f'SUM({REV})'), f'count({REV}) * 100')} AS avg_order_value "
            "FROM clean_orders WHERE status = 'completed' GROUP BY region ORDER BY total_revenue DESC, region"
        ),
        "top_products": _clean(
            f"SELECT product_name, CAST(count(*) AS BIGINT) AS order_count, CAST(SUM(quantity) AS BIGINT) AS total_quantity_sold, "
            f"{money(f'SUM({REV})')} AS total_revenue FROM clean_orders WHERE status = 'completed' "
            "GROUP BY product_name ORDER BY total_revenue DESC, product_name LIMIT 10"
        ),
        "status_share": _clean(
            f"SELECT status, CAST(count(*) AS BIGINT) AS order_count, {hu('count(*) * 100', 'SUM(count(*)) OVER ()')} AS percentage "
            "FROM clean_orders GROUP BY status ORDER BY order_count DESC, status"
        ),
        "daily_trend_30d": _clean(
            f"SELECT order_date, CAST(count(*) AS BIGINT) AS order_count, {money(f'SUM({REV})')} AS daily_revenue, "
            f"{hu(cents(f'SUM({REV})'), f'count({REV}) * 100')} AS avg_order_value FROM clean_orders "
            f"WHERE order_date >= {AS_OF} - INTERVAL '30' DAY GROUP BY order_date ORDER BY order_date DESC"
        ),
        "repeat_customers": _clean(
            f"SELECT customer_id, CAST(count(*) AS BIGINT) AS order_count, {money(f'SUM({REV})')} AS total_spent, "
            "MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date FROM clean_orders "
            "GROUP BY customer_id HAVING count(*) > 1 ORDER BY order_count DESC, customer_id LIMIT 20"
        ),
        "revenue_by_shipping": _clean(
            f"SELECT COALESCE(shipping_method, 'Not Specified') AS shipping_method, CAST(count(*) AS BIGINT) AS order_count, "
            f"{money(f'SUM({REV})')} AS total_revenue FROM clean_orders WHERE status = 'completed' "
            "GROUP BY shipping_method ORDER BY total_revenue DESC, 1"
        ),
        "column_population": _clean(
            "SELECT CAST(count(*) AS BIGINT) AS total_records, CAST(count(shipping_method) AS BIGINT) AS records_with_shipping_method, "
            f"{hu('count(shipping_method) * 100', 'count(*)')} AS percentage_populated FROM clean_orders"
        ),
        "monthly_revenue": _clean(
            f"SELECT year, month, CAST(count(DISTINCT order_id) AS BIGINT) AS total_orders, {money(f'SUM({REV})')} AS monthly_revenue "
            "FROM clean_orders WHERE status = 'completed' GROUP BY year, month ORDER BY year DESC, month DESC"
        ),
        # each week beside the one numbered just before it
        "week_over_week": _with(
            CLEAN_CTE,
            f"""sold AS (
  SELECT order_date - CAST(isodow(order_date) - 1 AS INTEGER) AS monday, {REV} AS amount FROM clean_orders WHERE status = 'completed')""",
            """nth AS (
  SELECT monday, count(*) AS n, SUM(amount) AS exact, CAST(SUM(amount) AS DOUBLE) AS approx, row_number() OVER (ORDER BY monday) AS i
  FROM sold GROUP BY monday)""",
        )
        + """SELECT CAST(t.monday AS DATE) AS week_start, CAST(t.n AS BIGINT) AS order_count, CAST(ROUND(t.exact, 2) AS DOUBLE) AS revenue,
       b.approx AS prev_week_revenue,
       sign((t.approx - b.approx) / b.approx * 100.0) * CAST(floor(abs((t.approx - b.approx) / b.approx * 100.0) * 100 + 0.5) AS DOUBLE) / 100.0 AS growth_percentage
FROM nth t LEFT JOIN nth b ON b.i + 1 = t.i""",
        "quarantine_by_date": _quar(
            "SELECT CAST(quarantine_timestamp AS DATE) AS quarantine_date, CAST(count(*) AS BIGINT) AS quarantined_count "
            "FROM quarantine_orders GROUP BY 1 ORDER BY quarantine_date DESC"
        ),
        "quarantine_issues": _quar(
            """SELECT issue_type, CAST(count(*) AS BIGINT) AS occurrence_count FROM (
  SELECT CASE WHEN order_id IS NULL THEN 'Missing Order ID'
              WHEN customer_id IS NULL THEN 'Missing Customer ID'
              WHEN TRY_CAST(price AS DECIMAL(38,0)) < 0 THEN 'Negative Price'
              WHEN TRY_CAST(quantity AS INTEGER) <= 0 THEN 'Invalid Quantity'
              ELSE 'Other Issue' END AS issue_type
  FROM quarantine_orders) GROUP BY issue_type ORDER BY occurrence_count DESC, issue_type"""
        ),
        "partition_share": _clean(
            f"SELECT year, month, CAST(count(*) AS BIGINT) AS record_count, {hu('count(*) * 100', 'SUM(count(*)) OVER ()')} AS percentage_of_total "
            "FROM clean_orders GROUP BY year, month ORDER BY year DESC, month DESC"
        ),
        "stale_partitions": _clean(
            f"SELECT year, month, day, CAST(count(*) AS BIGINT) AS record_count, MAX(order_date) AS latest_order_date, "
            f"CAST(datediff('day', MAX(order_date), {AS_OF}) AS INTEGER) AS days_old FROM clean_orders "
            f"GROUP BY year, month, day HAVING datediff('day', MAX(order_date), {AS_OF}) > 365 "
            "ORDER BY days_old DESC, year, month, day"
        ),
        # every customer has the best of the tiers whose minima they reach
        "customer_segments": _with(
            CLEAN_CTE,
            "tiers(place, name, orders, spent) AS (VALUES (1, 'VIP', 10, 1000), (2, 'Loyal', 5, 500), (3, 'Regular', 2, NULL), (4, 'New', NULL, NULL))",
            f"buyers AS (SELECT customer_id AS who, count(*) AS n, SUM({REV}) AS paid FROM clean_orders WHERE status = 'completed' GROUP BY ALL)",
            """placed AS (
  SELECT who, n, paid, arg_min(name, place) AS tier
  FROM buyers JOIN tiers ON (orders IS NULL OR n >= orders) AND (spent IS NULL OR paid >= spent) GROUP BY who, n, paid)""",
        )
        + f"""SELECT tier AS customer_segment, CAST(count(*) AS BIGINT) AS customer_count,
       {hu(cents('SUM(paid)'), 'count(paid) * 100')} AS avg_lifetime_value, {hu('SUM(n)', 'count(n)')} AS avg_orders_per_customer
FROM placed GROUP BY tier""",
        # a customer with x rows of one product and y of another has x * y pairs of rows
        "product_affinity": _with(
            CLEAN_CTE,
            "held AS (SELECT customer_id AS who, product_name AS what, count(*) AS n FROM clean_orders GROUP BY customer_id, product_name)",
            "met AS (SELECT x.what AS product_a, y.what AS product_b, SUM(x.n * y.n) AS pairs FROM held x, held y WHERE x.who = y.who AND x.what < y.what GROUP BY ALL)",
        )
        + "SELECT product_a, product_b, CAST(pairs AS BIGINT) AS co_occurrence_count FROM met WHERE pairs >= 2 ORDER BY pairs DESC, product_a, product_b LIMIT 20",
        "daily_sales_summary": _with(
            CLEAN_CTE,
            f"sold AS (SELECT order_date, region, order_id, customer_id, quantity, {REV} AS amount FROM clean_orders WHERE status = 'completed')",
        )
        + f"""SELECT order_date, region, CAST(len(list_distinct(list(order_id))) AS BIGINT) AS total_orders,
       CAST(len(list_distinct(list(customer_id))) AS BIGINT) AS unique_customers, CAST(SUM(quantity) AS BIGINT) AS total_items,
       {money('SUM(amount)')} AS total_revenue, {hu(cents('SUM(amount)'), 'count(amount) * 100')} AS avg_order_value
FROM sold GROUP BY ALL ORDER BY order_date DESC, total_revenue DESC, region LIMIT 100""",
    }
)

ORACLE["conformed_rows"] = _quar(
    "SELECT order_id, customer_id, product_name, quantity, CAST(price AS DOUBLE) AS price, order_date, "
    "status, region, shipping_method FROM typed"
)
ORACLE["duplicate_rows"] = _quar(
    f"SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(_RAW_COLS)} FROM raw_orders)) AS BIGINT) "
    "AS duplicate_records FROM raw_orders"
)
# The safe widenings (old -> new).
_SAFE = "('int','bigint'), ('float','double'), ('smallint','int'), ('smallint','bigint'), ('int','double')"
ORACLE["batch_compatibility"] = _with(
    PIPELINE_CTES,
    "text_batch AS (SELECT CAST(_ingest_ts AS DATE) AS batch, "
    + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _RAW_COLS)
    + " FROM raw_orders)",
    "inferred AS (SELECT batch, " + ", ".join(f"{_infer_sql(c)} AS t_{c}" for c in _RAW_COLS) + " FROM text_batch GROUP BY batch)",
    "changes AS ("
    + " UNION ALL ".join(
        f"SELECT batch, '{t}' AS old_type, t_{c} AS new_type FROM inferred WHERE t_{c} <> '{t}'" for c, t in _REG_TYPES.items()
    )
    + ")",
) + f"""SELECT i.batch, CAST(count(c.batch) AS INTEGER) AS change_count,
       bool_and(c.batch IS NULL OR (c.old_type, c.new_type) IN ({_SAFE})) AS is_backward_compatible
FROM inferred i LEFT JOIN changes c ON c.batch = i.batch GROUP BY i.batch"""

# ---- header drift by day, rule types, balance ----------------------------------
_FEED = (
    f"feed AS ({FEED_SQL})",
    f"days AS (SELECT batch, kind, {_infer_sql('customer_id')} AS t_customer, {_infer_sql('total')} AS t_total FROM feed GROUP BY batch, kind)",
    """changes AS (
  SELECT batch, 'new_column' AS change_type, 'coupon' AS column_name, CAST(NULL AS VARCHAR) AS old_type, 'string' AS new_type FROM days WHERE kind = 2
  UNION ALL SELECT batch, 'missing_column', 'priority', 'string', NULL FROM days WHERE kind = 1
  UNION ALL SELECT batch, 'column_order_change', NULL, NULL, NULL FROM days WHERE kind = 3
  UNION ALL SELECT batch, 'datatype_change', 'customer_id', 'int', t_customer FROM days WHERE t_customer <> 'int'
  UNION ALL SELECT batch, 'datatype_change', 'total', 'double', t_total FROM days WHERE t_total <> 'double')""",
)
ORACLE["feed_drift"] = _with(*_FEED) + "SELECT * FROM changes"
ORACLE["feed_compatibility"] = _with(*_FEED) + f"""
SELECT d.batch, CAST(count(c.change_type) AS INTEGER) AS change_count,
       COALESCE(bool_and(c.change_type <> 'missing_column' AND (c.change_type <> 'datatype_change' OR (c.old_type, c.new_type) IN ({_SAFE}))), true) AS is_backward_compatible
FROM days d LEFT JOIN changes c ON c.batch = d.batch GROUP BY d.batch"""
# the same feed by month: landed CSV files, each with its own header
_LANDED = [x.replace("CAST(o_orderdate AS DATE) AS batch", "strftime(o_orderdate, '%Y-%m') AS batch").replace("day(o_orderdate)", "month(o_orderdate)") for x in _FEED]
ORACLE["landed_drift"] = _with(*_LANDED) + "SELECT * FROM changes"
ORACLE["landed_compatibility"] = ORACLE["feed_compatibility"].replace(_with(*_FEED), _with(*_LANDED))
ORACLE["validation_balance"] = _with(f"raw_orders AS ({RAW_ORDERS_SQL})") + """
SELECT CAST(count(*) AS BIGINT) AS total, CAST(count_if(ok) AS BIGINT) AS valid, CAST(count_if(NOT ok) AS BIGINT) AS invalid
FROM (SELECT COALESCE(quantity >= 1, false) AND row_number() OVER (
               PARTITION BY customer_id
               ORDER BY CASE WHEN _l_partkey % 3 <> 0 THEN _ingest_ts END NULLS LAST, _l_partkey, _l_suppkey, _l_shipdate,
                        _l_extendedprice, _l_quantity, _ingest_ts, order_id NULLS LAST) = 1 AS ok
      FROM raw_orders)"""
ORACLE["rule_types"] = _with(f"raw_orders AS ({RAW_ORDERS_SQL})") + " UNION ALL ".join(
    f"SELECT '{name}' AS rule_name, {column} AS column_name, count_if(NOT {ok}) = 0 AS passed, CAST(count_if(NOT {ok}) AS BIGINT) AS failed_count, "
    f"CAST(count(*) AS BIGINT) AS total_count, CAST(count_if(NOT {ok}) AS DOUBLE) / count(*) * 100.0 AS failure_percentage, '{severity}' AS severity FROM raw_orders"
    for name, column, severity, ok in (
        ("order_date_datatype", "'order_date'", "warning", "(TRY_CAST(order_date AS DATE) IS NOT NULL)"),
        ("order_id_pattern", "'order_id'", "info", "COALESCE(regexp_matches(order_id, '^[0-9]+-[1-3]$'), false)"),
        ("price_below_1500", "CAST(NULL AS VARCHAR)", "error", "COALESCE(price < 1500, false)"),
    )
) + " UNION ALL SELECT 'coupon_not_null', 'coupon', false, 0, 0, 0.0, 'error'"

# M4: quartiles by rank, the smallest value that at least a quarter, half, three quarters do not exceed
ORACLE["numeric_summary"] = _clean(
    """SELECT column_name, count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS stddev, min(x) AS min,
       min(x) FILTER (WHERE 4 * place >= n) AS p25, min(x) FILTER (WHERE 2 * place >= n) AS p50, min(x) FILTER (WHERE 4 * place >= 3 * n) AS p75, max(x) AS max
FROM (
  SELECT column_name, x, row_number() OVER (PARTITION BY column_name ORDER BY x) AS place, count(*) OVER (PARTITION BY column_name) AS n
  FROM (SELECT 'quantity' AS column_name, CAST(quantity AS DOUBLE) AS x FROM clean_orders UNION ALL SELECT 'price', CAST(price AS DOUBLE) FROM clean_orders)
  WHERE x IS NOT NULL
) GROUP BY column_name"""
)

# keys of one batch that the table before it holds
ORACLE["cross_batch_keys"] = """SELECT o_custkey IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) < 2001) AS held, count(*) AS orders, count(DISTINCT o_custkey) AS customers
FROM orders WHERE year(o_orderdate) = 2001 GROUP BY held"""

# a batch that raises every alert: failing rows, copies and missing cells
_DEFECTIVE = """
d AS (
  SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 4 ELSE 1 END AS copies, o_custkey % 5 = 0 AS no_customer, o_custkey % 3 = 0 AS no_priority,
         o_orderkey % 7 = 0 AND o_totalprice > 0 AS below
  FROM orders),
c AS (
  SELECT CAST(sum(copies) AS BIGINT) AS total_records, CAST(sum(CASE WHEN no_customer OR below THEN 0 ELSE copies END) AS BIGINT) AS valid_records,
         CAST(sum(CASE WHEN no_customer OR below THEN copies ELSE 0 END) AS BIGINT) AS invalid_records, CAST(sum(copies - 1) AS BIGINT) AS duplicate_records,
         CAST(sum(CASE WHEN no_customer THEN copies ELSE 0 END) AS BIGINT) AS null_customer_id, CAST(sum(CASE WHEN no_priority THEN copies ELSE 0 END) AS BIGINT) AS null_priority
  FROM d),
m AS (
  SELECT *, null_customer_id + null_priority AS total_null_cells, """ + hu(
    "valid_records * 160 + (total_records - duplicate_records) * 120 + (total_records * 4 - null_customer_id - null_priority) * 30", "total_records * 4"
) + """ AS data_quality_score FROM c)"""
ORACLE["defective_counts"] = _with(_DEFECTIVE) + "SELECT * FROM m"
ORACLE["defective_alerts"] = _with(_DEFECTIVE) + """
SELECT unnest(['INVALID_RECORDS_THRESHOLD_EXCEEDED', 'DUPLICATE_RECORDS_THRESHOLD_EXCEEDED', 'LOW_QUALITY_SCORE']) AS alert_type,
       unnest(['ERROR', 'WARNING', 'ERROR']) AS severity,
       unnest([CAST(invalid_records AS DOUBLE) / total_records * 100.0, CAST(duplicate_records AS DOUBLE) / total_records * 100.0, data_quality_score]) AS metric_value,
       unnest([5.0::DOUBLE, 2.0::DOUBLE, 85.0::DOUBLE]) AS threshold_value
FROM m"""

ORACLE["defective_digest"] = _with(_DEFECTIVE) + """
SELECT 'orders' AS table_name, 'Data Quality Alert - 2 Errors, 1 Warnings' AS subject,
       'Data Quality Alerts:' || repeat(chr(10), 2) || array_to_string([
         printf('[ERROR] INVALID_RECORDS_THRESHOLD_EXCEEDED' || chr(10) || '  Invalid records percentage (%.2f%%) exceeds threshold (5.0%%)', invalid_records / total_records * 100.0),
         printf('[WARNING] DUPLICATE_RECORDS_THRESHOLD_EXCEEDED' || chr(10) || '  Duplicate records percentage (%.2f%%) exceeds threshold (2.0%%)', duplicate_records / total_records * 100.0),
         '[ERROR] LOW_QUALITY_SCORE' || chr(10) || '  Data quality score (' || data_quality_score || ') is below threshold (85.0)'],
         chr(10) || '  Timestamp: 2001-08-01 00:00:00' || repeat(chr(10), 2)) || chr(10) || '  Timestamp: 2001-08-01 00:00:00' AS body
FROM m"""
ORACLE["defective_document"] = _with(_DEFECTIVE) + """
SELECT 'orders' AS table_name, 'order_id,customer_id,price,priority' AS columns, CAST(4 AS BIGINT) AS column_count,
       unnest(['customer_id_not_null', 'price_range', 'priority_not_null']) AS rule_name,
       unnest([null_customer_id, (SELECT CAST(SUM(CASE WHEN o_orderkey % 3 = 0 THEN 4 ELSE 1 END) AS BIGINT) FROM orders WHERE o_orderkey % 7 = 0), null_priority]) AS failed_count,
       total_records AS total_count, unnest(['error', 'error', 'warning']) AS severity
FROM m"""

# one incoming batch conformed: registered order, casts, the lost originals, with and without its new column
_INCOMING = """
SELECT 'O' || o_orderkey AS order_id, CAST(o_custkey AS INTEGER) AS customer_id, CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS total,
       CAST(o_orderdate AS DATE) AS order_date, CAST(NULL AS VARCHAR) AS priority,
       CASE WHEN o_orderkey % 11 = 0 THEN 'n/a' END AS lost_total, CASE WHEN o_orderkey % 13 = 0 THEN o_custkey || '.5' END AS lost_customer_id"""
ORACLE["evolved_rows"] = _INCOMING + ", CASE WHEN o_orderkey % 3 = 0 THEN 'SAVE' END AS coupon FROM orders"
ORACLE["matched_rows"] = _INCOMING + " FROM orders"
ORACLE["admitted_files"] = """
SELECT 'lake' AS bucket, 'raw/orders/' || o_orderkey || '/' || ['a.csv', 'B.Parquet', 'c d.json'][1 + o_orderkey % 6] AS key,
       CAST(o_orderkey % 4 * 100 AS BIGINT) AS size, strftime(o_orderdate, '%Y-%m-%d') AS event_time
FROM orders WHERE o_orderkey % 6 < 3 AND o_orderkey % 5 <> 0 AND o_orderkey % 17 <> 0 AND o_orderkey % 4 <> 0"""
