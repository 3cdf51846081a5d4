"""Orders views over the driver's TPC-H-like tables.

``clean_orders`` maps lineitem x orders x part x customer x nation x region
onto the orders data model.  ``raw_orders`` is the same join as an incoming
batch with planted defects computed from the keys, so every engine plants the
same ones.  Both are lazy DataFrames: Catalyst prunes columns down to the
scans and picks every join strategy by checked size (no broadcast hints).

Lineage columns are not business data: ``_ingest_ts`` is when the batch holding the row arrived (the day of the
order), and ``_l_*`` identify the source line so "first occurrence" orderings
are total.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lineage import SOURCE_LINE

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# Order status codes and their names.
STATUS_NAMES = {"F": "completed", "O": "pending", "P": "shipped"}
# Fixed value: the priority that means "no shipping method".
UNSPECIFIED_PRIORITY = "4-NOT SPECIFIED"

# Lineage columns that make the UNIQUE "first occurrence" order total.
LINE_ORDER = list(SOURCE_LINE)


# The columns of the driver tables used here (the same at every
# scale).  Declaring them spares every read a footer-inference job.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _status(code):
    expr = F.lit(None).cast("string")
    for k, v in reversed(list(STATUS_NAMES.items())):
        expr = F.when(code == k, F.lit(v)).otherwise(expr)
    return expr


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    p = table(spark, sf_dir, "part")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    # No broadcast hints: Catalyst broadcasts a side only when its measured
    # size is under spark.sql.autoBroadcastJoinThreshold (AQE re-checks with
    # runtime sizes) and sort-merge joins it otherwise.
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
    cust = c.select("c_custkey", "c_nationkey").join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
    # orders x customer first (the smaller sides), so the lineitem-sized
    # intermediate is shuffled twice (by order key, by part key), not three times.
    orders_geo = o.join(cust, o.o_custkey == cust.c_custkey)
    return li.join(orders_geo, li.l_orderkey == orders_geo.o_orderkey).join(p, li.l_partkey == p.p_partkey)


def clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _joined(spark, sf_dir)
    order_date = F.col("o_orderdate").cast("date")
    return j.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("p_name").alias("product_name"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        order_date.alias("order_date"),
        _status(F.col("o_orderstatus")).alias("status"),
        F.col("r_name").alias("region"),
        F.when(F.col("o_orderpriority") != UNSPECIFIED_PRIORITY, F.col("o_orderpriority")).alias("shipping_method"),
        F.year(order_date).alias("year"),
        F.month(order_date).alias("month"),
        F.dayofmonth(order_date).alias("day"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _joined(spark, sf_dir)
    ok, pk = F.col("l_orderkey"), F.col("l_partkey")
    return j.select(
        F.when(ok % 101 != 0, F.concat(ok.cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))).alias("order_id"),
        F.when(ok % 97 != 0, F.col("o_custkey").cast("string")).alias("customer_id"),
        F.col("p_name").alias("product_name"),
        F.when(ok % 53 == 0, F.lit(0)).otherwise(F.col("l_quantity").cast("int")).alias("quantity"),
        F.when(pk % 83 == 0, F.lit(None).cast("double"))
        .when(pk % 89 == 0, -F.col("p_retailprice"))
        .otherwise(F.col("p_retailprice"))
        .alias("price"),
        F.when(ok % 79 == 0, F.lit("invalid-date")).otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("order_date"),
        _status(F.col("o_orderstatus")).alias("status"),
        F.col("r_name").alias("region"),
        F.when(F.col("o_orderpriority") != UNSPECIFIED_PRIORITY, F.col("o_orderpriority")).alias("shipping_method"),
        F.col("o_orderdate").alias("_ingest_ts"),
        F.col("l_partkey").alias("_l_partkey"),
        F.col("l_suppkey").alias("_l_suppkey"),
        F.col("l_shipdate").alias("_l_shipdate"),
        F.col("l_extendedprice").alias("_l_extendedprice"),
        F.col("l_quantity").alias("_l_quantity"),
    )


# The registered schema of the daily order feed below.
FEED_SCHEMA = "order_id string, customer_id int, total double, order_date date, priority string"


def feed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily files of orders whose header drifts, as text cells ``(batch, position, column_name, value)``.

    The day of the month mod 6 says how: 1 has no priority, 2 a new coupon,
    3 total before customer_id, 4 customer ids beyond int, 5 a total that is
    text for some orders; 0 is as registered.
    """
    o = table(spark, sf_dir, "orders")
    batch = F.col("o_orderdate").cast("date")
    kind = F.dayofmonth(batch) % 6

    def cell(position, name, value):
        at = position if isinstance(position, Column) else F.lit(position)
        return F.struct(at.alias("position"), F.lit(name).alias("column_name"), value.cast("string").alias("value"))

    key, customer, total = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice").cast("string")
    cells = F.array_compact(
        F.array(
            cell(0, "order_id", F.concat(F.lit("O"), key.cast("string"))),
            cell(F.when(kind == 3, 2).otherwise(1), "customer_id", F.when(kind == 4, customer * 10_000_000_000).otherwise(customer)),
            cell(F.when(kind == 3, 1).otherwise(2), "total", F.when((kind == 5) & (key % 2 == 0), "n/a").otherwise(total)),
            cell(3, "order_date", batch),
            F.when(kind != 1, cell(4, "priority", F.col("o_orderpriority"))),
            F.when(kind == 2, cell(5, "coupon", F.when(key % 3 == 0, "SAVE"))),
        )
    )
    return o.select(batch.alias("batch"), F.inline(cells))


def land_feed(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The orders as monthly CSV files under ``path``, each kind of month with a header of its own.

    The month mod 6 says how, as the day does in ``feed_cells``; every file
    carries its own header line.
    """
    o = table(spark, sf_dir, "orders")
    kind = F.month("o_orderdate") % 6
    month = F.date_format("o_orderdate", "yyyy-MM").alias("batch")
    key, customer, total = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice").cast("string")
    cells = {
        "order_id": F.concat(F.lit("O"), key.cast("string")),
        "customer_id": F.when(kind == 4, customer * 10_000_000_000).otherwise(customer),
        "total": F.when((kind == 5) & (key % 2 == 0), "n/a").otherwise(total),
        "order_date": F.col("o_orderdate").cast("date"),
        "priority": F.col("o_orderpriority"),
        "coupon": F.when(key % 3 == 0, "SAVE"),
    }
    usual = ["order_id", "customer_id", "total", "order_date", "priority"]
    headers = {0: usual, 1: usual[:-1], 2: [*usual, "coupon"], 3: ["order_id", "total", "customer_id", "order_date", "priority"], 4: usual, 5: usual}
    for k, names in headers.items():
        rows = o.where(kind == k).select(month, *[cells[c].alias(c) for c in names])
        rows.repartition("batch").write.partitionBy("batch").option("header", True).csv(f"{path}/kind={k}")


def defective_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders with a fifth of the customers and a third of the priorities missing, every third order four times, and prices below zero: a batch that raises every alert."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    rows = o.select(
        key.cast("string").alias("order_id"),
        F.when(F.col("o_custkey") % 5 != 0, F.col("o_custkey")).alias("customer_id"),
        F.when(key % 7 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("price"),
        F.when(F.pmod(F.col("o_custkey"), F.lit(3)) != 0, F.col("o_orderpriority")).alias("priority"),
        F.when(key % 3 == 0, F.lit(4)).otherwise(F.lit(1)).alias("copies"),
    )
    return rows.select("order_id", "customer_id", "price", "priority", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("_copy")).drop("_copy")


def incoming_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch against ``FEED_SCHEMA``: another order, totals as text of which some are no number, no priority, a new coupon."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    return o.select(
        F.when(key % 11 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("total"),
        F.when(key % 3 == 0, F.lit("SAVE")).alias("coupon"),
        F.concat(F.lit("O"), key.cast("string")).alias("order_id"),
        F.col("o_orderdate").cast("date").cast("string").alias("order_date"),
        (F.col("o_custkey") + F.when(key % 13 == 0, 0.5).otherwise(0.0)).alias("customer_id"),
    )


def arrival_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One arrival event for each order, as the JSON text a notification brings; half of the objects are none to admit."""
    key = F.col("o_orderkey")
    name = F.element_at(F.array(*[F.lit(x) for x in ("a.csv", "B.Parquet", "c d.json", "e.txt", "_f.csv", ".g.csv")]), (key % 6 + 1).cast("int"))
    folder = F.when(key % 5 == 0, F.lit("other")).otherwise(F.lit("raw/orders"))
    record = F.struct(
        F.when(key % 17 == 0, F.lit("aws:sns")).otherwise(F.lit("aws:s3")).alias("eventSource"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("eventTime"),
        F.struct(
            F.struct(F.lit("lake").alias("name")).alias("bucket"),
            F.struct(F.concat(folder, F.lit("/"), key.cast("string"), F.lit("/"), F.replace(name, F.lit(" "), F.lit("+"))).alias("key"), (key % 4 * 100).alias("size")).alias("object"),
        ).alias("s3"),
    )
    return table(spark, sf_dir, "orders").select(F.to_json(F.struct(F.array(record).alias("Records"))).alias("event"))


# ---------------------------------------------------------------------------
# The same views as SQL text, for cross-engine checks (DuckDB dialect; the
# driver tables are registered under their own names).
# ---------------------------------------------------------------------------

_STATUS_SQL = (
    "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' "
    "WHEN 'P' THEN 'shipped' END"
)
_JOIN_SQL = """
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey"""

CLEAN_ORDERS_SQL = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
       CAST(o_custkey AS VARCHAR) AS customer_id,
       p_name AS product_name,
       CAST(l_quantity AS INTEGER) AS quantity,
       CAST(p_retailprice AS DECIMAL(10,2)) AS price,
       CAST(o_orderdate AS DATE) AS order_date,
       {_STATUS_SQL} AS status,
       r_name AS region,
       CASE WHEN o_orderpriority <> '{UNSPECIFIED_PRIORITY}' THEN o_orderpriority END AS shipping_method,
       CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(day(o_orderdate) AS INTEGER) AS day
{_JOIN_SQL}"""

RAW_ORDERS_SQL = f"""
SELECT CASE WHEN l_orderkey % 101 <> 0 THEN CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS order_id,
       CASE WHEN l_orderkey % 97 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
       p_name AS product_name,
       CASE WHEN l_orderkey % 53 = 0 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS quantity,
       CASE WHEN l_partkey % 83 = 0 THEN NULL WHEN l_partkey % 89 = 0 THEN -p_retailprice ELSE p_retailprice END AS price,
       CASE WHEN l_orderkey % 79 = 0 THEN 'invalid-date' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS order_date,
       {_STATUS_SQL} AS status,
       r_name AS region,
       CASE WHEN o_orderpriority <> '{UNSPECIFIED_PRIORITY}' THEN o_orderpriority END AS shipping_method,
       o_orderdate AS _ingest_ts,
       l_partkey AS _l_partkey, l_suppkey AS _l_suppkey, l_shipdate AS _l_shipdate,
       l_extendedprice AS _l_extendedprice, l_quantity AS _l_quantity
{_JOIN_SQL}"""

FEED_SQL = """
SELECT CAST(o_orderdate AS DATE) AS batch,
       day(o_orderdate) % 6 AS kind,
       CAST(CASE WHEN day(o_orderdate) % 6 = 4 THEN o_custkey * 10000000000 ELSE o_custkey END AS VARCHAR) AS customer_id,
       CASE WHEN day(o_orderdate) % 6 = 5 AND o_orderkey % 2 = 0 THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END AS total
  FROM orders"""
