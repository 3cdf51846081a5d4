"""The orders dataset: registered schema, rule preset and the views over the
driver tables that the registered queries use."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import DateType, DecimalType, IntegerType, StringType, StructField, StructType

from ..operators.rules import orders_rules
from ..settings import TableSpec
from ..sources import driver_tables as dt
from .pipeline import Prepared, prepare

# The registered clean-table columns.
ORDERS_SCHEMA = StructType(
    [
        StructField("order_id", StringType()),
        StructField("customer_id", StringType()),
        StructField("product_name", StringType()),
        StructField("quantity", IntegerType()),
        StructField("price", DecimalType(10, 2)),
        StructField("order_date", DateType()),
        StructField("status", StringType()),
        StructField("region", StringType()),
        StructField("shipping_method", StringType()),
    ]
)

# Reports are run "as of" the last order date of the driver data.
AS_OF = _dt.date(2001, 8, 1)


def orders_spec(root: str) -> TableSpec:
    return TableSpec(name="orders", root=root, registered_schema=ORDERS_SCHEMA)


def raw_pipeline(spark: SparkSession, sf_dir: str) -> Prepared:
    """raw_orders -> conform to the registered schema -> orders rules.

    The lineage columns order "first occurrence" for UNIQUE and are unique per
    row, so no generated row id is needed (the join-derived input has no
    stable file order)."""
    raw = dt.raw_orders(spark, sf_dir)
    return prepare(raw, ORDERS_SCHEMA, orders_rules(dt.LINE_ORDER), mode="evolve", row_id=[])


def quarantine_orders(prepared: Prepared) -> DataFrame:
    q = prepared.quarantine(timestamp=F.col("_ingest_ts"), text_columns=("order_date",))
    d = F.col("order_date").try_cast("date")
    return q.withColumns({"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d)})


def clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dt.clean_orders(spark, sf_dir)
