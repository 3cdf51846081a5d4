"""The query book (Q1-Q21) over the clean and quarantine tables.

Every function takes DataFrames (a partitioned table scan in production)
and returns a lazy DataFrame.  Conventions:

* revenue = ``price * quantity`` in exact decimals; totals are rounded with
  ``round(decimal, 2)``; averages and shares are rounded half-up on integers
  (``functions.rounding``), so the result is exact and engine-independent;
* top-k queries carry a unique tie-break after the ranking key;
* "today" is a parameter (``as_of``) so reports are reproducible;
* date-range filters also filter the partition columns (year, month) so the
  scan prunes partitions -- a filter on ``order_date`` alone cannot.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rounding import cents, half_up_ratio, half_up_signed, money

COMPLETED = "completed"
# Customer segments, first match wins -- (name, at least this
# many orders, at least this much spent; None = no bound).
SEGMENTS = (
    ("VIP", 10, 1000),
    ("Loyal", 5, 500),
    ("Regular", 2, None),
    ("New", None, None),
)


def _rev() -> Column:
    return F.col("price") * F.col("quantity")


def _distinct(col: str, approx: bool) -> Column:
    """COUNT(DISTINCT col); ``approx`` uses HyperLogLog++ (no Expand, one pass)."""
    return F.approx_count_distinct(col) if approx else F.count_distinct(col)


def _completed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == COMPLETED)


def _as_date(d: str | _dt.date) -> _dt.date:
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(d)


def since(df: DataFrame, start: _dt.date) -> DataFrame:
    """order_date >= start, plus the implied predicate on the partition columns."""
    cond = F.col("order_date") >= F.lit(start)
    if "year" in df.columns and "month" in df.columns:
        cond = cond & ((F.col("year") > start.year) | ((F.col("year") == start.year) & (F.col("month") >= start.month)))
    return df.filter(cond)


# Q1
def clean_count(clean: DataFrame) -> DataFrame:
    return clean.agg(F.count(F.lit(1)).alias("total_clean_records"))


# Q2
def count_by_day(clean: DataFrame) -> DataFrame:
    return (
        clean.groupBy("year", "month", "day")
        .agg(F.count(F.lit(1)).alias("record_count"))
        .orderBy(F.desc("year"), F.desc("month"), F.desc("day"))
    )


# Q3
def quarantine_count(quarantine: DataFrame) -> DataFrame:
    return quarantine.agg(F.count(F.lit(1)).alias("total_quarantined_records"))


# Q4
def quality_summary(clean: DataFrame, quarantine: DataFrame) -> DataFrame:
    a = clean.agg(F.count(F.lit(1)).alias("count")).select(F.lit("Clean Records").alias("category"), "count")
    b = quarantine.agg(F.count(F.lit(1)).alias("count")).select(F.lit("Quarantined Records").alias("category"), "count")
    return a.unionByName(b)


# Q5
def null_check(clean: DataFrame) -> DataFrame:
    return clean.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("order_id").isNull()).alias("null_order_id"),
        F.count_if(F.col("customer_id").isNull()).alias("null_customer_id"),
        F.count_if(F.col("price").isNull()).alias("null_price"),
        F.count_if(F.col("order_date").isNull()).alias("null_order_date"),
    )


# Q6
def duplicate_ids(clean: DataFrame) -> DataFrame:
    return (
        clean.groupBy("order_id")
        .agg(F.count(F.lit(1)).alias("occurrence_count"))
        .filter(F.col("occurrence_count") > 1)
        .orderBy(F.desc("occurrence_count"), F.asc("order_id"))
    )


# Q7
def revenue_by_day(clean: DataFrame, approx_distinct: bool = False) -> DataFrame:
    return (
        _completed(clean)
        .groupBy("order_date")
        .agg(
            _distinct("order_id", approx_distinct).alias("total_orders"),
            F.sum("quantity").cast("bigint").alias("total_items"),
            money(F.sum(_rev())).alias("total_revenue"),
        )
        .orderBy(F.desc("order_date"))
    )


def _avg_money(x: Column) -> Column:
    # cents / (100 * n) = the average in money units, rounded half-up to a cent
    return half_up_ratio(cents(F.sum(x)), F.count(x) * 100)


# Q8
def revenue_by_region(clean: DataFrame, approx_distinct: bool = False) -> DataFrame:
    return (
        _completed(clean)
        .groupBy("region")
        .agg(
            _distinct("order_id", approx_distinct).alias("total_orders"),
            _distinct("customer_id", approx_distinct).alias("unique_customers"),
            money(F.sum(_rev())).alias("total_revenue"),
            _avg_money(_rev()).alias("avg_order_value"),
        )
        .orderBy(F.desc("total_revenue"), F.asc("region"))
    )


# Q9
def top_products(clean: DataFrame, k: int = 10) -> DataFrame:
    return (
        _completed(clean)
        .groupBy("product_name")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum("quantity").cast("bigint").alias("total_quantity_sold"),
            money(F.sum(_rev())).alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"), F.asc("product_name"))
        .limit(k)
    )


def _share_of_total(count_col: str) -> Column:
    total = F.sum(F.col(count_col)).over(Window.partitionBy())
    return half_up_ratio(F.col(count_col) * 100, total)


# Q10
def status_share(clean: DataFrame) -> DataFrame:
    # The window runs over the aggregated rows (one per status), not over the data.
    return (
        clean.groupBy("status")
        .agg(F.count(F.lit(1)).alias("order_count"))
        .withColumn("percentage", _share_of_total("order_count"))
        .orderBy(F.desc("order_count"), F.asc("status"))
    )


# Q11a
def daily_trend_30d(clean: DataFrame, as_of: str | _dt.date, days: int = 30) -> DataFrame:
    start = _as_date(as_of) - _dt.timedelta(days=days)
    return (
        since(clean, start)
        .groupBy("order_date")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            money(F.sum(_rev())).alias("daily_revenue"),
            _avg_money(_rev()).alias("avg_order_value"),
        )
        .orderBy(F.desc("order_date"))
    )


# Q11b
def repeat_customers(clean: DataFrame, k: int = 20) -> DataFrame:
    return (
        clean.groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            money(F.sum(_rev())).alias("total_spent"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
        .filter(F.col("order_count") > 1)
        .orderBy(F.desc("order_count"), F.asc("customer_id"))
        .limit(k)
    )


# Q11c
def revenue_by_shipping(clean: DataFrame) -> DataFrame:
    return (
        _completed(clean)
        .groupBy("shipping_method")
        .agg(F.count(F.lit(1)).alias("order_count"), money(F.sum(_rev())).alias("total_revenue"))
        .select(
            F.coalesce(F.col("shipping_method"), F.lit("Not Specified")).alias("shipping_method"),
            "order_count",
            "total_revenue",
        )
        .orderBy(F.desc("total_revenue"), F.asc("shipping_method"))
    )


# Q12
def column_population(clean: DataFrame, column: str = "shipping_method") -> DataFrame:
    filled = F.count_if(F.col(column).isNotNull())
    total = F.count(F.lit(1))
    return clean.agg(
        total.alias("total_records"),
        filled.alias(f"records_with_{column}"),
        half_up_ratio(filled * 100, total).alias("percentage_populated"),
    )


# Q13
def monthly_revenue(clean: DataFrame, approx_distinct: bool = False) -> DataFrame:
    return (
        _completed(clean)
        .groupBy("year", "month")
        .agg(_distinct("order_id", approx_distinct).alias("total_orders"), money(F.sum(_rev())).alias("monthly_revenue"))
        .orderBy(F.desc("year"), F.desc("month"))
    )


# Q14
def week_over_week(clean: DataFrame) -> DataFrame:
    weekly = (
        _completed(clean)
        .groupBy(F.date_trunc("week", F.col("order_date")).cast("date").alias("week_start"))
        .agg(F.count(F.lit(1)).alias("order_count"), F.sum(_rev()).alias("revenue"))
    )
    # Window over the weekly rows (one per week), not over the data.
    w = Window.orderBy("week_start")
    prev = F.lag(F.col("revenue").cast("double")).over(w)
    cur = F.col("revenue").cast("double")
    return weekly.select(
        "week_start",
        "order_count",
        money(F.col("revenue")).alias("revenue"),
        prev.alias("prev_week_revenue"),
        half_up_signed((cur - prev) / prev * 100.0).alias("growth_percentage"),
    ).orderBy(F.desc("week_start"))


# Q15
def quarantine_by_date(quarantine: DataFrame) -> DataFrame:
    return (
        quarantine.groupBy(F.col("quarantine_timestamp").cast("date").alias("quarantine_date"))
        .agg(F.count(F.lit(1)).alias("quarantined_count"))
        .orderBy(F.desc("quarantine_date"))
    )


# Q16
def quarantine_issues(quarantine: DataFrame) -> DataFrame:
    # The issue labels, first match wins.
    issue = (
        F.when(F.col("order_id").isNull(), "Missing Order ID")
        .when(F.col("customer_id").isNull(), "Missing Customer ID")
        # a bare DECIMAL is (38,0): a price that rounds to 0 is not "negative"
        .when(F.col("price").try_cast("decimal(38,0)") < 0, "Negative Price")
        .when(F.col("quantity").try_cast("int") <= 0, "Invalid Quantity")
        .otherwise("Other Issue")
    )
    return (
        quarantine.groupBy(issue.alias("issue_type"))
        .agg(F.count(F.lit(1)).alias("occurrence_count"))
        .orderBy(F.desc("occurrence_count"), F.asc("issue_type"))
    )


# Q17
def partition_share(clean: DataFrame) -> DataFrame:
    return (
        clean.groupBy("year", "month")
        .agg(F.count(F.lit(1)).alias("record_count"))
        .withColumn("percentage_of_total", _share_of_total("record_count"))
        .orderBy(F.desc("year"), F.desc("month"))
    )


# Q18
def stale_partitions(clean: DataFrame, as_of: str | _dt.date, max_age_days: int = 365) -> DataFrame:
    today = F.lit(_as_date(as_of))
    return (
        clean.groupBy("year", "month", "day")
        .agg(F.count(F.lit(1)).alias("record_count"), F.max("order_date").alias("latest_order_date"))
        .withColumn("days_old", F.datediff(today, F.col("latest_order_date")))
        .filter(F.col("days_old") > max_age_days)
        .orderBy(F.desc("days_old"), F.asc("year"), F.asc("month"), F.asc("day"))
    )


# Q19
def customer_segments(clean: DataFrame, as_of: str | _dt.date) -> DataFrame:
    today = F.lit(_as_date(as_of))
    per_customer = (
        _completed(clean)
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum(_rev()).alias("total_spent"),
            F.max("order_date").alias("last_order_date"),
        )
        .withColumn("days_since_last_order", F.datediff(today, F.col("last_order_date")))
    )
    seg = F.lit(None).cast("string")
    for name, min_orders, min_spent in reversed(SEGMENTS):
        cond = F.lit(True)
        if min_orders is not None:
            cond = cond & (F.col("order_count") >= min_orders)
        if min_spent is not None:
            cond = cond & (F.col("total_spent") >= min_spent)
        seg = F.when(cond, F.lit(name)).otherwise(seg)
    return (
        per_customer.groupBy(seg.alias("customer_segment"))
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            half_up_ratio(cents(F.sum("total_spent")), F.count("total_spent") * 100).alias("avg_lifetime_value"),
            half_up_ratio(F.sum("order_count"), F.count("order_count")).alias("avg_orders_per_customer"),
        )
        .orderBy(F.desc("avg_lifetime_value"), F.asc("customer_segment"))
    )


# Q20
def product_affinity(clean: DataFrame, k: int = 20, min_count: int = 2, block_size: int = 256, seeds: int = 16) -> DataFrame:
    """Pairs of products bought by the same customer, counted over row pairs.

    count(a, b) = sum over customers of n(c, a) * n(c, b), so the rows are
    first reduced to distinct (customer, product) with their counts -- a
    customer holding a third of the rows becomes at most one row per product.

    Products that cannot reach the report leave before any pairing.  With
    mass(a) = sum over customers of n(c, a)^2, count(a, b) is at most
    sqrt(mass(a) * mass(b)) (Cauchy-Schwarz).  The pairs among the ``seeds``
    products of the largest mass are counted first; the k-th of them is a floor
    under the k-th of all pairs, and a pair bounded below that floor, or a
    product bounded below it beside the largest mass, is never formed.  Pairs
    equal to the floor stay, so ties are decided as without pruning.

    Customers with more than ``block_size`` products left get their products
    cut into hash blocks; block i meets block j (i <= j) in its own join key
    ``(customer, i, j)``, so no single task enumerates all pairs of a big
    customer.  The pair rows are summed map-side in the same stage.  Rows
    without a customer or a product belong to no pair.
    """
    named = clean.where(F.col("customer_id").isNotNull() & F.col("product_name").isNotNull())
    cp = named.groupBy("customer_id", "product_name").agg(F.count(F.lit(1)).alias("n"))
    mass = product_mass(cp)
    floor = affinity_floor(cp, mass, k, min_count, seeds)
    most = mass.agg(F.max("mass")).scalar()
    kept = cp.join(mass.where(reaches(F.col("mass"), most, floor)), "product_name")
    big = kept.groupBy("customer_id").agg(F.count(F.lit(1)).alias("products")).where(F.col("products") > block_size)
    blocks = F.coalesce(F.ceil(F.col("products") / F.lit(block_size)).cast("int"), F.lit(1))
    cpb = kept.join(big, "customer_id", "left").withColumn("nb", blocks).withColumn("blk", F.pmod(F.xxhash64("product_name"), F.col("nb")).cast("int"))
    left = cpb.select(
        "customer_id",
        F.col("blk").alias("i"),
        F.explode(F.sequence(F.col("blk"), F.col("nb") - 1)).alias("j"),
        F.col("product_name").alias("pa"),
        F.col("n").alias("na"),
        F.col("mass").alias("ma"),
    )
    right = cpb.select(
        "customer_id",
        F.explode(F.sequence(F.lit(0), F.col("blk"))).alias("i"),
        F.col("blk").alias("j"),
        F.col("product_name").alias("pb"),
        F.col("n").alias("nb_"),
        F.col("mass").alias("mb"),
    )
    once = (F.col("i") < F.col("j")) | (F.col("pa") < F.col("pb"))
    pairs = left.join(right, ["customer_id", "i", "j"]).where(once & reaches(F.col("ma"), F.col("mb"), floor))
    return (
        pairs.groupBy(F.least("pa", "pb").alias("product_a"), F.greatest("pa", "pb").alias("product_b"))
        .agg(F.sum(F.col("na") * F.col("nb_")).alias("co_occurrence_count"))
        .filter(F.col("co_occurrence_count") >= min_count)
        .orderBy(F.desc("co_occurrence_count"), F.asc("product_a"), F.asc("product_b"))
        .limit(k)
    )


def product_mass(cp: DataFrame) -> DataFrame:
    """Per product, the sum of its squared counts over customers (double: it only bounds)."""
    n = F.col("n").cast("double")
    return cp.groupBy("product_name").agg(F.sum(n * n).alias("mass"))


def affinity_floor(cp: DataFrame, mass: DataFrame, k: int, min_count: int, seeds: int) -> Column:
    """A count that the k-th pair of all reaches: the k-th among the pairs of the ``seeds`` heaviest products, at least ``min_count``.

    A customer holds at most ``seeds`` of them, so no group grows with the data.
    """
    heavy = mass.orderBy(F.desc("mass"), F.asc("product_name")).limit(seeds).select("product_name")
    held = cp.join(heavy, "product_name", "left_semi")
    left = held.select("customer_id", F.col("product_name").alias("pa"), F.col("n").alias("na"))
    right = held.select("customer_id", F.col("product_name").alias("pb"), F.col("n").alias("nb"))
    counts = left.join(right, "customer_id").where("pa < pb").groupBy("pa", "pb").agg(F.sum(F.col("na") * F.col("nb")).alias("c"))
    best = counts.orderBy(F.desc("c")).limit(k)
    kth = best.agg(F.when(F.count(F.lit(1)) == k, F.min("c")).alias("kth"))
    return F.greatest(F.coalesce(kth.scalar(), F.lit(0)), F.lit(min_count)).cast("double")


def reaches(a: Column, b: Column, floor: Column) -> Column:
    """Whether two masses allow a count of ``floor`` (with room for the rounding of double sums)."""
    return a * b * F.lit(1 + 1e-6) >= floor * floor


# Q21 (the view S19 and its read-back)
def daily_sales_summary_view(clean: DataFrame, approx_distinct: bool = False) -> DataFrame:
    return (
        _completed(clean)
        .groupBy("order_date", "region")
        .agg(
            _distinct("order_id", approx_distinct).alias("total_orders"),
            _distinct("customer_id", approx_distinct).alias("unique_customers"),
            F.sum("quantity").cast("bigint").alias("total_items"),
            money(F.sum(_rev())).alias("total_revenue"),
            _avg_money(_rev()).alias("avg_order_value"),
        )
    )


def daily_sales_summary(clean: DataFrame, k: int = 100, approx_distinct: bool = False) -> DataFrame:
    return daily_sales_summary_view(clean, approx_distinct).orderBy(F.desc("order_date"), F.desc("total_revenue"), F.asc("region")).limit(k)
