"""Silver into gold: dimensions, sales summaries, customer segments, product
performance.

The builders are pure: frames in, frame out.  ``build_gold`` writes them.  Sales
are the completed transactions.  Metrics per customer and per product are each
needed by two tables; ``build_gold`` works them out once.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silverlode.functions import day_key, days_between, exact_avg, exact_sum
from silverlode.functions.time import clock
from silverlode.operators.merge import merge_by_key
from silverlode.operators.versioned import VersionedTable
from silverlode.session import Stage
from silverlode.sources.layers import TABLES, Layers

# Fixed value: status of a transaction that counts as a sale.
SALE = "COMPLETED"

# Fixed value: day range of the date dimension when there is no data to take it from.
DEFAULT_DAYS = (dt.date(2024, 1, 1), dt.date(2024, 12, 31))

STAMP = "gold_processed_timestamp"


def sales(transactions: DataFrame) -> DataFrame:
    return transactions.where(F.col("status") == SALE)


def stamped(df: DataFrame, now: dt.datetime | None) -> DataFrame:
    return df.withColumn(STAMP, clock(now))


# -- metrics -------------------------------------------------------------------

def customer_metrics(transactions: DataFrame) -> DataFrame:
    return sales(transactions).groupBy("customer_id").agg(
        exact_sum("final_amount").alias("total_revenue"),
        F.count("transaction_id").alias("total_transactions"),
        exact_avg("final_amount").alias("avg_transaction_value"),
        F.max("transaction_timestamp").alias("last_transaction_date"),
        F.min("transaction_timestamp").alias("first_transaction_date"),
    )


# What the summaries and metrics read of a transaction.
SALES_COLUMNS = ["transaction_id", "customer_id", "product_id", "transaction_timestamp", "final_amount", "quantity",
                 "discount", "profit", "status"]


def distinct_count(column: str, approximate: bool = False) -> Column:
    """Exact by default; the approximate count (2 % relative error) is a sketch that
    combines map-side, without a shuffle of distinct values."""
    return F.approx_count_distinct(column, 0.02) if approximate else F.count_distinct(column)


def product_metrics(transactions: DataFrame, approximate: bool = False) -> DataFrame:
    """A hot product is aggregated map-side; its buyers are first made distinct on
    (product, customer), which spreads them over all tasks."""
    return sales(transactions).groupBy("product_id").agg(
        exact_sum("final_amount").alias("total_revenue"),
        F.sum("quantity").alias("total_quantity_sold"),
        exact_sum("profit").alias("total_profit"),
        F.count("transaction_id").alias("total_transactions"),
        distinct_count("customer_id", approximate).alias("unique_customers"),
        exact_avg("final_amount").alias("avg_sale_price"),
        F.max("transaction_timestamp").alias("last_sale_date"),
        F.min("transaction_timestamp").alias("first_sale_date"),
    )


def _with_metrics(
    dimension: DataFrame, metrics: DataFrame | None, key: str, zero: dict[str, str], dates: list[str]
) -> DataFrame:
    """Attach metrics to every row of a dimension; no sales means zero, without a
    date.  Without any transactions table there are no date columns at all.

    Both sides have a row for every key; neither is broadcast, here or in the other joins of
    metrics with attributes, as Spark takes a few columns of compressed files for far less than they are."""
    if metrics is None:
        return dimension.withColumns({n: F.lit(0).cast(t) for n, t in zero.items()})
    joined = dimension.join(metrics.select(key, *zero, *dates).hint("merge"), key, "left")
    return joined.withColumns({n: F.coalesce(F.col(n), F.lit(0).cast(t)) for n, t in zero.items()})


# -- dimensions ----------------------------------------------------------------

def dim_customers(
    customers: DataFrame, metrics: DataFrame | None = None, now: dt.datetime | None = None
) -> DataFrame:
    out = _with_metrics(
        customers, metrics, "customer_id",
        {"total_revenue": "double", "total_transactions": "bigint", "avg_transaction_value": "double"},
        ["last_transaction_date", "first_transaction_date"])
    return stamped(out.withColumn("customer_lifetime_value", F.col("total_revenue")), now)


def dim_products(
    products: DataFrame, metrics: DataFrame | None = None, now: dt.datetime | None = None
) -> DataFrame:
    out = _with_metrics(
        products, metrics, "product_id",
        {"total_revenue": "double", "total_quantity_sold": "bigint",
         "total_transactions": "bigint", "avg_sale_price": "double"},
        ["last_sale_date"])
    return stamped(out, now)


def dim_dates(bounds: DataFrame) -> DataFrame:
    """One row per day, both ends included.  ``bounds`` is one row ``first_day,
    last_day``; the days are generated by Spark from it."""
    day = F.col("date")
    return bounds.select(
        F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("date")
    ).select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("week_number"),
        F.quarter(day).alias("quarter"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.when(F.weekday(day) < 5, 1).otherwise(0).alias("is_weekday"),
        day_key(day).alias("date_key"),
    )


def day_bounds(transactions: DataFrame) -> DataFrame:
    """First and last day of the transactions, or the default range."""
    event = F.to_date("transaction_timestamp")
    return transactions.agg(
        F.coalesce(F.min(event), F.lit(DEFAULT_DAYS[0])).alias("first_day"),
        F.coalesce(F.max(event), F.lit(DEFAULT_DAYS[1])).alias("last_day"),
    )


# -- sales summaries -----------------------------------------------------------

def _summary(
    transactions: DataFrame, period: dict[str, Column], extra: dict[str, Column], approximate: bool = False,
) -> DataFrame:
    """Sales per period.

    The two exact distinct counts share one scan: Spark expands the rows, makes
    them distinct on (period, customer) and (period, product) with map-side
    partials and only then counts, so one busy period is spread over many tasks.
    """
    dated = sales(transactions).withColumn("sale_date", F.to_date("transaction_timestamp"))
    metrics = {
        "transaction_count": F.count("transaction_id"),
        "unique_customers": distinct_count("customer_id", approximate),
        "unique_products": distinct_count("product_id", approximate),
        "total_revenue": exact_sum("final_amount"),
        "total_quantity_sold": F.sum("quantity"),
        "avg_transaction_value": exact_avg("final_amount"),
        "total_profit": exact_sum("profit"),
        **extra,
    }
    return dated.groupBy(*[c.alias(n) for n, c in period.items()]).agg(
        *[c.alias(n) for n, c in metrics.items()])


# Fixed value: binary logarithm of a sketch's registers; three standard errors are below 5 %.
SKETCH_BITS = 12
SKETCH_ERROR = 0.05


def daily_sketches(transactions: DataFrame) -> DataFrame:
    """Per day, sketches of its customers and products: a few kilobytes that stand for all ids, and
    that add up to any longer period, where distinct counts do not."""
    return sales(transactions).groupBy(F.to_date("transaction_timestamp").alias("sale_date")).agg(
        F.hll_sketch_agg("customer_id", SKETCH_BITS).alias("customers"), F.hll_sketch_agg("product_id", SKETCH_BITS).alias("products"))


def approximate_uniques(sketches: DataFrame, period: dict[str, Column]) -> DataFrame:
    """Distinct customers and products per period of days, from the days' sketches alone; each is
    within ``SKETCH_ERROR`` of the exact count with odds of 99.7 %."""
    return sketches.groupBy(*[c.alias(n) for n, c in period.items()]).agg(
        F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("unique_customers"),
        F.hll_sketch_estimate(F.hll_union_agg("products")).alias("unique_products"))


def daily_sales(
    transactions: DataFrame, now: dt.datetime | None = None, approximate: bool = False,
) -> DataFrame:
    day = F.col("sale_date")
    out = _summary(transactions, {"sale_date": day}, {
        "total_discount": exact_sum("discount"),
        "max_transaction_value": F.max("final_amount"),
        "min_transaction_value": F.min("final_amount"),
    }, approximate)
    return stamped(out.withColumns({
        "year": F.year(day), "month": F.month(day),
        "quarter": F.quarter(day), "week_number": F.weekofyear(day),
    }), now)


def weekly_sales(
    transactions: DataFrame, now: dt.datetime | None = None, approximate: bool = False,
) -> DataFrame:
    """By calendar year and ISO week, as the two columns say: the last days of
    December may be week 1 of their own calendar year."""
    day = F.col("sale_date")
    return stamped(_summary(
        transactions, {"year": F.year(day), "week_number": F.weekofyear(day)}, {}, approximate), now)


def monthly_sales(
    transactions: DataFrame, now: dt.datetime | None = None, approximate: bool = False,
) -> DataFrame:
    day = F.col("sale_date")
    return stamped(_summary(
        transactions, {"year": F.year(day), "month": F.month(day), "quarter": F.quarter(day)}, {}, approximate), now)


# -- customer segments ---------------------------------------------------------

# Limits for scores 5, 4, 3 and 2 (else 1).
RECENCY_LIMITS = (30, 60, 90, 180)
FREQUENCY_LIMITS = (20, 10, 5, 2)
MONETARY_LIMITS = (5000, 2000, 1000, 500)

# Segment by score, first match wins: name, then the condition on
# (recency, frequency, monetary).
SEGMENTS = (
    ("Champions", "recency_score >= 4 and frequency_score >= 4 and monetary_score >= 4"),
    ("Loyal Customers", "recency_score >= 3 and frequency_score >= 3 and monetary_score >= 3"),
    ("At Risk", "recency_score >= 4 and frequency_score <= 2"),
    ("Lost Customers", "recency_score <= 2 and frequency_score >= 3"),
    ("Potential Loyalists", "recency_score >= 3 and frequency_score <= 2"),
)
OTHER_SEGMENT = "Need Attention"


def _score(tests: list[Column]) -> Column:
    """5 for the first test that holds, then 4, 3, 2; 1 if none does."""
    return F.coalesce(*[F.when(t, 5 - i) for i, t in enumerate(tests)], F.lit(1))


def customer_segments(
    metrics: DataFrame, customers: DataFrame, as_of: dt.date | None = None,
    now: dt.datetime | None = None,
) -> DataFrame:
    """Recency, frequency and monetary scores per customer, and the segment they
    make.  Works on the per-customer metrics, so nothing large is shuffled twice.

    Columns the customers table does not have (segment, name) come out as NULL.
    """
    today = F.current_date() if as_of is None else F.lit(as_of)
    value, count, age = F.col("monetary_value"), F.col("frequency"), F.col("recency_days")
    scored = metrics.select(
        "customer_id",
        F.col("total_revenue").alias("monetary_value"),
        F.col("total_transactions").alias("frequency"),
        "last_transaction_date",
        days_between(today, F.col("last_transaction_date")).alias("recency_days"),
    ).withColumns({
        "recency_score": _score([age <= x for x in RECENCY_LIMITS]),
        "frequency_score": _score([count >= x for x in FREQUENCY_LIMITS]),
        "monetary_score": _score([value >= x for x in MONETARY_LIMITS]),
    })
    segment = F.coalesce(*[F.when(F.expr(test), F.lit(name)) for name, test in SEGMENTS],
                         F.lit(OTHER_SEGMENT))

    def attribute(name: str) -> Column:
        return F.col(name) if name in customers.columns else F.lit(None).cast("string")

    names = customers.select(
        "customer_id", attribute("customer_name").alias("customer_name"),
        attribute("segment").alias("original_segment"))
    return stamped(scored.withColumn("segment", segment).join(names.hint("merge"), "customer_id", "left"), now)


def product_performance(
    metrics: DataFrame, products: DataFrame, now: dt.datetime | None = None
) -> DataFrame:
    attributes = products.select("product_id", "product_name", "category", "price", "cost")
    margin = F.try_divide("total_profit", "total_revenue") * 100
    return stamped(
        metrics.join(attributes.hint("merge"), "product_id", "left").withColumn("profit_margin", margin), now)


# -- reports -------------------------------------------------------------------

def top_per_day(transactions: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` best-selling products or customers of each day, ties included.
    ``rank() <= k`` is pre-filtered in every task before the day's shuffle."""
    revenue = (
        sales(transactions)
        .groupBy(F.to_date("transaction_timestamp").alias("sale_date"), key)
        .agg(exact_sum("final_amount").alias("total_revenue"),
             F.count("transaction_id").alias("transaction_count"))
    )
    best_first = Window.partitionBy("sale_date").orderBy(F.col("total_revenue").desc())
    return revenue.withColumn("position", F.rank().over(best_first)).where(F.col("position") <= k)


def category_report(performance: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Revenue by category; with the products table also stock turnover (units sold
    per unit in stock)."""
    by = performance.groupBy("category").agg(
        exact_sum("total_revenue").alias("total_revenue"),
        F.sum("total_quantity_sold").alias("total_quantity_sold"),
        exact_sum("total_profit").alias("total_profit"),
        F.count(F.lit(1)).alias("product_count"),
    )
    if products is None:
        return by
    stock = products.groupBy("category").agg(F.sum("stock_quantity").alias("stock_quantity"))
    matched = by.join(stock.withColumnRenamed("category", "_c"), F.col("category").eqNullSafe(F.col("_c")), "left")
    return matched.drop("_c").withColumn(
        "stock_turnover", F.try_divide("total_quantity_sold", "stock_quantity"))


# -- writing -------------------------------------------------------------------

# Partition columns, sort order and (for merged tables) the key.
LAYOUT = {
    "dim_customers": {"keys": ["customer_id"]},
    "dim_products": {"keys": ["product_id"]},
    "dim_dates": {},
    "daily_sales_summary": {"partition_by": ["year", "month"], "newest": ["sale_date"]},
    "weekly_sales_summary": {"partition_by": ["year"], "newest": ["year", "week_number"]},
    "monthly_sales_summary": {"partition_by": ["year", "quarter"], "newest": ["year", "month"]},
    "customer_segments": {},
    "product_performance": {"partition_by": ["category"], "newest": ["total_revenue"]},
}


def write_gold(df: DataFrame, layers: Layers, name: str, now: dt.datetime | None = None) -> int:
    """Partitioned tables are gathered on their partition columns (a large value is
    cut, small ones are joined) and sorted inside each file; a global sort would add
    a shuffle that the partitioned layout makes pointless."""
    layout = LAYOUT[name]
    table = VersionedTable(df.sparkSession, layers.path("gold", name))
    if "keys" in layout:                      # rows of earlier runs whose key is gone stay
        old = table.read() if table.exists() else None
        return table.overwrite(merge_by_key(old, df, layout["keys"]), operation="MERGE", keys=layout["keys"], now=now)
    parts = layout.get("partition_by", [])
    if parts:
        df = df.hint("rebalance", *[F.col(c) for c in parts]).sortWithinPartitions(
            *parts, *[F.col(c).desc() for c in layout["newest"]])
    return table.overwrite(df, partition_by=parts, now=now)


def build_gold(
    spark: SparkSession, layers: Layers, as_of: dt.date | None = None,
    now: dt.datetime | None = None, optimize: bool = False,
) -> list[str]:
    """Write every gold table the silver layer has the inputs for."""
    def silver(name: str) -> DataFrame | None:
        table = VersionedTable(spark, layers.path("silver", name))
        return table.read() if table.exists() else None

    customers, products, transactions = (silver(n) for n in ("customers", "products", "transactions"))
    written = []

    def put(df: DataFrame, name: str) -> None:
        write_gold(df, layers, name, now)
        written.append(name)

    if transactions is None:
        if customers is not None:
            put(dim_customers(customers, now=now), "dim_customers")
        if products is not None:
            put(dim_products(products, now=now), "dim_products")
        first, last = DEFAULT_DAYS
        put(dim_dates(spark.range(1).select(F.lit(first).alias("first_day"), F.lit(last).alias("last_day"))),
            "dim_dates")
    else:
        put(dim_dates(day_bounds(transactions)), "dim_dates")
        # completed sales, their own columns only, once: all that follows reads these
        with Stage(sales(transactions).select(*SALES_COLUMNS), "sales") as staged:
            put(daily_sales(staged.read(), now), "daily_sales_summary")
            put(weekly_sales(staged.read(), now), "weekly_sales_summary")
            put(monthly_sales(staged.read(), now), "monthly_sales_summary")
            if customers is not None:
                with Stage(customer_metrics(staged.read()), "customer-metrics") as stage:
                    put(dim_customers(customers, stage.read(), now), "dim_customers")
                    put(customer_segments(stage.read(), customers, as_of, now), "customer_segments")
            if products is not None:
                with Stage(product_metrics(staged.read()), "product-metrics") as stage:
                    put(dim_products(products, stage.read(), now), "dim_products")
                    put(product_performance(stage.read(), products, now), "product_performance")
    if optimize:
        from silverlode.plans.upkeep import compact_tables
        compact_tables(spark, layers, {"gold": TABLES["gold"]}, now=now)
    return written
