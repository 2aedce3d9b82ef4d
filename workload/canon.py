"""The driver's tables seen as customers, products, transactions and events.

Every frame below covers its whole table.  Text is made untidy on purpose, so that
standardising has something to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Order of rows of one transaction id that arrived at the same time.
TIES = ["product_id", "quantity", "total_amount", "discount"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def transactions(spark: SparkSession, sf: str) -> DataFrame:
    """One row per line item.  The order side is joined by a plain equi-join:
    adaptive execution picks broadcast or sort-merge from measured sizes."""
    items, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    total, share = F.col("l_extendedprice"), F.col("l_discount")
    status = (
        F.when(F.col("o_orderstatus") == "F", "  completed")
        .when(F.col("o_orderstatus") == "O", "Pending ")
        .otherwise("cancelled")
    )
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("transaction_date"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (total / F.col("l_quantity")).alias("unit_price"),
        total.alias("total_amount"),
        (total * share).alias("discount"),
        (total - total * share).alias("final_amount"),
        F.col("o_orderpriority").alias("payment_method"),
        status.alias("status"),
        F.col("l_returnflag").alias("shipping_address"),
        F.col("l_shipdate").cast("timestamp").alias("ingestion_timestamp"),
    )


def flawed_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows with every kind of flaw: a third has no customer, some amounts
    are negative, some quantities too small or missing, ids repeat."""
    return transactions(spark, sf).withColumns({
        "customer_id": F.when(F.col("shipping_address") != "N", F.col("customer_id")),
        "final_amount": F.col("final_amount") - 10000,
        "quantity": F.nullif(F.col("quantity") - 5, F.lit(20)).cast("double"),
    })


def customers(spark: SparkSession, sf: str) -> DataFrame:
    people, nations = table(spark, sf, "customer"), table(spark, sf, "nation")
    return people.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.concat(F.lit("  "), F.lower("c_name"), F.lit(" ")).alias("customer_name"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit("@Example.COM ")).alias("email"),
        F.concat(F.lower("c_mktsegment"), F.lit(" ")).alias("segment"),
        F.lit("2024-01-01").alias("registration_date"),
        F.lower("n_name").alias("country"),
        F.col("c_acctbal").alias("balance"),
    )


def products(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")).alias("product_name"),
        F.concat(F.lower("p_type"), F.lit(" ")).alias("category"),
        F.col("p_retailprice").alias("price"),
        (F.col("p_retailprice") * 0.61).alias("cost"),
        F.col("p_size").alias("stock_quantity"),
    )


def orders_as_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """One completed transaction per order, a thousandth of the price: the scale at
    which the customer scores spread."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.round(F.col("o_totalprice") / 1000, 2).alias("final_amount"),
        F.col("o_orderdate").cast("timestamp").alias("transaction_timestamp"),
        F.lit("COMPLETED").alias("status"),
    )


def envelope(events: DataFrame) -> DataFrame:
    """Events (batch or stream) as a bus would deliver them."""
    body = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("transaction_date"),
        F.col("value").alias("final_amount"),
        F.col("event_type").alias("status"),
    ))
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def plain_time(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the input files and DuckDB have them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c, t in df.dtypes if t == "timestamp"})
