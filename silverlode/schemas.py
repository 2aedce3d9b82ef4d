"""Declared schemas of the raw inputs.  Every field is nullable: raw data is
judged by the quality rules, not by the reader."""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "double": T.DoubleType(), "timestamp": T.TimestampType(), "binary": T.BinaryType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def struct(spec: str) -> T.StructType:
    """``"a string, b int"`` as a schema, without a running session."""
    fields = (field.split() for field in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# Field names and types of the three raw feeds.
TRANSACTIONS = struct(
    "transaction_id string, customer_id string, product_id string, "
    "transaction_date string, quantity int, unit_price double, "
    "total_amount double, discount double, final_amount double, "
    "payment_method string, status string, shipping_address string"
)

CUSTOMERS = struct(
    "customer_id string, customer_name string, email string, "
    "segment string, registration_date string, country string"
)

PRODUCTS = struct(
    "product_id string, product_name string, category string, "
    "price double, cost double, stock_quantity int"
)

RAW = {"transactions": TRANSACTIONS, "customers": CUSTOMERS, "products": PRODUCTS}

# Primary key of each entity, used by the merge into silver.
KEYS = {
    "transactions": ["transaction_id"],
    "customers": ["customer_id"],
    "products": ["product_id"],
}

# What an event bus delivers: opaque key and value plus the broker's timestamp.
ENVELOPE = struct("key binary, value binary, timestamp timestamp")
