"""Silver tables: typed, conformed, deduplicated or filtered to existing parents.

Quarantined rows are not removed here; quarantine is an audit copy. The raw key is tested
for NULL before typing, so a non-numeric key becomes a NULL id: customers drop it,
products keep one such row, orders and transactions keep all.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace import vocab
from millrace.functions import (
    blank_to_null,
    conform_lower,
    conform_text,
    first_name,
    last_name,
    map_values,
    parse_currency,
    parse_date,
    parse_order_date,
    sentence_case,
    to_double,
    to_id,
    to_int,
)
from millrace.operators.dedup import first_per_key
from millrace.operators.references import (
    keep_referenced,
    keep_stored_referenced,
    match_parent,
    match_stored_parent,
)


def _keyed(bronze: DataFrame, key: str) -> DataFrame:
    return bronze.where(F.col(key).isNotNull())


def typed_customers(bronze: DataFrame) -> DataFrame:
    """Typed rows with the raw key kept as `raw_key`, before deduplication."""
    rows = _keyed(bronze, "customer_id").select(
        to_id(F.col("customer_id")).alias("customer_id"),
        first_name(F.col("full_name")).alias("first_name"),
        last_name(F.col("full_name")).alias("last_name"),
        conform_lower(F.col("email")).alias("email"),
        conform_text(F.col("phone_number")).alias("phone_number"),
        parse_date(F.col("signup_date"), vocab.CUSTOMER_DATE_FORMATS).alias("signup_date"),
        map_values(F.col("status"), vocab.CUSTOMER_STATUS).alias("status"),
        F.col("customer_id").alias("raw_key"),
    )
    return rows.where(F.col("customer_id").isNotNull())


def silver_customers(bronze: DataFrame) -> DataFrame:
    return first_per_key(typed_customers(bronze), "customer_id", ["raw_key"]).drop("raw_key")


def customer_keys(bronze: DataFrame) -> DataFrame:
    """The key column of silver_customers, repeats included, without deduplicating rows."""
    return typed_customers(bronze).select("customer_id")


def typed_orders(bronze: DataFrame) -> DataFrame:
    return _keyed(bronze, "order_id").select(
        to_id(F.col("order_id")).alias("order_id"),
        to_id(F.col("customer_id")).alias("customer_id"),
        parse_order_date(F.col("order_date")).alias("order_date"),
        parse_currency(F.col("total_amount")).alias("total_amount"),
        map_values(F.col("status"), vocab.ORDER_STATUS).alias("status"),
        conform_lower(F.col("channel")).alias("channel"),
    )


def silver_orders(
    bronze: DataFrame, customers: DataFrame, unique_customers: bool = False, in_buckets: bool = False
) -> DataFrame:
    """Orders of existing customers; repeated order ids stay.

    `customers` needs `customer_id` only. Say `unique_customers` when it is the stored
    silver table, and `in_buckets` when that lies in buckets of the id.
    """
    if in_buckets:
        return keep_stored_referenced(typed_orders(bronze), customers, "customer_id")
    return keep_referenced(typed_orders(bronze), customers, "customer_id", unique_customers)


def typed_transactions(bronze: DataFrame) -> DataFrame:
    return _keyed(bronze, "transaction_id").select(
        to_id(F.col("transaction_id")).alias("transaction_id"),
        to_int(F.col("order_id")).alias("order_id"),
        map_values(F.col("payment_method"), vocab.PAYMENT_METHOD).alias("payment_method"),
        to_double(F.col("transaction_amount")).alias("transaction_amount"),
        parse_date(F.col("transaction_date"), vocab.TRANSACTION_DATE_FORMATS).alias(
            "transaction_date"
        ),
        map_values(F.col("success_flag"), vocab.SUCCESS_FLAG).alias("success_flag"),
    )


def silver_transactions(bronze: DataFrame, orders: DataFrame, mode: str = "inner") -> DataFrame:
    """Transactions of existing orders.

    Order ids may repeat: `inner` repeats the transaction per order row, `semi` keeps it
    once, `stored` does as `inner` with orders stored in buckets of the id. `orders` needs `order_id` only.
    """
    join = {"inner": match_parent, "semi": keep_referenced, "stored": match_stored_parent}[mode]
    return join(typed_transactions(bronze), orders, "order_id")


def typed_products(bronze: DataFrame) -> DataFrame:
    """Typed rows with the raw key kept as `raw_key`, before deduplication."""
    return _keyed(bronze, "product_id").select(
        to_id(F.col("product_id")).alias("product_id"),
        conform_text(F.col("product_name")).alias("product_name"),
        sentence_case(F.col("category")).alias("category"),
        to_double(F.col("unit_price")).alias("unit_price"),
        blank_to_null(F.col("supplier_code")).alias("supplier_code"),
        F.col("product_id").alias("raw_key"),
    )


def silver_products(bronze: DataFrame) -> DataFrame:
    return first_per_key(typed_products(bronze), "product_id", ["raw_key"]).drop("raw_key")
