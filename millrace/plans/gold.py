"""Gold star schema: silver columns with the key set.

Two dimensions (customers, products) and two facts (orders, transactions). The filter is
not redundant: products, orders and transactions may carry a NULL id in silver.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COLUMNS = {
    "dim_customers": (
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "phone_number",
        "signup_date",
        "status",
    ),
    "dim_products": ("product_id", "product_name", "category", "unit_price", "supplier_code"),
    "fact_orders": ("order_id", "customer_id", "order_date", "total_amount", "status", "channel"),
    "fact_transactions": (
        "transaction_id",
        "order_id",
        "payment_method",
        "transaction_amount",
        "transaction_date",
        "success_flag",
    ),
}


def gold_table(name: str, silver: DataFrame) -> DataFrame:
    """The published columns; the first one is the primary key."""
    columns = COLUMNS[name]
    return silver.select(*columns).where(F.col(columns[0]).isNotNull())


def orders_by_status(fact_orders: DataFrame) -> DataFrame:
    """Orders and amount per conformed status."""
    return fact_orders.groupBy("status").agg(
        F.count("*").alias("orders"),
        F.count_if(F.col("total_amount").isNull()).alias("without_amount"),
        F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"),
        F.sum(F.col("total_amount").cast("decimal(18,2)")).cast("double").alias("amount"),
    )
