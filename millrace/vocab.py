"""Fixed values.

Everything here has to equal the legacy exports and the published rules for results
to match: landing file names, source columns, accepted spellings, date formats,
rejection reasons, declared checks. Nothing here is computed.
"""

# Landing file per source.
SOURCE_FILES = {
    "customers": "customers_legacy_large.csv",
    "orders": "orders_legacy_large.csv",
    "transactions": "transactions_legacy_large.csv",
    "products": "products_legacy_large.csv",
}

# Column order per source; every column arrives as text.
SOURCE_COLUMNS = {
    "customers": ("customer_id", "full_name", "email", "phone_number", "signup_date", "status"),
    "orders": ("order_id", "customer_id", "order_date", "total_amount", "status", "channel"),
    "transactions": (
        "transaction_id",
        "order_id",
        "payment_method",
        "transaction_amount",
        "transaction_date",
        "success_flag",
    ),
    "products": ("product_id", "product_name", "category", "unit_price", "supplier_code"),
}

# Lineage columns appended to every landed row.
LINEAGE_COLUMNS = ("ingested_at", "source_file", "batch_id")

# Expected size of the legacy exports.
EXPECTED_ROWS = {"customers": 5000, "orders": 5000, "transactions": 5000, "products": 1000}

# Published table and primary key per source.
GOLD_TABLES = {
    "customers": "dim_customers",
    "products": "dim_products",
    "orders": "fact_orders",
    "transactions": "fact_transactions",
}
PRIMARY_KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "orders": "order_id",
    "transactions": "transaction_id",
}

# Accepted spellings (upper case, trimmed) and the value they conform to.
CUSTOMER_STATUS = {"ACTIVE": "Active", "ACT": "Active", "INACTIVE": "Inactive"}
ORDER_STATUS = {
    "COMPLETED": "Completed",
    "DONE": "Completed",
    "C": "Completed",
    "CANCELLED": "Cancelled",
    "CANCELED": "Cancelled",
    "PENDING": "Pending",
    "P": "Pending",
}
PAYMENT_METHOD = {
    "CARD": "Credit Card",
    "CC": "Credit Card",
    "CREDIT CARD": "Credit Card",
    "CASH": "Cash",
    "EFT": "EFT",
    "DEBIT CARD": "Debit Card",
}
SUCCESS_FLAG = {
    "Y": True,
    "YES": True,
    "1": True,
    "TRUE": True,
    "N": False,
    "NO": False,
    "0": False,
    "FALSE": False,
}

# Date formats, tried in this order.
CUSTOMER_DATE_FORMATS = ("%Y-%m-%d", "%d/%m/%Y", "%m-%d-%Y")
TRANSACTION_DATE_FORMATS = ("%Y-%m-%d", "%d/%m/%Y")
# Orders first read year-month-day with slashes turned into dashes, then these.
ORDER_SLASH_FORMATS = ("%d/%m/%Y", "%m/%d/%Y")

# Whole-string shapes an order date may have without being quarantined.
ORDER_DATE_SHAPES = (
    "[0-9]{4}-[0-9]{2}-[0-9]{2}",
    "[0-9]{4}/[0-9]{2}/[0-9]{2}",
    "[0-9]{2}/[0-9]{2}/[0-9]{4}",
)

# Rejection reasons, in rule order.
REASONS = {
    1: "Null or non-numeric customer_id",
    2: "Unparseable signup_date",
    3: "Unresolvable status value",
    4: "Null order_id",
    5: "Null customer_id",
    6: "Unparseable order_date",
    7: "Unresolvable order status",
    8: "Null transaction_id",
    9: "Unparseable or impossible transaction_date",
    10: "Unresolvable payment_method",
    11: "Unresolvable success_flag",
    12: "Null product_id",
    13: "Unparseable unit_price",
    14: "Null category",
}

# Columns that must not be null in the published tables.
MANDATORY_COLUMNS = {
    "dim_customers": ("customer_id", "first_name", "last_name"),
    "dim_products": ("product_id", "product_name"),
    "fact_orders": ("order_id", "customer_id"),
    "fact_transactions": ("transaction_id", "order_id"),
}

# Names of the four validation checks.
ROW_COUNT_CHECK = "Row count reconciliation"
DUPLICATE_CHECK = "Duplicate PK check"
NULL_CHECK = "Null check"
REFERENCE_CHECK = "Referential integrity"

# Declared column tests: table -> unique columns, not-null columns, (column, parent table).
DECLARED_CHECKS = {
    "silver_customers": {"unique": ("customer_id",), "not_null": ("customer_id",), "relationships": ()},
    "silver_orders": {
        "unique": ("order_id",),
        "not_null": ("order_id", "customer_id"),
        "relationships": (("customer_id", "silver_customers"),),
    },
    "silver_transactions": {
        "unique": ("transaction_id",),
        "not_null": ("transaction_id", "order_id"),
        "relationships": (("order_id", "silver_orders"),),
    },
    "silver_products": {"unique": ("product_id",), "not_null": ("product_id",), "relationships": ()},
    "dim_customers": {"unique": ("customer_id",), "not_null": ("customer_id",), "relationships": ()},
    "dim_products": {"unique": ("product_id",), "not_null": ("product_id",), "relationships": ()},
    "fact_orders": {"unique": ("order_id",), "not_null": ("order_id",), "relationships": ()},
    "fact_transactions": {
        "unique": ("transaction_id",),
        "not_null": ("transaction_id",),
        "relationships": (),
    },
}
