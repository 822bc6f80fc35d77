"""Explicit raw-input schemas (no inference pass over the input)."""

from pyspark.sql.types import (ArrayType, DoubleType, StringType, StructField,
                               StructType)

CUSTOMERS = StructType([
    StructField("customer_id", StringType()),
    StructField("first_name", StringType()),
    StructField("last_name", StringType()),
    StructField("email", StringType()),
    StructField("signup_date", StringType()),
    StructField("loyalty_tier", StringType()),
    StructField("state", StringType()),
])

TRANSACTIONS = StructType([
    StructField("transaction_id", StringType()),
    StructField("customer_id", StringType()),
    StructField("amount", DoubleType()),
    StructField("timestamp", StringType()),   # raw text, parsed by the cleaning step
    StructField("channel", StringType()),
])

TICKET_MESSAGE = StructType([
    StructField("sender", StringType()),
    StructField("text", StringType()),
    StructField("sent_at", StringType()),
])

SUPPORT_TICKETS = StructType([
    StructField("ticket_id", StringType()),
    StructField("customer_id", StringType()),
    StructField("opened_at", StringType()),
    StructField("category", StringType()),
    StructField("messages", ArrayType(TICKET_MESSAGE)),
])

LOYALTY_EVENTS = StructType([
    StructField("customer_id", StringType()),
    StructField("event_type", StringType()),
    StructField("new_tier", StringType()),
    StructField("event_date", StringType()),
])

DUPLICATE_KEY = StructType([
    StructField("customer_id", StringType()),       # the injected copy
    StructField("is_duplicate_of", StringType()),   # the original
])

# Fixed domains of the categorical columns.
TIERS = ["BRONZE", "SILVER", "GOLD", "PLATINUM"]
CHANNELS = ["web", "mobile_app", "in_store", "call_center"]
CATEGORIES = ["billing", "loyalty_question", "product_issue", "shipping", "account_access"]
EVENT_TYPES = ["tier_upgrade", "tier_downgrade"]
