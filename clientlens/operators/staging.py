"""Staging (Q7): typed, case-folded, key-filtered versions of the processed inputs.

``run_ts`` is one timestamp for the whole run, passed in by the caller, so
every ``_loaded_at`` of a run is identical.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientlens.functions.scalar import money, parse_date, parse_ts


def _loaded(run_ts: str):
    return F.lit(run_ts).cast("timestamp").alias("_loaded_at")


def stg_customers(customers: DataFrame, run_ts: str) -> DataFrame:
    """Customers keyed by id; duplicates stay (they are flagged, not removed)."""
    return (customers.filter(F.col("customer_id").isNotNull())
            .select("customer_id", "first_name", "last_name",
                    F.lower("email").alias("email"),
                    parse_date("signup_date").alias("signup_date"),
                    F.upper("loyalty_tier").alias("loyalty_tier"),
                    F.upper("state").alias("state"),
                    "is_likely_duplicate",
                    _loaded(run_ts)))


def stg_transactions(transactions: DataFrame, run_ts: str) -> DataFrame:
    """Clean transactions with money as decimal(18,2); non-positive amounts drop."""
    return (transactions
            .filter(F.col("transaction_id").isNotNull() & F.col("customer_id").isNotNull()
                    & (F.col("amount") > 0))
            .select("transaction_id", "customer_id",
                    money("amount").alias("amount"),
                    F.col("event_timestamp").cast("timestamp").alias("event_timestamp"),
                    F.lower("channel").alias("channel"),
                    money("rolling_90d_spend").alias("rolling_90d_spend"),
                    F.col("rolling_90d_txn_count").cast("bigint").alias("rolling_90d_txn_count"),
                    _loaded(run_ts)))


def stg_loyalty_events(events: DataFrame, run_ts: str) -> DataFrame:
    """Tier-change events; rows whose date does not parse are left out."""
    d = parse_date("event_date")
    return (events.filter(F.col("customer_id").isNotNull() & d.isNotNull())
            .select("customer_id",
                    F.lower("event_type").alias("event_type"),
                    F.upper("new_tier").alias("new_tier"),
                    d.alias("event_date"),
                    _loaded(run_ts)))


def stg_support_ticket_messages(messages: DataFrame, run_ts: str) -> DataFrame:
    """Flattened ticket messages with typed timestamps."""
    return (messages.filter(F.col("ticket_id").isNotNull() & F.col("customer_id").isNotNull())
            .select("ticket_id", "customer_id",
                    parse_ts(F.col("opened_at").cast("string")).alias("opened_at"),
                    F.lower("category").alias("category"),
                    F.lower("message_sender").alias("message_sender"),
                    "message_text",
                    parse_ts(F.col("message_sent_at").cast("string")).alias("message_sent_at"),
                    _loaded(run_ts)))
