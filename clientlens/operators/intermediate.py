"""Intermediate models: transaction enrichment (Q8) and ticket roll-up (Q10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientlens.functions.joins import by_merge
from clientlens.functions.scalar import day_diff, hour_boundaries_between, zero_safe_div


def lifecycle_stage(days):
    """<=30 new, <=180 early, else (and NULL) established."""
    return (F.when(days <= 30, "new_customer").when(days <= 180, "early_customer")
            .otherwise("established_customer"))


def int_customer_transactions(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Q8: staged transactions + current customer attributes + derived fields."""
    c = customers.select("customer_id", "first_name", "last_name", "email", "loyalty_tier",
                         "state", "signup_date", "is_likely_duplicate")
    j = transactions.join(by_merge(c), "customer_id", "left")
    days = day_diff(F.col("event_timestamp"), F.col("signup_date"))
    return j.select(
        "transaction_id", "customer_id", "amount", "event_timestamp", "channel",
        "rolling_90d_spend", "rolling_90d_txn_count",
        "first_name", "last_name", "email", "loyalty_tier", "state", "signup_date",
        "is_likely_duplicate",
        zero_safe_div("amount", "rolling_90d_spend").alias("pct_of_90d_spend"),
        days.alias("days_since_signup"),
        lifecycle_stage(days).alias("customer_lifecycle_stage"),
        "_loaded_at")


def ticket_summary(messages: DataFrame) -> DataFrame:
    """One row per ticket from its messages."""
    sender = F.col("message_sender")
    return (messages.groupBy("ticket_id", "customer_id", "opened_at", "category")
            .agg(F.count(F.lit(1)).alias("message_count"),
                 F.min("message_sent_at").alias("first_message_at"),
                 F.max("message_sent_at").alias("last_message_at"),
                 F.count_if(sender == "agent").alias("agent_message_count"),
                 F.count_if(sender == "customer").alias("customer_message_count"))
            .withColumn("resolution_hours",
                        hour_boundaries_between("first_message_at", "last_message_at")))


def int_customer_support(messages: DataFrame, customers: DataFrame) -> DataFrame:
    """Q10: ticket roll-up joined to customer attributes.

    ``resolution_hours`` counts hour boundaries from the first to the last
    *message* (not from ``opened_at``); the agent/customer ratio is rounded
    to 2 places and NULL when the customer wrote nothing.
    """
    s = ticket_summary(messages)
    c = customers.select("customer_id", "loyalty_tier", "state", "signup_date")
    return (s.join(by_merge(c), "customer_id", "left")
            .select("ticket_id", "customer_id", "opened_at", "category", "message_count",
                    "first_message_at", "last_message_at", "resolution_hours",
                    "agent_message_count", "customer_message_count",
                    F.round(zero_safe_div("agent_message_count", "customer_message_count"), 2)
                    .alias("agent_to_customer_ratio"),
                    "loyalty_tier", "state", "signup_date"))
