"""Marts: SCD2 dimension (Q11), point-in-time facts (Q12, Q14) and the
per-customer feature table with its two flags (Q15-Q17)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientlens.functions.joins import by_merge
from clientlens.functions.scalar import (MONEY, day_diff, mode_key, money_avg_from,
                                         surrogate_key)
from clientlens.operators.scd2 import point_in_time_join

HIGH_VALUE_SPEND = 500
CHURN_SPEND = 1000
CHURN_RECENCY_DAYS = 60
NEVER_TRANSACTED_DAYS = 999


def _date(d: str):
    return F.lit(d).cast("date")


def customer_segment(age_days):
    """<=90 new, <=365 developing, else (and NULL) established."""
    return F.when(age_days <= 90, "new").when(age_days <= 365, "developing").otherwise("established")


def value_band(amount):
    return (F.when(amount >= 500, "high_value").when(amount >= 100, "mid_value")
            .otherwise("low_value"))


def resolution_speed(hours):
    return F.when(hours <= 24, "fast").when(hours <= 72, "standard").otherwise("slow")


def dim_customer(customers: DataFrame, history: DataFrame, as_of: str) -> DataFrame:
    """Q11: one row per customer version; versions of unknown customers drop."""
    c = customers.select("customer_id", "first_name", "last_name", "email", "state",
                         "signup_date", "is_likely_duplicate", "_loaded_at")
    age = day_diff(_date(as_of), F.col("signup_date"))
    return (history.join(by_merge(c), "customer_id", "inner")
            .select(surrogate_key("customer_id", "valid_from").alias("customer_sk"),
                    "customer_id", "first_name", "last_name", "email", "state", "signup_date",
                    "is_likely_duplicate", "loyalty_tier", "valid_from", "valid_to", "is_current",
                    "tier_sequence",
                    age.alias("customer_age_days"),
                    customer_segment(age).alias("customer_segment"),
                    "_loaded_at"))


VERSION_ATTRS = ["customer_sk", "loyalty_tier", "customer_segment", "state", "signup_date"]


def fact_transactions(transactions: DataFrame, dim: DataFrame, closed: str = "left") -> DataFrame:
    """Q12: transactions with the customer version valid at event time.

    ``closed='left'`` (default) gives each transaction at most one version;
    ``closed='both'`` reproduces BETWEEN semantics, where an event at
    midnight of a tier-change day meets both adjacent versions.
    """
    return transaction_rows(point_in_time_join(transactions, dim, "customer_id", "event_timestamp", VERSION_ATTRS, closed))


def transaction_rows(joined: DataFrame) -> DataFrame:
    """The columns of the transaction fact from transactions with their version."""
    return joined.select(
        "transaction_id", "customer_id", "customer_sk", "amount", "event_timestamp", "channel",
        "rolling_90d_spend", "rolling_90d_txn_count", "loyalty_tier", "customer_segment",
        "state", "signup_date",
        day_diff(F.col("event_timestamp"), F.col("signup_date")).alias("days_since_signup"),
        value_band(F.col("amount")).alias("transaction_value_band"),
        "_loaded_at")


def fact_support(tickets: DataFrame, dim: DataFrame, run_ts: str, closed: str = "left") -> DataFrame:
    """Q14: ticket roll-up with the customer version valid when it opened
    (``closed`` as in ``fact_transactions``)."""
    s = tickets.drop("loyalty_tier", "state", "signup_date")
    j = point_in_time_join(s, dim, "customer_id", "opened_at", VERSION_ATTRS, closed)
    return j.select(
        "ticket_id", "customer_id", "customer_sk", "opened_at", "category", "message_count",
        "resolution_hours", "agent_to_customer_ratio", "first_message_at", "last_message_at",
        "loyalty_tier", "customer_segment", "state", "signup_date",
        day_diff(F.col("opened_at"), F.col("signup_date")).alias("days_since_signup_at_ticket"),
        resolution_speed(F.col("resolution_hours")).alias("resolution_speed"),
        F.lit(run_ts).cast("timestamp").alias("_loaded_at"))


def window_start(as_of: str, days: int):
    """First day of a trailing window that ends on the as-of date."""
    return F.date_sub(_date(as_of), days)


def channel_measures(facts: DataFrame, as_of: str) -> DataFrame:
    """G6-G9 per (customer, channel): sums, counts and the newest time of the 30-day,
    90-day and lifetime windows. Combined map-side, so a hot customer is
    pre-aggregated before it moves."""
    ts, amt, tid = F.col("event_timestamp"), F.col("amount"), F.col("transaction_id")
    in30 = ts >= window_start(as_of, 30).cast("timestamp")
    in90 = ts >= window_start(as_of, 90).cast("timestamp")
    return facts.groupBy("customer_id", "channel").agg(
        F.sum(F.when(in30, amt)).alias("s30"), F.count(F.when(in30, amt)).alias("a30"),
        F.count(F.when(in30, tid)).alias("c30"),
        F.sum(F.when(in90, amt)).alias("s90"), F.count(F.when(in90, amt)).alias("a90"),
        F.count(F.when(in90, tid)).alias("c90"),
        F.count_if(in90).alias("r90"),
        F.sum(amt).alias("sl"), F.count(tid).alias("cl"), F.max(ts).alias("mx"))


def features_from_channels(per_channel: DataFrame, as_of: str) -> DataFrame:
    """The transaction features of each customer from ``channel_measures`` rows
    (at most one row per channel)."""
    r90 = F.col("r90")
    per_customer = per_channel.groupBy("customer_id").agg(
        *[F.sum(c).alias(c) for c in ("s30", "a30", "c30", "s90", "a90", "c90", "sl", "cl")],
        F.max("mx").alias("last_transaction_at"),
        F.min_by(F.col("channel"), F.when(r90 > 0, mode_key(r90, F.col("channel"))))
         .alias("most_used_channel_90d"))
    zero = F.lit(0)
    return per_customer.select(
        "customer_id",
        F.coalesce(F.col("s30"), zero).cast(MONEY).alias("total_spend_30d"),
        F.coalesce(F.col("c30"), zero).cast("bigint").alias("transaction_count_30d"),
        F.coalesce(money_avg_from(F.col("s30"), F.col("a30")), zero.cast(MONEY)).alias("avg_transaction_amount_30d"),
        F.coalesce(F.col("s90"), zero).cast(MONEY).alias("total_spend_90d"),
        F.coalesce(F.col("c90"), zero).cast("bigint").alias("transaction_count_90d"),
        F.coalesce(money_avg_from(F.col("s90"), F.col("a90")), zero.cast(MONEY)).alias("avg_transaction_amount_90d"),
        "most_used_channel_90d",
        F.coalesce(F.col("sl"), zero).cast(MONEY).alias("total_spend_lifetime"),
        F.coalesce(F.col("cl"), zero).cast("bigint").alias("transaction_count_lifetime"),
        "last_transaction_at",
        day_diff(_date(as_of), F.col("last_transaction_at")).alias("days_since_last_transaction"))


def transaction_features(facts: DataFrame, as_of: str) -> DataFrame:
    """30-day, 90-day and lifetime measures plus the 90-day channel
    mode, from one shuffle of the fact table."""
    return features_from_channels(channel_measures(facts, as_of), as_of)


def category_measures(support: DataFrame) -> DataFrame:
    """G10-G12 per (customer, category): tickets and resolution hours."""
    return support.groupBy("customer_id", "category").agg(
        F.count(F.lit(1)).alias("n"), F.count("ticket_id").alias("t"),
        F.sum("resolution_hours").alias("hs"), F.count("resolution_hours").alias("hn"))


def features_from_categories(per_cat: DataFrame) -> DataFrame:
    """The support features of each customer from ``category_measures`` rows."""
    return per_cat.groupBy("customer_id").agg(
        F.sum("t").alias("total_tickets_lifetime"),
        (F.sum("hs").cast("double") / F.sum("hn")).alias("avg_resolution_hours"),
        F.min_by(F.col("category"), mode_key(F.col("n"), F.col("category"))).alias("most_common_support_category"))


def support_features(support: DataFrame) -> DataFrame:
    """Ticket count, mean resolution hours and the category mode."""
    return features_from_categories(category_measures(support))


def feature_store_customer(dim: DataFrame, facts: DataFrame, support: DataFrame,
                           as_of: str, run_ts: str) -> DataFrame:
    """Q15-Q17: one row per current customer version.

    Missing measures become 0, missing recency 999 (never transacted), the
    two modes stay NULL. High value: lifetime spend > 500. Churn risk:
    recency > 60 days and lifetime spend > 1000.
    """
    return feature_rows(dim, transaction_features(facts, as_of), support_features(support), as_of, run_ts)


def feature_rows(dim: DataFrame, tx: DataFrame, sp: DataFrame, as_of: str, run_ts: str) -> DataFrame:
    """The feature table from the transaction and support features of each customer."""
    cur = (dim.filter(F.col("is_current"))
           .select("customer_id", "loyalty_tier", "customer_segment", "state", "signup_date",
                   "is_likely_duplicate"))
    j = cur.join(by_merge(tx), "customer_id", "left").join(by_merge(sp), "customer_id", "left")
    zero = F.lit(0)
    spend = F.coalesce(F.col("total_spend_lifetime"), zero.cast(MONEY))
    recency = F.coalesce(F.col("days_since_last_transaction"), F.lit(NEVER_TRANSACTED_DAYS).cast("bigint"))
    return j.select(
        "customer_id", "loyalty_tier", "customer_segment", "state", "signup_date",
        "is_likely_duplicate",
        day_diff(_date(as_of), F.col("signup_date")).alias("days_since_signup"),
        F.coalesce(F.col("total_spend_30d"), zero.cast(MONEY)).alias("total_spend_30d"),
        F.coalesce(F.col("transaction_count_30d"), zero.cast("bigint")).alias("transaction_count_30d"),
        F.coalesce(F.col("avg_transaction_amount_30d"), zero.cast(MONEY)).alias("avg_transaction_amount_30d"),
        F.coalesce(F.col("total_spend_90d"), zero.cast(MONEY)).alias("total_spend_90d"),
        F.coalesce(F.col("transaction_count_90d"), zero.cast("bigint")).alias("transaction_count_90d"),
        F.coalesce(F.col("avg_transaction_amount_90d"), zero.cast(MONEY)).alias("avg_transaction_amount_90d"),
        "most_used_channel_90d",
        spend.alias("total_spend_lifetime"),
        F.coalesce(F.col("transaction_count_lifetime"), zero.cast("bigint")).alias("transaction_count_lifetime"),
        "last_transaction_at",
        recency.alias("days_since_last_transaction"),
        F.coalesce(F.col("total_tickets_lifetime"), zero.cast("bigint")).alias("total_tickets_lifetime"),
        F.coalesce(F.col("avg_resolution_hours"), zero.cast("double")).alias("avg_resolution_hours"),
        "most_common_support_category",
        (spend > HIGH_VALUE_SPEND).alias("is_high_value_customer"),
        ((recency > CHURN_RECENCY_DAYS) & (spend > CHURN_SPEND)).alias("is_at_churn_risk"),
        F.lit(run_ts).cast("timestamp").alias("_loaded_at"))
