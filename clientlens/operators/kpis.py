"""KPI breakdowns over the marts (M1-M17). Each is one aggregation over a mart;
nothing is pulled to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientlens.functions.scalar import mean, money_avg, money_sum, mode_key, zero_safe_div


def customer_kpis(features: DataFrame) -> DataFrame:
    """M1."""
    return features.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if("is_high_value_customer").alias("high_value_customers"),
        F.count_if("is_at_churn_risk").alias("at_churn_risk"),
        mean("days_since_signup").alias("avg_days_since_signup"),
        money_avg("total_spend_lifetime").alias("avg_lifetime_spend"))


def customers_by(features: DataFrame, dim: str, with_risk: bool = False) -> DataFrame:
    """M2 (tier, with at-risk count) / M3 (segment)."""
    aggs = [F.count(F.lit(1)).alias("customer_count"),
            money_avg("total_spend_lifetime").alias("avg_lifetime_spend")]
    if with_risk:
        aggs.append(F.count_if("is_at_churn_risk").alias("at_risk_count"))
    return features.groupBy(dim).agg(*aggs)


def top_states(features: DataFrame, n: int = 15) -> DataFrame:
    """M4/O3: the n states with most customers (ties by state name)."""
    return (customers_by(features, "state")
            .orderBy(F.col("customer_count").desc(), F.col("state").asc()).limit(n))


def transaction_kpis(facts: DataFrame) -> DataFrame:
    """M5 + M6."""
    return facts.agg(
        money_sum("amount").alias("total_revenue"),
        money_avg("amount").alias("avg_transaction_value"),
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_distinct("customer_id").alias("unique_customers"))


def monthly_channel(facts: DataFrame, before_month: str | None = None,
                    channels: list[str] | None = None) -> DataFrame:
    """M7, with the M13 filters: drop months from ``before_month`` on (partial
    month) and keep only ``channels``. Filters apply before the aggregation."""
    month = F.date_format("event_timestamp", "yyyy-MM")
    f = facts
    if channels is not None:
        f = f.filter(F.col("channel").isin(channels))
    if before_month is not None:
        # month < 'yyyy-MM' is ts < the first instant of that month: a plain
        # comparison the Parquet scan can push down
        f = f.filter(F.col("event_timestamp") < F.to_timestamp(F.lit(before_month + "-01")))
    return (f.groupBy(month.alias("month"), "channel")
             .agg(money_sum("amount").alias("revenue"), F.count(F.lit(1)).alias("transaction_count")))


def revenue_by_tier(facts: DataFrame) -> DataFrame:
    """M8: tier at transaction time; transactions without a version are left out."""
    return (facts.filter(F.col("loyalty_tier").isNotNull()).groupBy("loyalty_tier")
            .agg(money_sum("amount").alias("total_revenue"),
                 money_avg("amount").alias("avg_transaction"),
                 F.count(F.lit(1)).alias("transaction_count")))


def revenue_by_band(facts: DataFrame) -> DataFrame:
    """M9."""
    return facts.groupBy("transaction_value_band").agg(
        F.count(F.lit(1)).alias("transaction_count"), money_sum("amount").alias("total_revenue"))


def support_kpis(support: DataFrame) -> DataFrame:
    """M10."""
    return support.agg(F.count(F.lit(1)).alias("total_tickets"),
                       mean("resolution_hours").alias("avg_resolution_hours"),
                       mean("message_count").alias("avg_messages"))


def support_by_category(support: DataFrame) -> DataFrame:
    """Categories by number of tickets, the most first (ties by name)."""
    return (support.groupBy("category").agg(F.count(F.lit(1)).alias("ticket_count"),
                                            mean("resolution_hours").alias("avg_resolution_hours"),
                                            mean("message_count").alias("avg_messages"))
            .orderBy(F.col("ticket_count").desc(), F.col("category").asc()))


def support_by_speed(support: DataFrame) -> DataFrame:
    """M11b."""
    return support.groupBy("resolution_speed").agg(F.count(F.lit(1)).alias("ticket_count"))


def churn_by_tier(features: DataFrame) -> DataFrame:
    """M12."""
    risk = F.col("is_at_churn_risk")
    spend = F.col("total_spend_lifetime")
    return features.groupBy("loyalty_tier").agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(risk).alias("at_risk_count"),
        money_avg(F.when(risk, spend)).alias("avg_spend_at_risk"),
        money_avg(F.when(~risk, spend)).alias("avg_spend_not_at_risk"),
        mean(F.when(risk, F.col("days_since_last_transaction"))).alias("avg_days_since_txn_at_risk"))


def churn_rollup(churn: DataFrame) -> DataFrame:
    """Roll-up over the tier rows of M12.

    The unweighted forms average the tier averages (one vote per tier); the
    weighted forms weight each tier by its at-risk count. Arg-max ties go to
    the alphabetically first tier.
    """
    n = F.col("at_risk_count")
    days = F.col("avg_days_since_txn_at_risk")
    spend = F.col("avg_spend_at_risk").cast("double")
    return churn.agg(
        F.sum(n).cast("bigint").alias("total_at_risk"),
        F.round(F.avg(days), 4).alias("avg_days_at_risk_unweighted"),
        F.round(F.sum(days * n) / F.sum(F.when(days.isNotNull(), n)), 4).alias("avg_days_at_risk_weighted"),
        F.min_by("loyalty_tier", mode_key(n, F.col("loyalty_tier"))).alias("highest_risk_tier"),
        F.round(F.avg(spend), 4).alias("avg_spend_at_risk_unweighted"),
        F.round(F.sum(spend * n) / F.sum(F.when(spend.isNotNull(), n)), 4).alias("avg_spend_at_risk_weighted"))


SEGMENT_LABELS = {"avg_spend_at_risk": "At Risk", "avg_spend_not_at_risk": "Not At Risk"}


def spend_by_risk_long(churn: DataFrame) -> DataFrame:
    """Unpivot the two spend averages to (tier, segment, avg_spend)."""
    long = churn.unpivot("loyalty_tier", list(SEGMENT_LABELS), "segment", "avg_spend")
    label = F.col("segment")
    for k, v in SEGMENT_LABELS.items():
        label = F.when(F.col("segment") == k, v).otherwise(label)
    return long.select("loyalty_tier", label.alias("segment"), "avg_spend")


def risk_rate_by_tier(churn: DataFrame) -> DataFrame:
    """Percent of a tier's customers at risk."""
    return churn.select("loyalty_tier",
                        (F.col("at_risk_count") * 100.0 / F.col("total_customers")).alias("risk_rate"))


def share_of_base(features: DataFrame, facts: DataFrame) -> DataFrame:
    """Percent of customers at risk and percent that transacted."""
    base = features.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_at_churn_risk").alias("r"))
    transacted = facts.agg(F.count_distinct("customer_id")).scalar()
    return base.select(
        zero_safe_div(F.col("r") * 100.0, "n").alias("pct_at_risk"),           # NULL for an empty base
        zero_safe_div(transacted * 100.0, "n").alias("pct_transacted"))
