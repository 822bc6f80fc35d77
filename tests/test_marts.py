"""Q8, Q10-Q17 thresholds and defaults on hand-made rows."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from clientlens.functions.scalar import hour_boundaries_between, money_avg
from clientlens.operators import intermediate, marts

AS_OF = "2024-06-30"
RUN_TS = "2024-06-30 06:00:00"


def test_hour_boundaries(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 59), datetime(2024, 1, 1, 1, 1)),
                                (datetime(2024, 1, 1, 1, 0), datetime(2024, 1, 1, 1, 59)),
                                (datetime(2024, 1, 1, 23, 30), datetime(2024, 1, 3, 0, 10))], "a timestamp, b timestamp")
    assert [r.h for r in df.select(hour_boundaries_between("a", "b").alias("h")).collect()] == [1, 0, 25]


def test_value_bands_speeds_segments_lifecycle(spark):
    amounts = spark.createDataFrame([(Decimal(x),) for x in ("99.99", "100.00", "499.99", "500.00")],
                                    "amount decimal(18,2)")
    assert [r.b for r in amounts.select(marts.value_band(F.col("amount")).alias("b")).collect()] == \
        ["low_value", "mid_value", "mid_value", "high_value"]
    hours = spark.createDataFrame([(24,), (25,), (72,), (73,), (None,)], "h bigint")
    assert [r.s for r in hours.select(marts.resolution_speed(F.col("h")).alias("s")).collect()] == \
        ["fast", "standard", "standard", "slow", "slow"]
    ages = spark.createDataFrame([(90,), (91,), (365,), (366,), (None,)], "d bigint")
    assert [r.s for r in ages.select(marts.customer_segment(F.col("d")).alias("s")).collect()] == \
        ["new", "developing", "developing", "established", "established"]
    assert [r.s for r in spark.createDataFrame([(30,), (31,), (180,), (181,), (None,)], "d bigint")
            .select(intermediate.lifecycle_stage(F.col("d")).alias("s")).collect()] == \
        ["new_customer", "early_customer", "early_customer", "established_customer", "established_customer"]


def test_money_avg_rounds_half_away_exactly(spark):
    df = spark.createDataFrame([(Decimal("0.01"),), (Decimal("0.02"),)], "a decimal(18,2)")
    assert df.agg(money_avg("a")).first()[0] == Decimal("0.02")     # 0.015 -> 0.02
    df = spark.createDataFrame([(Decimal("1.00"),), (Decimal("1.00"),), (Decimal("1.01"),)], "a decimal(18,2)")
    assert df.agg(money_avg("a")).first()[0] == Decimal("1.00")     # 1.00333


def _dim(spark):
    return spark.createDataFrame([
        ("never", "GOLD", "established", "TX", date(2020, 1, 1), False, True),
        ("c500", "GOLD", "established", "TX", date(2020, 1, 1), False, True),
        ("c1000", "GOLD", "established", "TX", date(2020, 1, 1), False, True),
        ("r60", "GOLD", "established", "TX", date(2020, 1, 1), False, True),
        ("r61", "GOLD", "established", "TX", date(2020, 1, 1), False, True),
        ("old", "BRONZE", "established", "TX", date(2020, 1, 1), False, False),
    ], "customer_id string, loyalty_tier string, customer_segment string, state string, signup_date date, "
       "is_likely_duplicate boolean, is_current boolean")


def _facts(spark):
    rows = [
        ("t1", "c500", Decimal("500.00"), datetime(2024, 6, 1), "web"),
        ("t2", "c1000", Decimal("1000.00"), datetime(2024, 1, 1), "web"),
        ("t3", "r60", Decimal("1000.01"), datetime(2024, 5, 1), "web"),          # 60 days before as_of
        ("t4", "r61", Decimal("1000.01"), datetime(2024, 4, 30, 23, 59), "web"),  # 61 days
        ("t5", "c500", Decimal("1.00"), datetime(2024, 7, 5), "mobile_app"),     # future-dated row counts
        ("t6", "c500", Decimal("2.00"), datetime(2024, 6, 2), "mobile_app"),     # channel tie -> mobile_app
    ]
    return spark.createDataFrame(rows, "transaction_id string, customer_id string, amount decimal(18,2), "
                                       "event_timestamp timestamp, channel string")


def _support(spark):
    return spark.createDataFrame([("k1", "c500", "billing", 10), ("k2", "c500", "shipping", 20),
                                  ("k3", "c500", "shipping", None)],
                                 "ticket_id string, customer_id string, category string, resolution_hours bigint")


def test_feature_store_defaults_and_flags(spark):
    f = {r.customer_id: r for r in marts.feature_store_customer(
        _dim(spark), _facts(spark), _support(spark), AS_OF, RUN_TS).collect()}
    assert set(f) == {"never", "c500", "c1000", "r60", "r61"}                    # current versions only
    n = f["never"]
    assert (n.days_since_last_transaction, n.total_spend_lifetime, n.is_at_churn_risk) == (999, Decimal("0.00"), False)
    assert n.most_used_channel_90d is None and n.most_common_support_category is None
    assert n.avg_resolution_hours == 0.0 and n.total_tickets_lifetime == 0
    assert f["c500"].is_high_value_customer is True                             # 503 > 500
    assert f["c500"].total_spend_lifetime == Decimal("503.00")
    assert f["c500"].days_since_last_transaction == -5                          # future row
    assert f["c500"].most_used_channel_90d == "mobile_app"                       # 2 vs 1
    assert f["c500"].transaction_count_30d == 3 and f["c500"].avg_transaction_amount_30d == Decimal("167.67")
    assert f["c500"].total_tickets_lifetime == 3 and f["c500"].avg_resolution_hours == 15.0
    assert f["c500"].most_common_support_category == "shipping"
    assert f["c1000"].is_high_value_customer and not f["c1000"].is_at_churn_risk  # exactly 1000: not > 1000
    assert not f["r60"].is_at_churn_risk and f["r60"].days_since_last_transaction == 60
    assert f["r61"].is_at_churn_risk and f["r61"].days_since_last_transaction == 61


def test_ticket_rollup_ratio(spark):
    msgs = spark.createDataFrame([
        ("k1", "c1", datetime(2024, 1, 1), "billing", "customer", datetime(2024, 1, 1, 0, 59)),
        ("k1", "c1", datetime(2024, 1, 1), "billing", "agent", datetime(2024, 1, 1, 1, 1)),
        ("k1", "c1", datetime(2024, 1, 1), "billing", "agent", datetime(2024, 1, 1, 1, 30)),
        ("k2", "c1", datetime(2024, 1, 1), "billing", "agent", datetime(2024, 1, 1, 3, 0)),
    ], "ticket_id string, customer_id string, opened_at timestamp, category string, message_sender string, "
       "message_sent_at timestamp")
    cust = spark.createDataFrame([("c1", "GOLD", "TX", date(2020, 1, 1))],
                                 "customer_id string, loyalty_tier string, state string, signup_date date")
    r = {x.ticket_id: x for x in intermediate.int_customer_support(msgs, cust).collect()}
    assert r["k1"].resolution_hours == 1 and r["k1"].agent_to_customer_ratio == 2.0
    assert r["k1"].message_count == 3 and r["k1"].customer_message_count == 1
    assert r["k2"].agent_to_customer_ratio is None and r["k2"].resolution_hours == 0


def test_enrichment_unknown_customer_and_zero_rolling_spend(spark):
    from clientlens.operators.intermediate import int_customer_transactions
    tx = spark.createDataFrame([
        ("t1", "c1", Decimal("10.00"), datetime(2024, 1, 31, 9), "web", Decimal("0.00"), 1, datetime(2024, 6, 1)),
        ("t2", "zz", Decimal("5.00"), datetime(2024, 1, 1), "web", Decimal("5.00"), 1, datetime(2024, 6, 1)),
    ], "transaction_id string, customer_id string, amount decimal(18,2), event_timestamp timestamp, "
       "channel string, rolling_90d_spend decimal(18,2), rolling_90d_txn_count bigint, _loaded_at timestamp")
    cust = spark.createDataFrame([("c1", "A", "B", "a@b", "GOLD", "CA", date(2024, 1, 1), False)],
                                 "customer_id string, first_name string, last_name string, email string, "
                                 "loyalty_tier string, state string, signup_date date, is_likely_duplicate boolean")
    got = {r.transaction_id: r for r in int_customer_transactions(tx, cust).collect()}
    assert got["t1"].pct_of_90d_spend is None                          # zero spend: no ratio
    assert got["t1"].days_since_signup == 30 and got["t1"].customer_lifecycle_stage == "new_customer"
    assert got["t2"].loyalty_tier is None and got["t2"].days_since_signup is None
    assert got["t2"].customer_lifecycle_stage == "established_customer"   # unknown: ELSE branch
    assert got["t2"].pct_of_90d_spend == 1.0


def test_dimension_drops_unknown_customers_and_keys_versions(spark):
    import hashlib

    from clientlens.operators.marts import dim_customer
    hist = spark.createDataFrame([("c1", "GOLD", date(2024, 1, 1), date(9999, 12, 31), 1, True),
                                  ("ghost", "GOLD", date(2024, 1, 1), date(9999, 12, 31), 1, True)],
                                 "customer_id string, loyalty_tier string, valid_from date, valid_to date, "
                                 "tier_sequence bigint, is_current boolean")
    cust = spark.createDataFrame([("c1", "A", "B", "a@b", "CA", date(2024, 5, 3), False, datetime(2024, 8, 1))],
                                 "customer_id string, first_name string, last_name string, email string, "
                                 "state string, signup_date date, is_likely_duplicate boolean, _loaded_at timestamp")
    rows = dim_customer(cust, hist, "2024-08-01").collect()
    assert [r.customer_id for r in rows] == ["c1"]
    r = rows[0]
    assert r.customer_sk == hashlib.md5(b"c1-2024-01-01").hexdigest()
    assert r.customer_age_days == 90 and r.customer_segment == "new"


def test_categories_are_sorted_by_tickets(spark):
    from clientlens.operators import kpis
    rows = [("b", 1, 2)] * 3 + [("c", 1, 2)] * 5 + [("a", 1, 2)] * 3 + [("d", None, 1)]
    df = spark.createDataFrame(rows, "category string, resolution_hours bigint, message_count bigint").repartition(4)
    assert [r.category for r in kpis.support_by_category(df).collect()] == ["c", "a", "b", "d"]
