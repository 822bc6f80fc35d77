"""Q9 tier history and the point-in-time join."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clientlens.operators import scd2
from clientlens.operators.scd2 import point_in_time_join, tier_history

CUST = "customer_id string, loyalty_tier string, signup_date date"
EV = "customer_id string, event_type string, new_tier string, event_date date"


def test_history_zero_one_three_events_and_ties(spark):
    customers = spark.createDataFrame([("c0", "BRONZE", date(2020, 1, 1)), ("c1", "GOLD", date(2020, 1, 1)),
                                       ("c3", "SILVER", date(2020, 1, 1)), ("c9", "GOLD", date(2020, 1, 1))], CUST)
    events = spark.createDataFrame([
        ("c1", "tier_upgrade", "GOLD", date(2021, 1, 1)),
        ("c3", "tier_upgrade", "GOLD", date(2021, 1, 1)),
        ("c3", "tier_downgrade", "SILVER", date(2021, 6, 1)),
        ("c3", "tier_upgrade", "PLATINUM", date(2022, 1, 1)),
        ("c9", "tier_upgrade", "PLATINUM", date(2021, 1, 1)),   # same-date tie: ordered by type, tier
        ("c9", "tier_downgrade", "SILVER", date(2021, 1, 1)),
        ("cx", "tier_upgrade", "GOLD", date(2021, 1, 1)),        # unknown customer: kept here, dropped by dim
    ], EV)
    h = {(r.customer_id, r.tier_sequence): r for r in tier_history(customers, events).collect()}
    assert h[("c0", 1)].valid_from == date(2020, 1, 1) and h[("c0", 1)].is_current
    assert h[("c0", 1)].valid_to == date(9999, 12, 31)
    assert h[("c1", 1)].valid_from == date(2021, 1, 1) and h[("c1", 1)].is_current
    assert [h[("c3", i)].valid_to for i in (1, 2, 3)] == [date(2021, 6, 1), date(2022, 1, 1), date(9999, 12, 31)]
    assert [h[("c3", i)].is_current for i in (1, 2, 3)] == [False, False, True]
    assert h[("c9", 1)].loyalty_tier == "SILVER" and h[("c9", 1)].valid_to == date(2021, 1, 1)
    assert h[("c9", 2)].loyalty_tier == "PLATINUM" and h[("c9", 2)].is_current
    assert ("cx", 1) in h


def test_history_expands_repeated_events_in_chunks(spark):
    customers = spark.createDataFrame([("c", "GOLD", date(2020, 1, 1))], CUST)
    rows = [("c", "tier_upgrade", "GOLD", date(2021, 1, 1))] * 7 + [("c", "tier_upgrade", "GOLD", date(2021, 2, 1))]
    events = spark.createDataFrame(rows, EV)
    h = sorted(tier_history(customers, events, chunk_rows=3).collect(), key=lambda r: r.tier_sequence)
    assert [r.tier_sequence for r in h] == list(range(1, 9))
    assert [r.valid_to for r in h[:7]] == [date(2021, 1, 1)] * 6 + [date(2021, 2, 1)]
    assert [r.is_current for r in h] == [False] * 7 + [True]


VERS = "customer_id string, valid_from date, valid_to date, tag string"
FACT = "fid string, customer_id string, ts timestamp"


def test_point_in_time_boundaries(spark):
    versions = spark.createDataFrame([("c", date(2021, 1, 1), date(2021, 6, 1), "v1"),
                                      ("c", date(2021, 6, 1), date(9999, 12, 31), "v2")], VERS)
    facts = spark.createDataFrame([("before", "c", datetime(2020, 12, 31, 23)),
                                   ("midnight", "c", datetime(2021, 6, 1)),
                                   ("inside", "c", datetime(2021, 3, 1, 5)),
                                   ("late", "c", datetime(2030, 1, 1)),
                                   ("unknown", "z", datetime(2021, 3, 1))], FACT)
    both = point_in_time_join(facts, versions, "customer_id", "ts", ["tag"], "both").collect()
    left = point_in_time_join(facts, versions, "customer_id", "ts", ["tag"], "left").collect()
    tags = lambda rows, f: sorted(str(r.tag) for r in rows if r.fid == f)
    assert tags(both, "before") == ["None"] and tags(both, "unknown") == ["None"]
    assert tags(both, "midnight") == ["v1", "v2"] and tags(left, "midnight") == ["v2"]
    assert tags(left, "inside") == ["v1"] and tags(left, "late") == ["v2"]
    assert len(left) == 5 and len(both) == 6


def test_versions_meet_only_the_years_of_their_facts(spark):
    versions = spark.createDataFrame([("c", date(2021, 1, 1), date(9999, 12, 31), "v1"),
                                      ("d", date(2021, 1, 1), date(9999, 12, 31), "v2")], VERS)
    facts = spark.createDataFrame([("far", "c", datetime(9999, 6, 1)), ("now", "c", datetime(2022, 6, 1))], FACT)
    years = scd2._fact_years(facts, "customer_id", "ts")
    by_year = scd2._by_year(versions, years, "customer_id", "valid_from", "valid_to", ["tag"])
    assert sorted((r.tag, r._vy) for r in by_year.collect()) == [("v1", 2022), ("v1", 9999)]
    got = point_in_time_join(facts, versions, "customer_id", "ts", ["tag"]).collect()
    assert sorted((r.fid, r.tag) for r in got) == [("far", "v1"), ("now", "v1")]
    none = facts.limit(0)
    assert scd2._by_year(versions, scd2._fact_years(none, "customer_id", "ts"), "customer_id", "valid_from",
                         "valid_to", ["tag"]).count() == 0
    assert point_in_time_join(none, versions, "customer_id", "ts", ["tag"]).count() == 0


def test_point_in_time_equals_range_join(spark):
    rnd = random.Random(11)
    vrows, frows = [], []
    for c in range(20):
        d = date(2015, 1, 1) + timedelta(days=rnd.randint(0, 400))
        for _ in range(rnd.randint(1, 6)):
            nd = d + timedelta(days=rnd.randint(1, 500))
            vrows.append((f"c{c}", d, nd, f"{c}-{d}"))
            d = nd
        vrows.append((f"c{c}", d, date(9999, 12, 31), f"{c}-{d}"))
    for i in range(2000):
        c = "c0" if rnd.random() < 0.3 else f"c{rnd.randint(0, 21)}"
        ts = datetime(2014, 6, 1) + timedelta(seconds=rnd.randint(0, 12 * 365 * 86400))
        if rnd.random() < 0.1:
            ts = datetime.combine(rnd.choice(vrows)[1], datetime.min.time())
        frows.append((str(i), c, ts))
    versions, facts = spark.createDataFrame(vrows, VERS), spark.createDataFrame(frows, FACT)
    for closed in ("both", "left"):
        got = point_in_time_join(facts, versions, "customer_id", "ts", ["tag"], closed)
        v = versions.withColumnRenamed("customer_id", "vc")
        upper = (F.col("ts") <= F.col("valid_to").cast("timestamp")) if closed == "both" else \
            (F.col("ts") < F.col("valid_to").cast("timestamp"))
        want = facts.join(v, (F.col("customer_id") == F.col("vc"))
                          & (F.col("ts") >= F.col("valid_from").cast("timestamp")) & upper, "left")
        a = sorted((r.fid, r.tag) for r in got.select("fid", "tag").collect())
        b = sorted((r.fid, r.tag) for r in want.select("fid", "tag").collect())
        assert a == b, closed


def _brute(facts, versions, closed):
    v = versions.withColumnRenamed("customer_id", "vc")
    upper = (F.col("ts") <= F.col("valid_to").cast("timestamp")) if closed == "both" else \
        (F.col("ts") < F.col("valid_to").cast("timestamp"))
    return facts.join(v, (F.col("customer_id") == F.col("vc"))
                      & (F.col("ts") >= F.col("valid_from").cast("timestamp")) & upper, "left")


def test_point_in_time_hot_key_with_same_day_versions(spark):
    # one key holds most facts and many versions, several of them empty
    # (same-date ties), which only a midnight fact meets under BETWEEN
    rnd = random.Random(5)
    vrows, d = [], date(2020, 1, 1)
    for i in range(60):
        nd = d if rnd.random() < 0.3 else d + timedelta(days=rnd.randint(1, 40))
        vrows.append(("hot", d, nd, f"h{i}"))
        d = nd
    vrows.append(("hot", d, date(9999, 12, 31), "hlast"))
    vrows.append(("cold", date(2020, 5, 5), date(9999, 12, 31), "c0"))
    frows = []
    for i in range(3000):
        c = "hot" if rnd.random() < 0.9 else "cold"
        day = date(2019, 12, 1) + timedelta(days=rnd.randint(0, 1000))
        ts = datetime.combine(day, datetime.min.time())
        if rnd.random() < 0.6:
            ts += timedelta(seconds=rnd.randint(0, 86399))
        frows.append((str(i), c, ts))
    frows.append(("nullts", "hot", None))
    versions, facts = spark.createDataFrame(vrows, VERS), spark.createDataFrame(frows, FACT)
    for closed in ("both", "left"):
        got = point_in_time_join(facts, versions, "customer_id", "ts", ["tag"], closed)
        assert got.columns == facts.columns + ["tag"]
        a = sorted((r.fid, str(r.tag)) for r in got.select("fid", "tag").collect())
        b = sorted((r.fid, str(r.tag)) for r in _brute(facts, versions, closed).select("fid", "tag").collect())
        assert a == b, closed


def test_point_in_time_timestamp_bounds(spark):
    versions = spark.createDataFrame([("c", datetime(2021, 1, 1, 12), datetime(2021, 1, 2, 12), "v1"),
                                      ("c", datetime(2021, 1, 2, 12), datetime(2030, 1, 1), "v2")],
                                     "customer_id string, valid_from timestamp, valid_to timestamp, tag string")
    facts = spark.createDataFrame([("a", "c", datetime(2021, 1, 1, 11)), ("b", "c", datetime(2021, 1, 2, 12)),
                                   ("c", "c", datetime(2021, 1, 2, 11, 59))], FACT)
    for closed, want in (("both", [("a", "None"), ("b", "v1"), ("b", "v2"), ("c", "v1")]),
                         ("left", [("a", "None"), ("b", "v2"), ("c", "v1")])):
        got = point_in_time_join(facts, versions, "customer_id", "ts", ["tag"], closed)
        assert sorted((r.fid, str(r.tag)) for r in got.collect()) == want


def test_history_backfill_signup_option(spark):
    customers = spark.createDataFrame([("early", "BRONZE", date(2020, 1, 1)), ("late", "GOLD", date(2022, 1, 1)),
                                       ("none", "SILVER", date(2020, 1, 1))], CUST)
    events = spark.createDataFrame([
        ("early", "tier_upgrade", "GOLD", date(2021, 1, 1)),
        ("early", "tier_upgrade", "PLATINUM", date(2021, 6, 1)),
        ("late", "tier_upgrade", "PLATINUM", date(2021, 1, 1)),      # signed up after the event: no backfill
        ("ghost", "tier_upgrade", "GOLD", date(2021, 1, 1)),         # unknown customer: no backfill
    ], EV)
    h = {(r.customer_id, r.tier_sequence): r
         for r in tier_history(customers, events, backfill_signup=True).collect()}
    assert sorted(h) == [("early", 1), ("early", 2), ("early", 3), ("ghost", 1), ("late", 1), ("none", 1)]
    b = h[("early", 1)]
    assert (b.loyalty_tier, b.valid_from, b.valid_to, b.is_current) == \
        ("BRONZE", date(2020, 1, 1), date(2021, 1, 1), False)
    assert h[("early", 2)].loyalty_tier == "GOLD" and h[("early", 3)].is_current
    assert h[("late", 1)].loyalty_tier == "PLATINUM" and h[("none", 1)].valid_to == date(9999, 12, 31)


@pytest.mark.parametrize("closed", ["left", "both"])
def test_versions_of_one_interval_meet_the_points_once(spark, monkeypatch, closed):
    """A key that repeats on the version side: its versions are not multiplied by
    points and years, and each fact takes all of them."""
    versions = spark.createDataFrame(
        [("a", f"first{i}", date(2020, 1, 1), date(2022, 1, 1)) for i in range(30)]
        + [("a", f"next{i}", date(2022, 1, 1), date(9999, 12, 31)) for i in range(20)] + [("b", "only", date(2020, 1, 1), date(9999, 12, 31))],
        "customer_id string, tag string, valid_from date, valid_to date")
    facts = spark.createDataFrame([("a", datetime(2021, 5, 1, 9)), ("a", datetime(2022, 1, 1)), ("b", datetime(2020, 1, 1)),
                                   ("c", datetime(2021, 1, 1)), (None, datetime(2021, 1, 1)), ("a", None)], "customer_id string, ts timestamp")
    sent, by_year = [], scd2._by_year
    monkeypatch.setattr(scd2, "_by_year", lambda *a: sent.append(by_year(*a)) or sent[-1])
    got = point_in_time_join(facts, versions, "customer_id", "ts", ["tag"], closed)
    assert sent[0].count() == 4 and got.columns == ["customer_id", "ts", "tag"]
    counts = {(r.customer_id, r.ts): (r.n, r.tags) for r in got.groupBy("customer_id", "ts").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("tag").alias("tags")).collect()}
    at_change = 50 if closed == "both" else 20
    assert counts == {("a", datetime(2021, 5, 1, 9)): (30, 30), ("a", datetime(2022, 1, 1)): (at_change, at_change),
                      ("b", datetime(2020, 1, 1)): (1, 1), ("c", datetime(2021, 1, 1)): (1, 0), (None, datetime(2021, 1, 1)): (1, 0),
                      ("a", None): (1, 0)}
