"""Bucketed point-in-time join (J6): no Exchange, hot customers in slots, same rows."""

import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clientlens.operators import bucketed, scd2

FACTS = "transaction_id string, customer_id string, event_timestamp timestamp"
VERSIONS = "customer_id string, tier string, valid_from date, valid_to date"
OPEN = date(9999, 12, 31)


def tables(spark, seed):
    rng = random.Random(seed)
    day = lambda n: date(2024, 1, 1) + timedelta(days=n)
    versions = []
    for k in [f"c{i}" for i in range(15)] + ["hot"]:
        cuts = sorted(rng.sample(range(120), rng.randint(1, 5)))
        versions += [(k, f"t{i}", day(a), b) for i, (a, b) in enumerate(zip(cuts, [*map(day, cuts[1:]), OPEN]))]
    facts = []
    for i in range(900):
        who = "hot" if rng.random() < 0.35 else rng.choice([f"c{i}" for i in range(18)] + [None])
        t = datetime(2024, 1, 1) + timedelta(days=rng.randrange(130), seconds=rng.choice([0, 1, 50_000]))
        facts.append((f"f{i}", who, t if rng.random() < 0.97 else None))
    return spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS)


@pytest.mark.parametrize("closed", ["left", "both"])
def test_same_rows_without_an_exchange(spark, tmpdir_path, closed):
    facts, versions = tables(spark, closed)
    f, v = bucketed.store(facts, versions, tmpdir_path, f"pit_{closed}", buckets=4, slot_rows=50)
    hot = f.filter("customer_id = 'hot'")
    assert hot.select("slot").distinct().count() > 3 and hot.groupBy("slot").count().agg(F.max("count")).first()[0] < 110
    got = bucketed.point_in_time(f, v, "event_timestamp", ["tier"], closed)
    want = scd2.point_in_time_join(facts, versions, "customer_id", "event_timestamp", ["tier"], closed)
    assert sorted(map(str, got.select("transaction_id", "tier").collect())) == sorted(
        map(str, want.select("transaction_id", "tier").collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_stored_tables_are_attached_to_another_session(spark, tmpdir_path):
    facts, versions = tables(spark, "attach")
    f, v = bucketed.store(facts, versions, tmpdir_path, "kept", buckets=4)
    rows = sorted(map(str, bucketed.point_in_time(f, v, "event_timestamp", ["tier"]).collect()))
    again = [bucketed.attach(spark, f"again_{n}", os.path.join(tmpdir_path, n), t.schema, 4) for n, t in (("facts", f), ("versions", v))]
    got = bucketed.point_in_time(*again, "event_timestamp", ["tier"])
    assert sorted(map(str, got.collect())) == rows
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_empty_and_wrong(spark, tmpdir_path):
    facts, versions = tables(spark, 0)
    f, v = bucketed.store(facts.limit(0), versions, tmpdir_path, "none", buckets=2)
    assert bucketed.point_in_time(f, v, "event_timestamp", ["tier"]).count() == 0
    with pytest.raises(ValueError):
        bucketed.point_in_time(f, v, "event_timestamp", ["tier"], "right")
