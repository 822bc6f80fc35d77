"""History state (Q9, Q11, J5): equal to a full rebuild, untouched buckets unread."""

import os
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from clientlens.operators import history_state, marts, scd2
from clientlens.sources import sinks

CUSTOMERS = ("customer_id string, first_name string, last_name string, email string, signup_date date, loyalty_tier string, "
             "state string, is_likely_duplicate boolean, _loaded_at timestamp")
EVENTS = "customer_id string, event_type string, new_tier string, event_date date, _loaded_at timestamp"
AS_OF, RUN = "2024-06-01", "2024-06-01 06:00:00"


def customer(k, tier="BRONZE", first="ann"):
    return (k, first, "x", f"{k}@y", date(2023, 1, 1) + timedelta(days=len(k)), tier, "NY", False, None)


def tables(spark, customers, events):
    load = F.lit(RUN).cast("timestamp")
    return (spark.createDataFrame(customers, CUSTOMERS).withColumn("_loaded_at", load),
            spark.createDataFrame([(*e, None) for e in events], EVENTS).withColumn("_loaded_at", load))


def same(versions, customers, events):
    full = scd2.tier_history(customers, events)
    order = sorted(map(str, history_state.history(versions).collect()))
    assert order == sorted(map(str, full.select(*history_state.HISTORY).collect()))
    dim, want = history_state.dimension(versions, AS_OF, RUN), marts.dim_customer(customers, full, AS_OF)
    assert dim.dtypes == want.dtypes and sorted(map(str, dim.collect())) == sorted(map(str, want.collect()))


def random_events(rng, n, customers):
    return [(rng.choice(customers), "up", rng.choice(["GOLD", "SILVER"]), date(2024, 1, 1) + timedelta(days=rng.randrange(90)))
            for _ in range(n)]


def test_deliveries_equal_a_full_rebuild(spark, tmpdir_path):
    rng = random.Random(1)
    ids = [f"c{i}" for i in range(40)]
    people = {k: customer(k) for k in ids}
    # unknown customers have events too; one customer has many, with ties
    events = random_events(rng, 120, ids[:20] + ["ghost"]) + [("c0", "up", "GOLD", date(2024, 1, 5))] * 30
    c, e = tables(spark, list(people.values()), events)
    same(history_state.refresh(c, e, tmpdir_path, 8), c, e)
    for step in range(3):
        events += random_events(rng, 3, ids + ["ghost2"])                  # new and late events
        events.remove(rng.choice(events))                                  # one taken back
        k = rng.choice(ids)
        people[k] = customer(k, "PLATINUM", f"renamed{step}")              # an attribute and the signup tier
        people.pop(rng.choice([i for i in ids if i in people and i != k]))  # one gone
        people[f"new{step}"] = customer(f"new{step}")
        c, e = tables(spark, list(people.values()), events)
        same(history_state.refresh(c, e, tmpdir_path, 8), c, e)


def test_untouched_buckets_are_neither_read_nor_written(spark, tmpdir_path):
    ids = [f"c{i}" for i in range(60)]
    people = [customer(k) for k in ids]
    c, e = tables(spark, people, [])
    history_state.refresh(c, e, tmpdir_path, 16)
    versions = os.path.join(tmpdir_path, "versions")
    before = {b: sorted(os.listdir(os.path.join(versions, b))) for b in os.listdir(versions) if b.startswith("bucket=")}
    own = c.select("customer_id", history_state._bucket(16)).filter("customer_id = 'c7'").first().bucket
    c, e = tables(spark, people, [("c7", "up", "GOLD", date(2024, 2, 2))])
    out = history_state.refresh(c, e, tmpdir_path, 16)
    same(out, c, e)
    after = {b: sorted(os.listdir(os.path.join(versions, b))) for b in before}
    assert [b for b in before if before[b] != after[b]] == [f"bucket={own}"]
    assert "PartitionFilters: [" in out.filter(F.col("bucket").isin([own]))._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("stop", ["swap", "digests"])
def test_a_stopped_run_is_finished_by_the_next(spark, tmpdir_path, monkeypatch, stop):
    ids = [f"c{i}" for i in range(20)]
    c, e = tables(spark, [customer(k) for k in ids], [("c1", "up", "GOLD", date(2024, 1, 1))])
    history_state.refresh(c, e, tmpdir_path, 4)
    write = sinks.write_partitions

    def stopped(df, path, part):
        if stop == "swap" or path.endswith("digests"):
            raise RuntimeError("stop")
        return write(df, path, part)

    c, e = tables(spark, [customer(k) for k in ids[1:]], [("c1", "up", "GOLD", date(2024, 1, 1)), ("c2", "up", "SILVER", date(2023, 12, 1))])
    with monkeypatch.context() as m:
        m.setattr(sinks, "write_partitions", stopped)
        with pytest.raises(RuntimeError):
            history_state.refresh(c, e, tmpdir_path, 4)
    c, e = tables(spark, [customer(k) for k in ids[1:]], [("c1", "up", "GOLD", date(2024, 1, 1)), ("c3", "up", "SILVER", date(2023, 12, 1))])
    same(history_state.refresh(c, e, tmpdir_path, 4), c, e)


def test_empty_tables_and_emptied_buckets(spark, tmpdir_path):
    c, e = tables(spark, [], [])
    assert history_state.refresh(c, e, tmpdir_path, 4).collect() == []
    c, e = tables(spark, [customer("a"), customer("b")], [("a", "up", "GOLD", date(2024, 1, 1))])
    same(history_state.refresh(c, e, tmpdir_path, 4), c, e)
    c, e = tables(spark, [], [])
    assert history_state.refresh(c, e, tmpdir_path, 4).collect() == []
