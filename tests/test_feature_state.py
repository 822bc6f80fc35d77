"""Feature state (Q15, G6-G12): equal to the full build after any sequence of runs."""

import os
import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clientlens.operators import changes, feature_state, incremental, marts
from clientlens.sources import sinks

FACT = "transaction_id string, customer_id string, channel string, amount decimal(18,2), event_timestamp timestamp"
TICKET = "ticket_id string, customer_id string, category string, resolution_hours bigint, opened_at timestamp"
DAY0 = datetime(2024, 1, 1)


def transactions(spark, rows):
    return spark.createDataFrame(rows, FACT)


def random_rows(rng, n, days=200):
    out = {}
    for i in range(n):
        t = DAY0 + timedelta(days=rng.randrange(days), seconds=rng.randrange(86400))
        # a third of the rows are one customer's
        who = "hot" if rng.random() < 0.33 else f"c{rng.randrange(12)}"
        out[f"t{i}"] = (f"t{i}", who, rng.choice(["web", "in_store", "call_center", None]),
                        rng.choice([None, Decimal(rng.randrange(1, 99999)) / 100]), t)
    return out


def tx(df, as_of):
    return sorted(map(str, marts.transaction_features(df, as_of).collect()))


def kept(state, as_of):
    return sorted(map(str, feature_state.transaction_features(state, as_of).collect()))


def with_period(df, period, time="event_timestamp"):
    return df.withColumn(incremental.PERIOD_COLUMNS[period], incremental.period_of(F.col(time), period))


@pytest.mark.parametrize("period,as_ofs", [("day", ["2024-05-01", "2024-05-03", "2024-07-20"]),
                                           ("month", ["2024-06-01", "2024-05-10", "2024-12-31"])])
def test_runs_equal_the_full_build(spark, tmpdir_path, period, as_ofs):
    rng = random.Random(period)
    rows = random_rows(rng, 300)
    root = os.path.join(tmpdir_path, "state")
    facts = with_period(transactions(spark, list(rows.values())), period)
    state = feature_state.refresh(spark, facts, root, as_ofs[0], period=period)
    assert kept(state, as_ofs[0]) == tx(facts, as_ofs[0])
    for as_of in as_ofs[1:]:
        # keys move to other days, rows go, rows come; a customer's newest day may go
        touched = set()
        for k in rng.sample(sorted(rows), 25):
            old = rows.pop(k)
            touched.add(old[4].date())
            if rng.random() < 0.6:
                new = (*old[:4], DAY0 + timedelta(days=rng.randrange(210), seconds=rng.randrange(86400)))
                rows[k] = new
                touched.add(new[4].date())
        newest = max((r for r in rows.values() if r[1] == "hot"), key=lambda r: r[4])
        del rows[newest[0]]
        touched.add(newest[4].date())
        if period == "month":
            touched = {d.replace(day=1) for d in touched}
        facts = with_period(transactions(spark, list(rows.values())), period)
        state = feature_state.refresh(spark, facts, root, as_of, period=period, changed=sorted(touched))
        assert kept(state, as_of) == tx(facts, as_of)


def test_an_unchanged_day_is_not_read(spark, tmpdir_path):
    """Rows of periods that are not announced may be anything: they are not read."""
    root = os.path.join(tmpdir_path, "state")
    at = lambda d: DAY0 + timedelta(days=d)
    base = [("a", "c", "web", Decimal("10.00"), at(0)), ("b", "c", "web", Decimal("5.00"), at(50))]
    feature_state.refresh(spark, with_period(transactions(spark, base), "day"), root, "2024-03-01")
    lying = [("a", "c", "web", Decimal("999.00"), at(0)), ("b", "c", "web", Decimal("5.00"), at(50)), ("n", "c", "web", Decimal("1.00"), at(51))]
    changes.announce(spark, root, "event_date", [date(2024, 2, 21)])
    state = feature_state.refresh(spark, with_period(transactions(spark, lying), "day"), root, "2024-03-02")
    row = feature_state.transaction_features(state, "2024-03-02").collect()[0]
    assert row.total_spend_lifetime == Decimal("16.00") and row.transaction_count_lifetime == 3
    days = spark.read.parquet(os.path.join(root, "days")).filter(changes.in_periods("event_date", [date(2024, 2, 21)]))
    assert "PartitionFilters: [" in days._jdf.queryExecution().executedPlan().toString()
    assert days.filter("customer_id is not null").count() == 1


@pytest.mark.parametrize("stop", ["state", "swap", "forget"])
def test_a_stopped_run_is_finished_by_the_next(spark, tmpdir_path, monkeypatch, stop):
    rng = random.Random(9)
    rows = random_rows(rng, 80)
    root = os.path.join(tmpdir_path, "state")
    feature_state.refresh(spark, with_period(transactions(spark, list(rows.values())), "day"), root, "2024-05-01")
    moved = sorted(rows)[:10]
    touched = set()
    for k in moved:
        touched.add(rows[k][4].date())
        rows[k] = (*rows[k][:4], rows[k][4] + timedelta(days=3))
        touched.add(rows[k][4].date())
    facts = with_period(transactions(spark, list(rows.values())), "day")
    changes.announce(spark, root, "event_date", sorted(touched))

    class Stop(Exception):
        pass

    def stopped(*a, **k):
        raise Stop

    with monkeypatch.context() as m:
        if stop == "state":
            write = sinks.write_table
            m.setattr(sinks, "write_table", lambda df, path, *a, **k: stopped() if "/state/version" in path else write(df, path, *a, **k))
        elif stop == "swap":
            m.setattr(sinks, "write_partitions", stopped)
        else:
            m.setattr(changes, "forget", stopped)
        with pytest.raises(Stop):
            feature_state.refresh(spark, facts, root, "2024-05-05")
    # more changes before the next run
    gone = rows.pop(sorted(rows)[20])
    changes.announce(spark, root, "event_date", [gone[4].date()])
    facts = with_period(transactions(spark, list(rows.values())), "day")
    state = feature_state.refresh(spark, facts, root, "2024-05-06")
    assert kept(state, "2024-05-06") == tx(facts, "2024-05-06")
    assert changes.pending(spark, root) == ([], [])


def test_tickets_are_followed_by_digest(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "state")
    at = lambda d: DAY0 + timedelta(days=d)
    one = [(f"t{i}", f"c{i % 3}", ["billing", "shipping"][i % 2], i if i % 4 else None, at(i % 6)) for i in range(24)]
    two = [(*r[:3], 40, r[4]) if r[0] in ("t3", "t4") else r for r in one if r[0] != "t7"] + [("t99", "c9", "billing", 1, at(40))]
    for rows in (one, two, two):
        t = spark.createDataFrame(rows, TICKET)
        state = feature_state.refresh(spark, with_period(t, "day", "opened_at"), root, "2024-03-01", feature_state.SUPPORT, compare=True)
        assert sorted(map(str, feature_state.support_features(state).collect())) == sorted(map(str, marts.support_features(t).collect()))


def test_empty_tables_and_a_first_run_without_rows(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "state")
    none = with_period(transactions(spark, []), "day")
    assert feature_state.refresh(spark, none, root, "2024-01-01").collect() == []
    some = with_period(transactions(spark, list(random_rows(random.Random(1), 20).values())), "day")
    days = [r[0] for r in some.select("event_date").distinct().collect()]
    state = feature_state.refresh(spark, some, root, "2024-04-01", changed=days)
    assert kept(state, "2024-04-01") == tx(some, "2024-04-01")
    state = feature_state.refresh(spark, none, root, "2024-04-02", changed=days)
    assert state.collect() == []
