"""Rolling state (W1, W2, Q5): equal to the whole recomputation, late rows included."""

import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clientlens.operators import clean, rolling_state
from clientlens.sources import sinks

SCHEMA = "transaction_id string, customer_id string, amount double, channel string, event_timestamp timestamp"
DAY0 = datetime(2024, 1, 1)


def transactions(spark, rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def row(rng, i, day=None):
    who = "hot" if rng.random() < 0.33 else rng.choice(["a", "b", "c", "", None])
    t = DAY0 + timedelta(days=rng.randrange(260) if day is None else day, seconds=rng.choice([0, 1, 86399, rng.randrange(86400)]))
    return (f"t{i}" if rng.random() < 0.95 else None, who, rng.choice([None, rng.randrange(1, 9999) / 100]), "web", t)


def same(got, rows):
    assert sorted(map(str, got.collect())) == sorted(map(str, clean.compute_rolling_spend(rows).collect()))


@pytest.mark.parametrize("given,period", [(True, "day"), (False, "month")])
def test_deliveries_equal_the_whole_recomputation(spark, tmpdir_path, given, period):
    rng = random.Random(4)
    rows = {i: row(rng, i) for i in range(250)}
    df = transactions(spark, rows.values())
    same(rolling_state.refresh(df, tmpdir_path, [] if given else None, period), df)
    for step in range(3):
        touched = set()
        for i in range(1000 * (step + 1), 1000 * (step + 1) + 12):        # new days and late rows
            rows[i] = row(rng, i, day=261 + step if i % 2 else None)
            touched.add(rows[i][4].date())
        gone = rng.choice(sorted(rows))                                   # a row taken back
        touched.add(rows.pop(gone)[4].date())
        moved = rng.choice(sorted(rows))                                  # a row that moves to another day
        touched.add(rows[moved][4].date())
        rows[moved] = (*rows[moved][:4], rows[moved][4] + timedelta(days=95))
        touched.add(rows[moved][4].date())
        df = transactions(spark, rows.values())
        same(rolling_state.refresh(df, tmpdir_path, sorted(touched) if given else None, period), df)


def test_a_new_day_reads_ninety_days_and_writes_one(spark, tmpdir_path):
    rows = [(f"t{d}", "a", 1.0, "web", DAY0 + timedelta(days=d)) for d in range(200)]
    rolling_state.refresh(transactions(spark, rows), tmpdir_path, [])
    folder = os.path.join(tmpdir_path, "rows")
    before = {d: sorted(os.listdir(os.path.join(folder, d))) for d in os.listdir(folder) if "=" in d}
    # days beyond the frame and rows of other days may be anything
    for d in range(0, 105):
        sinks.remove(spark, os.path.join(tmpdir_path, "seconds", f"event_date={(DAY0 + timedelta(days=d)).date()}"))
    batch = [("new", "a", 5.0, "web", DAY0 + timedelta(days=200)), ("lie", "a", 9e9, "web", DAY0 + timedelta(days=150))]
    out = rolling_state.refresh(transactions(spark, batch), tmpdir_path, [(DAY0 + timedelta(days=200)).date()])
    last = out.filter("transaction_id = 'new'").first()
    assert (float(last.rolling_90d_spend), last.rolling_90d_txn_count) == (95.0, 91)
    after = {d: sorted(os.listdir(os.path.join(folder, d))) for d in os.listdir(folder) if "=" in d}
    assert [d for d in after if before.get(d) != after[d]] == [f"event_date={date(2024, 7, 19)}"]


@pytest.mark.parametrize("stop", ["seconds", "rows"])
def test_a_stopped_run_is_finished_by_the_next(spark, tmpdir_path, monkeypatch, stop):
    rng = random.Random(5)
    rows = {i: row(rng, i) for i in range(60)}
    rolling_state.refresh(transactions(spark, rows.values()), tmpdir_path)
    write = sinks.write_partitions

    def stopped(df, path, part):
        if path.endswith(stop):
            raise RuntimeError("stop")
        return write(df, path, part)

    rows[100] = row(rng, 100, day=100)
    with monkeypatch.context() as m:
        m.setattr(sinks, "write_partitions", stopped)
        with pytest.raises(RuntimeError):
            rolling_state.refresh(transactions(spark, rows.values()), tmpdir_path)
    rows[101] = row(rng, 101, day=102)
    df = transactions(spark, rows.values())
    same(rolling_state.refresh(df, tmpdir_path), df)


def test_empty_deliveries(spark, tmpdir_path):
    none = transactions(spark, [])
    assert rolling_state.refresh(none, tmpdir_path).collect() == []
    df = transactions(spark, [("x", "a", 2.0, "web", DAY0)])
    same(rolling_state.refresh(df, tmpdir_path), df)
    assert rolling_state.refresh(none, tmpdir_path).collect() == []
    same(rolling_state.refresh(df, tmpdir_path), df)
    # columns of any name stay
    wide = df.withColumn("second", F.lit(1)).withColumn("who", F.lit("x"))
    assert rolling_state.refresh(wide, os.path.join(tmpdir_path, "wide")).columns == [
        *wide.columns, "rolling_90d_spend", "rolling_90d_txn_count"]
