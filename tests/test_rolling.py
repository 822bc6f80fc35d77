"""The skew-safe trailing frame equals the plain range window."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from clientlens.operators.rolling import rolling_sum_count

SCHEMA = "id string, k string, ts timestamp, v decimal(18,2)"


def plain(df, days=90):
    w = Window.partitionBy("k").orderBy(F.unix_seconds("ts")).rangeBetween(-days * 86400, 0)
    return df.select("id", F.sum("v").over(w).cast("decimal(18,2)").alias("s2"),
                     F.count("id").over(w).alias("c2"))


def run(df, days=90):
    return rolling_sum_count(df, "k", "ts", "v", "id", days, "s", "c")


def test_boundaries(spark):
    t0 = datetime(2024, 1, 1, 12, 0, 0)
    rows = [
        ("a", "x", t0, Decimal("1.00")),
        ("b", "x", t0 + timedelta(days=90), Decimal("2.00")),                 # exactly 90 days: in
        ("c", "y", t0, Decimal("1.00")),
        ("d", "y", t0 + timedelta(days=90, seconds=1), Decimal("2.00")),      # 90 days + 1 s: out
        ("e", "z", t0, Decimal("1.00")),
        ("f", "z", t0, Decimal("2.00")),                                      # same second: both see both
        ("g", "w", t0, Decimal("1.00")),
        ("h", "w", t0 + timedelta(milliseconds=400), Decimal("2.00")),        # sub-second: same second
        ("i", "n", t0, None),                                                 # NULL amount
        ("j", "n", t0 + timedelta(days=1), None),
    ]
    rows.append(("t", "x", None, Decimal("5.00")))                          # no time: NULLs, seen by none
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.id: (r.s, r.c) for r in run(df).collect()}
    assert got["b"] == (Decimal("3.00"), 2)
    assert got["d"] == (Decimal("2.00"), 1)
    assert got["e"] == got["f"] == (Decimal("3.00"), 2)
    assert got["g"] == got["h"] == (Decimal("3.00"), 2)
    assert got["j"] == (None, 2)
    assert got["t"] == (None, None)


def test_equals_plain_window_with_hot_key(spark):
    rnd = random.Random(3)
    base = datetime(2023, 1, 1)
    rows = []
    for i in range(3000):
        k = "hot" if rnd.random() < 0.4 else (None if rnd.random() < 0.05 else f"k{rnd.randint(0, 30)}")
        ts = base + timedelta(seconds=rnd.randint(0, 400 * 86400))
        if rnd.random() < 0.1:                                   # peers in the same second
            ts = base + timedelta(days=rnd.randint(0, 400))
        v = None if rnd.random() < 0.02 else Decimal(rnd.randint(1, 99999)) / 100
        rows.append((str(i), k, ts, v))
    df = spark.createDataFrame(rows, SCHEMA)
    for days in (90, 30, 1):
        j = run(df, days).join(plain(df, days), "id")
        assert j.count() == len(rows)
        bad = j.filter(~F.col("s").eqNullSafe(F.col("s2")) | (F.col("c") != F.col("c2")))
        assert bad.count() == 0, days


def test_frames_read_each_second_once(spark):
    """Blocks before 1970 and at block edges; the frames take two shuffles of the seconds."""
    from clientlens.operators import rolling
    span, rows = 90 * 86400, []
    for i, s in enumerate([-2 * span, -span - 1, -span, -1, 0, 1, span - 1, span, span + 1, 2 * span, 2 * span + 1]):
        rows += [(f"{i}{k}", k, datetime(1970, 1, 1) + timedelta(seconds=s), Decimal(1 << i)) for k in ("a", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    j = run(df).join(plain(df), "id")
    assert j.filter(F.col("s").eqNullSafe(F.col("s2")) & (F.col("c") == F.col("c2"))).count() == len(rows)
    seconds = rolling.second_sums(df, "k", "ts", F.col("v"), "id").checkpoint()
    frames = rolling.second_frames(seconds, 90, "s", "c", "decimal(18,2)")
    plan = frames._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Scan ExistingRDD") == 1
    assert plan.count("Window [") == 1 and plan.count("Sort [") == 1
