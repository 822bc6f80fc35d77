"""Randomized checks of the scalar helpers against plain Python."""

import random
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from clientlens.functions.scalar import (SURROGATE_NULL_TOKEN, day_diff, email_prefix,
                                         hour_boundaries_between, money_avg_from, surrogate_key)


def test_day_and_hour_boundaries_match_python(spark):
    rnd = random.Random(7)
    base = datetime(2023, 12, 31, 22)
    rows = []
    for i in range(500):
        a = base + timedelta(seconds=rnd.randint(0, 5 * 86400))
        b = a + timedelta(seconds=rnd.randint(-3 * 86400, 3 * 86400))
        rows.append((i, a, b))
    df = spark.createDataFrame(rows, "i int, a timestamp, b timestamp")
    got = {r.i: (r.d, r.h) for r in df.select("i", day_diff("b", "a").alias("d"),
                                             hour_boundaries_between("a", "b").alias("h")).collect()}
    for i, a, b in rows:
        floor_h = lambda t: t.replace(minute=0, second=0, microsecond=0)
        want_h = int((floor_h(b) - floor_h(a)).total_seconds() // 3600)
        assert got[i] == ((b.date() - a.date()).days, want_h), (a, b)


def test_money_average_rounds_half_away_from_zero(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(400):
        n = rnd.randint(1, 9)
        total = Decimal(rnd.randint(-10**7, 10**7)) / 100
        rows.append((i, total, n))
    df = spark.createDataFrame(rows, "i int, t decimal(18,2), n bigint")
    got = {r.i: r.m for r in df.select("i", money_avg_from(F.col("t"), F.col("n")).alias("m")).collect()}
    for i, t, n in rows:
        q = (abs(t) / n).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert got[i] == (q if t >= 0 else -q), (t, n)


def test_email_prefix_and_surrogate_key(spark):
    import hashlib
    df = spark.createDataFrame([("a.b@c.d", "x", None), ("no-at-sign", None, "2024-01-01")],
                               "e string, k string, d string")
    r = df.select(email_prefix("e").alias("p"), surrogate_key("k", "d").alias("sk")).collect()
    assert [x.p for x in r] == ["a.b", "no-at-sign"]
    null = SURROGATE_NULL_TOKEN
    assert r[0].sk == hashlib.md5(f"x-{null}".encode()).hexdigest()
    assert r[1].sk == hashlib.md5(f"{null}-2024-01-01".encode()).hexdigest()
