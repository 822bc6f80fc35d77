"""Bitmaps of customers (M6, M17): equal to exact distinct counts, numbers kept."""

import random

from pyspark.sql import functions as F

from clientlens.operators import bitmaps


def test_counts_equal_count_distinct_by_group_and_in_total(spark):
    rng = random.Random(1)
    # numbers over several buckets of 32,768 bits; one customer is in a third of the rows; nulls
    rows = [(f"c{rng.randrange(90_000)}" if rng.random() < 0.6 else rng.choice(["hot", None]), rng.choice("abc"), rng.randrange(3))
            for _ in range(60_000)]
    facts = spark.createDataFrame(rows, "customer_id string, channel string, month int").repartition(7)
    numbers = bitmaps.number_customers(spark.range(90_000).select(F.concat(F.lit("c"), "id").alias("customer_id"))
                                       .unionByName(facts.select("customer_id")))
    got = {r[0] for r in numbers.select("number").collect()}
    assert got == set(range(90_001))
    sets = bitmaps.customer_sets(facts, numbers, "month", "channel").checkpoint()
    assert sets.select("bucket").distinct().count() > 2
    for by in (["month", "channel"], ["channel"], []):
        want = {tuple(r) for r in facts.groupBy(*by).agg(F.count_distinct("customer_id").alias("n")).collect()}
        assert {tuple(r) for r in bitmaps.count_customers(sets, *by).collect()} == want


def test_new_customers_are_numbered_after_the_known_ones(spark):
    df = lambda *ids: spark.createDataFrame([(i,) for i in ids], "customer_id string")
    one = bitmaps.number_customers(df("a"))
    assert [tuple(r) for r in one.collect()] == [("a", 0)]
    two = {r.customer_id: r.number for r in bitmaps.number_customers(df("b", "a", "c", "b", None).repartition(3), one).collect()}
    assert two["a"] == 0 and sorted(two.values()) == [0, 1, 2] and set(two) == {"a", "b", "c"}
    none = bitmaps.number_customers(df().limit(0))
    assert none.count() == 0 and bitmaps.number_customers(df("x"), none).first().number == 0
    facts = df().limit(0).withColumn("m", F.lit(1))
    assert bitmaps.count_customers(bitmaps.customer_sets(facts, one, "m")).first()[0] == 0
