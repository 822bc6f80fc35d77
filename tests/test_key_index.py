"""Key index (Q13, K5): nothing missed, false hits change nothing, untouched periods unread."""

import os
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from clientlens.operators import changes, incremental, key_index
from clientlens.sources import sinks

D0 = datetime(2024, 1, 1)


def facts(spark, rows):
    """(key, day number) rows with their period."""
    df = spark.createDataFrame([(k, D0 + timedelta(days=d, hours=5)) for k, d in rows], "transaction_id string, event_timestamp timestamp")
    return df.withColumn("event_date", incremental.period_of(F.col("event_timestamp"), "day"))


def stored(spark, root, rows):
    table, index = os.path.join(root, "t"), os.path.join(root, "keys")
    sinks.write_table(facts(spark, rows), table, ["event_date"])
    target = spark.read.parquet(table)
    key_index.follow(spark, target, index, "transaction_id", "event_date")
    return table, index


def test_every_key_hits_its_period_and_few_others_do(spark, tmpdir_path):
    # one period with several segments, many with one
    rows = [(f"a{i}", 0) for i in range(5000)] + [(f"b{i}", 1 + i % 9) for i in range(900)]
    _, index = stored(spark, tmpdir_path, rows)
    idx = key_index.read(spark, index, "event_date")
    assert {r.segments for r in idx.select("segments").distinct().collect()} == {1, 8}
    probed = spark.createDataFrame([(k,) for k, _ in rows] + [(f"new{i}",) for i in range(3000)], "transaction_id string")
    hits = {(r.transaction_id, (r.event_date - date(2024, 1, 1)).days) for r in
            key_index.probe(idx, probed, "transaction_id", "event_date").collect()}
    assert hits >= set(rows) and len(hits) <= len(rows) + 5


def test_touched_periods_equal_the_key_scan(spark, tmpdir_path):
    rows = [(f"k{i}", i % 40) for i in range(400)]
    table, index = stored(spark, tmpdir_path, rows)
    target = spark.read.parquet(table)
    batch = facts(spark, [("k7", 39), ("k8", 8), ("k200", 39), ("brand new", 38)])
    want = {r[0] for r in incremental.touched_partitions(target, batch, "transaction_id", "event_date").collect()}
    got = key_index.touched(target, key_index.read(spark, index, "event_date"), batch, "transaction_id", "event_date")
    assert set(got) == want and len(got) == 5          # days 0, 7, 8, 38, 39


def test_a_false_hit_changes_nothing(spark, tmpdir_path):
    """A full segment says yes to every key; the exact check finds no row."""
    table, index = stored(spark, tmpdir_path, [("a", 0), ("b", 1), ("c", 2)])
    part = "event_date"
    lying = key_index.read(spark, index, part).withColumn(
        "words", F.array_repeat(F.lit(-1).cast("long"), key_index.WORDS)).checkpoint()
    batch = facts(spark, [("c", 3)])
    assert key_index.probe(lying, batch, "transaction_id", part).count() == 3
    got = key_index.touched(spark.read.parquet(table), lying, batch, "transaction_id", part)
    assert got == [date(2024, 1, 3), date(2024, 1, 4)]


def test_probe_is_an_equi_join_and_the_check_reads_named_periods(spark, tmpdir_path):
    table, index = stored(spark, tmpdir_path, [(f"k{i}", i % 5) for i in range(50)])
    hits = key_index.probe(key_index.read(spark, index, "event_date"), facts(spark, [("k1", 9)]), "transaction_id", "event_date")
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    held = spark.read.parquet(table).filter(changes.in_periods("event_date", [date(2024, 1, 2)]))
    plan = held.select("transaction_id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan or "PartitionFilters: [(event_date" in plan


def test_index_follows_announced_periods(spark, tmpdir_path):
    table, index = stored(spark, tmpdir_path, [("a", 0), ("b", 1), ("c", 2)])
    days = [date(2024, 1, 1), date(2024, 1, 2)]
    # day 0 gets another key, day 1 loses its row; noted, then a stop
    changes.announce(spark, index, "event_date", days)
    sinks.write_partitions(facts(spark, [("d", 0)]), table, ["event_date"])
    sinks.remove(spark, os.path.join(table, "event_date=2024-01-02"))
    target = spark.read.parquet(table)
    key_index.follow(spark, target, index, "transaction_id", "event_date")
    idx = key_index.read(spark, index, "event_date")
    hits = {(r.transaction_id, r.event_date.day) for r in
            key_index.probe(idx, facts(spark, [(k, 9) for k in "abcd"]), "transaction_id", "event_date").collect()}
    assert hits == {("d", 1), ("c", 3)}
    assert changes.pending(spark, index) == ([], [])


def test_null_period_and_empty_batch(spark, tmpdir_path):
    table, index = stored(spark, tmpdir_path, [("a", 0)])
    extra = spark.createDataFrame([("n", None)], "transaction_id string, event_timestamp timestamp").withColumn(
        "event_date", F.lit(None).cast("date"))
    changes.announce(spark, index, "event_date", [None])
    sinks.write_partitions(extra, table, ["event_date"])
    target = spark.read.parquet(table)
    key_index.follow(spark, target, index, "transaction_id", "event_date")
    idx = key_index.read(spark, index, "event_date")
    assert key_index.touched(target, idx, facts(spark, [("n", 4)]), "transaction_id", "event_date") == [None, date(2024, 1, 5)]
    assert key_index.touched(target, idx, facts(spark, [("a", 0)]).limit(0), "transaction_id", "event_date") == []


def test_segments_follow_the_number_of_keys(spark):
    df = facts(spark, [(f"k{i}", 0) for i in range(1025)] + [("x", 1)])
    got = {r.event_date.day: r.segments for r in key_index.build(df, "transaction_id", "event_date").collect()}
    assert got == {1: 2, 2: 1}


def test_words_of_a_segment_are_put_in_place_without_look_ups(spark):
    """Each bit is in its word, words without a bit are zero, and no map of 512
    words is searched 512 times."""
    rows = facts(spark, [(f"k{i}", 0) for i in range(3)])
    index = key_index.build(rows, "transaction_id", "event_date")
    want = {r[0] for r in rows.select(F.explode(key_index._positions("transaction_id"))).collect()}
    words = index.first()["words"]
    assert index.count() == 1 and len(words) == key_index.WORDS
    assert {i * 64 + b for i, w in enumerate(words) for b in range(64) if (w >> b) & 1} == want
    assert "map_from_entries" not in index._jdf.queryExecution().optimizedPlan().toString()
