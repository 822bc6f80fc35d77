"""Q13: lookback merge — first run, empty target, idempotence, update, late rows, moving keys."""

import re
from datetime import datetime

import pytest

from clientlens.operators.incremental import merge_incremental

S = "transaction_id string, event_timestamp timestamp, v int"


def rows(df):
    return sorted((r.transaction_id, r.event_timestamp, r.v) for r in df.collect())


def test_first_run_and_empty_target(spark):
    new = spark.createDataFrame([("a", datetime(2024, 1, 1), 1)], S)
    assert rows(merge_incremental(None, new)) == rows(new)
    empty = spark.createDataFrame([], S)
    assert rows(merge_incremental(empty, new)) == rows(new)


def test_same_batch_twice_is_a_no_op(spark):
    t = spark.createDataFrame([("a", datetime(2024, 1, 10), 1), ("b", datetime(2024, 1, 9), 2)], S)
    assert rows(merge_incremental(t, t)) == rows(t)


def test_update_inside_lookback_and_late_row_skipped(spark):
    target = spark.createDataFrame([("a", datetime(2024, 1, 10), 1), ("b", datetime(2024, 1, 8), 2),
                                    ("c", datetime(2024, 1, 1), 3)], S)
    batch = spark.createDataFrame([
        ("b", datetime(2024, 1, 8), 20),    # within 3 days of max (Jan 10): replaces b
        ("c", datetime(2024, 1, 1), 30),    # older than Jan 7: skipped, c keeps 3
        ("d", datetime(2024, 1, 6, 23), 4),  # late arrival beyond the lookback: skipped
        ("e", datetime(2024, 1, 7), 5),     # exactly at the cutoff: inserted
        ("a", datetime(2024, 1, 12), 10),   # key moving date: replaced, new date
    ], S)
    got = rows(merge_incremental(target, batch))
    assert got == [("a", datetime(2024, 1, 12), 10), ("b", datetime(2024, 1, 8), 20),
                   ("c", datetime(2024, 1, 1), 3), ("e", datetime(2024, 1, 7), 5)]


def test_partition_rewrite_touches_only_changed_dates(spark, tmpdir_path):
    import os

    from pyspark.sql import functions as F

    from clientlens.operators.incremental import rewrite_partitions, select_batch
    from clientlens.sources import sinks

    def part(df):
        return df.withColumn("p", F.to_date("event_timestamp"))

    table, stage = os.path.join(tmpdir_path, "t"), os.path.join(tmpdir_path, "stage")
    target = part(spark.createDataFrame([("a", datetime(2024, 1, 10), 1), ("b", datetime(2024, 1, 8), 2),
                                         ("c", datetime(2024, 1, 1), 3), ("f", datetime(2024, 1, 9), 6)], S))
    sinks.write_table(target, table, ["p"])
    untouched = sorted(os.listdir(os.path.join(table, "p=2024-01-01")))
    t = spark.read.parquet(table)
    batch = part(select_batch(spark.createDataFrame([
        ("b", datetime(2024, 1, 8), 20), ("c", datetime(2024, 1, 1), 30), ("d", datetime(2024, 1, 6, 23), 4),
        ("e", datetime(2024, 1, 7), 5), ("a", datetime(2024, 1, 12), 10)], S), t, "event_timestamp", 3))
    content, touched = rewrite_partitions(t, batch, "transaction_id", "p")
    assert sorted(str(v) for v in touched) == ["2024-01-07", "2024-01-08", "2024-01-10", "2024-01-12"]
    scans = content._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*\bp#\d+ IN \(", scans)      # untouched dates not read
    emptied = sinks.overwrite_partitions(spark, content, touched, table, "p", stage)
    assert [str(v) for v in emptied] == ["2024-01-10"]          # a moved away from Jan 10
    got = rows(spark.read.parquet(table).drop("p"))
    assert got == [("a", datetime(2024, 1, 12), 10), ("b", datetime(2024, 1, 8), 20),
                   ("c", datetime(2024, 1, 1), 3), ("e", datetime(2024, 1, 7), 5), ("f", datetime(2024, 1, 9), 6)]
    assert sorted(os.listdir(os.path.join(table, "p=2024-01-01"))) == untouched
    assert not os.path.exists(os.path.join(table, "p=2024-01-10"))


def test_partition_rewrite_keeps_rows_of_the_null_partition(spark, tmpdir_path):
    import os

    from clientlens.operators.incremental import rewrite_partitions
    from clientlens.sources import sinks

    ps = "transaction_id string, v int, p int"
    table, stage = os.path.join(tmpdir_path, "t"), os.path.join(tmpdir_path, "stage")
    sinks.write_table(spark.createDataFrame([("a", 1, None), ("b", 2, None), ("c", 3, 7)], ps), table, ["p"])
    t = spark.read.parquet(table)
    batch = spark.createDataFrame([("a", 10, None), ("c", 30, None)], ps)   # c moves into the NULL partition
    content, touched = rewrite_partitions(t, batch.select(*t.columns), "transaction_id", "p")
    emptied = sinks.overwrite_partitions(spark, content, touched, table, "p", stage)
    assert emptied == [7]
    got = sorted((r.transaction_id, r.v, r.p) for r in spark.read.parquet(table).collect())
    assert got == [("a", 10, None), ("b", 2, None), ("c", 30, None)]


@pytest.mark.parametrize("stop", ["before the swap", "after one partition", "before the removal"])
def test_stopped_swap_is_finished_by_the_next_run(spark, tmpdir_path, monkeypatch, stop):
    """After a stop anywhere, a re-run ends in the state of a run that was not stopped."""
    import os

    from pyspark.sql import functions as F

    from clientlens.operators import incremental
    from clientlens.sources import sinks

    facts = "transaction_id string, event_timestamp timestamp, v int"
    old = [("a", datetime(2024, 1, 10), 1), ("b", datetime(2024, 1, 8), 2), ("c", datetime(2024, 1, 1), 3)]
    new = [("n1", datetime(2024, 1, 9), 4), ("n2", datetime(2024, 1, 14), 5), ("b", datetime(2024, 1, 12), 6)]
    monkeypatch.setattr(incremental, "fact_transactions", lambda rows, dim, closed="left": rows)

    def refresh(table, stage, rows):
        incremental.refresh_fact_partitions(spark.createDataFrame(rows, facts), None, table, stage, 3)

    def state(table):
        return sorted(spark.read.parquet(table).select("transaction_id", "event_timestamp", "v").collect())

    paths = {k: (os.path.join(tmpdir_path, k, "t"), os.path.join(tmpdir_path, k, "s")) for k in ("whole", "stopped")}
    for table, stage in paths.values():
        refresh(table, stage, old)
    refresh(*paths["whole"], new)

    swap, remove = sinks.write_partitions, sinks._path

    def broken_swap(df, path, cols):
        if stop == "after one partition":
            swap(df.filter(F.col(cols[0]) == F.lit("2024-01-14").cast("date")), path, cols)
        if stop != "before the removal":
            raise RuntimeError("stopped")
        swap(df, path, cols)

    def broken_path(spark, *parts):
        if stop == "before the removal" and parts[-1].startswith("event_date="):
            raise RuntimeError("stopped")
        return remove(spark, *parts)

    with monkeypatch.context() as m:
        m.setattr(sinks, "write_partitions", broken_swap)
        m.setattr(sinks, "_path", broken_path)
        with pytest.raises(RuntimeError, match="stopped"):
            refresh(*paths["stopped"], new)
    refresh(*paths["stopped"], new)
    assert state(paths["stopped"][0]) == state(paths["whole"][0])
    assert [r.transaction_id for r in state(paths["whole"][0])] == ["a", "b", "c", "n1", "n2"]
    assert not os.path.exists(os.path.join(paths["stopped"][0], "event_date=2024-01-08"))
