"""Incremental refresh of a fact by key with a lookback window.

Semantics: rows of the new batch whose time is within ``lookback_days`` of
the newest row already in the target replace target rows with the same key
or are added; older batch rows (late beyond the lookback) are skipped. An
absent or empty target is a first run and takes the whole batch.

Plain Parquet has no MERGE, so the merged state is ``target minus replaced
keys`` plus the selected batch rows; the caller writes it as a new version
(``clientlens.sources.sinks.commit_version``) and never overwrites the
version it is reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientlens.functions.joins import by_merge
from clientlens.operators import changes, key_index
from clientlens.operators.marts import fact_transactions


def lookback_cutoff(target: DataFrame, ts: str, lookback_days: int) -> Column:
    """Scalar subquery: newest target time minus the lookback (NULL if empty)."""
    return target.agg(F.max(F.col(ts)) - F.make_interval(days=F.lit(lookback_days))).scalar()


def select_batch(batch: DataFrame, target: DataFrame | None, ts: str, lookback_days: int) -> DataFrame:
    if target is None:
        return batch
    cutoff = lookback_cutoff(target, ts, lookback_days)
    return batch.filter((F.col(ts) >= cutoff) | cutoff.isNull())


def merge_by_key(target: DataFrame | None, rows: DataFrame, key: str) -> DataFrame:
    """Upsert: target rows whose key appears in ``rows`` are replaced."""
    if target is None:
        return rows
    keys = rows.select(key).distinct()
    return target.join(by_merge(keys), key, "left_anti").unionByName(rows.select(*target.columns))


def merge_incremental(target: DataFrame | None, new: DataFrame, key: str = "transaction_id",
                      ts: str = "event_timestamp", lookback_days: int = 3) -> DataFrame:
    """Q13 on an already-built batch."""
    return merge_by_key(target, select_batch(new, target, ts, lookback_days), key)


def refresh_fact_transactions(transactions: DataFrame, dim: DataFrame, target: DataFrame | None,
                              lookback_days: int = 3, closed: str = "left") -> DataFrame:
    """Q13 for the transaction fact: the lookback filter is applied to the staged
    transactions *before* the point-in-time join, so only the slice is joined."""
    batch = fact_transactions(select_batch(transactions, target, "event_timestamp", lookback_days),
                              dim, closed)
    return merge_by_key(target, batch, "transaction_id")


# --- partition-scoped refresh: only the touched periods are rewritten ---------------

# partition column of the stored fact per period; the period should match the
# volume: a day holds tens of GB at TB scale, a month suits small tables
PERIOD_COLUMNS = {"day": "event_date", "month": "event_month"}


def period_of(ts: Column, period: str) -> Column:
    return F.to_date(ts) if period == "day" else F.trunc(ts, "month")


def touched_partitions(target: DataFrame, batch: DataFrame, key: str, part: str) -> DataFrame:
    """Partition values whose content changes: those of the batch rows and those
    holding target rows that the batch replaces (a key may move to another date)."""
    replaced = target.select(key, part).join(by_merge(batch.select(key)), key, "left_semi")
    return batch.select(part).unionByName(replaced.select(part)).distinct()


def rewrite_partitions(target: DataFrame, batch: DataFrame, key: str, part: str,
                       touched: list | None = None) -> tuple[DataFrame, list]:
    """New content of the touched partitions only: their target rows minus the
    replaced keys, plus the batch. Returns (content, touched values).

    The touched values (one per partition, bounded by the calendar) are
    collected so the target is read through a literal partition filter:
    untouched partitions are never scanned. Values that the caller knows
    (``touched``, from the key index) save the scan of the target's keys."""
    if touched is None:
        touched = [r[0] for r in touched_partitions(target, batch, key, part).collect()]
    kept = target.filter(changes.in_periods(part, touched)).join(by_merge(batch.select(key)), key, "left_anti")
    return kept.unionByName(batch.select(*target.columns)), touched


def refresh_fact_partitions(transactions: DataFrame, dim: DataFrame, table_path: str, stage_path: str,
                            lookback_days: int = 3, closed: str = "left", period: str = "day",
                            index_path: str | None = None, followers: tuple[str, ...] = ()) -> None:
    """Q13 on a fact stored partitioned by event ``period``: the same merge as
    ``refresh_fact_transactions``, but only the touched partitions are written
    (staged, then swapped in by dynamic partition overwrite). With ``index_path``
    the touched partitions come from the key index kept there, and a run reads of
    the table the newest partition's times, the touched partitions and the keys of
    partitions that the index names; without, it scans the key column.

    A run that was stopped during its swap is finished first, from its stage:
    the cutoff of this run then comes from the whole table, as if that run had
    not been stopped. Tables derived from the fact (``followers``: their folders)
    get a note of the touched periods before the table changes."""
    from clientlens.sources import readers, sinks
    part, key = PERIOD_COLUMNS[period], "transaction_id"
    spark = transactions.sparkSession
    sinks.finish_swap(spark, table_path, stage_path)
    target = spark.read.parquet(table_path) if readers.table_exists(spark, table_path) else None
    # times rise with the periods: the newest one holds the newest time
    latest = None if target is None else target.filter(F.col(part) == changes.newest(target, part))
    batch = (fact_transactions(select_batch(transactions, latest, "event_timestamp", lookback_days),
                               dim, closed)
             .withColumn(part, period_of(F.col("event_timestamp"), period)))
    if target is None:
        sinks.write_table(batch, table_path, [part])
        if index_path is not None:
            sinks.remove(spark, index_path)
            key_index.follow(spark, spark.read.parquet(table_path), index_path, key, part)
        return
    # the slice feeds the touched partitions, the key anti-join and the new rows
    batch = batch.checkpoint(eager=True)
    touched = None
    if index_path is not None:
        key_index.follow(spark, target, index_path, key, part)
        touched = key_index.touched(target, key_index.read(spark, index_path, part), batch, key, part)
    content, touched = rewrite_partitions(target, batch, key, part, touched)
    if touched:
        for root in (*followers, *([index_path] if index_path is not None else [])):
            changes.announce(spark, root, part, touched)
        sinks.overwrite_partitions(spark, content, touched, table_path, part, stage_path)
        if index_path is not None:
            key_index.follow(spark, spark.read.parquet(table_path), index_path, key, part)
