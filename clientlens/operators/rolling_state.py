"""Rolling spend kept up to date from 90 days and the changed days only.

Kept by period of the event (day, or month for small tables):

* ``seconds``: sums and counts per (customer, second), the first step of the
  rolling frame (``rolling.second_sums``), so a hot customer's day is at most
  86,400 narrow rows;
* ``rows``: the transactions with their two rolling columns.

A change of day d reaches the rows of days d to d + 90 of the same customers. A
run reads the transactions of the changed days, of ``seconds`` the days d - 90 to
d + 90 of the customers that have rows in changed days (before or after), cuts
their frames anew, and rewrites the days that hold affected rows; rows of other
customers in those days are carried over. So a delivery of the newest day reads
90 days of partial sums and writes one day; late rows are whole.

The changed periods are given, or found by a digest per period of the delivered
table; with months, read the distances as whole months.
The new content is staged for both tables and swapped in by dynamic partition
overwrite; a complete stage is swapped in first by the next run. The digests are
removed before a swap and stored after it: a run that finds none takes every period
as changed. (A caller that names the periods names those of a stopped run again.)
"""

from __future__ import annotations

import os
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DecimalType, LongType, StructField, StructType

from clientlens.functions.joins import by_merge
from clientlens.functions.scalar import MONEY, money
from clientlens.operators import changes, incremental, rolling
from clientlens.operators.changes import in_periods
from clientlens.sources import readers, sinks

DAYS = 90
SUM, COUNT = "rolling_90d_spend", "rolling_90d_txn_count"


def _dated(df: DataFrame, period: str) -> DataFrame:
    return df.withColumn(incremental.PERIOD_COLUMNS[period], incremental.period_of(F.col("event_timestamp"), period))


def _seconds(rows: DataFrame, period: str) -> DataFrame:
    sums = rolling.second_sums(rows, "customer_id", "event_timestamp", money("amount"), "transaction_id")
    return sums.select(F.col("_rk")["k"].alias("customer_id"), F.col("_rs").alias("second"),
                       F.col("s").cast("decimal(28,2)").alias("s"), "nv", "nc",
                       incremental.period_of(F.timestamp_seconds("_rs"), period).alias(incremental.PERIOD_COLUMNS[period]))


def _frames(seconds: DataFrame) -> DataFrame:
    per_sec = seconds.select(F.struct(F.col("customer_id").alias("k")).alias("_rk"), F.col("second").alias("_rs"), "s", "nv", "nc")
    return rolling.second_frames(per_sec, DAYS, SUM, COUNT, MONEY)


def _digests(rows: DataFrame, columns: list[str], part: str) -> DataFrame:
    """One row per period: number of rows and hash sum."""
    return rows.groupBy(part).agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*sorted(columns)).cast("decimal(38,0)")).alias("h"))


def _swap_in(spark: SparkSession, root: str, part: str) -> None:
    # the rows are staged last: a stage is complete with them
    if readers.table_exists(spark, os.path.join(root, "stage", "rows")):
        sinks.remove(spark, os.path.join(root, "digests"))
        for name in ("seconds", "rows"):
            staged = spark.read.parquet(os.path.join(root, "stage", name))        # has a row at least, see _stage
            sinks.write_partitions(staged.withColumn(part, F.col(part).cast("date")), os.path.join(root, name), [part])
    sinks.remove(spark, os.path.join(root, "stage"))


def _periods(changed: list, before: int, after: int, period: str) -> set:
    """The periods within a distance in days of changed ones."""
    return {p for c in changed if c is not None for p in changes.periods_of(
        c - timedelta(days=before), changes.last_day(c, period) + timedelta(days=after), period)}


def refresh(transactions: DataFrame, root: str, changed: list | None = None, period: str = "day") -> DataFrame:
    """Bring the kept rows up to date with ``transactions`` (clean, as delivered:
    only its changed periods are read if ``changed`` names them) and return them,
    with the columns of ``transactions`` and the two rolling ones."""
    spark = transactions.sparkSession
    columns, part = transactions.columns, incremental.PERIOD_COLUMNS[period]
    dated = _dated(transactions, period)
    rows_path, seconds_path, digest_path = (os.path.join(root, n) for n in ("rows", "seconds", "digests"))
    _swap_in(spark, root, part)
    own = None
    if changed is None:
        own = _digests(dated, columns, part).checkpoint()          # one row per period
    if not readers.table_exists(spark, rows_path):
        seconds = _seconds(transactions, period)
        sinks.write_table(seconds, seconds_path, [part])
        kept = spark.read.schema(seconds.schema).parquet(seconds_path)
        rolled = rolling.with_frames(dated, "customer_id", "event_timestamp", _frames(kept), SUM, COUNT)
        if own is not None:
            sinks.write_table(own, digest_path)
        sinks.write_table(rolled, rows_path, [part])
        return _stored(spark, root, dated, part).select(*columns, SUM, COUNT)
    if own is not None:
        every = own.select(part).unionByName(_stored(spark, root, dated, part).select(part)).distinct()
        changed = [r[0] for r in every.collect()]                              # one per period
        if readers.table_exists(spark, digest_path):
            both = own.unionByName(spark.read.schema(own.schema).parquet(digest_path))
            changed = [r[0] for r in both.groupBy(part, "n", "h").agg(F.count(F.lit(1)).alias("k")).filter("k = 1")
                       .select(part).distinct().collect()]
    changed = changes.ordered(changed)
    if changed:
        _replace(spark, dated, root, changed, period)
    if own is not None:
        sinks.write_table(own, digest_path)
    return _stored(spark, root, dated, part).select(*columns, SUM, COUNT)


def _replace(spark: SparkSession, dated: DataFrame, root: str, changed: list, period: str) -> None:
    part = incremental.PERIOD_COLUMNS[period]
    stored = _stored(spark, root, dated, part)
    new = dated.filter(in_periods(part, changed)).checkpoint()
    fresh = _seconds(new, period)
    seconds = spark.read.schema(fresh.schema).parquet(os.path.join(root, "seconds"))
    # customers with rows in changed periods, before or after
    who = (new.select("customer_id").unionByName(stored.filter(in_periods(part, changed)).select("customer_id"))
           .select(F.col("customer_id").alias("__who")).distinct().checkpoint())
    theirs = lambda df, how: df.join(by_merge(who), F.col("customer_id").eqNullSafe(F.col("__who")), how)

    other = lambda before: sorted(_periods(changed, before, DAYS, period) - set(changed))
    around, later = other(DAYS), other(0)
    frames = _frames(theirs(seconds.filter(in_periods(part, around)), "left_semi").unionByName(fresh))
    held = stored.filter(in_periods(part, later)).drop(SUM, COUNT)
    cut = rolling.with_frames(new.unionByName(theirs(held, "left_semi")), "customer_id", "event_timestamp", frames, SUM, COUNT)
    # only periods with an affected row are rewritten
    cut = cut.checkpoint()
    hit = [r[0] for r in cut.select(part).distinct().collect()]
    carried = theirs(stored.filter(in_periods(part, [p for p in later if p in set(hit)])), "left_anti")
    _stage(fresh, os.path.join(root, "stage", "seconds"), changed, part)
    _stage(carried.select(*cut.columns).unionByName(cut), os.path.join(root, "stage", "rows"), changed, part)
    _swap_in(spark, root, part)


def _stage(content: DataFrame, path: str, periods: list, part: str) -> None:
    """Write the new content of periods; each gets a marked row without any value,
    so that one without rows is overwritten too."""
    spark = content.sparkSession
    marks = spark.createDataFrame([(p,) for p in periods], f"{part} date").select(
        *[F.lit(None).cast(content.schema[c].dataType).alias(c) for c in content.columns if c != part], part, F.lit(True).alias("__mark"))
    sinks.write_table(content.withColumn("__mark", F.lit(False)).unionByName(marks), path, [part])


def _stored(spark: SparkSession, root: str, dated: DataFrame, part: str) -> DataFrame:
    """The kept rows, with the columns of ``dated`` and the rolling ones."""
    fields = [f for f in dated.schema.fields if f.name != part]
    schema = StructType([*fields, StructField(SUM, DecimalType(18, 2)), StructField(COUNT, LongType()),
                         StructField("__mark", BooleanType()), dated.schema[part]])
    rows = spark.read.schema(schema).parquet(os.path.join(root, "rows"))
    return rows.filter(~F.coalesce("__mark", F.lit(False))).drop("__mark")
