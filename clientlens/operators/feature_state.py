"""The feature table kept up to date from changed and expiring days only
(Q15, G6-G12).

Kept under one folder per source table (transactions, tickets):

* ``days``: partial aggregates per (customer, channel or category, day), stored by
  the period of the fact (day or month). They are sums and counts, so slices of
  days can be added to and taken from any total.
* ``state``: per (customer, channel or category) the totals of the windows (30
  days, 90 days, lifetime) as of the last run, and the newest time of each active
  day. The days make the newest time exact after rows have gone; a row has one
  entry per active day, a number that the calendar bounds.

A run reads the fact's rows of the changed periods only, and of ``days`` the
changed periods and the days that leave (or, with an earlier as-of date, enter) a
window: totals + new partials of changed days - old ones - expired days. The fact
is never read whole again. Sums are exact (decimals and integers), so the result
equals the full build whatever the number of runs.

Crash safety uses complete folders only: the new partials are staged, then the
state is written as a new version, then the stage replaces its periods in
``days`` (dynamic partition overwrite). A run that finds the stage of the newest
version swaps it in first (again, if need be). The periods that a fact refresh is
about to change are announced before its swap and forgotten only after the
state's commit, so a stop in between loses none; a period handled twice adds
nothing.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clientlens.operators import changes, incremental, marts
from clientlens.operators.changes import in_periods
from clientlens.sources import readers, sinks

SUM = "decimal(28,2)"
WINDOWS = (30, 90)


@dataclass(frozen=True)
class Source:
    """What is kept of one fact table."""
    name: str
    by: str                              # second key: channel or category
    time: str
    measures: dict[str, Callable[[], Column]]     # lifetime aggregates of a day
    types: dict[str, str]
    reads: tuple[str, ...]
    windows: tuple[int, ...] = ()


TRANSACTIONS = Source(
    "transactions", "channel", "event_timestamp",
    {"s": lambda: F.sum("amount"), "a": lambda: F.count("amount"), "c": lambda: F.count("transaction_id"),
     "r": lambda: F.count(F.lit(1))},
    {"s": SUM, "a": "bigint", "c": "bigint", "r": "bigint"}, ("transaction_id", "amount"), WINDOWS)
SUPPORT = Source(
    "support", "category", "opened_at",
    {"s": lambda: F.sum("resolution_hours"), "a": lambda: F.count("resolution_hours"),
     "c": lambda: F.count("ticket_id"), "r": lambda: F.count(F.lit(1))},
    {"s": "bigint", "a": "bigint", "c": "bigint", "r": "bigint"}, ("ticket_id", "resolution_hours"))


def day_partials(facts: DataFrame, source: Source, part: str, period: str) -> DataFrame:
    """One row per (customer, ``by``, day) with its period, sums, counts and newest time."""
    day = F.to_date(source.time)
    return (facts.filter(F.col("customer_id").isNotNull())
            .groupBy("customer_id", source.by, day.alias("day"))
            .agg(*[m().cast(source.types[n]).alias(n) for n, m in source.measures.items()], F.max(source.time).alias("mx"))
            .withColumn(part, incremental.period_of(F.col("day"), period)))


def _moved(old: str, new: str, days: int) -> Column:
    """Days that are in a window as of one of two dates only."""
    a, b = sorted((old, new))
    d = F.col("day")
    return (d >= marts.window_start(a, days)) & (d < marts.window_start(b, days))


def _changes(old: DataFrame, new: DataFrame, source: Source, part: str, changed: list, was: str, now: str) -> DataFrame:
    """Signed sums per (customer, by): what the totals gain, and the changed days
    that go (``gone``) and come (``come``)."""
    names = list(source.measures)

    def weighted(rows: DataFrame, is_new: bool) -> DataFrame:
        zero = F.lit(0)
        again = F.lit(True) if is_new else in_periods(part, changed)
        out = rows.withColumn("w_l", F.lit(1) if is_new else F.when(again, F.lit(-1)).otherwise(zero))
        for k in source.windows:
            inside = lambda at: F.coalesce((F.col("day") >= marts.window_start(at, k)).cast("int"), zero)
            out = out.withColumn(f"w_{k}", inside(now) if is_new
                                 else F.when(again, -inside(was)).otherwise(inside(now) - inside(was)))
        seen = F.when((F.col("w_l") != 0) & F.col("day").isNotNull(), F.struct("day", "mx"))
        return out.withColumn("gone", F.lit(None).cast("date") if is_new else seen["day"]).withColumn(
            "come", seen if is_new else F.lit(None).cast("struct<day:date,mx:timestamp>"))

    both = weighted(old, False).unionByName(weighted(new, True))
    sums = [F.sum(F.col(n) * F.col(f"w_{k}")).cast(source.types[n]).alias(f"{n}_{k}")
            for k in ("l", *source.windows) for n in names]
    # changed days of a customer: bounded by the calendar
    return both.groupBy("customer_id", source.by).agg(*sums, F.collect_set("gone").alias("gone"), F.collect_list("come").alias("come"))


def _merged(state: DataFrame, changes: DataFrame, source: Source) -> DataFrame:
    totals = [f"{n}_{k}" for k in ("l", *source.windows) for n in source.measures]
    new = changes.select(F.col("customer_id").alias("k_customer"), F.col(source.by).alias("k_by"),
                         *[F.col(t).alias("d_" + t) for t in totals], "gone", "come")
    j = state.join(new, state["customer_id"].eqNullSafe(F.col("k_customer")) & state[source.by].eqNullSafe(F.col("k_by")), "full")
    kept = F.filter(F.coalesce("active", F.array().cast(state.schema["active"].dataType)),
                    lambda x: ~F.coalesce(F.array_contains("gone", x["day"]), F.lit(False)))
    zero = F.lit(0)
    out = j.select(F.coalesce("customer_id", "k_customer").alias("customer_id"),
                   F.when(F.col("customer_id").isNotNull(), F.col(source.by)).otherwise(F.col("k_by")).alias(source.by),
                   *[(F.coalesce(t, zero) + F.coalesce("d_" + t, zero)).cast(state.schema[t].dataType).alias(t) for t in totals],
                   F.concat(kept, F.coalesce("come", F.array().cast(state.schema["active"].dataType))).alias("active"))
    return out.filter(F.col("r_l") > 0)


def digests(facts: DataFrame, source: Source, part: str) -> DataFrame:
    """One row per period: number and hash sum of the columns that are kept."""
    row = F.xxhash64("customer_id", source.by, source.time, *source.reads).cast("decimal(38,0)")
    return facts.groupBy(part).agg(F.count(F.lit(1)).alias("n"), F.sum(row).alias("h"))


def _differing(own: DataFrame, path: str, part: str, days: DataFrame | None) -> list:
    """Periods whose digest is not the stored one. Without stored digests (a first
    run, or one after a stop) all of the table and all kept ones."""
    spark = own.sparkSession
    if not readers.table_exists(spark, path):
        every = own.select(part) if days is None else own.select(part).unionByName(days.select(part)).distinct()
        return [r[0] for r in every.collect()]                                             # one per period
    both = own.unionByName(spark.read.schema(own.schema).parquet(path)).groupBy(part, "n", "h").agg(F.count(F.lit(1)).alias("k"))
    return [r[0] for r in both.filter("k = 1").select(part).distinct().collect()]      # one per period


def refresh(spark: SparkSession, facts: DataFrame, root: str, as_of: str, source: Source = TRANSACTIONS,
            period: str = "day", changed: list | None = None, compare: bool = False) -> DataFrame:
    """Bring the state up to date and return it. ``facts`` has the period column
    (``incremental.PERIOD_COLUMNS``); its changed periods are those announced and
    those in ``changed``. For a fact that is rebuilt by each run, ``compare`` finds
    them by a digest per period. Without a state everything is built once."""
    part = incremental.PERIOD_COLUMNS[period]
    days_path, state_path, stage_path = (os.path.join(root, n) for n in ("days", "state", "stage"))
    newest = sinks.current_version(spark, state_path)
    folders, announced = changes.pending(spark, root)
    number, own, digest_path = 0, None, os.path.join(root, "digests")
    schema = day_partials(facts, source, part, period).schema
    if newest is not None:
        number = int(newest.rsplit("=", 1)[1])
        _swap_in(spark, newest, stage_path, days_path, part, schema)
    if compare:
        own = digests(facts, source, part).checkpoint()                   # one row per period
        held = None if newest is None else spark.read.schema(schema).parquet(days_path)
        changed = [*(changed or []), *_differing(own, digest_path, part, held)]

    if newest is not None:
        state = spark.read.parquet(newest)
        was = state.agg(F.max("as_of")).first()[0]
        changed = changes.ordered([*announced, *(changed or [])])
        new = day_partials(facts.filter(in_periods(part, changed)), source, part, period)
    else:
        state, was, changed = None, None, None
        new = day_partials(facts, source, part, period)

    # a changed period without rows is staged as one row without a customer
    version = os.path.join(stage_path, f"version={number + 1:06d}")
    if changed:
        marks = spark.createDataFrame([(p,) for p in changed], f"{part} date")
        missing = [F.lit(None).cast(new.schema[c].dataType).alias(c) for c in new.columns if c != part]
        new = new.unionByName(marks.select(part, *missing))
    # without a state there is nothing to swap: a stop leaves days that the next first run replaces
    at = days_path if newest is None else version
    sinks.write_table(new, at, [part])
    new = spark.read.schema(schema).parquet(at).filter(F.col("customer_id").isNotNull())

    totals = [f"{n}_{k}" for k in ("l", *source.windows) for n in source.measures]
    if state is None or was is None:
        whole = _changes(new.limit(0), new, source, part, [], as_of, as_of)
        out = whole.filter(F.col("r_l") > 0).select("customer_id", source.by, *totals, F.col("come").alias("active"))
    else:
        # literal periods: the changed ones and those with days that cross a window's start
        crossed = _periods_between(was, as_of, source.windows, period)
        slices = in_periods(part, changed)
        for k in source.windows:
            slices = slices | _moved(was, as_of, k)
        old = (spark.read.schema(new.schema).parquet(days_path).filter(in_periods(part, [*changed, *crossed]))
               .filter(F.col("customer_id").isNotNull() & slices))
        out = _merged(state, _changes(old, new, source, part, changed, was, as_of), source)
    target = os.path.join(state_path, f"version={number + 1:06d}")
    sinks.remove(spark, digest_path)                   # they do not hold for the state from here on
    sinks.write_table(out.withColumn("as_of", F.lit(as_of)), target)
    _swap_in(spark, target, stage_path, days_path, part, schema)
    if own is not None:
        sinks.write_table(own, digest_path)
    changes.forget(spark, folders)
    if number > 1:
        sinks.remove(spark, os.path.join(state_path, f"version={number - 1:06d}"))
    return spark.read.parquet(target)


def _periods_between(was: str, now: str, windows: tuple[int, ...], period: str) -> list:
    """Periods with a day that crosses the start of a window."""
    a, b = sorted(map(date.fromisoformat, (was, now)))
    return changes.ordered(p for k in windows for p in changes.periods_of(
        a - timedelta(days=k), b - timedelta(days=k + 1), period))


def _swap_in(spark: SparkSession, state: str, stage_path: str, days_path: str, part: str, schema: StructType) -> None:
    """Put the stage of this state version into ``days``; may be repeated."""
    stage = os.path.join(stage_path, os.path.basename(state))
    if readers.table_exists(spark, stage):
        sinks.write_partitions(spark.read.schema(schema).parquet(stage), days_path, [part])
        sinks.remove(spark, stage)


def transaction_features(state: DataFrame, as_of: str) -> DataFrame:
    """The transaction features from the state, as ``marts.transaction_features``
    gives them from the whole fact."""
    named = {"s30": "s_30", "a30": "a_30", "c30": "c_30", "s90": "s_90", "a90": "a_90", "c90": "c_90", "r90": "r_90",
             "sl": "s_l", "cl": "c_l"}
    rows = state.select("customer_id", "channel", *[F.col(c).alias(n) for n, c in named.items()],
                        F.array_max(F.transform("active", lambda x: x["mx"])).alias("mx"))
    return marts.features_from_channels(rows, as_of)


def support_features(state: DataFrame) -> DataFrame:
    """The support features from the state."""
    return marts.features_from_categories(state.select("customer_id", "category", F.col("r_l").alias("n"), F.col("c_l").alias("t"),
                                                       F.col("s_l").alias("hs"), F.col("a_l").alias("hn")))


def feature_store(dim: DataFrame, facts: DataFrame, support: DataFrame, root: str, as_of: str, run_ts: str,
                  period: str = "day", changed: list | None = None) -> DataFrame:
    """Q15 as ``marts.feature_store_customer`` gives it, from states under ``root``
    that this call brings up to date. ``facts`` has its period column; the ticket
    fact is rebuilt by every run, so its changed days are found by digest."""
    spark = dim.sparkSession
    tx = refresh(spark, facts, os.path.join(root, TRANSACTIONS.name), as_of, TRANSACTIONS, period, changed)
    part = incremental.PERIOD_COLUMNS[period]
    opened = support.withColumn(part, incremental.period_of(F.col(SUPPORT.time), period))
    sp = refresh(spark, opened, os.path.join(root, SUPPORT.name), as_of, SUPPORT, period, compare=True)
    return marts.feature_rows(dim, transaction_features(tx, as_of), support_features(sp), as_of, run_ts)
