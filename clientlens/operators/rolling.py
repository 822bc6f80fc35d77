"""Trailing time-range sums per key that stay balanced under key skew.

For each row the result covers rows of the same key whose time lies in
``[t - days, t]`` at one-second resolution, both ends inclusive, rows of the
same second seeing each other — the semantics of
``Window.partitionBy(key).orderBy(epoch_seconds).rangeBetween(-days*86400, 0)``.

That plain window sorts all rows of a key in one task, so a key holding a
third of the data becomes one task holding a third of the data. Here time
is cut into blocks as long as the frame, so that a frame is the end of one block
and the start of the next, for every key alike:

* rows are first collapsed to one row per (key, second)   — map-side combine
* start of the own block: the running sum up to the row
* end of the block before: the sum of its seconds at or after the row's time less
  ``days`` days, which a probe placed there reads off the same running sum.

A partition is a (key, block): at most one row and one probe per second of the
block, however many rows the key has. Each second is read once, moved to its block
and its probe's, and the two parts meet in one sum by (key, second).

Sums are carried as exact decimals together with non-null counts, so a frame
whose values are all NULL yields NULL, as in a window aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientlens.functions.joins import by_merge

DAY = 86400


METRICS = ["s", "nv", "nc"]


def _keyed(df: DataFrame, key: str, ts: str) -> DataFrame:
    # the key wrapped in a struct: never NULL and equal when both keys are NULL,
    # so plain equi-joins keep NULL keys together (as a window partition does)
    # and can reuse the (key, second) partitioning of earlier steps
    return df.withColumn("_rk", F.struct(F.col(key).alias("k"))).withColumn("_rs", F.unix_seconds(F.col(ts)))


def second_sums(df: DataFrame, key: str, ts: str, value: Column, counted: str) -> DataFrame:
    """One row per (key, second): peers in the same second collapse here."""
    return (_keyed(df, key, ts).filter(F.col("_rs").isNotNull())
            .groupBy("_rk", "_rs")
            .agg(F.coalesce(F.sum(value), F.lit(0)).alias("s"),
                 F.count(value).alias("nv"),
                 F.count(F.col(counted)).alias("nc")))


def second_frames(per_sec: DataFrame, days: int, sum_name: str, count_name: str, sum_type: str) -> DataFrame:
    """(``_ok``, ``_os``, sum, count): the trailing frame of every (key, second)."""
    span, metrics = days * DAY, METRICS
    block = F.floor(F.col("_rs") / span).cast("bigint")

    def placed(probe: int) -> Column:
        # a row of its own block, or a probe without value in the one before
        return F.struct((block - probe).alias("_rb"), (F.col("_rs") - probe * span).alias("_at"), F.lit(probe).alias("_probe"),
                        *[(F.lit(0).cast(per_sec.schema[m].dataType) if probe else F.col(m)).alias("v_" + m) for m in metrics])

    rows = per_sec.select("_rk", "_rs", F.explode(F.array(placed(0), placed(1))).alias("p")).select("_rk", "_rs", "p.*")
    # one order for both: the rows are sorted and gone through once
    back = Window.partitionBy("_rk", "_rb").orderBy(F.col("_at").desc(), F.col("_probe").asc())
    later = back.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = back.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = rows.select("_rk", "_rs", "_probe", *["v_" + m for m in metrics],
                       *[F.sum("v_" + m).over(later).alias("l_" + m) for m in metrics],
                       *[F.sum("v_" + m).over(whole).alias("b_" + m) for m in metrics])
    # a row has its block's sum less the later seconds', a probe the later ones'
    per_second = (sums.groupBy(F.col("_rk").alias("_ok"), F.col("_rs").alias("_os"))
                  .agg(*[F.sum(F.when(F.col("_probe") == 1, F.col("l_" + m))
                               .otherwise(F.col("b_" + m) - F.col("l_" + m) + F.col("v_" + m))).alias("w_" + m) for m in metrics]))
    return per_second.select(
        "_ok", "_os",
        F.when(F.col("w_nv") > 0, F.col("w_s")).cast(sum_type).alias(sum_name),
        F.col("w_nc").cast("bigint").alias(count_name))


def with_frames(df: DataFrame, key: str, ts: str, frames: DataFrame, sum_name: str, count_name: str) -> DataFrame:
    """``df`` with the frame of each row's (key, second)."""
    out = _keyed(df, key, ts).join(by_merge(frames), (F.col("_rk") == F.col("_ok")) & (F.col("_rs") == F.col("_os")), "left")
    return out.select(*df.columns, sum_name, count_name)


def rolling_sum_count(df: DataFrame, key: str, ts: str, value: Column | str, counted: str,
                      days: int, sum_name: str, count_name: str,
                      sum_type: str = "decimal(18,2)") -> DataFrame:
    """Append ``sum_name`` (sum of ``value``) and ``count_name`` (count of
    non-null ``counted``) over the trailing ``days``-day frame of each row."""
    value = F.col(value) if isinstance(value, str) else value
    frames = second_frames(second_sums(df, key, ts, value, counted), days, sum_name, count_name, sum_type)
    return with_frames(df, key, ts, frames, sum_name, count_name)
