"""Periods that a table refresh is about to change, noted for the tables that
are derived from it.

A note is a complete folder with one row per period. It is written before the
table changes and removed after the derived table has followed, so a stop in
between leaves it for the next run; following twice changes nothing.
"""

from __future__ import annotations

import os
import uuid
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientlens.sources import readers, sinks


def in_periods(part: str, values: list) -> Column:
    """Literal partition filter; None stands for rows without a time."""
    some = [v for v in values if v is not None]
    found = F.col(part).isin(some) if some else F.lit(False)
    return found | F.col(part).isNull() if len(some) < len(values) else found


def outside_periods(part: str, values: list) -> Column:
    """The other periods, rows without a time among them unless None is listed."""
    return ~F.coalesce(in_periods(part, values), F.lit(False))


def ordered(periods) -> list:
    return sorted(set(periods), key=lambda p: (p is not None, p))


def periods_of(first: date, last: date, period: str) -> list[date]:
    """The periods (days, or months by their first day) from one day to another."""
    days = (first + timedelta(days=i) for i in range((last - first).days + 1))
    return list(days) if period == "day" else sorted({d.replace(day=1) for d in days})


def last_day(start: date, period: str) -> date:
    return start if period == "day" else (start.replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)


def announce(spark: SparkSession, root: str, part: str, periods: list) -> None:
    """Note for the derived table under ``root`` that ``periods`` will change."""
    if periods:
        df = spark.createDataFrame([(p,) for p in periods], f"{part} date").coalesce(1)
        sinks.write_table(df, os.path.join(root, "pending", f"change={uuid.uuid4().hex}"))


def pending(spark: SparkSession, root: str) -> tuple[list[str], list]:
    """(folders of the notes, their periods)."""
    done = [p for p, _, _ in readers.listing(spark, os.path.join(root, "pending")) if p.endswith("/" + sinks.DONE)]
    folders = [os.path.dirname(p) for p in done]
    return folders, ordered(r[0] for f in folders for r in spark.read.parquet(f).collect())       # one per period


def forget(spark: SparkSession, folders: list[str]) -> None:
    for f in folders:
        sinks.remove(spark, f)


def newest(target: DataFrame, part: str):
    """The last period that has rows (from the partition values alone)."""
    return target.agg(F.max(part)).first()[0]
