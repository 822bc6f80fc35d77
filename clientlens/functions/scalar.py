"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values shared with the warehouse conventions the pipeline reproduces.
OPEN_END_DATE = "9999-12-31"                       # open validity end of a version
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"  # null stand-in in hashed keys
MONEY = "decimal(18,2)"
ISO_DATE_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize(c: str | Column) -> Column:
    """``lower(trim(c))`` — the blocking / comparison normal form."""
    return F.lower(F.trim(col(c)))


def email_prefix(c: str | Column) -> Column:
    """Text before the first ``@`` (whole string when there is none)."""
    return F.substring_index(col(c), "@", 1)


def parse_event_ts(c: str | Column) -> Column:
    """Tolerant timestamp parse that also requires an ISO date prefix.

    ``try_to_timestamp`` alone accepts ``2024`` or ``10:11`` (the latter
    becomes *today*), so the shape check keeps such text out.
    """
    c = col(c)
    return F.when(c.rlike(ISO_DATE_SHAPE), F.try_to_timestamp(c))


def parse_date(c: str | Column) -> Column:
    """``yyyy-MM-dd`` text to date, NULL when it does not parse."""
    c = col(c)
    return F.when(c.rlike(ISO_DATE_SHAPE + "$"), F.try_to_date(c, "yyyy-MM-dd"))


def parse_ts(c: str | Column) -> Column:
    """Text to timestamp, NULL when it does not parse (never raises)."""
    return F.try_to_timestamp(col(c))


def money(c: str | Column) -> Column:
    """Money as exact decimal(18,2)."""
    return col(c).cast(MONEY)


def day_diff(end: str | Column, start: str | Column) -> Column:
    """Calendar days from ``start`` to ``end`` (date boundaries crossed)."""
    return F.datediff(F.to_date(col(end)), F.to_date(col(start))).cast("bigint")


def hour_boundaries_between(start: str | Column, end: str | Column) -> Column:
    """Number of hour boundaries crossed from ``start`` to ``end``.

    00:59 -> 01:01 is 1 hour; this is not ``timestampdiff(HOUR)``, which
    counts whole 60-minute spans.
    """
    s = F.unix_seconds(F.date_trunc("hour", col(start)))
    e = F.unix_seconds(F.date_trunc("hour", col(end)))
    return ((e - s) / F.lit(3600)).cast("bigint")


def zero_safe_div(num: str | Column, den: str | Column) -> Column:
    """``num / nullif(den, 0)`` in double precision."""
    d = col(den).cast("double")
    return F.when(d != 0, col(num).cast("double") / d)


def mean(c: str | Column) -> Column:
    """Average as ``sum / count`` in double: the same IEEE division everywhere."""
    c = col(c)
    return F.sum(c).cast("double") / F.count(c)


def money_avg_from(total: Column, n: Column) -> Column:
    """Money average from a decimal(18,2) total and a row count.

    Rounded half away from zero to whole cents with integer arithmetic, so the
    result is exact regardless of how the sum was partitioned.
    """
    cents = (total * 100).cast("bigint")
    mag = F.floor((F.abs(cents) * 2 + n) / (n * 2)).cast("bigint")
    rounded = F.when(cents < 0, -mag).otherwise(mag)
    return F.when(n > 0, (rounded / F.lit(100.0)).cast(MONEY))


def money_sum(c: str | Column) -> Column:
    return F.sum(col(c)).cast(MONEY)


def money_avg(c: str | Column) -> Column:
    """Aggregate: average of a money column, exact to the cent."""
    c = col(c)
    return money_avg_from(F.sum(c), F.count(c))


def surrogate_key(*cols: str | Column) -> Column:
    """md5 over '-'-joined text of the columns, NULLs replaced by a token."""
    parts = [F.coalesce(col(c).cast("string"), F.lit(SURROGATE_NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def open_end() -> Column:
    return F.lit(OPEN_END_DATE).cast("date")


def mode_key(count: Column, value: Column) -> Column:
    """Ordering struct for a mode: highest count first, then the smallest value."""
    return F.struct((-count).alias("neg_count"), value.alias("value"))
