"""Type-2 history: validity intervals from change events (Q9) and the
point-in-time (interval) join of facts onto versions (J6/J7).

Both avoid a window or join whose partition is one whole key:

* history: events are counted per (key, date, type, tier) first; the
  ordered window then runs over that collapsed table, whose size per key is
  bounded by calendar days, and the rows are expanded back afterwards in
  chunks of at most ``chunk_rows`` rows per task.
* interval join: versions meet the calendar years in which their key has
  facts (never years without one). The range test runs on distinct (key, day,
  midnight) points of the facts, not on fact rows, and facts take their matches
  by an equi-join on the point: a key with many facts never meets its versions
  row by row, and a key with many versions meets at most 732 points per year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from clientlens.functions.joins import by_merge
from clientlens.functions.scalar import open_end


def tier_history(customers: DataFrame, events: DataFrame, chunk_rows: int = 1 << 20,
                 backfill_signup: bool = False) -> DataFrame:
    """Q9: one row per customer x tier state.

    Customers with events get one version per event (valid from its date to
    the next event's date, open-ended for the last). Customers without events
    get one open-ended version from their signup date with their signup tier.
    Ties on one date are ordered by (event_type, new_tier).
    With ``backfill_signup`` a known customer whose signup precedes the first
    event also gets a version with the signup tier from signup to that event
    (sequence 1; the event versions then count from 2), so facts before the
    first event are not left without a tier.
    Columns: customer_id, loyalty_tier, valid_from, valid_to, tier_sequence, is_current.
    """
    order = ["event_date", "event_type", "new_tier"]
    counted = events.groupBy("customer_id", *order).agg(F.count(F.lit(1)).alias("k"))
    w = Window.partitionBy("customer_id").orderBy(*order)
    combos = counted.select(
        "customer_id", *order, "k",
        F.sum("k").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("last_seq"),
        F.lead("event_date").over(w).alias("next_date"))

    # chunk c covers sequence numbers [first + c*chunk, min(last, first + (c+1)*chunk - 1)];
    # spread by (customer, chunk), so a hot (customer, date, tier) group is
    # expanded by many tasks
    first = F.col("last_seq") - F.col("k") + 1
    lo = first + F.col("_c") * chunk_rows
    hi = F.least(F.col("last_seq"), lo + chunk_rows - 1)
    chunks = combos.withColumn("_c", F.explode(F.sequence(F.lit(0), ((F.col("k") - 1) / chunk_rows).cast("bigint"))))
    rows = chunks.repartition("customer_id", "_c").withColumn("tier_sequence", F.explode(F.sequence(lo, hi)))

    raw_to = F.when(F.col("tier_sequence") < F.col("last_seq"), F.col("event_date")).otherwise(F.col("next_date"))
    with_events = rows.select(
        "customer_id",
        F.col("new_tier").alias("loyalty_tier"),
        F.col("event_date").alias("valid_from"),
        F.coalesce(raw_to, open_end()).alias("valid_to"),
        F.col("tier_sequence").cast("bigint").alias("tier_sequence"),
        raw_to.isNull().alias("is_current"))

    has_events = events.select("customer_id").distinct()
    without = (customers.join(by_merge(has_events), "customer_id", "left_anti")
               .select("customer_id", "loyalty_tier",
                       F.col("signup_date").alias("valid_from"),
                       open_end().alias("valid_to"),
                       F.lit(1).cast("bigint").alias("tier_sequence"),
                       F.lit(True).alias("is_current")))
    if not backfill_signup:
        return with_events.unionByName(without)
    first = counted.groupBy("customer_id").agg(F.min("event_date").alias("_first"))
    backfill = (customers.join(by_merge(first), "customer_id")
                .filter(F.col("signup_date") < F.col("_first"))
                .select("customer_id", "loyalty_tier",
                        F.col("signup_date").alias("valid_from"),
                        F.col("_first").alias("valid_to"),
                        F.lit(1).cast("bigint").alias("tier_sequence"),
                        F.lit(False).alias("is_current")))
    shifted = (with_events.join(by_merge(backfill.select("customer_id", F.lit(1).alias("_shift"))), "customer_id", "left")
               .withColumn("tier_sequence", F.col("tier_sequence") + F.coalesce(F.col("_shift"), F.lit(0)))
               .select(*with_events.columns))
    return shifted.unionByName(without).unionByName(backfill)


def _by_year(versions: DataFrame, fact_years: DataFrame, key: str, valid_from: str, valid_to: str,
             version_cols: list[str]) -> DataFrame:
    """Versions once per year in which their key has facts and they are valid
    (``fact_years``: distinct ``_yk``, ``_vy``), with bounds ``_vf``/``_vt``."""
    v = versions.select(F.col(key).alias("_vk"), F.col(valid_from).alias("_vf"),
                        F.col(valid_to).alias("_vt"), *version_cols)
    return (v.join(by_merge(fact_years), (F.col("_vk") == F.col("_yk")) & F.col("_vy").between(F.year("_vf"), F.year("_vt")))
            .drop("_yk"))


def _fact_years(facts: DataFrame, key: str, day: str) -> DataFrame:
    return (facts.filter(F.col(key).isNotNull() & F.col(day).isNotNull())
            .select(F.col(key).alias("_yk"), F.year(day).alias("_vy")).distinct())


def point_in_time_join(facts: DataFrame, versions: DataFrame, key: str, ts: str,
                       version_cols: list[str], closed: str = "left",
                       valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Left-join each fact to the version of its key valid at time ``ts``.

    ``closed='both'`` tests ``valid_from <= ts <= valid_to`` (a fact at midnight
    of a change day then meets two versions, as with SQL BETWEEN);
    ``closed='left'`` tests ``valid_from <= ts < valid_to`` (exactly one).
    ``version_cols`` are carried from the version side (renamed by the caller
    if they clash with fact columns).

    With date bounds (the SCD2 dimension), whether a fact falls in a version
    depends only on (key, date of ``ts``, ``ts`` at midnight), so the range test
    runs on the distinct such *points* — at most 732 per key and year, however
    many facts a key has — inner-joined to the versions by (key, year), which
    AQE may split on either side. Versions enter as distinct intervals, without
    ``version_cols``: many versions of one interval (a key that repeats on the
    version side) are not multiplied by points and years. Facts meet their
    intervals by an equi-join on the point, spread over tasks by (key, day), and
    take the versions of the interval by another, whose hot partitions AQE splits
    on the side of the facts. No facts, no versions: an empty slice replicates
    nothing, and a far-future fact only its own year.
    """
    if closed not in ("both", "left"):
        raise ValueError("closed must be 'both' or 'left'")
    date_bounds = all(isinstance(versions.schema[c].dataType, DateType) for c in (valid_from, valid_to))
    if not date_bounds:
        return _interval_join(facts, versions, key, ts, version_cols, closed, valid_from, valid_to)
    both = closed == "both"
    t = F.col(ts)
    f = facts.withColumn("_pd", F.to_date(t))
    if both:
        f = f.withColumn("_pm", t == F.col("_pd").cast("timestamp"))
    pkeys = [key, "_pd"] + (["_pm"] if both else [])
    known = f.filter(F.col(key).isNotNull() & F.col("_pd").isNotNull())
    points = known.select(*pkeys).distinct().withColumn("_py", F.year("_pd"))
    # versions of the same interval meet the points as one
    spans = versions.select(key, valid_from, valid_to).distinct()
    v = _by_year(spans, _fact_years(known, key, "_pd"), key, valid_from, valid_to, [])
    d, vt = F.col("_pd"), F.col("_vt")
    if both:
        upper = (d < vt) | ((d == vt) & F.col("_pm"))
    else:
        upper = d < vt
        v = v.filter(F.col("_vf") < vt)            # empty versions match nothing
    matches = (points.join(by_merge(v), (F.col(key) == F.col("_vk")) & (F.col("_py") == F.col("_vy"))
                           & (d >= F.col("_vf")) & upper)
               .select(*[F.col(k).alias("_m" + k) for k in pkeys], F.col("_vf").alias("_match_from"), F.col("_vt").alias("_match_to")))
    on = [F.col(k) == F.col("_m" + k) for k in pkeys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    placed = f.join(by_merge(matches), cond, "left").drop(*pkeys[1:], *["_m" + k for k in pkeys])
    carried = versions.select(F.col(key).alias("_vk"), F.col(valid_from).alias("_vf"), F.col(valid_to).alias("_vt"), *version_cols)
    same = (F.col(key) == F.col("_vk")) & (F.col("_match_from") == F.col("_vf")) & (F.col("_match_to") == F.col("_vt"))
    return (placed.join(by_merge(carried), same, "left")
            .drop("_match_from", "_match_to", "_vk", "_vf", "_vt"))


def _interval_join(facts: DataFrame, versions: DataFrame, key: str, ts: str, version_cols: list[str],
                   closed: str, valid_from: str, valid_to: str) -> DataFrame:
    """For timestamp bounds: facts join the versions of their key and year plus
    the range test."""
    v = _by_year(versions, _fact_years(facts, key, ts), key, valid_from, valid_to, version_cols)
    v = v.withColumn("_vf", F.col("_vf").cast("timestamp")).withColumn("_vt", F.col("_vt").cast("timestamp"))
    f = facts.withColumn("_fy", F.year(F.col(ts)))
    t = F.col(ts)
    upper = (t <= F.col("_vt")) if closed == "both" else (t < F.col("_vt"))
    cond = (F.col(key) == F.col("_vk")) & (F.col("_fy") == F.col("_vy")) & (t >= F.col("_vf")) & upper
    return f.join(by_merge(v), cond, "left").drop("_vk", "_vf", "_vt", "_vy", "_fy")
