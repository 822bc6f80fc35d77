"""Tier history and dimension kept up to date for changed customers only
(Q9, Q11, J5).

``versions`` holds, by customer bucket, every tier interval with its customer's
attributes: the history is its projection, the dimension its rows of known
customers plus what depends on the as-of date. A run takes the staged customers
and events as they are delivered (whole) and

1. sums a digest per customer over both tables (one narrow aggregation), and a
   digest per bucket over those; buckets that equal the stored ones are left
   alone and not read;
2. compares customer digests within the other buckets: new, changed and gone
   customers, late events included, whatever their date;
3. cuts the intervals of those customers anew, from their own events; the other
   rows of the bucket are carried over as they are;
4. stages the buckets with their customer digests and swaps both in by dynamic
   partition overwrite; the bucket digests are stored last.

A complete stage is swapped in first by the next run (again, if need be), so
versions and customer digests always go together. The bucket digests are removed
before a swap; a run that finds none sums them from the customer digests.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientlens.functions.joins import by_merge
from clientlens.functions.scalar import surrogate_key
from clientlens.operators import marts, scd2
from clientlens.sources import readers, sinks

BUCKETS = 64
ATTRIBUTES = ["first_name", "last_name", "email", "state", "signup_date", "is_likely_duplicate"]
SCHEMA = ("customer_id string, loyalty_tier string, valid_from date, valid_to date, tier_sequence bigint, is_current boolean, "
          "first_name string, last_name string, email string, state string, signup_date date, is_likely_duplicate boolean, "
          "known boolean, bucket int")
DIGESTS = "customer_id string, n bigint, h decimal(38,0), bucket int"
HISTORY = ["customer_id", "loyalty_tier", "valid_from", "valid_to", "tier_sequence", "is_current"]


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("customer_id"), F.lit(buckets)).cast("int").alias("bucket")


def customer_digests(customers: DataFrame, events: DataFrame, buckets: int) -> DataFrame:
    """(customer_id, n, h, bucket): rows and hash sum of all that a customer's versions come from."""
    c = customers.select("customer_id", F.xxhash64(F.lit("c"), "loyalty_tier", *ATTRIBUTES).alias("h"))
    e = events.select("customer_id", F.xxhash64(F.lit("e"), "event_type", "new_tier", "event_date").alias("h"))
    return (c.unionByName(e).groupBy("customer_id")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("h"))
            .select("customer_id", "n", "h", _bucket(buckets)))


def _bucket_digests(digests: DataFrame) -> DataFrame:
    """One row per bucket."""
    return digests.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum(
        F.xxhash64("customer_id", "n", "h").cast("decimal(38,0)")).alias("h"))


def cut(customers: DataFrame, events: DataFrame, buckets: int) -> DataFrame:
    """Versions with attributes and bucket, all cut anew."""
    c = customers.select("customer_id", *ATTRIBUTES, F.lit(True).alias("known"))
    return (scd2.tier_history(customers, events).join(by_merge(c), "customer_id", "left")
            .select(*HISTORY, *ATTRIBUTES, F.coalesce("known", F.lit(False)).alias("known"), _bucket(buckets)))


def _swap_in(spark: SparkSession, root: str) -> None:
    stage = os.path.join(root, "stage")
    # the digests are staged last: a stage is complete with them
    if readers.table_exists(spark, os.path.join(stage, "digests")):
        sinks.remove(spark, os.path.join(root, "buckets"))
        for name, schema in (("versions", SCHEMA), ("digests", DIGESTS)):
            sinks.write_partitions(spark.read.schema(schema).parquet(os.path.join(stage, name)), os.path.join(root, name), ["bucket"])
    sinks.remove(spark, stage)


def refresh(customers: DataFrame, events: DataFrame, root: str, buckets: int = BUCKETS) -> DataFrame:
    """Bring ``versions`` up to date and return them. ``buckets`` holds for the
    life of the state."""
    spark = customers.sparkSession
    path, digest_path, sums_path, stage = (os.path.join(root, n) for n in ("versions", "digests", "buckets", "stage"))
    _swap_in(spark, root)
    own = customer_digests(customers, events, buckets).checkpoint()
    sums = _bucket_digests(own).checkpoint()
    if not readers.table_exists(spark, digest_path):
        sinks.write_table(cut(customers, events, buckets), path, ["bucket"])
        sinks.write_table(own, digest_path, ["bucket"])
        sinks.write_table(sums, sums_path)
        return read(spark, root)
    kept = spark.read.schema(DIGESTS).parquet(digest_path).filter("n is not null")
    held = spark.read.schema(sums.schema).parquet(sums_path) if readers.table_exists(spark, sums_path) else _bucket_digests(kept)
    apart = sums.unionByName(held).groupBy("bucket", "n", "h").agg(F.count(F.lit(1)).alias("k")).filter("k = 1")
    touched = [r[0] for r in apart.select("bucket").distinct().collect()]                 # at most ``buckets``
    if not touched:
        return read(spark, root)
    here = F.col("bucket").isin(touched)
    fresh = own.filter(here)
    changed = (fresh.unionByName(kept.filter(here)).groupBy("customer_id", "n", "h").agg(F.count(F.lit(1)).alias("k"))
               .filter("k = 1").select(F.col("customer_id").alias("changed")).distinct().checkpoint())
    of = lambda df: df.join(by_merge(changed), F.col("customer_id").eqNullSafe(F.col("changed")), "left_semi")
    carried = read(spark, root).filter(here).join(by_merge(changed), F.col("customer_id").eqNullSafe(F.col("changed")), "left_anti")
    content = carried.unionByName(cut(of(customers), of(events), buckets))
    # a bucket without customers is overwritten by one row without any
    none = spark.createDataFrame([(b,) for b in touched], "bucket int").join(
        fresh.select(F.col("bucket").alias("held")).distinct(), F.col("bucket") == F.col("held"), "left_anti")

    def marked(rows: DataFrame) -> DataFrame:
        blank = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns if c != "bucket"]
        return rows.unionByName(none.select(*blank, "bucket"))

    sinks.write_table(marked(content), os.path.join(stage, "versions"), ["bucket"])
    sinks.write_table(marked(fresh), os.path.join(stage, "digests"), ["bucket"])
    _swap_in(spark, root)
    sinks.write_table(sums, sums_path)
    return read(spark, root)


def read(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(os.path.join(root, "versions")).filter(F.col("tier_sequence").isNotNull())


def history(versions: DataFrame) -> DataFrame:
    """Q9 from the kept versions."""
    return versions.select(*HISTORY)


def dimension(versions: DataFrame, as_of: str, run_ts: str) -> DataFrame:
    """Q11 from the kept versions: no join, no shuffle."""
    age = marts.day_diff(F.lit(as_of).cast("date"), F.col("signup_date"))
    return versions.filter("known").select(
        surrogate_key("customer_id", "valid_from").alias("customer_sk"), "customer_id", "first_name", "last_name", "email",
        "state", "signup_date", "is_likely_duplicate", "loyalty_tier", "valid_from", "valid_to", "is_current", "tier_sequence",
        age.alias("customer_age_days"), marts.customer_segment(age).alias("customer_segment"),
        F.lit(run_ts).cast("timestamp").alias("_loaded_at"))
