"""Bucketed, sorted storage of facts and versions, and their point-in-time join
without a shuffle (J6, J7).

Both tables are stored in ``buckets`` buckets by (customer_id, slot), sorted, so a
join on the two columns reads bucket against bucket: the plan has no Exchange on
either side. A customer with more than ``SLOT_ROWS`` facts would fill one bucket,
so its facts are dealt over several slots by a hash of the fact's key, and its few
versions are stored once per slot; every other customer has slot 0 only. The slots
of hot customers are a small table (at most facts / SLOT_ROWS rows).

The tables are external: their files lie at a given path and are attached to a
session's catalog under a name.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientlens.operators import marts

BUCKETS = 16
SLOT_ROWS = 1 << 20


def slots_of(facts: DataFrame, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """(customer_id, slots) of customers with more than ``slot_rows`` facts."""
    n = F.ceil(F.col("n") / slot_rows).cast("int")
    return (facts.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > slot_rows)
            .select("customer_id", n.alias("slots")))


def _store(df: DataFrame, name: str, path: str, buckets: int, *then: str) -> DataFrame:
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    # one task a bucket, so a bucket is one sorted file
    (df.repartition(buckets, "customer_id", "slot").write.mode("overwrite").option("path", path)
     .bucketBy(buckets, "customer_id", "slot").sortBy("customer_id", "slot", *then).saveAsTable(name))
    return spark.table(name)


def store(facts: DataFrame, versions: DataFrame, root: str, name: str, key: str = "transaction_id", time: str = "event_timestamp",
          buckets: int = BUCKETS, slot_rows: int = SLOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Store both tables under ``root`` and attach them as ``<name>_facts`` and
    ``<name>_versions``."""
    slots = slots_of(facts, slot_rows).checkpoint()
    many = F.coalesce("slots", F.lit(1))
    dealt = facts.join(slots, "customer_id", "left").withColumn("slot", F.pmod(F.xxhash64(key), many).cast("int")).drop("slots")
    held = (versions.join(slots, "customer_id", "left")
            .withColumn("slot", F.explode(F.sequence(F.lit(0), many - 1))).drop("slots"))
    return (_store(dealt, f"{name}_facts", os.path.join(root, "facts"), buckets, time),
            _store(held, f"{name}_versions", os.path.join(root, "versions"), buckets, "valid_from"))


def attach(spark: SparkSession, name: str, path: str, schema, buckets: int = BUCKETS) -> DataFrame:
    """A stored table in another session's catalog."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (customer_id, slot) "
              f"SORTED BY (customer_id, slot) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def point_in_time(facts: DataFrame, versions: DataFrame, time: str, columns: list[str], closed: str = "left") -> DataFrame:
    """Each fact with the version that holds at its time (columns of ``versions``;
    null without one), by a join of bucket with bucket."""
    if closed not in ("both", "left"):
        raise ValueError("closed must be 'both' or 'left'")
    v = versions.select(F.col("customer_id").alias("v_customer"), F.col("slot").alias("v_slot"),
                        F.col("valid_from").cast("timestamp").alias("v_from"), F.col("valid_to").cast("timestamp").alias("v_to"), *columns)
    t = F.col(time)
    upper = t <= F.col("v_to") if closed == "both" else t < F.col("v_to")
    # a sort-merge join: both sides are sorted, and a hash join would hold a bucket
    return facts.hint("merge").join(v.hint("merge"), (F.col("customer_id") == F.col("v_customer")) & (F.col("slot") == F.col("v_slot"))
                                    & (t >= F.col("v_from")) & upper, "left").drop("v_customer", "v_slot", "v_from", "v_to", "slot")


def fact_transactions(facts: DataFrame, versions: DataFrame, closed: str = "left") -> DataFrame:
    """Q12 from stored staged transactions and versions."""
    return marts.transaction_rows(point_in_time(facts, versions, "event_timestamp", marts.VERSION_ATTRS, closed))
