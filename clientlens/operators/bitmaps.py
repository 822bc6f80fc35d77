"""Distinct customers as mergeable exact bitmaps.

Customers get dense numbers from 0; a set of customers is then a bitmap of one
bit per number, cut into buckets of 32,768 bits (Spark's bitmap functions). A
month's set is built once from its facts; sets of several months, of a channel or
of all time are merged with ``bitmap_or_agg`` and counted with ``bitmap_count``.
Merging reads 4 KB per bucket and month, whatever the number of facts, and is
exact, where counts per month cannot be added up.

Numbers are kept: new customers are numbered after the last one, so stored
bitmaps stay valid when customers come; a customer without a number is in no set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def number_customers(customers: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(customer_id, number): ``known`` numbers and gapless ones after them for the
    other customers. Nulls get none."""
    new = customers.select("customer_id").filter(F.col("customer_id").isNotNull()).distinct()
    if known is not None:
        new = new.join(known.select("customer_id"), "customer_id", "left_anti")
    # gapless across tasks: the place within the partition plus the rows before it
    placed = new.withColumn("at", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("at", 33)
    last = None if known is None else known.agg(F.max("number")).first()[0]
    begin, begins = 0 if last is None else last + 1, []
    for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect():   # one per partition
        begins.append((r.p, begin))
        begin += r.n
    offsets = customers.sparkSession.createDataFrame(begins, "p bigint, begin bigint")
    numbered = placed.join(F.broadcast(offsets), part.cast("long") == F.col("p")).select(
        "customer_id", (F.col("begin") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("number"))
    return numbered if known is None else known.select("customer_id", "number").unionByName(numbered)


def customer_sets(facts: DataFrame, numbers: DataFrame, *by) -> DataFrame:
    """(``by``, bucket, bits): the customers of each group of facts."""
    rows = facts.select("customer_id", *by).join(numbers, "customer_id")
    names = rows.columns[1:-1]
    return (rows.groupBy(*names, F.bitmap_bucket_number("number").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")))


def merged(sets: DataFrame, *by: str) -> DataFrame:
    """The union of sets within coarser groups."""
    return sets.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_customers(sets: DataFrame, *by: str, name: str = "unique_customers") -> DataFrame:
    """Exact distinct customers per group (sets of one group merged first)."""
    return merged(sets, *by).groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("bigint").alias(name))
