"""Stored layout of a fact: clustered by customer inside a period, and compacted
(K2, K4).

Rows lie in folders by period and customer cluster (a hash of the customer), sorted
by customer and time, so a look-up of one customer reads one cluster of each period
(partition filter) and, inside its files, the row groups whose statistics hold the
customer (pushed filter). Refreshes append small files; ``compact`` rewrites the
folders with several files as one sorted file each, and nothing else.

A folder's new content is staged and swapped in by dynamic partition overwrite; a
complete stage is swapped in first by the next call, so a stop in between loses
nothing.
"""

from __future__ import annotations

import os
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientlens.sources import readers, sinks

CLUSTER, CLUSTERS = "customer_cluster", 32


def cluster_of(customer: Column, clusters: int = CLUSTERS) -> Column:
    return F.pmod(F.xxhash64(customer), F.lit(clusters)).cast("int")


def _write(df: DataFrame, path: str, part: str, mode: str, time: str, folders: str = "static") -> None:
    """Rows of a folder together and sorted; a large folder is split by AQE.
    ``folders``: whether an overwrite replaces the table ("static") or only the
    folders that it writes ("dynamic")."""
    (df.hint("rebalance", part, CLUSTER).sortWithinPartitions(part, CLUSTER, "customer_id", time).write.mode(mode)
     .option("partitionOverwriteMode", folders).partitionBy(part, CLUSTER).parquet(path))


def append(df: DataFrame, path: str, part: str, time: str = "event_timestamp", clusters: int = CLUSTERS) -> None:
    """Add rows (with their period column) to the table at ``path``."""
    _write(df.withColumn(CLUSTER, cluster_of(F.col("customer_id"), clusters)), path, part, "append", time)


def of_customer(table: DataFrame, customer: str, clusters: int = CLUSTERS) -> DataFrame:
    """The rows of one customer, from its cluster's files only."""
    return table.filter((F.col(CLUSTER) == cluster_of(F.lit(customer), clusters)) & (F.col("customer_id") == customer))


def files_read(df: DataFrame) -> int:
    """Files that hold the rows a scan gives (a report for look-ups)."""
    return df.select(F.col("_metadata.file_path").alias("f")).distinct().count()


def fragmented(spark: SparkSession, path: str, part: str, files: int = 2) -> dict[str, list[int]]:
    """{period folder's text: clusters} of the folders with ``files`` files and more."""
    folders = Counter(os.path.dirname(f) for f in spark.read.parquet(path).inputFiles())
    out: dict[str, list[int]] = {}
    for folder, n in folders.items():
        if n >= files:
            period, cluster = (x.split("=", 1)[1] for x in folder.rsplit("/", 2)[1:])
            out.setdefault(period, []).append(int(cluster))
    return out


def compact(spark: SparkSession, path: str, part: str, time: str = "event_timestamp", files: int = 2) -> int:
    """Rewrite every folder with ``files`` files and more; the number of folders."""
    stage = path.rstrip("/") + "_compacted"
    schema = spark.read.parquet(path).schema
    _swap_in(spark, stage, path, part, time, schema)
    found = fragmented(spark, path, part, files)
    if not found:
        return 0
    null = "__HIVE_DEFAULT_PARTITION__"
    where = [(F.col(part).isNull() if p == null else F.col(part) == F.lit(p).cast(schema[part].dataType)) & F.col(CLUSTER).isin(c)
             for p, c in found.items()]
    _write(spark.read.schema(schema).parquet(path).filter(reduce(lambda a, b: a | b, where)), stage, part, "overwrite", time)
    _swap_in(spark, stage, path, part, time, schema)
    return sum(map(len, found.values()))


def _swap_in(spark: SparkSession, stage: str, path: str, part: str, time: str, schema) -> None:
    if readers.table_exists(spark, stage):
        _write(spark.read.schema(schema).parquet(stage), path, part, "overwrite", time, "dynamic")
    sinks.remove(spark, stage)
