"""Writes (K1-K7). Transforms never write; only the pipeline runner calls these."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _rebalanced(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Group rows by the partition columns before a partitioned write, so each
    task writes few files; AQE's rebalance coalesces small groups and splits a
    large one (a hot date is not one task)."""
    return df.hint("rebalance", *partition_by)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                rebalance: bool = True) -> None:
    """K1/K2/K4: full overwrite as Parquet, optionally Hive-partitioned.

    ``rebalance`` (partitioned writes only) costs one shuffle and is meant for
    many partition values (dates); with a handful (channels) every task writes
    at most that many files anyway, so it can be left off."""
    w = (_rebalanced(df, partition_by) if partition_by and rebalance else df).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace only the partitions present in ``df`` (dynamic overwrite)."""
    (_rebalanced(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by).parquet(path))


def quarantine_path(root: str, table: str) -> str:
    """K3: ``_quarantine/<table>`` next to the clean outputs."""
    return os.path.join(root, "_quarantine", table)


# --- versioned tables: the incremental target is never overwritten in place ---

POINTER = "_CURRENT"
DONE = "_SUCCESS"               # written by Spark when a write has been committed


def _path(spark: SparkSession, *parts: str):
    """(Hadoop path, its file system)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(*parts))
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder."""
    p, fs = _path(spark, path)
    fs.delete(p, True)


def _read_text(spark: SparkSession, *parts: str) -> str | None:
    """A small text file, None if it does not exist."""
    p, fs = _path(spark, *parts)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        jvm = spark.sparkContext._jvm
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return lines.readLine()
    finally:
        stream.close()


def _replace_text(spark: SparkSession, text: str, *parts: str) -> None:
    """Write one line to a file in one atomic step: readers see the old content
    or the new one, never none."""
    target, _ = _path(spark, *parts)
    tmp, fs = _path(spark, *parts[:-1], parts[-1] + ".tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray((text + "\n").encode()))
    finally:
        out.close()
    jvm = spark.sparkContext._jvm
    option = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(option, 1)
    how[0] = option.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(tmp, target, how)


def _versions(spark: SparkSession, table_root: str) -> list[tuple[int, bool]]:
    """(number, completely written) of every version folder, in order."""
    root, fs = _path(spark, table_root)
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    return sorted((int(n.split("=")[1]), fs.exists(_path(spark, table_root, n, DONE)[0]))
                  for n in names if n.startswith("version="))


def current_version(spark: SparkSession, table_root: str) -> str | None:
    """Path of the committed version of a versioned table, or None. Without a
    pointer (a stop before the first switch, or a lost file) it is the newest
    version that was written completely: whole versions are never forgotten."""
    name = _read_text(spark, table_root, POINTER)
    if not name:
        whole = [n for n, done in _versions(spark, table_root) if done]
        name = f"version={whole[-1]:06d}" if whole else None
    return os.path.join(table_root, name) if name else None


def commit_version(spark: SparkSession, df: DataFrame, table_root: str,
                   partition_by: list[str] | None = None) -> str:
    """Write ``df`` as a new version folder, then switch the pointer to it.

    The number is one above the highest folder there is, complete or not, so no
    version is ever written over. Readers of the previous version are unaffected
    while the write runs, a failed write leaves the pointer at the last good
    version, and the switch replaces the pointer atomically.
    """
    n = max((n for n, _ in _versions(spark, table_root)), default=-1) + 1
    name = f"version={n:06d}"
    write_table(df, os.path.join(table_root, name), partition_by)
    _replace_text(spark, name, table_root, POINTER)
    return os.path.join(table_root, name)


# --- partitioned tables: staged content, then a swap that a re-run can finish ---

MANIFEST = "_MANIFEST"


def overwrite_partitions(spark: SparkSession, content: DataFrame, touched: list, table_path: str,
                         part: str, stage_path: str) -> list:
    """Replace the ``touched`` partitions (values of ``part``) of a partitioned
    Parquet table with ``content``.

    The new content is written to ``stage_path`` first, so the table is never
    read and overwritten by one job. A manifest beside it names the partitions
    left without rows; from then on the stage is the truth and ``finish_swap``
    carries it into the table, in this run or, after a stop, in the next. A
    failure before the manifest leaves the table as it was. Returns the removed
    values.
    """
    write_table(content, stage_path, [part])
    # the content's schema, not partition-type inference (a stage holding only
    # the NULL partition would otherwise read back as type void)
    staged = spark.read.schema(content.schema).parquet(stage_path)
    # partition values only: at most one row per touched partition
    present = {r[0] for r in staged.select(part).distinct().collect()}
    emptied = [v for v in touched if v not in present]
    # date / number / plain-text values; NULL lives in Spark's default partition
    texts = ["__HIVE_DEFAULT_PARTITION__" if v is None else v.isoformat() if hasattr(v, "isoformat") else str(v)
             for v in emptied]
    _replace_text(spark, json.dumps({"part": part, "emptied": texts, "schema": content.schema.jsonValue()}),
                  stage_path, MANIFEST)
    finish_swap(spark, table_path, stage_path)
    return emptied


def finish_swap(spark: SparkSession, table_path: str, stage_path: str) -> bool:
    """Carry a complete stage into the table: its partitions replace the
    table's, emptied ones are removed, then the manifest goes. Every step may be
    repeated, so a swap stopped anywhere is finished by calling this again.
    False if there is nothing to finish."""
    text = _read_text(spark, stage_path, MANIFEST)
    if text is None:
        return False
    plan = json.loads(text)
    staged = spark.read.schema(StructType.fromJson(plan["schema"])).parquet(stage_path)
    write_partitions(staged, table_path, [plan["part"]])
    for value in plan["emptied"]:
        p, fs = _path(spark, table_path, f"{plan['part']}={value}")
        fs.delete(p, True)
    manifest, fs = _path(spark, stage_path, MANIFEST)
    fs.delete(manifest, False)
    return True
