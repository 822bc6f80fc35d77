"""Scans of the raw inputs and of written zones."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clientlens.sources import schemas

# Lines that do not parse keep their raw text in this column (``keep_corrupt``),
# with the fields that did parse beside it.
CORRUPT = "_corrupt_record"


def _kept(reader, schema, keep_corrupt: bool):
    if not keep_corrupt:
        return reader.schema(schema)
    return (reader.schema(StructType([*schema.fields, StructField(CORRUPT, StringType())]))
            .option("columnNameOfCorruptRecord", CORRUPT))


def _csv(spark: SparkSession, schema, path: str, keep_corrupt: bool = False) -> DataFrame:
    # header names are checked against the schema (a reordered or renamed header
    # fails instead of binding columns by position)
    reader = (spark.read.option("header", True).option("enforceSchema", False)
              .option("mode", "PERMISSIVE"))
    return _kept(reader, schema, keep_corrupt).csv(path)


def _json(spark: SparkSession, schema, path: str, keep_corrupt: bool = False) -> DataFrame:
    return _kept(spark.read.option("mode", "PERMISSIVE"), schema, keep_corrupt).json(path)


def load_customers(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    """Newline-delimited JSON customers under an explicit flat schema."""
    return _json(spark, schemas.CUSTOMERS, path, keep_corrupt)


def load_transactions(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    """Headered CSV transactions; empty fields read as NULL.

    With ``keep_corrupt`` a ``_corrupt_record`` column holds the raw line of
    rows whose fields failed to parse (e.g. a non-numeric amount).
    """
    return _csv(spark, schemas.TRANSACTIONS, path, keep_corrupt)


def load_support_tickets(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    """S3: nested JSON tickets with an array of message structs."""
    return _json(spark, schemas.SUPPORT_TICKETS, path, keep_corrupt)


def load_loyalty_events(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    """Headered CSV of loyalty tier changes."""
    return _csv(spark, schemas.LOYALTY_EVENTS, path, keep_corrupt)


def load_duplicate_key(spark: SparkSession, path: str) -> DataFrame:
    """Answer key of known duplicates (NDJSON)."""
    return spark.read.schema(schemas.DUPLICATE_KEY).json(path)


def zone_path(root: str, zone: str, table: str) -> str:
    """K7: a zone name is used verbatim as a folder under the root."""
    return os.path.join(root, zone, table)


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a readable Parquet table (used for K6/S9)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    return bool(fs.exists(p)) and bool(fs.exists(jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")))


def listing(spark: SparkSession, folder: str) -> tuple:
    """(path, bytes, modification time) of the files in a folder and in its
    direct sub-folders."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for pattern in ("*", "*/*"):
        p = jvm.org.apache.hadoop.fs.Path(folder, pattern)
        for s in p.getFileSystem(conf).globStatus(p) or []:
            if s.isFile():
                out.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return tuple(sorted(out))


class MissingInput(RuntimeError):
    pass


def check_raw_paths(spark: SparkSession, paths: dict[str, str]) -> None:
    """S10 for files: every named input path must exist (checked before any scan)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    missing = []
    for name, path in paths.items():
        p = jvm.org.apache.hadoop.fs.Path(path)
        if not p.getFileSystem(conf).exists(p):
            missing.append(name)
    if missing:
        raise MissingInput(f"raw inputs missing: {', '.join(sorted(missing))}")


def check_raw_inputs(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    """Preflight — every raw input must be present and non-empty."""
    empty = [name for name, df in frames.items() if df.isEmpty()]
    if empty:
        raise MissingInput(f"raw inputs empty or missing: {', '.join(sorted(empty))}")


def corrupt_rows(df: DataFrame) -> DataFrame:
    """Rows whose CSV fields failed to parse (needs ``keep_corrupt=True``).

    Spark refuses queries that reference only the corrupt-record column of a
    raw file, so report or write these rows whole (all columns).
    """
    return df.filter(F.col(CORRUPT).isNotNull())
