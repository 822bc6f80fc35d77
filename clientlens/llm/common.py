"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientlens.session import ensure_checkpoint_dir, scratch_path

# Records and bytes of one Arrow batch on its way to a Python worker: a batch
# of long texts stays small whatever the text lengths are.
ARROW_RECORDS = 1000
ARROW_BYTES = 32 << 20

# Words of one block of texts that a task holds as numpy arrays at a time.
BLOCK_BYTES = 2 << 20

_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Session settings of the corpus operators: shared scratch folder, batch
    sizes towards the Python workers, and this package's code sent to the
    executors (they need not have it installed). Idempotent."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_RECORDS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="clientlens-code-"), "clientlens_code.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(root):
                for n in sorted(names):
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.relpath(full, os.path.dirname(root)))
        spark.sparkContext.addPyFile(path)
        _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Spark removes a query's shuffle files when it ends (it keeps them until the
# driver collects its garbage otherwise).
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: computed once, its
    lineage cut, readable after the loss of any executor. The shuffles of its
    computation are over then, and their files go at once."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{spark.sparkContext.applicationId}-{name}-{uuid.uuid4().hex}")
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)
    table = spark.read.schema(df.schema).parquet(path)
    table._written = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    for t in tables:
        path = t.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(t._written)
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, *wanted: str) -> list[str]:
    """Column names for helper columns that clash with none of ``df``'s."""
    taken = {c.lower() for c in df.columns}
    out = []
    for w in wanted:
        n = f"__{w}"
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def raw_texts(texts: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of each text (null stays None)."""
    return texts.cast(pa.binary()).to_pylist()


def blocks(raws: list[bytes | None], limit: int = BLOCK_BYTES):
    """(first, last) index ranges of consecutive texts of about ``limit``
    bytes together; one text is never cut."""
    first = size = 0
    for i, r in enumerate(raws):
        if i > first and size + len(r or b"") > limit:
            yield first, i
            first, size = i, 0
        size += len(r or b"")
    if first < len(raws):
        yield first, len(raws)


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_ROLL = np.uint64(0x9E3779B97F4A7C15)


def rolling(h: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of every window of ``n`` consecutive values (as many as
    ``len(h) - n + 1``; windows do not know document ends)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = h[:m].copy()
    for j in range(1, n):
        out *= _ROLL
        out += h[j:j + m]
    return mix64(out)


PIECE_BYTES = 1 << 20
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def pieces(raw: bytes, limit: int = PIECE_BYTES):
    """Consecutive parts of a text of about ``limit`` bytes, cut at blanks only:
    a very long text is worked on part by part, and no word is cut."""
    at = 0
    while len(raw) - at > limit:
        blank = _BLANK.search(raw, at + limit)
        if blank is None:
            break
        yield raw[at:blank.start()]
        at = blank.end()
    yield raw[at:] if at else raw
