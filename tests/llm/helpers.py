"""Small tables with the awkward cases every corpus operator must take."""

import os
import tempfile

from pyspark.sql import functions as F

LONG = " ".join(f"word{i}" for i in range(30_000))

# null and empty texts, one word, no letter, ties, a repeated row, a null id, a very long text
AWKWARD = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"),
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"),
    (2, None),
    (3, ""),
    (4, "word"),
    (5, "12 34 !!"),
    (None, "a row without an id but with words"),
    (6, LONG),
    (7, "Ünïcödé ñandú \U0001F642 日本語 İstanbul ΣΑΣ\x1c x y"),
    (8, " \n\t\n "),
]


def awkward(spark, rows=AWKWARD, extra=True):
    """doc_id, text and columns whose names clash with the operators' own."""
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    if extra:
        for name in ("__hits", "__row", "__key", "__figures", "quality", "language", "ids", "start", "shard", "slot", "lang"):
            df = df.withColumn(name, F.lit("taken"))
        df = df.withColumn("n_chars", F.lit(None).cast("long"))
    return df


def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")


def sf_dir(**tables):
    """A folder with the tables as the queries read them."""
    root = tempfile.mkdtemp(prefix="clientlens-llm-")
    for name, df in tables.items():
        df.write.parquet(os.path.join(root, f"{name}.parquet"))
    return root
