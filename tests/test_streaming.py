"""The fact refresh run per micro-batch through ``foreachBatch``."""

import os

from pyspark.sql import functions as F

from clientlens.operators.incremental import refresh_fact_transactions
from clientlens.operators.marts import fact_transactions
from clientlens.plans.chain import Chain
from clientlens.streaming import fact_refresh_batch

SF = "/root/testdata/sf0.001"
SPLIT = "1996-01-01 00:00:00"


def test_foreach_batch_refresh_matches_batch_runs(spark, tmpdir_path):
    c = Chain.from_tables(spark, SF, materialize=False)
    dim = c.dim_customer.checkpoint(eager=True)
    stg = c.stg_transactions
    early = stg.filter(F.col("event_timestamp") < F.lit(SPLIT).cast("timestamp"))
    src = os.path.join(tmpdir_path, "incoming")
    early.coalesce(1).write.parquet(os.path.join(src, "b1"))
    stg.coalesce(1).write.parquet(os.path.join(src, "b2"))
    schema = spark.read.parquet(os.path.join(src, "b1")).schema

    fact_root = os.path.join(tmpdir_path, "fact")
    q = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
         .option("recursiveFileLookup", True).parquet(src)
         .writeStream.foreachBatch(fact_refresh_batch(dim, fact_root, period="month"))
         .option("checkpointLocation", os.path.join(tmpdir_path, "stream-ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination(600)
    assert q.exception() is None
    got = spark.read.parquet(fact_root)
    assert any(n.startswith("event_month=") for n in os.listdir(fact_root))

    first = fact_transactions(spark.read.parquet(os.path.join(src, "b1")), dim)
    want = refresh_fact_transactions(spark.read.parquet(os.path.join(src, "b2")), dim, first, 3)
    cols = want.columns
    assert got.count() == want.count() == stg.count()
    assert got.select(cols).exceptAll(want).count() == 0
