"""S1-S4, S8, S10 readers and K1-K3, K5/K6 sinks on small files."""

import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.errors.exceptions.captured import IllegalArgumentException

from clientlens.sources import readers, sinks


def write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_csv_transactions(spark, tmpdir_path):
    p = write(os.path.join(tmpdir_path, "t.csv"),
              "transaction_id,customer_id,amount,timestamp,channel\n"
              "t1,c1,10.5,2024-01-01T00:00:00,web\n"
              "t2,,abc,2024-01-01T00:00:00,web\n"
              "t3,\"\",3,,web\n"
              "t4,c4\n")
    df = readers.load_transactions(spark, p, keep_corrupt=True)
    r = {x.transaction_id: x for x in df.collect()}
    assert r["t1"].amount == 10.5 and r["t1"]._corrupt_record is None
    assert r["t2"].amount is None and r["t2"].customer_id is None and r["t2"]._corrupt_record is not None
    assert r["t3"].customer_id is None or r["t3"].customer_id == ""
    assert r["t4"].channel is None
    assert len(readers.corrupt_rows(df).collect()) >= 1   # whole rows: the column alone is not queryable


def test_csv_reordered_header_fails(spark, tmpdir_path):
    p = write(os.path.join(tmpdir_path, "bad.csv"),
              "customer_id,transaction_id,amount,timestamp,channel\nc1,t1,1.0,2024-01-01,web\n")
    with pytest.raises((AnalysisException, IllegalArgumentException, Exception)):
        readers.load_transactions(spark, p).collect()


def test_json_sources(spark, tmpdir_path):
    c = write(os.path.join(tmpdir_path, "c.json"), json.dumps(
        {"customer_id": "c1", "first_name": "A", "last_name": "B", "email": "a@b", "signup_date": "2024-01-01",
         "loyalty_tier": "Gold", "state": "TX", "extra": 1}) + "\n")
    assert readers.load_customers(spark, c).first().state == "TX"
    t = write(os.path.join(tmpdir_path, "t.json"), json.dumps(
        {"ticket_id": "k", "customer_id": "c1", "opened_at": "2024-01-01T00:00:00", "category": "billing",
         "messages": [{"sender": "customer", "text": "x", "sent_at": "2024-01-01T01:00:00"}]}) + "\n")
    assert readers.load_support_tickets(spark, t).first().messages[0].sender == "customer"
    k = write(os.path.join(tmpdir_path, "k.json"), json.dumps({"customer_id": "x", "is_duplicate_of": "y"}) + "\n")
    assert readers.load_duplicate_key(spark, k).first().is_duplicate_of == "y"
    le = write(os.path.join(tmpdir_path, "l.csv"), "customer_id,event_type,new_tier,event_date\nc1,tier_upgrade,Gold,2024-01-01\n")
    assert readers.load_loyalty_events(spark, le).first().new_tier == "Gold"


def test_presence_check(spark):
    empty = spark.createDataFrame([], "a int")
    with pytest.raises(readers.MissingInput):
        readers.check_raw_inputs(spark, {"customers": empty, "other": spark.range(1)})
    readers.check_raw_inputs(spark, {"x": spark.range(1)})


def test_missing_raw_files_fail_before_any_scan(spark, tmpdir_path):
    from clientlens.plans.pipeline import run_from_files
    os.makedirs(os.path.join(tmpdir_path, "in", "customers.json"))
    with pytest.raises(readers.MissingInput, match="loyalty_events.csv"):
        run_from_files(spark, os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "out"),
                       "2024-01-01", "2024-01-01 00:00:00")


def test_partitioned_and_quarantine_sinks(spark, tmpdir_path):
    df = spark.createDataFrame([("t1", "web"), ("t2", "mobile_app")], "transaction_id string, channel string")
    out = os.path.join(tmpdir_path, "processed", "transactions")
    sinks.write_table(df, out, partition_by=["channel"])
    back = spark.read.parquet(out)
    assert back.columns == ["transaction_id", "channel"] and back.count() == 2
    assert back.filter("channel = 'web'").count() == 1
    q = sinks.quarantine_path(os.path.join(tmpdir_path, "processed"), "transactions")
    sinks.write_table(df, q)
    assert spark.read.parquet(q).count() == 2 and "/_quarantine/" in q


def test_versioned_commit(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "fact")
    assert sinks.current_version(spark, root) is None
    v0 = sinks.commit_version(spark, spark.range(3), root)
    assert sinks.current_version(spark, root) == v0
    v1 = sinks.commit_version(spark, spark.read.parquet(v0).union(spark.range(3, 5)), root)
    assert v1 != v0 and spark.read.parquet(sinks.current_version(spark, root)).count() == 5
    assert spark.read.parquet(v0).count() == 3     # the previous version is untouched


def test_failed_commit_keeps_the_last_good_version(spark, tmpdir_path):
    import pytest
    from pyspark.sql import functions as F

    root = os.path.join(tmpdir_path, "fact")
    good = spark.range(5).withColumnRenamed("id", "k")
    v0 = sinks.commit_version(spark, good, root)
    broken = spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("boom")))
                                   .otherwise(F.col("id")).alias("k"))
    with pytest.raises(Exception):
        sinks.commit_version(spark, broken, root)
    assert sinks.current_version(spark, root) == v0
    assert sorted(r.k for r in spark.read.parquet(sinks.current_version(spark, root)).collect()) == list(range(5))


def test_lost_pointer_and_partial_versions_lose_nothing(spark, tmpdir_path):
    import shutil
    root = os.path.join(tmpdir_path, "t")
    sinks.commit_version(spark, spark.range(3), root)
    v1 = sinks.commit_version(spark, spark.range(100), root)
    assert not [n for n in os.listdir(root) if n.endswith(".tmp")]
    os.remove(os.path.join(root, "_CURRENT"))                      # a stop around the switch, or a lost file
    assert sinks.current_version(spark, root) == v1
    shutil.copytree(v1, os.path.join(root, "version=000002"))      # a write that did not finish
    os.remove(os.path.join(root, "version=000002", "_SUCCESS"))
    assert sinks.current_version(spark, root) == v1
    v3 = sinks.commit_version(spark, spark.range(101), root)
    assert os.path.basename(v3) == "version=000003" and sinks.current_version(spark, root) == v3
    assert spark.read.parquet(v1).count() == 100
