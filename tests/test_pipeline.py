"""E3 end to end from raw files; second run is an idempotent incremental refresh."""

import os

from clientlens.operators import clean
from clientlens.plans.pipeline import run_from_files
from clientlens.sources import adapters, readers, sinks

SF = "/root/testdata/sf0.001"


def test_pipeline_from_files_twice(spark, tmpdir_path):
    raw = adapters.write_raw_inputs(spark, SF, os.path.join(tmpdir_path, "raw"))
    root = os.path.join(tmpdir_path, "zones")

    kw = dict(fact_layout="versioned")
    r1 = run_from_files(spark, raw, root, adapters.AS_OF, adapters.RUN_TS, **kw)
    assert r1.tests_run == 36
    a = r1.audit
    assert a["input_rows"] == a["clean_rows"] + a["quarantined_rows"] and a["quarantined_rows"] > 0
    explicit = clean.audit_counts(readers.load_transactions(spark, os.path.join(raw, "transactions.csv")))
    assert explicit.first().asDict() == a          # observed on the write == a separate aggregation
    assert spark.read.parquet(sinks.quarantine_path(os.path.join(root, "processed"), "transactions")).count() \
        == a["quarantined_rows"]
    n_fact = r1.tables["fact_transactions"].count()
    assert n_fact == r1.tables["stg_transactions"].count()
    assert r1.tables["feature_store_customer"].count() == r1.tables["stg_customers"].count()
    assert "channel" == spark.read.parquet(os.path.join(root, "processed", "transactions")).columns[-1]
    v1 = sinks.current_version(spark, os.path.join(root, "marts", "fact_transactions"))

    r2 = run_from_files(spark, raw, root, adapters.AS_OF, adapters.RUN_TS, **kw)
    v2 = sinks.current_version(spark, os.path.join(root, "marts", "fact_transactions"))
    assert v2 != v1
    cols = [c for c in r2.tables["fact_transactions"].columns]
    assert r2.tables["fact_transactions"].select(cols).exceptAll(spark.read.parquet(v1).select(cols)).count() == 0
    assert r2.tables["fact_transactions"].count() == n_fact


def test_pipeline_partitioned_fact_refresh(spark, tmpdir_path):
    raw = adapters.write_raw_inputs(spark, SF, os.path.join(tmpdir_path, "raw"))
    root = os.path.join(tmpdir_path, "zones")
    kw = dict(fact_period="month")
    r1 = run_from_files(spark, raw, root, adapters.AS_OF, adapters.RUN_TS, **kw)
    first = r1.tables["fact_transactions"]
    cols = first.columns
    rows1 = sorted(first.collect())
    assert len(rows1) == r1.tables["stg_transactions"].count()
    assert "event_month" not in cols
    r2 = run_from_files(spark, raw, root, adapters.AS_OF, adapters.RUN_TS, **kw)
    assert sorted(r2.tables["fact_transactions"].select(cols).collect()) == rows1


def test_command_line_clean_and_daily(spark, tmpdir_path):
    from clientlens.__main__ import main
    raw = adapters.write_raw_inputs(spark, SF, os.path.join(tmpdir_path, "raw"))
    out = os.path.join(tmpdir_path, "processed")
    r = main(["clean", raw, out], spark)
    a = r["audit"]
    assert a["input_rows"] == a["clean_rows"] + a["quarantined_rows"]
    assert sorted(os.listdir(out)) == ["_quarantine", "customers", "support_ticket_messages", "transactions"]
    d = main(["daily", raw, os.path.join(tmpdir_path, "zones"), "--as-of", adapters.AS_OF,
              "--run-ts", adapters.RUN_TS, "--fact-period", "month"], spark)
    assert d["tests_passed"] == 36 and d["audit"] == a
