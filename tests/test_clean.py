"""Q1-Q3, G1, Q6 on hand-made edge rows."""

from pyspark.sql import functions as F

from clientlens.operators import clean
from clientlens.sources import schemas

RAW = [
    ("t1", "c1", 10.0, "2024-01-02T10:11:12", "web"),      # clean
    ("t2", "c1", 11.0, "02/01/2024", "web"),               # dd/MM/yyyy
    ("t3", "c1", 12.0, "01-02-24 10:11", "web"),           # MM-dd-yy HH:mm
    ("t4", "c1", 13.0, "", "web"),                         # empty
    ("t5", "c1", 14.0, "NaT", "web"),                      # NaT
    ("t6", "c1", 15.0, "1704190272", "web"),               # epoch text
    ("t7", "c1", 16.0, "2024", "web"),                     # year only: parses in Spark, rejected by shape
    ("t8", "c1", 17.0, "10:11", "web"),                    # time only: would become today
    ("t9", "", 18.0, "2024-01-02T10:11:12", "web"),        # empty customer
    ("t10", None, 19.0, "2024-01-02T10:11:12", "web"),     # null customer
    ("t11", "", 20.0, "NaT", "web"),                       # both defects
    ("t12", "c2", 21.0, "2024-01-02 10:11:12", "web"),     # space separator is fine
]


def raw(spark):
    return spark.createDataFrame(RAW, schemas.TRANSACTIONS)


def test_quarantine_split_reasons(spark):
    c, q = clean.clean_transactions(raw(spark))
    assert sorted(r.transaction_id for r in c.collect()) == ["t1", "t12"]
    reasons = {r.transaction_id: r.quarantine_reason for r in q.collect()}
    assert reasons == {
        "t2": "malformed_timestamp", "t3": "malformed_timestamp", "t4": "malformed_timestamp",
        "t5": "malformed_timestamp", "t6": "malformed_timestamp", "t7": "malformed_timestamp",
        "t8": "malformed_timestamp", "t9": "missing_customer_id", "t10": "missing_customer_id",
        "t11": "malformed_timestamp"}
    assert "timestamp" not in c.columns and "event_timestamp" in c.columns
    assert {"ts_parsed", "quarantine_reason", "timestamp"} <= set(q.columns)


def test_split_is_complete_and_disjoint(spark):
    c, q = clean.clean_transactions(raw(spark))
    ids_c = {r.transaction_id for r in c.collect()}
    ids_q = {r.transaction_id for r in q.collect()}
    assert not ids_c & ids_q and len(ids_c | ids_q) == len(RAW)


def test_audit_and_summary(spark):
    a = clean.audit_counts(raw(spark)).first()
    assert (a.input_rows, a.clean_rows, a.quarantined_rows) == (12, 2, 10)
    assert (a.malformed_timestamp_rows, a.missing_customer_rows) == (8, 2)
    s = {r.quarantine_reason: r.row_count for r in
         clean.quarantine_summary(clean.clean_transactions(raw(spark))[1], raw(spark)).collect()}
    assert s == {"malformed_timestamp": 8, "missing_customer_id": 2}


def test_flatten_tickets(spark):
    rows = [
        ("k1", "c1", "2024-01-01T00:00:00", "billing", None),
        ("k2", "c1", "2024-01-01T00:00:00", "billing", []),
        ("k3", "c1", "2024-01-01T00:00:00", "billing", [("customer", "hi", "2024-01-01T01:00:00")]),
        ("k4", "c2", "2024-01-01T00:00:00", "shipping",
         [("customer", "a", "2024-01-01T01:00:00"), ("agent", "b", "not a time")]),
    ]
    df = spark.createDataFrame(rows, schemas.SUPPORT_TICKETS)
    out = clean.flatten_support_tickets(df).orderBy("ticket_id", "message_text").collect()
    assert [r.ticket_id for r in out] == ["k3", "k4", "k4"]
    assert out[2].message_sent_at is None and out[1].message_sent_at is not None
    assert out[0].message_sender == "customer"


def test_rolling_spend_columns(spark):
    c, _ = clean.clean_transactions(raw(spark))
    r = clean.compute_rolling_spend(c)
    assert {"rolling_90d_spend", "rolling_90d_txn_count"} <= set(r.columns)
    assert r.filter(F.col("rolling_90d_txn_count") != 1).count() == 0


def test_lines_that_do_not_parse_end_in_the_quarantine(spark, tmpdir_path):
    """Three kinds of broken lines, each with its own reason; every line read is clean or quarantined."""
    import os

    from clientlens.plans.pipeline import clean_job
    from clientlens.sources import readers, sinks
    raw = os.path.join(tmpdir_path, "raw")
    os.makedirs(raw)
    put = lambda name, text: open(os.path.join(raw, name), "w").write(text)
    put("t.csv", "transaction_id,customer_id,amount,timestamp,channel\n"
                 "1,c1,5.0,2024-01-02T10:11:12,web\n"
                 "2,c1,many,2024-01-02T10:11:12,web\n"
                 "3,c1,7.0\n"
                 "4,c1,8.0,2024-01-02T10:11:12,web,more,fields\n"
                 '5,c1,"9,5",2024-01-02T10:11:12,web\n'
                 "6,,many,NaT,web\n"
                 "7,,1.0,2024-01-02T10:11:12,web\n"
                 "8,c1,,2024-01-02T10:11:12,web\n")
    put("c.json", '{"customer_id": "c1", "first_name": "a"}\n{"customer_id": "c2", "fir\nnot json\n[1, 2]\n')
    put("s.json", '{"ticket_id": "t1", "customer_id": "c1", "messages": [{"sender": "agent", "text": "x"}]}\n{"ticket_id": "t2", "messages": 5}\n{\n')
    out = os.path.join(tmpdir_path, "out")
    p = lambda n: os.path.join(raw, n)
    tables, audit = clean_job(spark, readers.load_customers(spark, p("c.json"), True), readers.load_transactions(spark, p("t.csv"), True),
                              readers.load_support_tickets(spark, p("s.json"), True), out)
    q = {s: spark.read.parquet(sinks.quarantine_path(out, s)).collect() for s in ("transactions", "customers", "support_tickets")}
    assert {r.transaction_id: r.quarantine_reason for r in q["transactions"]} == {
        "2": "unparsable_amount", "3": "wrong_field_count", "4": "wrong_field_count", "5": "unparsable_amount",
        "6": "unparsable_amount", "7": "missing_customer_id"}
    lines = {r.transaction_id: r.raw_line for r in q["transactions"]}
    assert lines["3"] == "3,c1,7.0" and lines["7"] is None
    assert sorted(r.transaction_id for r in tables["transactions"].collect()) == ["1", "8"]
    assert audit["input_rows"] == 8 == audit["clean_rows"] + audit["quarantined_rows"]
    assert sorted(r.raw_line for r in q["customers"]) == sorted(['{"customer_id": "c2", "fir', "not json", "[1, 2]"])
    assert {r.quarantine_reason for r in q["customers"]} == {"broken_json"}
    assert [r.customer_id for r in tables["customers"].collect()] == ["c1"]
    assert sorted(r.quarantine_reason for r in q["support_tickets"]) == ["broken_json", "unparsable_field"]


def test_whole_files_rescue_nothing(spark, tmpdir_path):
    import os

    from clientlens.sources import adapters, readers
    d = adapters.write_raw_inputs(spark, "/root/testdata/sf0.001", os.path.join(tmpdir_path, "raw"))
    for load, name, schema, kind in ((readers.load_customers, "customers", schemas.CUSTOMERS, "json"),
                                     (readers.load_transactions, "transactions", schemas.TRANSACTIONS, "csv"),
                                     (readers.load_support_tickets, "support_tickets", schemas.SUPPORT_TICKETS, "json"),
                                     (readers.load_loyalty_events, "loyalty_events", schemas.LOYALTY_EVENTS, "csv")):
        path = os.path.join(d, adapters.RAW_FILES[name])
        load(spark, path, True).write.parquet(os.path.join(tmpdir_path, name))
        good, rescued = clean.rescue(spark.read.parquet(os.path.join(tmpdir_path, name)), schema, kind)
        assert rescued.count() == 0 and good.dtypes == load(spark, path).dtypes and good.exceptAll(load(spark, path)).count() == 0
