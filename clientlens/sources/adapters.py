"""Derive the raw input shapes from the driver's TPC-H-style tables.

The mapping rules are fixed so that the DuckDB oracle can derive exactly the
same rows (see ``clientlens.plans.oracle``). Driver timestamps load as
TIMESTAMP_NTZ and are cast to session-zone (UTC) timestamps here, once.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientlens.functions.joins import by_merge
from clientlens.sources import schemas

# Fixed values of the adapter rules.
SIGNUP_EPOCH = "1995-01-01"
SIGNUP_DAYS = 2404                   # signups up to 2001-08-01
STATES = 20
DELIVERY_END = "2001-06-01"          # the first of two deliveries stops here
EVENT_SHIFT_DAYS = 8766              # 2024-01-01 becomes 2000-01-01
OPENED_EPOCH = "2001-01-01 00:00:00"
AS_OF = "2001-08-02"                 # the day after the last order
RUN_TS = "2001-08-02 06:00:00"       # one run timestamp for every _loaded_at
SEGMENT_TIER = {"AUTOMOBILE": "Platinum", "BUILDING": "Gold", "FURNITURE": "Silver"}  # else Bronze
CHANNEL_BY_MOD4 = ["web", "mobile_app", "in_store", "call_center"]
CATEGORY_BY_MOD5 = ["billing", "loyalty_question", "product_issue", "shipping", "account_access"]
ROLE_SENDER = {"user": "customer", "assistant": "agent", "system": "system"}
ISO_TS = "yyyy-MM-dd'T'HH:mm:ss"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def customer_key(custkey) -> F.Column:
    return F.concat(F.lit("Customer#"), F.lpad(custkey.cast("string"), 9, "0"))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with 20 states, signups spread over the order years and
    e-mail prefixes that vary on their own: two customers whose names differ in
    one digit have prefixes at distance 0 to 2, or further where one of them
    carries the long variant."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    seg, k = F.col("c_mktsegment"), F.col("c_custkey")
    tier = F.lit("Bronze")
    for s, t in reversed(list(SEGMENT_TIER.items())):
        tier = F.when(seg == s, t).otherwise(tier)
    prefix = F.concat(F.lit("m"), F.lpad((k % 100).cast("string"), 2, "0"),
                      F.when(k % 7 == 0, F.lit("typo")).when(k % 7 == 1, F.lit("x")).otherwise(F.lit("")),
                      F.lit("."), F.floor(k / 1000).cast("string"))
    return (c.join(n, c.c_nationkey == n.n_nationkey)
            .select(F.col("c_name").alias("customer_id"),
                    F.col("c_name").alias("first_name"),
                    F.col("n_name").alias("last_name"),
                    F.concat(prefix, F.lit("@"), F.lower(seg), F.lit(".example")).alias("email"),
                    F.date_format(F.date_add(F.lit(SIGNUP_EPOCH).cast("date"),
                                             (k * 37 % SIGNUP_DAYS).cast("int")), "yyyy-MM-dd").alias("signup_date"),
                    tier.alias("loyalty_tier"),
                    state_of(k).alias("state")))


def state_of(custkey) -> F.Column:
    return F.concat(F.lit("ST"), F.lpad((custkey % STATES).cast("string"), 2, "0"))


def duplicate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answer key: customer k+100 counts as a copy of customer k when both share
    nation and state (stands in for a generator's ground truth)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    a = c.alias("a")
    b = c.alias("b")
    return (a.join(by_merge(b), (F.col("b.c_custkey") == F.col("a.c_custkey") + 100)
                   & (F.col("a.c_nationkey") == F.col("b.c_nationkey"))
                   & (state_of(F.col("a.c_custkey")) == state_of(F.col("b.c_custkey"))))
            .select(F.col("b.c_name").alias("customer_id"),
                    F.col("a.c_name").alias("is_duplicate_of")))


def raw_transactions(spark: SparkSession, sf_dir: str, midnight: bool = False,
                     defects: bool = True, delivery: str = "all") -> DataFrame:
    """Orders as raw transaction rows (CSV shape: amount double, time as text).

    ``midnight`` puts every event at 00:00 of its order date; ``defects``
    injects the five malformed time kinds and empty customer references.
    ``delivery`` is one of two successive ones for a daily run: ``first`` stops
    before ``DELIVERY_END`` and lacks one order in 50, ``second`` holds all
    orders, some of the last month moved on by a day.
    """
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").cast("timestamp").alias("od"))
    k = F.col("o_orderkey")
    end = F.lit(DELIVERY_END).cast("timestamp")
    if delivery == "first":
        o = o.filter((F.col("od") < end) & (k % 50 != 11))
    elif delivery == "second":
        moved = (k % 40 == 13) & F.col("od").between(F.date_sub(end, 31).cast("timestamp"), end)
        o = o.withColumn("od", F.when(moved, F.col("od") + F.make_dt_interval(days=F.lit(1))).otherwise(F.col("od")))
    ev = F.col("od") if midnight else F.timestamp_seconds(F.unix_seconds("od") + k % 86400)
    text = F.date_format(ev, ISO_TS)
    cust = customer_key(F.col("o_custkey"))
    if defects:
        m = k % 100
        text = (F.when(m == 1, F.date_format(ev, "dd/MM/yyyy"))
                .when(m == 2, F.date_format(ev, "MM-dd-yy HH:mm"))
                .when(m == 3, F.lit(""))
                .when(m == 4, F.lit("NaT"))
                .when(m == 5, F.unix_seconds(ev).cast("string"))
                .otherwise(text))
        cust = F.when(k % 200 == 7, F.lit("")).otherwise(cust)
    channel = F.element_at(F.array(*[F.lit(c) for c in CHANNEL_BY_MOD4]), (k % 4 + 1).cast("int"))
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return o.select(
        k.cast("string").alias("transaction_id"),
        cust.alias("customer_id"),
        (F.floor(cents / 500).cast("bigint") / F.lit(100.0)).alias("amount"),
        text.alias("timestamp"),
        channel.alias("channel"),
    )


def raw_loyalty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One loyalty event per user and day of the whole ``events`` table: a day
    with a purchase upgrades, any other downgrades, and the day's largest value
    names the tier. Days are moved back onto the order years, to one of five
    years by the user. Users cover a tenth of the customers (and an unknown
    customer 0), so customers without events occur."""
    e = table(spark, sf_dir, "events")
    day = F.date_sub(F.to_date(F.col("ts").cast("timestamp")),
                     (F.lit(EVENT_SHIFT_DAYS) + F.col("user_id") % 5 * 365).cast("int"))
    v = F.max("value")
    tier = F.when(v < 25, "Bronze").when(v < 75, "Silver").when(v < 150, "Gold").otherwise("Platinum")
    return (e.groupBy("user_id", day.alias("day"))
            .agg(tier.alias("new_tier"), F.bool_or(F.col("event_type") == "purchase").alias("up"))
            .select(customer_key(F.col("user_id")).alias("customer_id"),
                    F.when(F.col("up"), "tier_upgrade").otherwise("tier_downgrade").alias("event_type"),
                    "new_tier", F.date_format("day", "yyyy-MM-dd").alias("event_date")))


def raw_ticket_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat message rows (one per conversation turn) with the ticket columns."""
    cv = table(spark, sf_dir, "conversations")
    n_customers = table(spark, sf_dir, "customer").agg(F.count(F.lit(1))).scalar()
    cid = F.col("conv_id")
    opened = F.lit(OPENED_EPOCH).cast("timestamp") + F.make_dt_interval(hours=cid.cast("int"))
    step = (cid % 48 + 1) * (F.col("turn") + 1)
    sent = opened + F.make_dt_interval(hours=step.cast("int"))
    role = F.col("role")
    sender = F.lit(None).cast("string")
    for r, s in reversed(list(ROLE_SENDER.items())):
        sender = F.when(role == r, s).otherwise(sender)
    category = F.element_at(F.array(*[F.lit(c) for c in CATEGORY_BY_MOD5]), (cid % 5 + 1).cast("int"))
    return cv.select(
        cid.cast("string").alias("ticket_id"),
        customer_key(cid % n_customers).alias("customer_id"),
        F.date_format(opened, ISO_TS).alias("opened_at"),
        category.alias("category"),
        F.col("turn"),
        sender.alias("sender"),
        F.col("text"),
        F.date_format(sent, ISO_TS).alias("sent_at"),
    )


MESSAGES_PER_ROW = 256               # most messages one nested ticket row carries


def raw_support_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested ticket rows (the NDJSON input shape) built from the flat turns.

    This only re-creates the shape the source delivers; in production the
    nested rows arrive as files and are read by ``load_support_tickets``.
    Arrays are bounded by grouping on ``turn div MESSAGES_PER_ROW``, and by a
    hash of the text for messages without a turn: a longer ticket arrives as
    several rows with the same ticket columns, which flatten to the same messages.
    """
    m = raw_ticket_messages(spark, sf_dir)
    part = F.coalesce(F.floor(F.col("turn") / MESSAGES_PER_ROW), F.pmod(F.xxhash64("text", "sender"), F.lit(1 << 20)) + (1 << 40))
    msgs = F.array_sort(F.collect_list(F.struct("turn", "sender", "text", "sent_at")))
    return (m.groupBy("ticket_id", "customer_id", "opened_at", "category",
                      part.alias("_part"))
            .agg(msgs.alias("m"))
            .select("ticket_id", "customer_id", "opened_at", "category",
                    F.transform("m", lambda x: F.struct(x["sender"].alias("sender"),
                                                        x["text"].alias("text"),
                                                        x["sent_at"].alias("sent_at")))
                    .cast(schemas.SUPPORT_TICKETS["messages"].dataType).alias("messages")))


RAW_FILES = {"customers": "customers.json", "transactions": "transactions.csv",
             "support_tickets": "support_tickets.json", "loyalty_events": "loyalty_events.csv",
             "duplicate_key": "duplicate_key.json"}


def write_raw_inputs(spark: SparkSession, sf_dir: str, raw_dir: str, delivery: str = "all") -> str:
    """Write the raw inputs as the sources deliver them (NDJSON / headered
    CSV) under ``raw_dir``; ``readers`` and ``run_from_files`` read them back."""
    p = lambda k: os.path.join(raw_dir, RAW_FILES[k])
    raw_customers(spark, sf_dir).write.mode("overwrite").json(p("customers"))
    raw_transactions(spark, sf_dir, delivery=delivery).write.mode("overwrite").option("header", True).csv(p("transactions"))
    raw_support_tickets(spark, sf_dir).write.mode("overwrite").json(p("support_tickets"))
    raw_loyalty_events(spark, sf_dir).write.mode("overwrite").option("header", True).csv(p("loyalty_events"))
    duplicate_key(spark, sf_dir).write.mode("overwrite").json(p("duplicate_key"))
    return raw_dir


def write_broken_inputs(spark: SparkSession, sf_dir: str, raw_dir: str) -> str:
    """The raw inputs with lines that do not parse, by the number in a line's first
    key: of 60 transactions one has a word for an amount and one lacks its last two
    fields; of 50 customers and tickets one line breaks off in the middle."""
    whole = write_raw_inputs(spark, sf_dir, os.path.join(raw_dir, "whole"))
    out = os.path.join(raw_dir, "broken")
    lines = lambda k: spark.read.text(os.path.join(whole, RAW_FILES[k]))
    head = ",".join(f.name for f in schemas.TRANSACTIONS.fields)
    fields = F.split("value", ",")
    number = fields[0].cast("long")
    value = (F.when(number % 60 == 17, F.concat_ws(",", fields[0], fields[1], F.lit("a lot"), fields[3], fields[4]))
             .when(number % 60 == 23, F.concat_ws(",", fields[0], fields[1], fields[2])).otherwise(F.col("value")))
    body = lines("transactions").filter(F.col("value") != head).select(value.alias("value"))

    def headed(batches):
        import pyarrow as pa
        yield pa.RecordBatch.from_arrays([pa.array([head])], names=["value"])
        yield from batches
    body.mapInArrow(headed, "value string").write.text(os.path.join(out, RAW_FILES["transactions"]))
    for name, key in (("customers", "customer_id"), ("support_tickets", "ticket_id")):
        number = F.regexp_extract(F.get_json_object("value", f"$.{key}"), "([0-9]+)$", 1).cast("long")
        half = F.substring("value", F.lit(1), (F.length("value") / 2).cast("int"))
        (lines(name).select(F.when(number % 50 == 9, half).otherwise(F.col("value")).alias("value"))
         .write.text(os.path.join(out, RAW_FILES[name])))
    raw_loyalty_events(spark, sf_dir).write.option("header", True).csv(os.path.join(out, RAW_FILES["loyalty_events"]))
    return out
