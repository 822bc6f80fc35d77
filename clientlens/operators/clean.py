"""Cleaning of the raw inputs: quarantine split (Q1-Q3), audit (G1), flatten (Q6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from clientlens.functions.scalar import parse_event_ts, parse_ts
from clientlens.sources.readers import CORRUPT
from clientlens.sources.schemas import TRANSACTIONS

MALFORMED_TS = "malformed_timestamp"
MISSING_CUSTOMER = "missing_customer_id"
# lines that do not parse
BROKEN_JSON = "broken_json"                    # not a JSON object
WRONG_FIELDS = "wrong_field_count"             # a CSV line with too few or too many fields
UNPARSABLE = "unparsable_"                     # + the first field whose text is not of its type
RAW_LINE = "raw_line"


def rescue_reason(schema: StructType, kind: str) -> Column:
    """Why the raw line in ``_corrupt_record`` does not parse: it is read again with
    every field as text; if that fails too the line itself is broken, otherwise a
    field's text is not of its type. NULL where the line parsed."""
    line = F.col(CORRUPT)
    texts = StructType([*[StructField(f.name, StringType()) for f in schema.fields], StructField(CORRUPT, StringType())])
    options = {"columnNameOfCorruptRecord": CORRUPT}
    again = (F.from_csv if kind == "csv" else F.from_json)(line, texts.simpleString()[len("struct<"):-1].replace(":", " "), options)
    typed = [f for f in schema.fields if not isinstance(f.dataType, (StringType, ArrayType, StructType))]
    field = F.lit("field")
    for f in reversed(typed):
        text = again[f.name]
        field = F.when(text.isNotNull() & text.try_cast(f.dataType).isNull(), f.name).otherwise(field)
    return (F.when(line.isNull(), F.lit(None).cast("string"))
            .when(again[CORRUPT].isNotNull(), WRONG_FIELDS if kind == "csv" else BROKEN_JSON)
            .otherwise(F.concat(F.lit(UNPARSABLE), field)))


def rescue(df: DataFrame, schema: StructType, kind: str) -> tuple[DataFrame, DataFrame]:
    """Split rows that were read with ``keep_corrupt`` into (parsed, rescued):
    every line is in one of them. rescued: the columns that did parse, the raw line
    and its reason. ``df`` must be a stored copy of the scan (Spark refuses plans
    that read nothing but the corrupt-record column of a text file)."""
    bad = F.col(CORRUPT).isNotNull()
    return (df.filter(~bad).drop(CORRUPT),
            df.filter(bad).select(*[f.name for f in schema.fields], F.col(CORRUPT).alias(RAW_LINE),
                                  rescue_reason(schema, kind).alias("quarantine_reason")))


def with_validity(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Add ``ts_parsed``, ``quarantine_reason`` (NULL for clean rows) and ``is_valid``.

    One reason column makes the clean/quarantine split provably disjoint and
    complete: a line that did not parse wins over a bad timestamp, and that over a
    missing customer reference.
    """
    parsed = parse_event_ts(ts_col)
    cid = F.col("customer_id")
    reason = (F.when(parsed.isNull(), F.lit(MALFORMED_TS))
              .when(cid.isNull() | (cid == ""), F.lit(MISSING_CUSTOMER)))
    if CORRUPT in df.columns:
        reason = F.coalesce(rescue_reason(TRANSACTIONS, "csv"), reason)
    return (df.withColumn("ts_parsed", parsed)
              .withColumn("quarantine_reason", reason)
              .withColumn("is_valid", F.col("quarantine_reason").isNull()))


def audit_metrics() -> list:
    """G1 counts as aggregate expressions over ``with_validity`` rows."""
    return [
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(F.col("is_valid")).alias("clean_rows"),
        F.count_if(F.col("quarantine_reason") == MALFORMED_TS).alias("malformed_timestamp_rows"),
        F.count_if(F.col("quarantine_reason") == MISSING_CUSTOMER).alias("missing_customer_rows"),
        F.count_if(~F.col("is_valid")).alias("quarantined_rows"),
    ]


def clean_transactions(df: DataFrame, observation=None) -> tuple[DataFrame, DataFrame]:
    """Q1/Q2: split raw transactions into (clean, quarantined); nothing is dropped.

    clean: raw columns minus ``timestamp`` plus ``event_timestamp``.
    quarantined: raw columns plus ``ts_parsed`` and ``quarantine_reason``, and
    ``raw_line`` where the scan kept the lines that do not parse.
    With an ``Observation`` the G1 counts are collected by the first action
    that runs the split (no separate scan of the input).
    """
    v = with_validity(df)
    if observation is not None:
        v = v.observe(observation, *audit_metrics())
    raw_cols = [c for c in df.columns if c != CORRUPT]
    line = [F.col(CORRUPT).alias(RAW_LINE)] if CORRUPT in df.columns else []
    clean = (v.filter("is_valid")
             .select(*[c for c in raw_cols if c != "timestamp"],
                     F.col("ts_parsed").alias("event_timestamp")))
    quarantined = v.filter(~F.col("is_valid")).select(*raw_cols, *line, "ts_parsed", "quarantine_reason")
    return clean, quarantined


def quarantine_summary(quarantined: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    """Q3: rows per quarantine reason, with the share of all input rows when given."""
    out = quarantined.groupBy("quarantine_reason").agg(F.count(F.lit(1)).alias("row_count"))
    if raw is not None:
        total = raw.agg(F.count(F.lit(1))).scalar()
        out = out.withColumn("pct_of_input", F.col("row_count") * 100.0 / total)
    return out


def audit_counts(raw: DataFrame) -> DataFrame:
    """G1: input / clean / quarantined counts and the quarantine rate in one pass."""
    v = with_validity(raw)
    return v.agg(*audit_metrics()).withColumn("quarantine_rate",
                 F.when(F.col("input_rows") > 0,
                        F.col("quarantined_rows").cast("double") / F.col("input_rows")))


def flatten_support_tickets(df: DataFrame) -> DataFrame:
    """Q6: one row per message; tickets with NULL/empty arrays produce no rows."""
    return (df.select("ticket_id", "customer_id", "opened_at", "category",
                      F.explode("messages").alias("message"))
              .select("ticket_id", "customer_id", "opened_at", "category",
                      F.col("message.sender").alias("message_sender"),
                      F.col("message.text").alias("message_text"),
                      parse_ts(F.col("message.sent_at")).alias("message_sent_at")))


def compute_rolling_spend(transactions: DataFrame, days: int = 90) -> DataFrame:
    """Q5: trailing ``days``-day spend and transaction count per customer.

    Money is summed as exact decimal(18,2); see ``clientlens.operators.rolling``
    for how the frame is evaluated without one task per customer.
    """
    from clientlens.functions.scalar import money
    from clientlens.operators.rolling import rolling_sum_count
    return rolling_sum_count(transactions, "customer_id", "event_timestamp", money("amount"),
                             "transaction_id", days, f"rolling_{days}d_spend", f"rolling_{days}d_txn_count")
