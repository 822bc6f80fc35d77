"""One daily run (E3): raw inputs -> processed -> staging -> gate ->
intermediate -> marts -> gate.

Every zone is written as Parquet and the next zone reads it back, so each
stage's plan starts from files (no lineage across zones, re-readable after
an executor loss), and the written tables carry real size statistics for
AQE's join choices. The transaction fact is refreshed incrementally: only
the partitions that the lookback slice touches are staged and swapped in (or,
with ``fact_layout="versioned"``, the merged fact is committed as a new version).
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from clientlens.operators import (clean, dedup, feature_state, history_state, incremental, intermediate, marts,
                                  quality, rolling_state, staging)
from clientlens.session import scratch_path
from clientlens.sources import readers, schemas, sinks


@dataclass
class RunResult:
    root: str
    tables: dict[str, DataFrame] = field(default_factory=dict)
    audit: dict = field(default_factory=dict)
    tests_run: int = 0


def _write_read(spark: SparkSession, df: DataFrame, path: str, partition_by=None) -> DataFrame:
    # the zones are partitioned by low-cardinality columns only (channel)
    sinks.write_table(df, path, partition_by, rebalance=False)
    return spark.read.parquet(path)


def clean_job(spark: SparkSession, raw_customers: DataFrame, raw_transactions: DataFrame,
              raw_support_tickets: DataFrame, out_dir: str, state_dir: str | None = None,
              period: str = "day") -> tuple[dict[str, DataFrame], dict]:
    """The cleaning job. Writes ``customers`` (duplicates flagged),
    ``transactions`` (clean, with rolling spend, partitioned by channel),
    ``support_ticket_messages`` and ``_quarantine/transactions`` under
    ``out_dir``; returns the read-back tables and the transaction audit.

    The raw inputs are parsed once: a scratch copy of the transactions as Parquet
    feeds the quarantine and the rolling spend, and is removed at the end. Of scans
    that kept the lines that do not parse (``keep_corrupt``) those lines go to the
    quarantine of their source, so that every line read is clean or quarantined. With a
    ``state_dir`` the rolling spend is kept there between runs, and only rows that
    changed days reach are cut anew."""
    scratch = scratch_path(spark, f"raw-{uuid.uuid4().hex}")
    try:
        customers = parsed(spark, raw_customers, "customers", schemas.CUSTOMERS, "json", scratch, out_dir)
        tickets = parsed(spark, raw_support_tickets, "support_tickets", schemas.SUPPORT_TICKETS, "json", scratch, out_dir)
        transactions = _write_read(spark, raw_transactions, os.path.join(scratch, "transactions"))
        return _clean_job(spark, customers, transactions, tickets, out_dir, state_dir, period)
    finally:
        sinks.remove(spark, scratch)


def parsed(spark: SparkSession, raw: DataFrame, name: str, schema, kind: str, scratch: str, out_dir: str) -> DataFrame:
    """The rows of a scan whose lines parsed. The other lines of a scan that kept
    them go to ``_quarantine/<name>`` with the raw line and a reason."""
    if readers.CORRUPT not in raw.columns:
        return raw
    good, rescued = clean.rescue(_write_read(spark, raw, os.path.join(scratch, name)), schema, kind)
    sinks.write_table(rescued, sinks.quarantine_path(out_dir, name))
    return good


def _clean_job(spark, raw_customers, raw_transactions, raw_support_tickets, out_dir, state_dir, period):
    # G1 counts ride on the quarantine write (a single scan -> filter -> write
    # stage, so each task's counts are merged once) instead of another scan
    audit = Observation("transaction_audit")
    clean_tx, quarantined = clean.clean_transactions(raw_transactions, audit)
    sinks.write_table(quarantined, sinks.quarantine_path(out_dir, "transactions"))
    counts = dict(audit.get)
    counts["quarantine_rate"] = counts["quarantined_rows"] / counts["input_rows"] if counts["input_rows"] else None
    p = lambda t: os.path.join(out_dir, t)
    rolled = rolling_state.refresh(clean_tx, state_dir, period=period) if state_dir else clean.compute_rolling_spend(clean_tx)
    tables = {
        "customers": _write_read(spark, dedup.dedupe_customers(raw_customers), p("customers")),
        "transactions": _write_read(spark, rolled, p("transactions"), partition_by=["channel"]),
        "support_ticket_messages": _write_read(spark, clean.flatten_support_tickets(raw_support_tickets),
                                               p("support_ticket_messages")),
    }
    return tables, counts


def run_pipeline(spark: SparkSession, raw_customers: DataFrame, raw_transactions: DataFrame,
                 raw_support_tickets: DataFrame, raw_loyalty_events: DataFrame, root: str,
                 as_of: str, run_ts: str, closed: str = "left", lookback_days: int = 3,
                 gate: bool = True, fact_layout: str = "partitioned", fact_period: str = "day") -> RunResult:
    """Run every stage once; returns the read-back tables of all zones.

    ``fact_layout='partitioned'`` keeps the transaction fact partitioned by
    ``fact_period`` and rewrites only the partitions the refresh touches;
    ``'versioned'`` commits the whole merged fact as a new version folder."""
    readers.check_raw_inputs(spark, {"customers": raw_customers, "transactions": raw_transactions,
                                     "support_tickets": raw_support_tickets,
                                     "loyalty_events": raw_loyalty_events})
    out = RunResult(root)
    z = lambda zone, t: readers.zone_path(root, zone, t)

    # processed zone (cleaning job)
    scratch = scratch_path(spark, f"raw-{uuid.uuid4().hex}")
    raw_loyalty_events = parsed(spark, raw_loyalty_events, "loyalty_events", schemas.LOYALTY_EVENTS, "csv", scratch,
                                os.path.join(root, "processed"))
    processed, out.audit = clean_job(spark, raw_customers, raw_transactions, raw_support_tickets,
                                     os.path.join(root, "processed"), z("processed", "_rolling"), fact_period)
    customers, transactions, messages = (processed["customers"], processed["transactions"],
                                         processed["support_ticket_messages"])

    # staging zone + gate
    stg = {
        "stg_customers": staging.stg_customers(customers, run_ts),
        "stg_transactions": staging.stg_transactions(transactions, run_ts),
        "stg_loyalty_events": staging.stg_loyalty_events(raw_loyalty_events, run_ts),
        "stg_support_ticket_messages": staging.stg_support_ticket_messages(messages, run_ts),
    }
    stg = {k: _write_read(spark, v, z("staging", k)) for k, v in stg.items()}
    if gate:
        out.tests_run += quality.assert_passing(quality.run_checks(stg, quality.STAGING_CHECKS))

    # intermediate zone
    versions = history_state.refresh(stg["stg_customers"], stg["stg_loyalty_events"], z("intermediate", "_versions"))
    inter = {
        "int_customer_transactions": intermediate.int_customer_transactions(stg["stg_transactions"],
                                                                            stg["stg_customers"]),
        # only customers with changes are cut anew, see history_state
        "int_customer_loyalty": history_state.history(versions),
        "int_customer_support": intermediate.int_customer_support(stg["stg_support_ticket_messages"],
                                                                  stg["stg_customers"]),
    }
    inter = {k: _write_read(spark, v, z("intermediate", k)) for k, v in inter.items()}

    # marts zone + gate
    dim = _write_read(spark, history_state.dimension(versions, as_of, run_ts), z("marts", "dim_customer"))
    fact_root, kept = z("marts", "fact_transactions"), z("marts", "_features")
    part, checked = incremental.PERIOD_COLUMNS[fact_period], z("marts", "_unique_fact_transactions")
    if fact_layout == "partitioned":
        if not readers.table_exists(spark, fact_root):
            for derived in (kept, checked):            # of a fact that is gone
                sinks.remove(spark, derived)
        incremental.refresh_fact_partitions(
            stg["stg_transactions"], dim, fact_root, z("marts", "_stage_fact_transactions"), lookback_days, closed,
            period=fact_period, index_path=z("marts", "_keys_fact_transactions"),
            followers=(os.path.join(kept, feature_state.TRANSACTIONS.name), *([checked] if gate else [])))
        fact_tx = spark.read.parquet(fact_root).drop(part)
    else:
        committed = sinks.current_version(spark, fact_root)
        target = spark.read.parquet(committed) if committed else None
        merged = incremental.refresh_fact_transactions(stg["stg_transactions"], dim, target, lookback_days, closed)
        fact_tx = spark.read.parquet(sinks.commit_version(spark, merged, fact_root))
    fact_sp = _write_read(spark, marts.fact_support(inter["int_customer_support"], dim, run_ts, closed),
                          z("marts", "fact_support"))
    if fact_layout == "partitioned":
        # from kept totals: only changed and expiring periods of the fact are read
        features = feature_state.feature_store(dim, spark.read.parquet(fact_root), fact_sp, kept, as_of, run_ts, fact_period)
    else:
        features = marts.feature_store_customer(dim, fact_tx, fact_sp, as_of, run_ts)
    feats = _write_read(spark, features, z("marts", "feature_store_customer"))
    mart_tables = {"dim_customer": dim, "fact_transactions": fact_tx, "fact_support": fact_sp,
                   "feature_store_customer": feats}
    if gate:
        known = {}
        if fact_layout == "partitioned":
            # the fact's keys: those of touched periods, the others by the key index
            known["fact_transactions", "transaction_id"] = quality.unique_after(
                spark, spark.read.parquet(fact_root), z("marts", "_keys_fact_transactions"), checked, "transaction_id", part)
        out.tests_run += quality.assert_passing(quality.run_checks(mart_tables, quality.MART_CHECKS, known))

    sinks.remove(spark, scratch)
    out.tables = {"customers": customers, "transactions": transactions, "support_ticket_messages": messages,
                  **stg, **inter, **mart_tables}
    return out


def run_from_files(spark: SparkSession, input_dir: str, root: str, as_of: str, run_ts: str, **kw) -> RunResult:
    """The same run over raw files: customers.json, transactions.csv,
    support_tickets.json and loyalty_events.csv in ``input_dir``."""
    p = lambda n: os.path.join(input_dir, n)
    readers.check_raw_paths(spark, {n: p(n) for n in ("customers.json", "transactions.csv",
                                                       "support_tickets.json", "loyalty_events.csv")})
    return run_pipeline(spark,
                        readers.load_customers(spark, p("customers.json"), keep_corrupt=True),
                        readers.load_transactions(spark, p("transactions.csv"), keep_corrupt=True),
                        readers.load_support_tickets(spark, p("support_tickets.json"), keep_corrupt=True),
                        readers.load_loyalty_events(spark, p("loyalty_events.csv"), keep_corrupt=True),
                        root, as_of, run_ts, **kw)
