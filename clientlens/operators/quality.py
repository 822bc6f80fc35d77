"""Declarative data-quality tests (T1-T3) and the gate between stages (T4).

Failure counts follow the usual warehouse-test conventions:
``unique`` counts duplicated non-NULL values, ``not_null`` counts NULL rows,
``accepted_values`` counts distinct non-NULL values outside the list (NULL passes).
Each table is scanned once for all its NULL and accepted-value checks; each
``unique`` check is one partially-aggregated group-by.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientlens.functions.joins import by_merge
from clientlens.operators import changes, key_index
from clientlens.operators.changes import in_periods, ordered
from clientlens.sources import sinks
from clientlens.sources.schemas import CHANNELS, TIERS


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str                      # unique | not_null | accepted_values
    values: tuple = field(default=())


def _checks(model: str, spec: dict[str, list]) -> list[Check]:
    out = []
    for column, tests in spec.items():
        for t in tests:
            if isinstance(t, tuple):
                out.append(Check(model, column, t[0], tuple(t[1])))
            else:
                out.append(Check(model, column, t))
    return out


ACCEPT_TIER = ("accepted_values", TIERS)
ACCEPT_CHANNEL = ("accepted_values", CHANNELS)

STAGING_CHECKS = (
    _checks("stg_customers", {"customer_id": ["unique", "not_null"], "email": ["not_null"],
                              "loyalty_tier": ["not_null", ACCEPT_TIER]})
    + _checks("stg_transactions", {"transaction_id": ["unique", "not_null"], "customer_id": ["not_null"],
                                   "amount": ["not_null"], "channel": [ACCEPT_CHANNEL]})
    + _checks("stg_loyalty_events", {"customer_id": ["not_null"], "event_date": ["not_null"]})
    + _checks("stg_support_ticket_messages", {"ticket_id": ["not_null"], "customer_id": ["not_null"]})
)

MART_CHECKS = (
    _checks("dim_customer", {"customer_sk": ["unique", "not_null"], "customer_id": ["not_null"],
                             "loyalty_tier": ["not_null", ACCEPT_TIER], "valid_from": ["not_null"],
                             "valid_to": ["not_null"], "is_current": ["not_null"]})
    + _checks("fact_transactions", {"transaction_id": ["unique", "not_null"], "customer_id": ["not_null"],
                                    "amount": ["not_null"], "event_timestamp": ["not_null"]})
    + _checks("fact_support", {"ticket_id": ["unique", "not_null"], "customer_id": ["not_null"]})
    + _checks("feature_store_customer", {"customer_id": ["unique", "not_null"],
                                         "total_spend_lifetime": ["not_null"],
                                         "days_since_last_transaction": ["not_null"],
                                         "is_high_value_customer": ["not_null"],
                                         "is_at_churn_risk": ["not_null"]})
)

RESULT_SCHEMA = "model string, column_name string, test_name string, failures bigint"


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Number of non-NULL values that occur more than once."""
    c = F.col(column)
    return (df.filter(c.isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
              .agg(F.count_if(F.col("n") > 1).alias("failures")))


def duplicated(table: DataFrame, index: DataFrame, column: str, part: str, touched: list, before: DataFrame) -> DataFrame:
    """T1 after a refresh: the values of ``column`` that occur more than once, from
    the touched periods and the key index. A duplicated value has a row in a touched
    period, or it was duplicated before and is in ``before`` (the last result): only
    such values are counted, in the touched periods and in those that the index
    names for them. The other periods are not read, and the table is not shuffled."""
    own = table.filter(in_periods(part, touched)).select(column)
    asked = own.unionByName(before.select(column)).filter(F.col(column).isNotNull()).distinct().checkpoint()
    named = [r[0] for r in key_index.probe(index, asked, column, part).select(part).distinct().collect()]    # one per period
    rows = table.filter(in_periods(part, ordered([*touched, *named]))).select(column)
    return (rows.join(by_merge(asked), column, "left_semi").groupBy(column).agg(F.count(F.lit(1)).alias("n"))
            .filter("n > 1").select(column))


def unique_after(spark: SparkSession, table: DataFrame, index_path: str, root: str, column: str, part: str) -> DataFrame:
    """T1 of a partitioned fact from the periods announced to ``root`` since the last
    call (all of the table the first time); one row: ``failures``."""
    folders, touched = changes.pending(spark, root)
    last = sinks.current_version(spark, os.path.join(root, "duplicated"))
    kind = table.schema[column].dataType.simpleString()
    if last is None:
        found = table.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(column)
        number = 0
    else:
        number = int(last.rsplit("=", 1)[1])
        before = spark.read.schema(f"{column} {kind}").parquet(last)
        found = duplicated(table, key_index.read(spark, index_path, part), column, part, touched, before)
    path = os.path.join(root, "duplicated", f"version={number + 1:06d}")
    sinks.write_table(found, path)
    changes.forget(spark, folders)
    if last is not None:
        sinks.remove(spark, last)
    return spark.read.schema(f"{column} {kind}").parquet(path).agg(F.count(F.lit(1)).alias("failures"))


def _table_results(model: str, df: DataFrame, checks: list[Check], known: dict | None = None) -> DataFrame:
    spark = df.sparkSession
    exprs, names = [], []
    for i, ch in enumerate(checks):
        c = F.col(ch.column)
        if ch.test == "not_null":
            exprs.append(F.count_if(c.isNull()).alias(f"f{i}"))
        elif ch.test == "accepted_values":
            exprs.append(F.count_distinct(F.when(~c.isin(list(ch.values)), c)).alias(f"f{i}"))
        else:
            continue
        names.append(i)
    parts = []
    if exprs:
        wide = df.agg(*exprs)
        stacked = wide.select(F.explode(F.array(*[
            F.struct(F.lit(checks[i].column).alias("column_name"), F.lit(checks[i].test).alias("test_name"),
                     F.col(f"f{i}").cast("bigint").alias("failures")) for i in names])).alias("r"))
        parts.append(stacked.select(F.lit(model).alias("model"), "r.*"))
    for ch in checks:
        if ch.test == "unique":
            own = (known or {}).get((model, ch.column))
            parts.append((unique_failures(df, ch.column) if own is None else own).select(
                F.lit(model).alias("model"), F.lit(ch.column).alias("column_name"),
                F.lit("unique").alias("test_name"), F.col("failures").cast("bigint")))
    if not parts:
        return spark.createDataFrame([], RESULT_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_checks(tables: dict[str, DataFrame], checks: list[Check], known: dict | None = None) -> DataFrame:
    """Results of every check: (model, column_name, test_name, failures). ``known``:
    failures of ``unique`` checks by (model, column), as ``unique_after`` gives them."""
    out = None
    for model, df in tables.items():
        mine = [c for c in checks if c.model == model]
        if not mine:
            continue
        r = _table_results(model, df, mine, known)
        out = r if out is None else out.unionByName(r)
    return out


class DataQualityError(RuntimeError):
    pass


def assert_passing(results: DataFrame) -> int:
    """T4 gate: raise if any check failed; returns the number of checks run.

    The result table has one row per check (tens of rows), so collecting it
    to the driver is bounded.
    """
    rows = results.collect()
    bad = [r for r in rows if r.failures]
    if bad:
        detail = ", ".join(f"{r.model}.{r.column_name} {r.test_name}={r.failures}" for r in bad)
        raise DataQualityError(f"{len(bad)} of {len(rows)} data tests failed: {detail}")
    return len(rows)
