"""The dataset chain of one pipeline run, built lazily from raw inputs.

``Chain`` wires the operators in dependency order (raw -> processed ->
staging -> intermediate -> marts). Nothing executes until an action; each
property returns the same DataFrame object on repeated access so Spark can
reuse shuffles within one plan.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from clientlens.operators import clean, dedup, intermediate, marts, scd2, staging
from clientlens.session import scratch_path
from clientlens.sources import adapters


class Chain:
    def __init__(self, raw_customers: DataFrame, raw_transactions: DataFrame,
                 raw_loyalty_events: DataFrame, raw_support_tickets: DataFrame,
                 as_of: str, run_ts: str, closed: str = "left", materialize: bool = False,
                 materialize_marts: bool = False):
        self.raw_customers = raw_customers
        self.raw_transactions = raw_transactions
        self.raw_loyalty_events = raw_loyalty_events
        self.raw_support_tickets = raw_support_tickets
        self.as_of = as_of
        self.run_ts = run_ts
        self.closed = closed
        self.materialize = materialize
        self.materialize_marts = materialize_marts
        self._run_id = uuid.uuid4().hex
        self._written = materialize      # processed tables are read back from files

    def _keep(self, name: str, df: DataFrame) -> DataFrame:
        """Cut the lineage of a dataset that many branches read.

        It is written once as Parquet under the shared folder named by
        ``spark.checkpoint.dir`` and read back: computed once, re-readable
        after an executor loss, and with real size statistics for the planner.
        """
        if not self.materialize:
            return df
        return self._write(name, df)

    def _write(self, name: str, df: DataFrame) -> DataFrame:
        path = scratch_path(df.sparkSession, f"chain-{self._run_id}/{name}")
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.parquet(path)

    @classmethod
    def from_tables(cls, spark: SparkSession, sf_dir: str, midnight: bool = False,
                    closed: str = "left", as_of: str = adapters.AS_OF,
                    run_ts: str = adapters.RUN_TS, materialize: bool = True,
                    materialize_marts: bool = False) -> "Chain":
        return cls(adapters.raw_customers(spark, sf_dir),
                   adapters.raw_transactions(spark, sf_dir, midnight=midnight),
                   adapters.raw_loyalty_events(spark, sf_dir),
                   adapters.raw_support_tickets(spark, sf_dir),
                   as_of, run_ts, closed, materialize, materialize_marts)

    def reuse_processed(self, other: "Chain") -> "Chain":
        """Start from ``other``'s processed datasets (already built)."""
        for name in ("split", "customers", "transactions", "messages", "dim_customer"):
            if name in other.__dict__ or name in ("customers", "transactions"):
                self.__dict__[name] = getattr(other, name)
        self._written = other._written
        return self

    # processed zone -----------------------------------------------------------
    @cached_property
    def split(self) -> tuple[DataFrame, DataFrame]:
        good, quarantined = clean.clean_transactions(self.raw_transactions)
        # the rolling spend reads the clean rows twice
        return self._keep("clean_transactions", good), quarantined

    @property
    def clean_transactions(self) -> DataFrame:
        return self.split[0]

    @property
    def quarantined(self) -> DataFrame:
        return self.split[1]

    @cached_property
    def customers(self) -> DataFrame:
        return self._keep("customers", dedup.dedupe_customers(self.raw_customers))

    @cached_property
    def transactions(self) -> DataFrame:
        return self._keep("transactions", clean.compute_rolling_spend(self.clean_transactions))

    @cached_property
    def messages(self) -> DataFrame:
        return clean.flatten_support_tickets(self.raw_support_tickets)

    # staging ------------------------------------------------------------------
    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.customers, self.run_ts)

    @cached_property
    def stg_transactions(self) -> DataFrame:
        return staging.stg_transactions(self.transactions, self.run_ts)

    @cached_property
    def stg_loyalty_events(self) -> DataFrame:
        return staging.stg_loyalty_events(self.raw_loyalty_events, self.run_ts)

    @cached_property
    def stg_support_ticket_messages(self) -> DataFrame:
        return staging.stg_support_ticket_messages(self.messages, self.run_ts)

    # intermediate -------------------------------------------------------------
    @cached_property
    def int_customer_transactions(self) -> DataFrame:
        return intermediate.int_customer_transactions(self.stg_transactions, self.stg_customers)

    @cached_property
    def int_customer_loyalty(self) -> DataFrame:
        return scd2.tier_history(self.stg_customers, self.stg_loyalty_events)

    @cached_property
    def int_customer_support(self) -> DataFrame:
        return intermediate.int_customer_support(self.stg_support_ticket_messages, self.stg_customers)

    def _mart(self, name: str, df: DataFrame) -> DataFrame:
        return self._write(name, df) if self.materialize_marts else df

    # marts --------------------------------------------------------------------
    @cached_property
    def dim_customer(self) -> DataFrame:
        dim = marts.dim_customer(self.stg_customers, self.int_customer_loyalty, self.as_of)
        if self.materialize_marts:
            return self._write("dim_customer", dim)
        # both facts and the feature table read the dimension: over a written
        # processed zone its lineage is cut once instead of recomputed per reader
        return self._write("dim_customer", dim) if self._written else dim

    @cached_property
    def fact_transactions(self) -> DataFrame:
        return self._mart("fact_transactions",
                          marts.fact_transactions(self.stg_transactions, self.dim_customer, self.closed))

    @cached_property
    def fact_support(self) -> DataFrame:
        return self._mart("fact_support",
                          marts.fact_support(self.int_customer_support, self.dim_customer, self.run_ts, self.closed))

    @cached_property
    def feature_store_customer(self) -> DataFrame:
        return self._mart("feature_store_customer",
                          marts.feature_store_customer(self.dim_customer, self.fact_transactions,
                                                       self.fact_support, self.as_of, self.run_ts))

    def staging_tables(self) -> dict[str, DataFrame]:
        return {"stg_customers": self.stg_customers, "stg_transactions": self.stg_transactions,
                "stg_loyalty_events": self.stg_loyalty_events,
                "stg_support_ticket_messages": self.stg_support_ticket_messages}

    def mart_tables(self) -> dict[str, DataFrame]:
        return {"dim_customer": self.dim_customer, "fact_transactions": self.fact_transactions,
                "fact_support": self.fact_support, "feature_store_customer": self.feature_store_customer}
