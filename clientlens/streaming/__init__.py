"""Streaming hook for the incremental fact refresh.

The pipeline is batch; late data is handled by the lookback merge
(``clientlens.operators.incremental``). The same refresh can run per micro-batch
of a Structured Streaming source through ``foreachBatch``: each batch of staged
transactions is merged into the fact stored by period, and only the partitions
it touches are rewritten. No streaming state is kept; the table is the state,
and a batch that is replayed after a stop finishes the stopped swap first and
then merges the same keys again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from clientlens.operators.incremental import refresh_fact_partitions


def fact_refresh_batch(dim: DataFrame, fact_root: str, lookback_days: int = 3, closed: str = "left",
                       period: str = "day", stage_root: str | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: merge each micro-batch of staged
    transactions into the fact at ``fact_root``, partitioned by ``period``."""

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        refresh_fact_partitions(batch, dim, fact_root, stage_root or fact_root.rstrip("/") + "_stage",
                                lookback_days, closed, period)

    return on_batch
