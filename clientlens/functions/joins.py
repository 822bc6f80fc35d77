"""How tables meet whose size the planner cannot tell."""

from __future__ import annotations

from pyspark.sql import DataFrame


def by_merge(df: DataFrame) -> DataFrame:
    """A side of a join whose other side grows with the input as well: they meet as
    sorted partitions.

    The planner takes the bytes of a stored table's files for its size. Files of like
    rows are compressed to a small part of what the rows take (8 MB of files for 243
    MB), so such a table passes for one to broadcast, and all of it would be gathered
    and hashed on the driver. Joins with tables of a bounded number of rows (nations,
    periods, buckets) are left to the planner."""
    return df.hint("merge")
