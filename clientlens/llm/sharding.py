"""Operator 8: a uniform shuffle into shards of exact size.

Every input partition draws how many of its rows go to each shard from the
multivariate hypergeometric law of a uniform permutation (one row of the
communication matrix), permutes its rows locally and deals them out
accordingly; after the exchange the rows of each shard are permuted again. The
result is a uniformly random arrangement of all rows in which every shard has
exactly its size (counts differ by one at most).

No task or driver ever holds the matrix: the rows follow from a seeded binary
tree over the partitions. A node draws how its slots of each shard split between
its halves, so a task walks the few nodes above its own partition (their number
grows with the logarithm of the partitions) and all tasks agree. Only the row count
and bytes of each partition go to the driver.

The second permutation orders a shard by a random key of each row. A shard is dealt
as buckets of the key's leading bits, of about ``bucket_rows`` rows and
``bucket_bytes`` bytes, so no task sorts a whole shard; a bucket's first slot is the
number of rows in the buckets before it.

The rows are first written with their partition number and position into the
shared folder: a lost task deals the same rows again. Values of keys play no
part, so a hot source or a large group of copies spreads like any other rows.
Null ids and texts, repeated rows and columns of any name are carried along
unchanged; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientlens.llm import common

SHARDS, SEED, BUCKET_ROWS, BUCKET_BYTES = 16, 8, 1 << 16, 64 << 20

_NUMPY_LIMIT = 10 ** 9


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws without replacement are good: numpy's draw where
    it can count that far, ratio of uniforms (Stadlober) beyond."""
    if n == 0 or good == 0:
        return 0
    if bad == 0:
        return n
    if good + bad < _NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, n))
    total, few, many, m = good + bad, min(good, bad), max(good, bad), min(n, good + bad - n)
    if m == 0:
        return good
    p = few / total
    centre = m * p + 0.5
    width = math.sqrt((total - m) * m * p * (1 - p) / (total - 1) + 0.5)
    spread = 2 * math.sqrt(2 / math.e) * width + 3 - 2 * math.sqrt(3 / math.e)
    top = min(min(m, few) + 1, math.floor(centre + 16 * width))

    def weight(z: int) -> float:
        return math.lgamma(z + 1) + math.lgamma(few - z + 1) + math.lgamma(m - z + 1) + math.lgamma(many - m + z + 1)

    peak = weight((m + 1) * (few + 1) // (total + 2))
    while True:
        u = 1 - rng.random()
        w = centre + spread * (rng.random() - 0.5) / u
        if 0 <= w < top and 2 * math.log(u) <= peak - weight(int(w)):
            break
    z = int(w) if good <= bad else m - int(w)
    return z if m == n else good - z


def split(rng: np.random.Generator, room: tuple[int, ...], n: int) -> tuple[int, ...]:
    """How ``n`` rows, drawn uniformly, fall on shards with that much room."""
    out, rest = [], sum(room)
    for r in room:
        rest -= r
        k = hypergeometric(rng, r, rest, n)
        out.append(k)
        n -= k
    return tuple(out)


class Matrix:
    """Rows of the communication matrix, by the seeded tree over the partitions."""

    def __init__(self, counts: list[int], room: list[int], seed: int):
        self.before, self.room, self.seed = [0], tuple(room), seed
        for c in counts:
            self.before.append(self.before[-1] + c)

    def node(self, low: int, high: int) -> tuple[int, ...]:
        """Slots of each shard that partitions low to high - 1 fill."""
        parent, left = (0, len(self.before) - 1), self.room
        while parent != (low, high):                 # down from the root
            a, b = parent
            mid = (a + b) // 2
            rng = np.random.default_rng([self.seed, a, b])
            first = split(rng, left, self.before[mid] - self.before[a])
            if high <= mid:
                parent, left = (a, mid), first
            else:
                parent, left = (mid, b), tuple(x - y for x, y in zip(left, first))
        return left

    def row(self, i: int) -> tuple[int, ...]:
        return self.node(i, i + 1)


def even(total: int, parts: int) -> list[int]:
    return [total // parts + (i < total % parts) for i in range(parts)]


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_rows: int = BUCKET_ROWS,
          bucket_bytes: int = BUCKET_BYTES, text_col: str = "text") -> DataFrame:
    """``docs`` with one struct column ``placed`` (under a free name if taken)
    of ``shard`` and ``slot``: slots count from 0 without gaps in each shard."""
    common.prepare(docs.sparkSession)
    part, pos, to, bucket, order, begin, s, k, placed = common.free_name(
        docs, "part", "pos", "shard", "bucket", "order", "begin", "s", "k", "placed")
    row = F.monotonically_increasing_id()
    rows = common.written(docs.withColumns({part: F.shiftright(row, 33), pos: row.bitwiseAND((1 << 33) - 1)}), "rows")
    size = F.sum(F.octet_length(text_col)) if text_col in docs.columns else F.lit(0)
    counted = {r[part]: r for r in rows.groupBy(part).agg(F.count("*").alias("n"), size.alias("bytes")).collect()}   # one per partition
    counts = [counted[i].n if i in counted else 0 for i in range(max(counted, default=-1) + 1)]
    total, room = sum(counts), even(sum(counts), shards)
    wanted = max(total / bucket_rows, sum(r.bytes or 0 for r in counted.values()) / bucket_bytes) / shards
    bits = max(0, math.ceil(math.log2(max(wanted, 1))))

    @F.arrow_udf("int")
    def deal(parts: pa.Array, positions: pa.Array) -> pa.Array:
        p, at = parts.to_numpy(zero_copy_only=False), positions.to_numpy(zero_copy_only=False)
        out = np.empty(len(p), np.int32)
        for i in np.unique(p).tolist():
            mine = p == i
            places, ends = dealt(i)
            out[mine] = np.searchsorted(ends, places[at[mine]], side="right")
        return pa.array(out)

    held: dict = {}

    def dealt(i):
        """Partition i's local permutation and the ends of its shares."""
        if i not in held:
            held.clear()
            held[i] = (np.random.default_rng([seed, len(counts), i]).permutation(counts[i]),
                       np.cumsum(Matrix(counts, room, seed).row(i)))
        return held[i]

    key = F.xxhash64(F.lit(seed), F.col(part), F.col(pos))
    lead = F.shiftrightunsigned(order, 64 - bits) if bits else F.lit(0).cast("long")
    keyed = lambda df: df.withColumn(to, deal(part, pos)).withColumn(order, key).withColumn(bucket, lead)
    sizes = keyed(rows.select(part, pos)).groupBy(to, bucket).agg(F.count("*").alias("n"))
    before = Window.partitionBy(s).orderBy(k).rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select(F.col(to).alias(s), F.col(bucket).alias(k), "n").select(
        s, k, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(begin))             # a row per bucket
    again = Window.partitionBy(to, bucket).orderBy(order, part, pos)
    return (keyed(rows).join(begins, (F.col(to) == F.col(s)) & (F.col(bucket) == F.col(k))).drop(s, k)
            .withColumn(placed, F.struct(F.col(to).alias("shard"), (F.col(begin) + F.row_number().over(again) - 1).cast("long").alias("slot")))
            .drop(part, pos, to, bucket, order, begin))
