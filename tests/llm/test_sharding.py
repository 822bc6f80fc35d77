import zlib
from collections import Counter

import numpy as np
import pytest

from clientlens.llm import sharding
from clientlens.llm.queries import QUERIES

from .helpers import AWKWARD, awkward, empty, sf_dir


def test_matrix_rows_have_exact_sums():
    counts, room = [5, 0, 17, 3, 40, 1], sharding.even(66, 7)
    rows = np.array([sharding.Matrix(counts, room, 3).row(i) for i in range(len(counts))])
    assert (rows >= 0).all() and rows.sum(axis=1).tolist() == counts and rows.sum(axis=0).tolist() == room
    again = sharding.Matrix(counts, room, 3)
    assert all(again.row(i) == tuple(rows[i]) for i in (4, 0, 2))        # any order, any task


def test_matrix_is_hypergeometric():
    """Mean and variance of one cell over many seeds: those of a uniform permutation."""
    counts, room = [30, 50, 20], [40, 60]
    x = np.array([sharding.Matrix(counts, room, s).row(1)[0] for s in range(4000)])
    mean, var = 50 * 0.4, 50 * 0.4 * 0.6 * 50 / 99
    assert abs(x.mean() - mean) < 4 * (var / 4000) ** 0.5 and abs(x.var() / var - 1) < 0.1


@pytest.mark.parametrize("good, bad, n", [(4 * 10 ** 9, 6 * 10 ** 9, 10 ** 9), (2 * 10 ** 9, 10 ** 9, 2 * 10 ** 9), (10 ** 10, 10 ** 10, 5)])
def test_hypergeometric_beyond_numpys_limit(good, bad, n):
    rng = np.random.default_rng(0)
    x = np.array([sharding.hypergeometric(rng, good, bad, n) for _ in range(2000)], float)
    p, total = good / (good + bad), good + bad
    var = n * p * (1 - p) * (total - n) / (total - 1)
    assert abs(x.mean() - n * p) < 5 * (var / 2000) ** 0.5 and abs(x.var() / var - 1) < 0.15
    assert x.min() >= max(0, n - bad) and x.max() <= min(good, n)


@pytest.mark.parametrize("bucket_rows", [1 << 16, 9])
def test_shards_are_exact_and_slots_gapless(spark, bucket_rows):
    n = 1003
    docs = spark.range(n, numPartitions=6).selectExpr("id AS doc_id", "CAST(id AS string) AS text", "id AS placed")
    rows = sharding.shard(docs, 16, bucket_rows=bucket_rows).collect()
    assert sorted(r.doc_id for r in rows) == list(range(n))
    by = {}
    for r in rows:
        by.setdefault(r["__placed"].shard, []).append(r["__placed"].slot)
    assert len(by) == 16 and {len(s) for s in by.values()} == {62, 63}
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    again = sharding.shard(docs, 16, bucket_rows=bucket_rows).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))         # the same seed, the same places


def test_rows_are_spread_uniformly(spark):
    """Over seeds, the first rows of the input fall on all shards and slots alike."""
    docs = spark.range(64, numPartitions=4).selectExpr("id AS doc_id")
    seen, place = Counter(), []
    for seed in range(12):
        for r in sharding.shard(docs, 4, seed=seed).filter("doc_id < 16").collect():
            seen[r["__placed"].shard] += 1
            place.append(r["__placed"].slot)
    assert sum(seen.values()) == 192 and all(30 <= c <= 66 for c in seen.values())
    assert 6 < np.mean(place) < 9


def test_buckets_follow_rows_and_bytes(spark):
    """Small buckets by either bound: the same shards, exact sizes, gapless slots."""
    docs = spark.range(500, numPartitions=5).selectExpr("id AS doc_id", "repeat('x', 100) AS text", "id AS s", "id AS k")
    place = lambda **o: {r.doc_id: r["__placed"] for r in sharding.shard(docs, 4, **o).collect()}
    one, rows, size = place(), place(bucket_rows=10), place(bucket_bytes=1000)
    for other in (rows, size):
        assert {i: p.shard for i, p in other.items()} == {i: p.shard for i, p in one.items()}
        for shard in range(4):
            assert sorted(p.slot for p in other.values() if p.shard == shard) == list(range(125))
    out = sharding.shard(docs, 4)
    assert out.columns[:4] == docs.columns and len(out.columns) == 5


def test_many_partitions_cost_few_draws():
    """The row of one of 100,000 partitions takes a draw per shard and level."""
    import time
    matrix = sharding.Matrix([60_000] * 100_000, sharding.even(6 * 10 ** 9, 16), 1)
    t = time.perf_counter()
    row = matrix.row(77_777)
    assert sum(row) == 60_000 and time.perf_counter() - t < 1


def test_query_on_awkward_rows(spark):
    rows = QUERIES["op8_sharding"](spark, sf_dir(documents=awkward(spark))).collect()
    want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in AWKWARD), key=str)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in rows), key=str) == want
    assert {r.law for r in rows} == {"rows"} and max(Counter(r.shard for r in rows).values()) == 1
    assert {r.grown_shard for r in rows} == {None}


def test_columns_pass_and_empty(spark):
    docs = awkward(spark)
    out = sharding.shard(docs, 3)
    assert out.columns[:len(docs.columns)] == docs.columns and len(out.columns) == len(docs.columns) + 1
    assert sharding.shard(empty(spark)).count() == 0
