"""Operator 9: sequence packing along a space-filling curve.

Each document's token ids are hashed into a small vector, the vector is
projected to three dimensions and the document gets the Hilbert-curve index of
that point. Documents are range-sorted by the index (ties by row number), laid
end to end along the curve, and the line is cut every ``capacity`` tokens:
neighbouring (similar) documents share sequences, and only the last sequence
has padding.

Stages: (1) tokenise once into a table in the shared folder; (2) range-sort the
slim (index, row, length) rows and write their running token counts; one number
per partition goes to the driver to make the counts global; (3) join the plan
back by row number and cut. Token ids are shuffled once and never sorted.

Edge cases: a null or empty text has the single end-of-document id; a document
of any length is cut over as many sequences as it needs; rows are told apart by
a row number, so repeated rows and null or repeated ids are packed one by one;
an empty table gives no pieces; other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientlens.llm import common
from clientlens.llm.tokens import EOS, encoder

CAPACITY = 2048
HASH_DIMS, CURVE_DIMS, CURVE_BITS, SEED = 64, 3, 10, 9


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert-curve index of integer points (rows; each coordinate below
    ``2 ** bits``), by undoing the curve's rotations from the top bit down."""
    x = points.astype(np.int64).copy()
    n = x.shape[1]
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        low = q - 1
        for i in range(n):
            turned = (x[:, i] & q) != 0
            swap = np.where(turned, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(turned, low, swap)
            if i:
                x[:, i] ^= swap
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), np.int64)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        flip ^= np.where(x[:, n - 1] & q, q - 1, 0)
    x ^= flip[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


def curve_keys(ids: list[np.ndarray]) -> np.ndarray:
    """The Hilbert index of each document's hashed, projected id vector."""
    every = common.mix64(np.arange(1 << 16, dtype=np.uint64) + np.uint64(SEED << 20))
    slot = (every % np.uint64(HASH_DIMS)).astype(np.int64)
    sign = np.where(every >> np.uint64(63), 1.0, -1.0)
    vec = np.zeros((len(ids), HASH_DIMS))
    for row, i in enumerate(ids):
        if len(i):
            vec[row] = np.bincount(slot[i], weights=sign[i], minlength=HASH_DIMS)
    vec /= np.maximum(np.linalg.norm(vec, axis=1, keepdims=True), 1e-12)
    axes = np.linalg.qr(np.random.default_rng(SEED).standard_normal((HASH_DIMS, CURVE_DIMS)))[0]
    unit = (vec @ axes + 1) / 2
    return hilbert_index(np.clip(unit * (1 << CURVE_BITS), 0, (1 << CURVE_BITS) - 1), CURVE_BITS)


def tokenized(docs: DataFrame, id_col: str, text_col: str, vocabulary: str | None = None) -> DataFrame:
    """(row, id, ids, n_tokens, key): one row per document, its 16-bit ids (the
    end-of-document id included) and its place on the curve, as a written
    table."""
    kind = pa.struct([("ids", pa.binary()), ("n_tokens", pa.int64()), ("key", pa.int64())])
    end = EOS.to_bytes(2, "little")

    @F.arrow_udf("ids binary, n_tokens bigint, key bigint")
    def tokenise(texts: pa.Array) -> pa.Array:
        enc = encoder(vocabulary)
        ids = [enc.encode(r) + end for r in common.raw_texts(texts)]
        keys = curve_keys([np.frombuffer(i, "<u2") for i in ids])
        return pa.StructArray.from_arrays(
            [pa.array(ids, pa.binary()), pa.array([len(i) // 2 for i in ids], pa.int64()), pa.array(keys)],
            fields=list(kind))

    return common.written(
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                    F.col(text_col).alias("text"))
            .select("row", "id", tokenise("text").alias("t"))
            .select("row", "id", "t.ids", "t.n_tokens", "t.key"), "tokens")


def line_up(sizes: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Places (row, n_tokens, key) rows end to end in key order. Returns
    (row, part, before) as a written table, ``before`` counting the tokens of
    the same part that come earlier, and the tokens before each part."""
    schema = pa.schema([("row", pa.int64()), ("part", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64())])

    def running(batches):
        part, total = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.column("n_tokens").to_numpy(zero_copy_only=False)
            ends = np.cumsum(n) + total
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(np.full(len(n), part, np.int64)), pa.array(ends - n), pa.array(n)], schema=schema)
            total = int(ends[-1]) if len(n) else total

    line = common.written(
        sizes.repartitionByRange("key", "row").sortWithinPartitions("key", "row")
             .mapInArrow(running, "row bigint, part bigint, before bigint, n_tokens bigint"), "line")
    base, parts = 0, {}
    for part, total in sorted((r.part, r.total) for r in line.groupBy("part").agg(F.sum("n_tokens").alias("total")).collect()):
        parts[part] = base
        base += total
    return line.drop("n_tokens"), parts


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         vocabulary: str | None = None) -> DataFrame:
    """One row per piece: the document's id under its own name, ``start`` (the
    document's ids before the piece), ``length``, ``ids`` (little-endian 32-bit),
    ``doc_tokens``, ``sequence_id`` and ``offset`` in the sequence."""
    common.prepare(docs.sparkSession)
    tokens = tokenized(docs, id_col, text_col, vocabulary)
    line, parts = line_up(tokens.select("row", "n_tokens", "key"))
    kind = dict(docs.dtypes)[id_col]
    names = ["start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    schema = f"id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"

    def cut(batches):
        for b in batches:
            which, out = [], {n: [] for n in names}
            at = zip(b.column("ids").to_pylist(), b.column("part").to_pylist(), b.column("before").to_pylist())
            for r, (raw, part, before) in enumerate(at):
                ids = np.frombuffer(raw, "<u2").astype("<u4")
                begin, start = parts[part] + before, 0
                while start < len(ids):
                    seq, off = divmod(begin + start, capacity)
                    n = min(capacity - off, len(ids) - start)
                    which.append(r)
                    for k, v in zip(names, (start, n, ids[start:start + n].tobytes(), len(ids), seq, off)):
                        out[k].append(v)
                    start += n
            cols = [b.column("id").take(pa.array(which, pa.int64()))]
            cols += [pa.array(out[k], pa.binary() if k == "ids" else pa.int64()) for k in names]
            yield pa.RecordBatch.from_arrays(cols, names=["id", *names])

    pieces = (tokens.select("row", "id", "ids").join(line, "row")
              .select("id", "ids", "part", "before").mapInArrow(cut, schema))
    return pieces.withColumnRenamed("id", id_col)
