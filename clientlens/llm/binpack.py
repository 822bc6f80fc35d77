"""Operator 10: best-fit-decreasing packing into fixed-size id matrices.

A document longer than a row is split losslessly into full rows and one rest.
Pieces are packed in windows of a bounded number of tokens: longest piece
first, each into the open row with the least room that still fits it, found by
a search in a segment tree over the capacities. A task streams its partition
and holds one window; there is no shuffle, so neither skewed keys nor long
documents gather anywhere.

Output: a table in the shared folder, one row per matrix row, with the ids
(little-endian 32-bit, padded to ``capacity``), the cumulative segment lengths
and the position of every token in its segment (it resets to 0 at each segment, so
no position reaches ``capacity``), plus the documents of the segments and the
tokens that stand before each in its document (``starts``, the way back).

Edge cases: a null or empty text is the end-of-document id alone; ties in
length go by the order in the window; repeated rows and null ids are packed row
by row; an empty table gives an empty matrix; other columns are not read.
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
WINDOW_TOKENS = 4 << 20      # tokens that a task packs at a time
PAD = 0


class BestFit:
    """Open rows by remaining capacity, with a segment tree over the capacity
    values: ``take(n)`` finds the least capacity of at least ``n`` that has an
    open row, in a logarithmic number of steps."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, row: int, room: int) -> None:
        if room:
            self.rows[room].append(row)
            self._add(room, 1)

    def take(self, n: int) -> tuple[int, int] | None:
        """(row, room) of the best fit, which is no longer open; None if no
        open row has room for ``n``."""
        count, node = self.count, n + self.leaves
        while not count[node]:                       # up, until a subtree right of n holds an open row
            while node & 1:
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.leaves:                    # down, to its least capacity
            node *= 2
            node += not count[node]
        room = node - self.leaves
        self._add(room, -1)
        return self.rows[room].pop(), room


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Rows of piece numbers; no row's lengths exceed ``capacity``."""
    rows: list[list[int]] = []
    tree = BestFit(capacity)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[i])
        if found is None:
            found = (len(rows), capacity)
            rows.append([])
        row, room = found
        rows[row].append(i)
        tree.put(row, room - lengths[i])
    return rows


def pack_matrix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                window_tokens: int = WINDOW_TOKENS, vocabulary: str | None = None) -> DataFrame:
    """The packed matrix as a written table: ``sequence_id`` (gapless),
    ``ids``, ``cu_seqlens`` (from 0 to the tokens used), ``positions``
    (little-endian 32-bit, one per id, from 0 in each segment; 0 on padding), ``doc_ids``, ``starts``
    and ``doc_tokens`` of the segments in order."""
    common.prepare(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    out_schema = (f"part bigint, line bigint, ids binary, cu_seqlens array<int>, positions binary, "
                  f"doc_ids array<{kind}>, starts array<bigint>, doc_tokens array<bigint>")
    end = EOS.to_bytes(2, "little")

    def rows_of(window, doc_type, line):
        """Arrow batches of the packed rows of one window."""
        part = TaskContext.get().partitionId()
        packed = best_fit_decreasing([len(w[2]) for w in window], capacity)
        for first in range(0, len(packed), 256):
            cols = [[] for _ in range(8)]
            for k, row in enumerate(packed[first:first + 256], first + line):
                ids, pos = np.full(capacity, PAD, "<u4"), np.zeros(capacity, "<u4")
                cu = [0]
                for i in row:
                    piece = window[i][2]
                    a, b = cu[-1], cu[-1] + len(piece)
                    ids[a:b], pos[a:b] = piece, np.arange(len(piece))
                    cu.append(b)
                mine = [window[i] for i in row]
                for c, v in zip(cols, (part, k, ids.tobytes(), cu, pos.tobytes(), [m[0] for m in mine],
                                       [m[1] for m in mine], [m[3] for m in mine])):
                    c.append(v)
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.list_(doc_type),
                     pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, kinds)],
                names=["part", "line", "ids", "cu_seqlens", "positions", "doc_ids", "starts", "doc_tokens"])
        return line + len(packed)

    def pack(batches):
        enc, window, held, line, doc_type = encoder(vocabulary), [], 0, 0, None
        for b in batches:
            doc_type = b.column("id").type
            for doc, raw in zip(b.column("id").to_pylist(), common.raw_texts(b.column("text"))):
                ids = np.frombuffer(enc.encode(raw) + end, "<u2")
                for start in range(0, len(ids), capacity):
                    window.append((doc, start, ids[start:start + capacity], len(ids)))
                held += len(ids)
                if held >= window_tokens:
                    line = yield from rows_of(window, doc_type, line)
                    window, held = [], 0
        if window:
            yield from rows_of(window, doc_type, line)

    rows = common.written(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                          .mapInArrow(pack, out_schema), "matrix")
    # rows before each written partition: one number per partition, looked up
    # where the rows are, so the matrix itself is not shuffled
    base, total = {}, 0
    for part, n in sorted((r["part"], r["n"]) for r in rows.groupBy("part").agg(F.count("*").alias("n")).collect()):
        base[part] = total
        total += n

    def number(parts: pa.Array, lines: pa.Array) -> pa.Array:
        return pa.array([base[p] + i for p, i in zip(parts.to_pylist(), lines.to_pylist())], pa.int64())

    return rows.select(F.arrow_udf(number, "bigint")("part", "line").alias("sequence_id"), "ids", "cu_seqlens", "positions",
                       "doc_ids", "starts", "doc_tokens")


def pieces(matrix: DataFrame) -> DataFrame:
    """One row per segment, cut back out of the matrix rows: ``doc_id``,
    ``start``, ``length``, ``ids``, ``doc_tokens``, ``sequence_id``,
    ``offset`` and the segment's first position."""
    at = matrix.select("sequence_id", "ids", "positions", "cu_seqlens",
                       F.posexplode(F.arrays_zip("doc_ids", "starts", "doc_tokens")).alias("k", "s"))
    low, high = F.element_at("cu_seqlens", F.col("k") + 1), F.element_at("cu_seqlens", F.col("k") + 2)
    first = F.substring("positions", low * 4 + 1, F.lit(4))
    return at.select(
        F.col("s.doc_ids").alias("doc_id"), F.col("s.starts").alias("start"),
        (high - low).cast("long").alias("length"), F.substring("ids", low * 4 + 1, (high - low) * 4).alias("ids"),
        F.col("s.doc_tokens").alias("doc_tokens"), "sequence_id", low.cast("long").alias("offset"),
        F.conv(F.concat(*[F.substring(F.hex(first), 7 - 2 * i, 2) for i in range(4)]), 16, 10)
         .cast("long").alias("first_position"))
