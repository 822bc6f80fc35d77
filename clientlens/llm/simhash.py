"""Operator 12: near-duplicate documents by SimHash and a binary trie self-join.

Fingerprint: A-Z lower-cased, words separated by blanks and the characters 9 to
13, shingles of three words with repeats (a text of fewer words is one
shingle); a bit is 1 if it is set in over half of the shingles' XXH64 hashes
(seed 42). Two fingerprints are linked when at most ``within`` bits differ.

Self-join: the distinct fingerprints are the leaves of a binary trie. The join
walks pairs of nodes of equal depth from the root down: a pair's children are
paired, the bits in which their paths differ are added up, and a pair is left
as soon as they exceed ``within``. A pair of nodes with few leaves is compared
leaf by leaf.

On the cluster: of ``within + 1`` even blocks of bits, two linked fingerprints
agree in one at least. So there is one trie for each block, with that block's
bits in front, and at the depth of the block only pairs of a node with itself
are left: these are the tasks (about 4 x 65,536 of them for 3 bits), and each
fingerprint is sent ``within + 1`` times. A pair of nodes with more than
``NODE_ROWS`` leaves is not walked in one task: its walk goes on as a Spark
job, four bits at a time with the same budget, until every pair is small
enough (distinct fingerprints always part in the end). Inside a task the walk
is done for all its node pairs at once in numpy. Links within a task are
thinned to one link per leaf and connected group, which keeps every component;
equal fingerprints are one leaf, so copies make no links at all.

Edge cases: a null text and a text without words have fingerprint zero, linked
like any other; repeated rows and ids each keep a row; a null id is never the
smallest unless a component has no other; an empty table gives no rows; columns
of any name pass through ``fingerprints`` untouched; very long texts are hashed
part by part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientlens.llm import common
from clientlens.llm.neardup import components

SHINGLE, SEED = 3, 42
WITHIN = 3
NODE_ROWS = 1 << 18          # leaves of a node pair that one task walks
STEP = 4                     # bits by which a larger pair is walked on as a job
TASK_ROWS = 1 << 18          # leaves that a task holds at a time
LEAF_PAIRS = 64              # node pairs of at most so many leaf pairs are compared directly
FRONT = 1 << 18              # node pairs or leaf pairs held at a time
HASHES = 1 << 18             # shingle hashes whose bits are counted at a time


def _hashes(words: list[bytes]) -> list[int]:
    if len(words) < SHINGLE:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    digest = xxhash.xxh64_intdigest
    return [digest(text[a:b], SEED) for a, b in zip(starts[:len(words) - SHINGLE + 1].tolist(), ends[SHINGLE - 1:].tolist())]


def _ones(h: list[int]) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set."""
    raw = np.array(h, "<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def _bits(ones: np.ndarray, n: np.ndarray) -> np.ndarray:
    """(texts x 64) counts and numbers of hashes -> fingerprints."""
    return np.packbits(2 * ones > n[:, None], axis=1, bitorder="little").view("<u8").ravel()


def _long_counts(raw: bytes) -> tuple[np.ndarray, int]:
    ones, n, kept = np.zeros(64, np.int64), 0, []
    for piece in common.pieces(raw):
        words = kept + piece.lower().split()
        if len(words) >= SHINGLE:
            h = _hashes(words)
            for i in range(0, len(h), HASHES):
                ones += _ones(h[i:i + HASHES])
            n += len(h)
            words = words[1 - SHINGLE:]
        kept = words
    if not n and kept:
        ones, n = _ones(_hashes(kept)), 1
    return ones, n


def simhash(raws: list[bytes | None]) -> np.ndarray:
    """The fingerprint (unsigned) of each text."""
    out = np.zeros(len(raws), np.uint64)
    for first, last in common.blocks(raws, common.PIECE_BYTES):
        h, counts = [], np.zeros(last - first, np.int64)
        for i in range(first, last):
            raw = raws[i] or b""
            if len(raw) > common.PIECE_BYTES:                    # alone in its block
                ones, n = _long_counts(raw)
                out[i] = _bits(ones[None], np.array([n]))[0]
            else:
                own = _hashes(raw.lower().split())
                h += own
                counts[i - first] = len(own)
        some = np.flatnonzero(counts)
        if len(some):
            bits = np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones = np.add.reduceat(bits, (np.cumsum(counts) - counts)[some], axis=0, dtype=np.int64)
            out[first + some] = _bits(ones, counts[some])
    return out


def fingerprints(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with the fingerprint as a long (two's complement); its name."""
    common.prepare(docs.sparkSession)
    (name,) = common.free_name(docs, "fingerprint")

    @F.arrow_udf("bigint")
    def sign(texts: pa.Array) -> pa.Array:
        return pa.array(simhash(common.raw_texts(texts)).view(np.int64), pa.int64())

    return docs.withColumn(name, sign(F.col(text_col))), name


# --- the walk inside a task -----------------------------------------------------

class Walk:
    """The walk over the node pairs of sorted leaves ``r`` (unsigned; each node a
    range of them). Gives (leaf, leaf) links, one per leaf and connected group."""

    def __init__(self, r: np.ndarray, within: int):
        self.r, self.within = r, within
        self.before: dict[int, np.ndarray] = {}        # by depth: leaves with that bit set, before each place
        self.found = [np.empty(0, np.int64), np.empty(0, np.int64)]

    def ones(self, depth: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        if depth not in self.before:
            bit = (self.r >> np.uint64(63 - depth)) & np.uint64(1)
            self.before[depth] = np.append(0, np.cumsum(bit.astype(np.int64)))
        c = self.before[depth]
        return c[hi] - c[lo]

    def keep(self, i: np.ndarray, j: np.ndarray) -> None:
        self.found = [np.append(self.found[0], i), np.append(self.found[1], j)]
        if len(self.found[0]) > 4 * FRONT:
            self.found = list(self.links())

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """(leaf, smallest leaf of its group) for the leaves that have a link."""
        u, v = self.found
        label = np.arange(len(self.r))
        while True:
            low, high = np.minimum(label[u], label[v]), np.maximum(label[u], label[v])
            apart = low < high
            if not apart.any():
                at = np.flatnonzero(label != np.arange(len(label)))
                return at, label[at]
            np.minimum.at(label, high[apart], low[apart])
            while (label[label] != label).any():
                label = label[label]

    def compare(self, pairs: np.ndarray) -> None:
        """Every leaf of one node with every leaf of the other."""
        while pairs.shape[1]:
            sizes = (pairs[1] - pairs[0]) * (pairs[3] - pairs[2])
            many = max(1, int(np.searchsorted(np.cumsum(sizes), FRONT, side="right")))
            now, pairs, size = pairs[:, :many], pairs[:, many:], sizes[:many]
            of = np.repeat(np.arange(many), size)
            k = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
            width = (now[3] - now[2])[of]
            i, j = now[0][of] + k // width, now[2][of] + k % width
            near = (np.bitwise_count(self.r[i] ^ self.r[j]) <= self.within) & (i != j)
            self.keep(i[near], j[near])

    def walk(self, pairs: np.ndarray, depth: int) -> None:
        """``pairs``: rows a from, a to, b from, b to, bits that differ so far."""
        stack = [(depth, pairs)]
        while stack:
            depth, p = stack.pop()
            if p.shape[1] > FRONT:
                half = p.shape[1] // 2
                stack += [(depth, p[:, :half]), (depth, p[:, half:])]
                continue
            small = ((p[1] - p[0]) * (p[3] - p[2]) <= LEAF_PAIRS) | (depth >= 64)
            self.compare(p[:, small])
            alo, ahi, blo, bhi, spent = p[:, ~small]
            if not len(alo):
                continue
            amid, bmid = ahi - self.ones(depth, alo, ahi), bhi - self.ones(depth, blo, bhi)
            same = alo == blo                         # a node with itself: its two children meet once
            children = np.concatenate([
                np.stack([alo, amid, blo, bmid, spent]), np.stack([amid, ahi, bmid, bhi, spent]),
                np.stack([alo, amid, bmid, bhi, spent + 1]),
                np.stack([amid, ahi, blo, bmid, spent + 1])[:, ~same]], axis=1)
            live = ((children[0] < children[1]) & (children[2] < children[3]) & (children[4] <= self.within)
                    & ~((children[0] == children[2]) & (children[1] - children[0] < 2)))
            if live.any():
                stack.append((depth + 1, children[:, live]))


NODE = ["trie", "depth", "a", "b"]


def _walk_task(within: int, fronts: list[int]):
    """Links (a, b) of the node pairs in sorted rows of (trie, depth, a, b, spent,
    side, leaf)."""

    def links(cols: dict[str, np.ndarray]) -> pa.RecordBatch:
        n = len(cols["leaf"])
        new = np.append(True, np.any([cols[c][1:] != cols[c][:-1] for c in NODE], axis=0)) if n else np.empty(0, bool)
        begins = np.flatnonzero(new)
        ends = np.append(begins[1:], n)
        second = np.append(0, np.cumsum(cols["side"]))
        mids = ends - (second[ends] - second[begins])
        alone = cols["a"][begins] == cols["b"][begins]
        pairs = np.stack([begins, mids, np.where(alone, begins, mids), ends, cols["spent"][begins].astype(np.int64)])
        depths = cols["depth"][begins]
        walk = Walk(cols["leaf"].view(np.uint64), within)
        for depth in np.unique(depths).tolist():
            walk.walk(pairs[:, depths == depth], depth)
        i, j = walk.links()
        turn = np.array(fronts, np.uint64)[cols["trie"]]
        r, left = walk.r, (np.uint64(64) - turn) % np.uint64(64)
        back = np.where(turn == 0, r, (r >> turn) | (r << left)).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(back[i]), pa.array(back[j])], names=["a", "b"])

    def run(batches):
        names, held, size = [*NODE, "spent", "side", "leaf"], [], 0

        def joined() -> dict[str, np.ndarray]:
            return {c: np.concatenate([h[c] for h in held]) for c in names}

        for batch in batches:
            held.append({c: batch.column(c).to_numpy(zero_copy_only=False) for c in names})
            size += batch.num_rows
            if size >= TASK_ROWS:
                cols = joined()
                last = np.flatnonzero(np.any([cols[c][1:] != cols[c][:-1] for c in NODE], axis=0))
                if len(last):                         # the last node pair may go on
                    cut = int(last[-1]) + 1
                    yield links({c: v[:cut] for c, v in cols.items()})
                    held = [{c: v[cut:] for c, v in cols.items()}]
                    size -= cut
        if size:
            yield links(joined())

    return run


# --- the walk over the cluster ----------------------------------------------------

def _turned(x: Column, by: int) -> Column:
    """Rotated left by ``by`` bits."""
    return x if by == 0 else F.shiftleft(x, by).bitwiseOR(F.shiftrightunsigned(x, 64 - by))


def _children(rows: DataFrame, within: int) -> DataFrame:
    """The rows of node pairs in the pairs of their children ``STEP`` levels down
    that are within the budget."""
    other = F.explode(F.sequence(F.lit(0), F.lit((1 << STEP) - 1))).alias("other")
    own = F.expr(f"shiftrightunsigned(leaf, {64 - STEP} - depth)").bitwiseAND((1 << STEP) - 1)
    met = rows.select("*", own.alias("own"), other).withColumn(
        "spent", F.col("spent") + F.bit_count(F.col("own").bitwiseXOR(F.col("other")))).filter(F.col("spent") <= within)
    itself = F.col("a") == F.col("b")
    first = F.when(itself, F.col("own") <= F.col("other")).otherwise(F.col("side") == 0)
    down = lambda node, child: F.shiftleft(F.col(node), STEP) + child
    return met.select("trie", (F.col("depth") + STEP).alias("depth"),
                      down("a", F.when(first, F.col("own")).otherwise(F.col("other"))).alias("a"),
                      down("b", F.when(first, F.col("other")).otherwise(F.col("own"))).alias("b"),
                      "spent", F.when(first, 0).otherwise(1).alias("side"), "leaf")


def links(prints: DataFrame, print_col: str, within: int = WITHIN, node_rows: int = NODE_ROWS) -> DataFrame:
    """(a, b) links among the distinct fingerprints in ``prints``: every pair
    within the budget lies in one component of these links, and no link joins
    fingerprints that no chain of such pairs joins."""
    if not 0 <= within <= 15:
        raise ValueError("within must be 0 to 15")
    blocks = within + 1
    fronts = [64 * i // blocks for i in range(blocks + 1)]
    roots = F.explode(F.array(*[F.struct(
        F.lit(i).alias("trie"), F.lit(fronts[i + 1] - fronts[i]).alias("depth"),
        F.shiftrightunsigned(_turned(F.col(print_col), fronts[i]), 64 - (fronts[i + 1] - fronts[i])).alias("node"),
        _turned(F.col(print_col), fronts[i]).alias("leaf")) for i in range(blocks)])).alias("t")
    rows = prints.select(roots).select("t.trie", "t.depth", F.col("t.node").alias("a"), F.col("t.node").alias("b"),
                                       F.lit(0).alias("spent"), F.lit(0).alias("side"), "t.leaf")
    out = None
    while True:
        large = common.written(rows.groupBy(*NODE).agg(F.count("*").alias("n")).filter(
            (F.col("n") > node_rows) & (F.col("depth") + STEP <= 64)).select(*NODE), "node-pairs")
        split = not large.isEmpty()
        small = rows.join(large, NODE, "left_anti") if split else rows
        found = (small.repartition(*NODE).sortWithinPartitions(*NODE, "side", "leaf")
                 .mapInArrow(_walk_task(within, fronts), "a bigint, b bigint"))
        out = found if out is None else out.unionByName(found)
        if not split:
            return out
        rows = common.written(_children(rows.join(large, NODE, "left_semi"), within), "node-children")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", within: int = WITHIN,
                    node_rows: int = NODE_ROWS) -> DataFrame:
    """One row per document: its id, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id that links reach, its own included."""
    signed, name = fingerprints(docs.select(id_col, text_col), text_col)
    signed = common.written(signed.select(F.col(id_col).alias("id"), F.col(name).alias("print")), "simhashes")
    prints = common.written(signed.groupBy("print").agg(F.min("id").alias("low")), "fingerprints")
    labels = components(links(prints, "print", within, node_rows))
    of = prints.join(labels.withColumnRenamed("row", "print"), "print", "left").select(
        "print", "low", F.coalesce("label", "print").alias("class"))
    of = common.written(of, "fingerprint-classes")
    least = of.groupBy("class").agg(F.min("low").alias("component_id"))
    known = of.join(least, "class").select("print", "component_id")
    return signed.join(known, "print").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
