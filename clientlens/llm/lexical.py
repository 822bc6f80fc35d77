"""Operator 13: ranked lexical search by bit-sliced Bloom signatures.

Terms are the words of ``decontam`` (A-Z lower-cased, whole texts). A document's
score for an item is the sum, over the item's terms with repeats, of
``w * ((1000000000 * tf) div (1000 * tf + 8 * m))`` with ``w =
floor(1000 * ln((2 N + 2) / (2 df + 1)))`` and ``m = 25 + (75 * n * N) div L``.

Index (one pass over the documents, no shuffle): a task puts documents with about
equally many terms into blocks of at most ``BLOCK_ROWS`` rows and gives each
block a Bloom signature of ``KEY_BITS`` bits a key, stored by slices: one bitmap
over the rows for each signature bit. A term with tf occurrences adds a key for
each level it reaches (tf of 1, 2, 3, 5 and 9 or more). Beside the slices a block
holds its rows' ids, lengths, largest tf and text fingerprints; the tasks' counts
of documents by term are kept in the same table.

Search, for blocks of items: (1) a key's slices are intersected into a bitmap of
the rows that may hold it; never one that does is missed. The weights of an
item's terms are summed over each level's bitmaps, and times the most that a tf
below the next level can give they bound the score of every row from above. The
``PROBES`` highest bounds of each item are scored exactly; the k-th score is the
threshold. (2) Every row whose bound is above the threshold (or equal to it, and
its id before the k-th's) is a candidate; the others are provably not among the
first k. Of candidates with the same text (by 128-bit fingerprint) an item needs
the k smallest ids only. (3) All candidates are scored exactly from their texts.

What is sent to the tasks is bounded by the block of items (``BLOCK_TERMS`` terms):
their terms with weights, the thresholds, and the ids of the probes; the
candidates are broadcast only if they are at most ``SENT_ROWS`` and joined by
their ids otherwise.

Edge cases: null and wordless texts have no term and no rank, null and wordless
items no result; repeated items and rows are ranked one by one; a null id sorts
last; terms that no document holds score nothing; empty tables give no rows;
columns of any name are left aside; very long texts are counted part by part.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientlens.llm import common
from clientlens.llm.decontam import LOWER, UPPER, WORD, words_of

TOP, PROBES = 10, 32
LEVELS = (1, 2, 3, 5, 9)         # a key for each of these tf that a term reaches
KEY_BITS, KEY_HASHES = 9, 6
BLOCK_ROWS, BLOCK_BITS = 1024, 1 << 25
BUFFER_ROWS, BUFFER_KEYS = 8192, 1 << 21     # documents and keys that a task holds to form blocks
VOCABULARY = 1 << 19             # terms that a task numbers at a time
BLOCK_TERMS = 50_000             # (item, term) pairs searched at a time
SENT_ROWS = 200_000              # candidates broadcast at most

_GOLD, _SILVER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def _keys(h: np.ndarray, level: np.ndarray | int) -> np.ndarray:
    """The key of a term (by hash) at a level (by number)."""
    return common.mix64(h + _SILVER * np.asarray(level, np.uint64))


def _places(keys: np.ndarray, width: int) -> np.ndarray:
    """(keys x hashes) signature bits."""
    step = (keys >> np.uint64(32)) | np.uint64(1)
    return ((keys[:, None] + step[:, None] * np.arange(KEY_HASHES, dtype=np.uint64)) % np.uint64(width)).astype(np.int64)


class _Numbers(dict):
    """Numbers terms in the order of their first use."""

    def __missing__(self, term):
        n = self[term] = len(self)
        return n


class _Builder:
    """Signature blocks and term counts of one task."""

    def __init__(self):
        self.terms, self.h, self.df = _Numbers(), np.empty(0, np.uint64), np.empty(0, np.int64)
        self.rows, self.keys = [], 0               # (id, n, largest tf, print, keys)

    def add(self, ids: list, raws: list[bytes | None]) -> None:
        for first, last in common.blocks(raws, common.PIECE_BYTES):
            doc, at = [], []
            for i in range(first, last):
                for piece in common.pieces(raws[i] or b""):
                    words = words_of(piece)
                    at.append(np.fromiter(map(self.terms.__getitem__, words), np.int64, len(words)))
                    doc.append(np.full(len(words), i - first, np.int64))
            pair, tf = np.unique((np.concatenate(doc) << 32) | np.concatenate(at), return_counts=True)
            doc, at = pair >> 32, pair & 0xFFFFFFFF
            new = len(self.terms) - len(self.h)
            if new:
                names = list(self.terms)[-new:] if new < len(self.terms) else list(self.terms)
                self.h = np.append(self.h, np.fromiter(map(xxhash.xxh3_64_intdigest, names), np.uint64, new))
                self.df = np.append(self.df, np.zeros(new, np.int64))
            self.df += np.bincount(at, minlength=len(self.df))
            begins = np.searchsorted(doc, np.arange(last - first + 1))
            for i in range(last - first):
                a, b = int(begins[i]), int(begins[i + 1])
                if a < b:
                    h, f, raw = self.h[at[a:b]], tf[a:b], raws[first + i]
                    own = np.concatenate([_keys(h[f >= t], k) for k, t in enumerate(LEVELS)])
                    self.rows.append((ids[first + i], int(f.sum()), int(f.max()), xxhash.xxh3_128_digest(raw), own))
                    self.keys += len(own)

    def full(self) -> bool:
        return len(self.rows) >= BUFFER_ROWS or self.keys >= BUFFER_KEYS

    def blocks(self):
        rows = sorted(self.rows, key=lambda r: len(r[4]))
        self.rows, self.keys = [], 0
        while rows:
            # the rows are in order of size: a block is as wide as its last row asks for
            many = 1
            while many < min(BLOCK_ROWS, len(rows)) and (many + 1) * len(rows[many][4]) * KEY_BITS <= BLOCK_BITS:
                many += 1
            block, rows = rows[:many], rows[many:]
            width = max(64, KEY_BITS * len(block[-1][4]))
            bits = np.zeros((width, many), bool)
            of = np.repeat(np.arange(many), [len(r[4]) for r in block])
            bits[_places(np.concatenate([r[4] for r in block]), width), of[:, None]] = True
            yield [r[0] for r in block], [r[1] for r in block], [r[2] for r in block], [r[3] for r in block], width, \
                np.packbits(bits, axis=1).tobytes()

    def counts(self):
        out = list(self.terms), self.df
        self.terms, self.h, self.df = _Numbers(), np.empty(0, np.uint64), np.empty(0, np.int64)
        return out


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of ``docs`` as a written table: signature blocks (``ids`` is not
    null) and counts of documents by term (``term`` is not null; to be summed)."""
    common.prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (f"ids array<{kind}>, lengths array<bigint>, tops array<bigint>, prints array<binary>, width int, slices binary, "
              "term string, df bigint")

    def run(batches):
        task, id_type = _Builder(), None

        def record(blocks, terms=(), df=()):
            b, t = len(blocks), len(terms)
            cols = [[x[i] for x in blocks] + [None] * t for i in range(6)]
            types = [pa.list_(id_type), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, types)]
                + [pa.array([None] * b + [x.decode(errors="replace") for x in terms], pa.string()), pa.array([None] * b + list(df), pa.int64())],
                names=["ids", "lengths", "tops", "prints", "width", "slices", "term", "df"])

        def counted():
            terms, df = task.counts()
            for i in range(0, len(terms), 1 << 16):
                yield record([], terms[i:i + (1 << 16)], df[i:i + (1 << 16)].tolist())

        for batch in batches:
            id_type = batch.column("id").type
            ids, raws = batch.column("id").to_pylist(), common.raw_texts(batch.column("text"))
            for first, last in common.blocks(raws):
                task.add(ids[first:last], raws[first:last])
                if task.full():
                    yield from (record([b]) for b in task.blocks())
                if len(task.terms) >= VOCABULARY:
                    yield from counted()
        if id_type is not None:
            yield from (record([b]) for b in task.blocks())
            yield from counted()

    return common.written(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema), "signatures")


class _Items:
    """A block of items, ready for bounds and exact scores."""

    def __init__(self, rows: list[tuple[int, str, int, int]], docs: int, words: int):
        """``rows``: (item, term, occurrences in the item, documents with it)."""
        self.docs, self.words = docs, words
        names = sorted({r[1] for r in rows})
        self.number = {t.encode(): i for i, t in enumerate(names)}
        self.h = np.fromiter((xxhash.xxh3_64_intdigest(t) for t in self.number), np.uint64, len(names))
        self.items = sorted({r[0] for r in rows})
        place, own = {q: i for i, q in enumerate(self.items)}, [[] for _ in self.items]
        for q, term, times, df in rows:
            w = math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))
            own[place[q]].append((self.number[term.encode()], times * w))
        self.at = [np.array([x[0] for x in o], np.int64) for o in own]
        self.weights = [np.array([x[1] for x in o], np.int64) for o in own]

    def damp(self, n: int) -> int:
        """The m of a document of n terms."""
        return 25 + (75 * n * self.docs) // self.words

    def bounds(self, lengths, tops, width: int, slices: bytes) -> np.ndarray:
        """(items x rows) upper bounds of the scores of a signature block."""
        rows = len(lengths)
        bitmaps = np.frombuffer(slices, np.uint8).reshape(width, -1)
        may = np.bitwise_and.reduce(bitmaps[_places(_keys(self.h, 0), width)], axis=1)
        out = np.zeros((len(self.items), rows))
        m8 = 8 * np.array([self.damp(n) for n in lengths], np.int64)
        top = np.array(tops, np.int64)
        worth = lambda tf: (1_000_000_000 * tf) // (1000 * tf + m8)
        before = 0
        for level in range(len(LEVELS)):
            if level:
                live = np.flatnonzero(may.any(axis=1))
                if not len(live):
                    break
                narrow = np.bitwise_and.reduce(bitmaps[_places(_keys(self.h[live], level), width)], axis=1)
                may[live] &= narrow
            # a term at this level and not at the next has at most this tf
            most = worth(np.minimum(LEVELS[level + 1] - 1, top) if level + 1 < len(LEVELS) else top)
            gain = (most - before).astype(np.float64)
            before = most
            some = may.any(axis=1)
            bits = np.unpackbits(may, axis=1, count=rows).astype(np.float32)
            for i, (at, w) in enumerate(zip(self.at, self.weights)):
                live = some[at]
                if live.any():
                    kind = np.float32 if w.sum() < 1 << 24 else np.float64        # exact sums of whole numbers
                    out[i] += gain * (w[live].astype(kind) @ bits[at[live]].astype(kind, copy=False))
        return out

    def scores(self, raw: bytes | None, items: list[int], place: dict[int, int]) -> list[tuple[int, int]]:
        """(item, score) of a document for each of ``items`` where it is above 0."""
        tf, n = Counter(), 0
        for piece in common.pieces(raw or b""):
            words = words_of(piece)
            n += len(words)
            tf.update(filter(self.number.__contains__, words))
        if not n:
            return []
        m8 = 8 * self.damp(n)
        worth = {self.number[t]: (1_000_000_000 * f) // (1000 * f + m8) for t, f in tf.items()}
        out = []
        for q in items:
            i = place[q]
            s = sum(w * worth.get(t, 0) for t, w in zip(self.at[i].tolist(), self.weights[i].tolist()))
            if s > 0:
                out.append((q, s))
        return out


def _probes(sent: _Items, kind: str, many: int):
    """Per task and item the rows with the highest bounds."""
    def run(batches):
        best = [[] for _ in sent.items]
        id_type = None
        for batch in batches:
            id_type = batch.column("ids").type.value_type
            for r in range(batch.num_rows):
                ids = batch.column("ids")[r].values
                ub = sent.bounds(batch.column("lengths")[r].as_py(), batch.column("tops")[r].as_py(),
                                 batch.column("width")[r].as_py(), batch.column("slices")[r].as_buffer())
                for i, u in enumerate(ub):
                    least = best[i][-1][0] if len(best[i]) == many else 0
                    at = np.flatnonzero(u > least)
                    if len(at):
                        at = at[np.argsort(-u[at], kind="stable")[:many]]
                        best[i] = sorted(best[i] + [(float(u[j]), ids[j].as_py()) for j in at.tolist()], key=lambda x: -x[0])[:many]
        if id_type is not None:
            rows = [(q, x[1], x[0]) for q, b in zip(sent.items, best) for x in b]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], id_type),
                                              pa.array([x[2] for x in rows], pa.float64())], names=["q", "id", "bound"])
    return run, f"q bigint, id {kind}, bound double"


def _candidates(sent: _Items, kind: str, thresholds: dict[int, tuple[int, object]]):
    """Rows that are not provably behind an item's k-th document."""
    def run(batches):
        limits = np.array([thresholds.get(q, (0, None))[0] for q in sent.items], np.float64)[:, None]
        lasts = [thresholds.get(q, (0, None))[1] for q in sent.items]
        for batch in batches:
            for r in range(batch.num_rows):
                ids, prints = batch.column("ids")[r].values, batch.column("prints")[r].values
                ub = sent.bounds(batch.column("lengths")[r].as_py(), batch.column("tops")[r].as_py(),
                                 batch.column("width")[r].as_py(), batch.column("slices")[r].as_buffer())
                i, j = np.nonzero((ub >= limits) & (ub > 0))
                even = ub[i, j] == limits[i, 0]
                keep = ~even
                for k in np.flatnonzero(even).tolist():
                    one, last = ids[int(j[k])].as_py(), lasts[int(i[k])]
                    keep[k] = limits[i[k], 0] == 0 or last is None or (one is not None and one <= last)
                i, j = i[keep], j[keep]
                yield pa.RecordBatch.from_arrays([pa.array(np.array(sent.items, np.int64)[i]), ids.take(pa.array(j)), prints.take(pa.array(j))],
                                                 names=["q", "id", "print"])
    return run, f"q bigint, id {kind}, print binary"


def _scored(sent: _Items, wanted: DataFrame, docs: DataFrame, kind: str, small: bool) -> DataFrame:
    """(q, id, score) of the wanted (id, items) documents, from their whole texts."""
    def run(batches):
        place = {q: i for i, q in enumerate(sent.items)}
        for batch in batches:
            q, ids, score, at = [], [], [], []
            for r, (raw, items) in enumerate(zip(common.raw_texts(batch.column("text")), batch.column("items").to_pylist())):
                for item, s in sent.scores(raw, items, place):
                    q.append(item)
                    at.append(r)
                    score.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), batch.column("id").take(pa.array(at, pa.int64())),
                                              pa.array(score, pa.int64())], names=["q", "id", "score"])

    on = wanted.withColumnRenamed("id", "wanted")
    met = docs.join(F.broadcast(on) if small else on, F.col("id").eqNullSafe(F.col("wanted")))
    return met.select("id", "text", "items").mapInArrow(run, f"q bigint, id {kind}, score bigint")


def first(rows: DataFrame, many: int, *order) -> DataFrame:
    """The first ``many`` rows of each item and their ``rank``."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*order))).filter(F.col("rank") <= many)


def search(index: DataFrame, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", top: int = TOP, probes: int = PROBES,
           block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``top`` documents of each item: (item, ``rank``, id, ``score``)."""
    common.prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    blocks = index.filter("ids is not null").select("ids", "lengths", "tops", "prints", "width", "slices")
    size = blocks.select(F.explode("lengths").alias("n")).agg(F.count("*").alias("docs"), F.sum("n").alias("words")).first()
    words = F.regexp_extract_all(F.translate(F.col(item_text_col), UPPER, LOWER), F.lit(WORD), F.lit(0))
    asked = common.written(items.select(F.col(item_col).alias("item"), words.alias("words"))
                           .withColumn("q", F.monotonically_increasing_id()), "items")
    pairs = asked.select("q", F.explode("words").alias("term")).groupBy("q", "term").agg(F.count("*").alias("times"))
    # the counts of the items' terms only
    df = (index.filter("term is not null").select("term", "df").join(pairs.select("term").distinct(), "term")
          .groupBy("term").agg(F.sum("df").alias("df")))
    pairs = common.written(pairs.join(df, "term"), "item-terms")
    parts = max(1, -(-pairs.count() // block_terms))
    out = None
    for part in range(parts):
        mine = pairs if parts == 1 else pairs.filter(F.pmod(F.xxhash64("q"), F.lit(parts)) == part)
        rows = [(r.q, r.term, r.times, r.df) for r in mine.collect()]           # about block_terms rows
        if not rows:
            continue
        sent = _Items(rows, size.docs, size.words)
        run, schema = _probes(sent, kind, probes)
        probed = first(blocks.mapInArrow(run, schema), probes, F.desc("bound")).groupBy("id").agg(F.collect_list("q").alias("items"))
        probed = _scored(sent, common.written(probed, "probes"), texts, kind, True)
        # one row per item of the block
        behind = {r.q: (r.score, r.id) for r in first(probed, top, F.desc("score"), F.asc_nulls_last("id"))
                  .filter(F.col("rank") == top).collect()}
        run, schema = _candidates(sent, kind, behind)
        # of equal texts the first ids only
        alike = Window.partitionBy("q", "print").orderBy(F.asc_nulls_last("id"))
        near = (blocks.mapInArrow(run, schema).withColumn("nth", F.row_number().over(alike)).filter(F.col("nth") <= top)
                .groupBy("id").agg(F.collect_set("q").alias("items")))
        near = common.written(near, "candidates")
        scored = first(_scored(sent, near, texts, kind, near.count() <= SENT_ROWS), top, F.desc("score"), F.asc_nulls_last("id"))
        out = scored if out is None else out.unionByName(scored)
    if out is None:
        return asked.select(F.col("item").alias(item_col), F.lit(0).alias("rank"), F.lit(None).cast(kind).alias(id_col),
                            F.lit(0).cast("long").alias("score")).limit(0)
    return out.join(asked.select("q", "item"), "q").select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
