"""Operator 1: benchmark decontamination.

The benchmark items become windows of ``n`` words (an item of fewer words is
one window). The distinct (window, item) pairs are sent to the tasks in blocks
of at most ``BLOCK_PAIRS``: one block for usual benchmarks; for a larger set
the documents are written once and scanned once per block, and each block gives a
slim table of the rows it hits, so what a task holds is bounded whatever the
benchmark's size. A scan numbers the words of a batch by the block's
vocabulary, skips windows with a word outside of it, looks up rolling hashes
of the others in the sorted hashes of the block, and verifies each hit by the
window's exact words. With one block documents are not shuffled.

Edge cases: null or wordless texts have no words and no hits; wordless or null
items have no window; hits of an item without an id count, but it is not
listed; repeated items and rows give repeated results; an empty benchmark or
table leaves everything clean; other columns pass through, the result is one
struct column under a free name.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientlens.llm import common

WINDOW = 10
BLOCK_PAIRS = 200_000        # (window, item) pairs broadcast at a time
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"        # after A-Z are lower-cased
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")       # the same words in UTF-8 bytes

RESULT = ("n_words bigint, spans array<struct<first:bigint,last:bigint>>, items array<string>")


def words_of(raw: bytes | None) -> list[bytes]:
    return _WORDS.findall(raw.lower()) if raw else []


def item_windows(benchmark: DataFrame, item_col: str, text_col: str, n: int) -> DataFrame:
    """Distinct (gram, item): windows as words joined by blanks."""
    words = F.regexp_extract_all(F.translate(F.col(text_col), UPPER, LOWER), F.lit(WORD), F.lit(0))
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), words.alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - n + 1, F.lit(1)))
    return (items.select("item", "w", F.explode(starts).alias("at"))
            .select(F.concat_ws(" ", F.slice("w", F.col("at"), F.lit(n))).alias("gram"), "item").distinct())


class Grams:
    """One block of windows, ready for scanning."""

    def __init__(self, pairs: list[tuple[str, str | None]]):
        self.vocabulary: dict[bytes, int] = {}
        self.items: dict[bytes, list[str]] = {}
        lengths: dict[int, list[np.ndarray]] = {}
        for gram, item in pairs:
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
                            for w in gram.encode().split(b" ")], np.int64)
            key = ids.tobytes()
            if key not in self.items:
                lengths.setdefault(len(ids), []).append(ids)
            self.items.setdefault(key, []).extend([] if item is None else [item])
        self.hashes = {k: np.unique(self._hash(np.array(v).T)) for k, v in lengths.items()}

    @staticmethod
    def _hash(columns) -> np.ndarray:
        out = np.zeros(len(columns[0]), np.uint64)
        for c in columns:
            out = common.mix64(out * np.uint64(31) + c.astype(np.uint64))
        return out

    def scan(self, raws: list[bytes | None]):
        """Per text: (words, merged hit spans as [first, last] word numbers, items)."""
        words, begins = [], []
        for raw in raws:
            begins.append(len(words))
            words += words_of(raw)
            words.append(b"")                        # between texts: in no window
        get = self.vocabulary.get
        ids = np.fromiter([get(w, 0) for w in words], np.int64, len(words))
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        begins = np.array(begins + [len(words)])
        spans: list[list[list[int]]] = [[] for _ in raws]
        items: list[set[str]] = [set() for _ in raws]
        for k, hashes in self.hashes.items():
            at = np.flatnonzero(known[k:] - known[:-k] == k)
            if len(at):
                at = at[np.isin(self._hash([ids[at + j] for j in range(k)]), hashes)]
            for i, doc in zip(at.tolist(), (np.searchsorted(begins, at, side="right") - 1).tolist()):
                found = self.items.get(ids[i:i + k].tobytes())
                if found is not None:
                    items[doc].update(found)
                    spans[doc].append([i - int(begins[doc]), i - int(begins[doc]) + k - 1])
        counts = (np.diff(begins) - 1).tolist()
        return counts, [merged(s) for s in spans], [sorted(x) for x in items]


def merged(spans: list[list[int]]) -> list[list[int]]:
    """Overlapping or touching [first, last] spans joined, in order."""
    out: list[list[int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return out


def _scanner(grams: Grams, text: str):
    """The scan of one block as a column."""
    sent = None if not grams.items else grams

    @F.arrow_udf(RESULT)
    def scan(texts: pa.Array) -> pa.Array:
        raws, n, spans, items = common.raw_texts(texts), [], [], []
        for a, b in common.blocks(raws):
            part = sent.scan(raws[a:b]) if sent else ([len(words_of(r)) for r in raws[a:b]], [[]] * (b - a), [[]] * (b - a))
            for whole, piece in zip((n, spans, items), part):
                whole += piece
        return _results(n, spans, items)

    return scan.asNondeterministic()(F.col(text))


def _results(n: list, spans: list, items: list) -> pa.Array:
    span = pa.struct([("first", pa.int64()), ("last", pa.int64())])
    return pa.StructArray.from_arrays(
        [pa.array(n, pa.int64()), pa.array([[{"first": a, "last": b} for a, b in s] for s in spans], pa.list_(span)),
         pa.array(items, pa.list_(pa.string()))], names=["n_words", "spans", "items"])


def _with_more(hits: str, more: str):
    """Results with the spans and items of further blocks (null without any), as a column."""
    @F.arrow_udf(RESULT)
    def merge(found: pa.Array, more: pa.Array) -> pa.Array:
        n, spans, items = [], [], []
        for one, other in zip(found.to_pylist(), more.to_pylist()):
            every = one["spans"] + (other["spans"] if other else [])
            n.append(one["n_words"])
            spans.append(merged([[x["first"], x["last"]] for x in every]))
            items.append(sorted({*one["items"], *(other["items"] if other else [])}))
        return _results(n, spans, items)

    return F.when(F.col(more).isNull(), F.col(hits)).otherwise(merge(F.col(hits), F.col(more)))


def find(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", n: int = WINDOW, block_pairs: int = BLOCK_PAIRS) -> tuple[DataFrame, str]:
    """``docs`` with a struct column (its name is returned too): ``n_words``,
    ``spans`` of hit words (first and last word number), ``items``."""
    spark = docs.sparkSession
    common.prepare(spark)
    (hits,) = common.free_name(docs, "hits")
    grams = common.written(item_windows(benchmark, item_col, item_text_col, n), "grams")
    total = grams.count()
    parts = max(1, -(-total // block_pairs))

    def scanned(rows: DataFrame, i: int) -> DataFrame:
        block = grams if parts == 1 else grams.filter(F.pmod(F.xxhash64("gram", "item"), F.lit(parts)) == i)
        pairs = [(r.gram, r.item) for r in block.collect()]         # about block_pairs rows
        return rows.withColumn(hits, _scanner(Grams(pairs), text_col))

    if parts == 1:
        return scanned(docs, 0), hits
    # the documents are written once, with the first block's result; each further
    # block gives a slim table of the rows that it hits
    row, more = common.free_name(docs.withColumn(hits, F.lit(0)), "row", "more")
    base = common.written(scanned(docs.withColumn(row, F.monotonically_increasing_id()), 0), "scanned")
    slim = None
    for i in range(1, parts):
        h = F.col(hits)
        part = common.written(scanned(base.select(row, text_col), i).filter(F.size(h["spans"]) > 0)
                              .select(row, h["spans"].alias("spans"), h["items"].alias("items")), "block-hits")
        slim = part if slim is None else slim.unionByName(part)
    # a row has an entry per block that hits it
    every = slim.groupBy(row).agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    joined = base.join(every.select(row, F.struct("spans", "items").alias(more)), row, "left")
    return joined.withColumn(hits, _with_more(hits, more)).select(*docs.columns, hits), hits


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", remove: str = "document",
                  **options) -> DataFrame:
    """``docs`` without contaminated rows (``remove="document"``), or with the
    hit words cut out of their texts (``remove="span"``, from the first to the
    last character of each span)."""
    found, hits = find(docs, benchmark, text_col, **options)
    if remove == "document":
        return found.filter(F.size(F.col(hits)["spans"]) == 0).drop(hits)
    if remove != "span":
        raise ValueError(f"remove must be 'document' or 'span', not {remove!r}")

    @F.arrow_udf("string")
    def cut(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for raw, spans in zip(common.raw_texts(texts), found.to_pylist()):
            if raw is not None and spans:
                at = [m.span() for m in _WORDS.finditer(raw.lower())]
                for s in reversed(spans):
                    raw = raw[:at[s["first"]][0]] + raw[at[s["last"]][1]:]
            out.append(None if raw is None else raw.decode())
        return pa.array(out, pa.string())

    text = F.col(text_col)
    return found.withColumn(text_col, F.when(F.size(F.col(hits)["spans"]) > 0, cut(text, F.col(hits)["spans"]))
                            .otherwise(text)).drop(hits)
