"""Operator 3: language identification by nearest centroid.

A text becomes the L2-normalised TF-IDF vector of its hashed letter n-grams
(one to three letters, words kept apart). Each language has several centroids,
found by spherical k-means; a text has the language of the centroid with the
largest cosine. It is rejected when even that cosine is below the centroid's own
limit, a fraction of what its training texts reach, or when too many of its
three-letter n-grams are unseen in the language's sample. The cosine alone fails
with length, since collisions give any long text one; the share of unseen n-grams
has the same mean at every length. Its limit is what nearly all training texts
keep to when each is counted without itself, plus an allowance for chance that
falls with the root of the number of n-grams.

Fit: document frequencies are counted over all training rows (partial sums per
task, then one small aggregation). The centroids are fitted on at most
``SAMPLE_PER_LANG`` rows per language, those with the smallest hashes; each
language is one task over that bounded sample. The model is a few centroids per
language and is sent to the tasks of the prediction, which is one pass without
a shuffle.

Edge cases: a null text or one without a letter is ``und`` with score 0 and
rejected; without any training row every text is ``und``; equal cosines go to
the first language in alphabetical order; repeated rows get equal results; the
result is one struct column under a free name; an empty table stays empty; a
very long text is counted whole, part by part.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientlens.llm import common

DIMS_LOG2, MAX_N, CENTROIDS, SAMPLE_PER_LANG, ROUNDS, SEED = 12, 3, 4, 2000, 12, 3
REJECT_QUANTILE, REJECT_FRACTION = 0.01, 0.3
SEEN_LOG2, UNSEEN_QUANTILE, CHANCE, MARGIN = 20, 0.99, 1.5, 0.05
UNKNOWN = "und"
RESULT = "lang string, score double, rejected boolean, letters boolean"
_DIMS = 1 << DIMS_LOG2
_BLOCK = 256                  # texts whose dense vectors a task holds at a time
BLOCK_CHARS = 1 << 20         # characters whose symbols a task holds at a time
_BLANK, _BETWEEN = re.compile(r"\s"), re.compile(r"[\W\d_]")

_letter: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letter:
        _letter.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letter[0]


def letters_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters and separators (one after each word) of all texts: the text's
    number, the code point (a blank for a separator) and whether it is a letter."""
    points = []
    for t in texts:
        points.append(np.frombuffer((" " + t.lower() + " ").encode("utf-32-le", "replace"), np.uint32) if t else
                      np.full(1, 32, np.uint32))
    doc = np.repeat(np.arange(len(texts)), [len(p) for p in points])
    p = np.concatenate(points) if points else np.empty(0, np.uint32)
    letter = _is_letter()[p]
    keep = letter | np.concatenate([[True], letter[:-1]])          # one separator after each word
    keep[1:] |= doc[1:] != doc[:-1]
    return doc[keep], np.where(letter, p, 32)[keep].astype(np.uint64), letter[keep]


def symbol_blocks(texts: list[str | None]):
    """(text number, code point, is it a letter, is it new) of the symbols of
    ``letters_of``, in blocks of about ``BLOCK_CHARS`` characters. A longer text
    comes in several blocks, cut between words: the last symbols of one block open
    the next, not new, so that an n-gram across a cut is counted once."""
    def block(group):
        doc, p, letter = letters_of([texts[i] for i in group])
        return np.array(group)[doc], p, letter, np.ones(len(p), bool)

    group, size = [], 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if group and size + n > BLOCK_CHARS:
            yield block(group)
            group, size = [], 0
        if n <= BLOCK_CHARS:
            group.append(i)
            size += n
            continue
        at, tail, tail_letter = 0, np.empty(0, np.uint64), np.empty(0, bool)
        while at < n:
            cut = _BLANK.search(t, at + BLOCK_CHARS, at + 2 * BLOCK_CHARS) or _BETWEEN.search(t, at + BLOCK_CHARS)
            end = cut.start() if cut else n
            _, p, letter = letters_of([t[at:end]])
            if at:                                   # the separator before the text's first word
                p, letter = p[1:], letter[1:]
            new = np.append(np.zeros(len(tail), bool), np.ones(len(p), bool))
            p, letter = np.append(tail, p), np.append(tail_letter, letter)
            yield np.full(len(p), i), p, letter, new
            at, tail, tail_letter = end, p[1 - MAX_N:], letter[1 - MAX_N:]
    if group:
        yield block(group)


def seen_cells(texts: list[str | None]):
    """Blocks of (text number, cell) of every n-gram of ``MAX_N`` letters and separators."""
    for doc, p, _, new in symbol_blocks(texts):
        m = max(len(p) - MAX_N + 1, 0)
        gram = np.zeros(m, np.uint64)
        for n in range(MAX_N):
            gram = gram * np.uint64(0x110000) + p[n:n + m]
        ok = (doc[:m] == doc[len(doc) - m:]) & new[len(doc) - m:]
        yield doc[:m][ok], (common.mix64(gram[ok]) >> np.uint64(64 - SEEN_LOG2)).astype(np.int64)


def cell_counts(texts: list[str | None]) -> list[np.ndarray]:
    """Per text its cells, and their counts in a second row."""
    out = [np.empty((2, 0), np.int64) for _ in texts]
    for doc, cells in seen_cells(texts):
        ids, begins = np.unique(doc, return_index=True)          # the texts follow each other
        for i, a, b in zip(ids.tolist(), begins.tolist(), [*begins.tolist()[1:], len(doc)]):
            c, k = np.unique(cells[a:b], return_counts=True)
            if out[i].shape[1]:
                both = np.append(out[i], [c, k], axis=1)
                c, at = np.unique(both[0], return_inverse=True)
                k = np.bincount(at, weights=both[1]).astype(np.int64)
            out[i] = np.array([c, k])
    return out


def allowance(n: np.ndarray) -> np.ndarray:
    return CHANCE / np.sqrt(np.maximum(n, 1))


def unseen_limit(own: list[np.ndarray]) -> tuple[np.ndarray, float]:
    """Which cells the training texts (each one's cells, and their counts in a
    second row) have, and the share of
    unseen n-grams, without the allowance, above which a text is rejected. Each
    text is counted against the others: only cells of its own are unseen."""
    df = np.zeros(1 << SEEN_LOG2, np.int64)
    for c, _ in own:
        df[c] += 1
    n = np.array([k.sum() for _, k in own])
    share = np.array([k[df[c] == 1].sum() for c, k in own]) / np.maximum(n, 1)
    return df > 0, max(float(np.quantile(share - allowance(n), UNSEEN_QUANTILE)), 0.0) + MARGIN


def counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-gram counts (texts x dimensions) and which texts have a letter."""
    has = np.zeros(len(texts), bool)
    out = np.zeros(len(texts) * _DIMS, np.float32)
    for doc, p, letter, new in symbol_blocks(texts):
        has |= np.bincount(doc[letter], minlength=len(texts)) > 0
        gram = np.zeros(len(p), np.uint64)
        for n in range(1, MAX_N + 1):
            m = len(p) - n + 1
            if m <= 0:
                break
            gram = gram[:m] * np.uint64(0x110000) + p[n - 1:]
            ok = (doc[:m] == doc[n - 1:]) & new[n - 1:]
            if n == 1:
                ok &= letter
            h = (gram[ok] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - DIMS_LOG2)
            out += np.bincount(doc[:m][ok] * _DIMS + h.astype(np.int64), minlength=len(out)).astype(np.float32)
    return out.reshape(len(texts), _DIMS), has


def vectors(texts: list[str | None], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    tf, has = counts(texts)
    v = np.log1p(tf) * idf
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    return v.astype(np.float32), has


def cluster(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: unit centroids and, for each, the cosine limit under
    which a text is rejected. The first centre is the mean direction, further
    ones are drawn with weights that grow with the distance to those so far."""
    rng = np.random.default_rng(SEED)
    centres = [v.mean(axis=0) / max(float(np.linalg.norm(v.mean(axis=0))), 1e-12)]
    for _ in range(1, min(k, len(v))):
        far = np.clip(1 - np.max(v @ np.array(centres).T, axis=1), 0, None) ** 2
        if far.sum() <= 0:
            break
        centres.append(v[rng.choice(len(v), p=far / far.sum())])
    c = np.array(centres)
    for _ in range(ROUNDS):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        near = np.argmax(v @ c.T, axis=1)
        c = np.array([v[near == i].sum(axis=0) if (near == i).any() else c[i] for i in range(len(c))])
    c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    cos = v @ c.T
    near, best = np.argmax(cos, axis=1), cos.max(axis=1)
    limits = [np.quantile(best[near == i], REJECT_QUANTILE) * REJECT_FRACTION if (near == i).any() else 0.0
              for i in range(len(c))]
    return c.astype(np.float32), np.array(limits)


@dataclass
class Model:
    idf: np.ndarray
    langs: list[str]             # of each centroid
    centroids: np.ndarray
    limits: np.ndarray
    seen: dict[str, tuple[bytes, float]]    # of each language: packed cells, limit of the unseen share

    def unseen(self, texts: list[str | None], langs: list[str]) -> np.ndarray:
        """Is the share of n-grams that the text's language has not seen too large?"""
        n, new, limit = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), np.ones(len(texts))
        owners = {lang: np.array([x == lang for x in langs]) for lang in set(langs)}
        for lang, mine in owners.items():
            limit[mine] = self.seen[lang][1]
        for doc, cells in seen_cells(texts):
            n += np.bincount(doc, minlength=len(texts))
            for lang, mine in owners.items():
                at = mine[doc]
                bits, c = np.frombuffer(self.seen[lang][0], np.uint8), cells[at]
                known = bits[c >> 3] >> (7 - (c & 7)).astype(np.uint8) & 1
                new += np.bincount(doc[at][known == 0], minlength=len(texts))
        return new > (limit + allowance(n)) * n

    def predict(self, texts: list[str | None]):
        if not self.langs:
            return [(UNKNOWN, 0.0, True, bool(h)) for h in counts(texts)[1]]
        v, has = vectors(texts, self.idf)
        cos = v @ self.centroids.T
        best = np.argmax(cos, axis=1)
        top = np.clip(cos[np.arange(len(texts)), best], 0, 1).astype(float)
        strange = self.unseen(texts, [self.langs[b] for b in best])
        return [(self.langs[b], s, bool(s < self.limits[b] or u), True) if h else (UNKNOWN, 0.0, True, False)
                for b, s, h, u in zip(best.tolist(), top.tolist(), has.tolist(), strange.tolist())]


def fit(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", centroids: int = CENTROIDS,
        sample_per_lang: int = SAMPLE_PER_LANG) -> Model:
    """The model of the labelled ``rows`` (null texts and labels are left out)."""
    spark = rows.sparkSession
    common.prepare(spark)
    rows = rows.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("text is not null and lang is not null")

    def frequencies(batches):
        df, n = np.zeros(_DIMS, np.int64), 0
        for b in batches:
            texts = b.column("text").to_pylist()
            for i in range(0, len(texts), _BLOCK):
                c, has = counts(texts[i:i + _BLOCK])
                df += (c > 0).sum(axis=0)
                n += int(has.sum())
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], names=["dim", "n"])

    by_dim = dict(rows.select("text").mapInArrow(frequencies, "dim bigint, n bigint")
                  .groupBy("dim").agg(F.sum("n").alias("n")).collect())      # one row per dimension at most
    total = by_dim.pop(-1, 0)
    df = np.zeros(_DIMS)
    df[list(by_dim)] = list(by_dim.values())
    idf = np.log((1 + total) / (1 + df)) + 1

    # a bounded sample: texts under a hash limit that leaves about a fifth more
    # than wanted, of which each language keeps the smallest
    key = F.xxhash64("text")
    # copies have one hash, so the share is one of the distinct hashes
    many = {r["lang"]: r["count"] for r in rows.select("lang", key.alias("key")).distinct().groupBy("lang").count().collect()}
    if not many:
        return Model(idf, [], np.empty((0, _DIMS)), np.empty(0), {})
    share = F.element_at(F.create_map(*[F.lit(x) for lang, n in many.items()
                                        for x in (lang, min(1.0, 1.2 * sample_per_lang / n + 64 / n))]), F.col("lang"))
    unit = F.pmod(key, F.lit(1 << 30)) / float(1 << 30)
    sample = (rows.withColumn("key", key).filter(unit < share).dropDuplicates(["lang", "key"])
              .withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("key")))
              .filter(F.col("nth") <= sample_per_lang))

    def cells(texts: pa.Array) -> pa.Array:
        out, t = [], texts.to_pylist()
        for i in range(0, len(t), _BLOCK):
            v, has = vectors(t[i:i + _BLOCK], idf)
            out += [{"v": x.tobytes(), "cells": c.astype(np.int32).tobytes()} if h else None
                    for x, h, c in zip(v, has, cell_counts(t[i:i + _BLOCK]))]
        return pa.array(out, pa.struct([("v", pa.binary()), ("cells", pa.binary())]))

    def centres(group):
        v = np.array([np.frombuffer(x, np.float32) for x in group.sort_values("key")["v"]])
        c, limits = cluster(v, centroids)
        seen, unseen = unseen_limit([np.frombuffer(x, np.int32).reshape(2, -1) for x in group["cells"]])
        return group.iloc[:len(c)][["lang"]].assign(
            v=[x.tobytes() for x in c], limit=limits, seen=[np.packbits(seen).tobytes()] + [None] * (len(c) - 1), unseen=unseen)

    found = (sample.select("lang", "key", F.arrow_udf(cells, "v binary, cells binary").asNondeterministic()("text").alias("x"))
             .filter("x is not null").select("lang", "key", "x.v", "x.cells").groupBy("lang")
             .applyInPandas(centres, "lang string, v binary, limit double, seen binary, unseen double")
             .collect())                                                     # a few rows per language
    found = sorted(found, key=lambda r: (r.lang, r.v))
    return Model(idf, [r.lang for r in found], np.array([np.frombuffer(r.v, np.float32) for r in found]).reshape(-1, _DIMS),
                 np.array([r.limit for r in found]), {r.lang: (bytes(r.seen), r.unseen) for r in found if r.seen is not None})


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct column (its name is returned too): ``lang``,
    ``score``, ``rejected`` and whether the text has ``letters``."""
    common.prepare(docs.sparkSession)
    (found,) = common.free_name(docs, "language")

    def predict(texts: pa.Array) -> pa.Array:
        t, out = texts.to_pylist(), []
        for i in range(0, len(t), _BLOCK):
            out += model.predict(t[i:i + _BLOCK])
        cols = list(zip(*out)) if out else [[], [], [], []]
        kinds = [pa.string(), pa.float64(), pa.bool_(), pa.bool_()]
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                          names=["lang", "score", "rejected", "letters"])

    return docs.withColumn(found, F.arrow_udf(predict, RESULT).asNondeterministic()(F.col(text_col))), found


def held_out(doc_id: F.Column) -> F.Column:
    """Rows that the fit must not see: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows whose language is not rejected, columns as given."""
    marked, found = identify(docs, model, text_col)
    return marked.filter(~F.col(found)["rejected"]).drop(found)
