"""Operator 5: quality rules on repetition coverage.

Per text: words, their code points, special symbols, repeated lines, and the
characters of words that lie inside duplicated n-grams of several lengths
(rolling hashes over a block of texts in numpy) or inside repeated lines. A
text is kept if it passes the base rules, every coverage is within its limit
(wider ones for texts of fewer than ``SHORT_WORDS`` words) and symbols are few. Rows are judged in place, batch by batch: nothing is shuffled and no
task holds more than a batch.

Words are separated by blanks and the characters 9 to 13. Windows never cross
texts. An n-gram is duplicated if its words occur twice or more in the text,
the first time included; a line is duplicated if it has a word and equals an
earlier line of the text.

Edge cases: a null or empty text has no words and fails the base rules; texts
of any length are judged whole; the result is one struct column under a free
name, so other columns may have any names; repeated rows are judged alike; an
empty table stays empty.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientlens.llm import common

BASE_N, MIN_WORDS, MAX_REPEAT_PCT = 5, 10, 20
# Most characters, in percent of all word characters, inside duplicated n-grams
# of n words and inside repeated lines: the published limits of web-corpus filters.
COVERAGE_PCT = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
LINE_CHARS_PCT = 20
# A text of fewer words than this that states one sentence twice is beyond them:
# it has wider limits.
SHORT_WORDS = 100
SHORT_COVERAGE_PCT = {5: 25, 6: 24, 7: 23, 8: 23, 9: 22, 10: 20}
SHORT_LINE_CHARS_PCT = 25
SYMBOLS_PCT = 30             # most special symbols, in percent of the words
_SYMBOLS = re.compile(rb"[#*$%&|<>]")

FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars",
          *[f"dup_{n}gram_chars" for n in COVERAGE_PCT]]
RESULT = ", ".join(f"{f} bigint" for f in FIELDS)


def repeated(hashes: np.ndarray, doc: np.ndarray, left: np.ndarray, n: int) -> np.ndarray:
    """For every word: does it lie in a window of ``n`` words that its text
    holds twice? ``left``: words from here to the end of the text."""
    inside = np.zeros(len(hashes) + 1, np.int64)
    at = np.flatnonzero(left >= n)
    if len(at):
        key = common.mix64(common.rolling(hashes, n)[at] + doc[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        order = np.argsort(key)
        same = np.zeros(len(at) + 1, bool)
        same[1:-1] = key[order[1:]] == key[order[:-1]]
        twice = at[order[same[1:] | same[:-1]]]
        np.add.at(inside, twice, 1)
        np.add.at(inside, twice + n, -1)
    return np.cumsum(inside[:-1]) > 0


def measure(raws: list[bytes | None]) -> dict[str, np.ndarray]:
    """The figures of FIELDS for a block of texts."""
    out = {f: np.zeros(len(raws), np.int64) for f in FIELDS}
    words, counts = [], []
    for i, raw in enumerate(raws):
        own = raw.split() if raw else []             # bytes: exactly blanks and the characters 9 to 13
        counts.append(len(own))
        words += own
        if own:
            out["n_symbols"][i] = len(_SYMBOLS.findall(raw))
            seen = set()
            for line in raw.split(b"\n"):
                if line in seen:
                    out["n_dup_lines"][i] += 1
                    out["dup_line_chars"][i] += sum(len(w.decode(errors="replace")) for w in line.split())
                elif line.strip():
                    seen.add(line)
    counts = np.array(counts, np.int64)
    out["n_words"] = counts
    if not words:
        return out
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    doc = np.repeat(np.arange(len(raws)), counts)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(words))
    # code points of a word: its bytes without continuation bytes
    joined = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    points = np.concatenate([[0], np.cumsum((joined & 0xC0) != 0x80)])
    chars = np.diff(points[np.concatenate([[0], ends])])
    total = lambda x: np.bincount(doc, weights=x, minlength=len(raws)).astype(np.int64)
    out["word_chars"] = total(chars)
    for n in sorted({BASE_N, *COVERAGE_PCT}):
        inside = repeated(hashes, doc, left, n)
        if n == BASE_N:
            out["n_repeat_words"] = total(inside)
        if n in COVERAGE_PCT:
            out[f"dup_{n}gram_chars"] = total(chars * inside)
        if not inside.any() and n >= BASE_N:
            break                                    # longer windows repeat only where these do
    return out


def _figures(texts: pa.Array) -> pa.Array:
    raws = common.raw_texts(texts)
    parts = [measure(raws[a:b]) for a, b in common.blocks(raws)]
    return pa.StructArray.from_arrays(
        [pa.array(np.concatenate([p[f] for p in parts]) if parts else np.empty(0, np.int64)) for f in FIELDS], names=FIELDS)


def judge(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct column (its name is returned too): the figures of
    FIELDS, ``base_failed``, ``failed`` (the limits that the text breaks) and
    ``kept``."""
    common.prepare(docs.sparkSession)
    figures, verdict = common.free_name(docs, "figures", "quality")
    f = lambda name: F.col(figures)[name]
    base = (f("n_words") < MIN_WORDS) | (100 * f("n_repeat_words") > MAX_REPEAT_PCT * f("n_words"))
    limits = {f"dup_{n}gram_chars": (pct, SHORT_COVERAGE_PCT[n]) for n, pct in COVERAGE_PCT.items()}
    limits["dup_line_chars"] = (LINE_CHARS_PCT, SHORT_LINE_CHARS_PCT)
    most = lambda pct, short: F.when(f("n_words") < SHORT_WORDS, short).otherwise(pct)
    broken = F.array_compact(F.array(*[F.when(100 * f(k) > most(*pcts) * f("word_chars"), F.lit(k)) for k, pcts in limits.items()],
                                     F.when(100 * f("n_symbols") > SYMBOLS_PCT * f("n_words"), F.lit("n_symbols"))))
    measured = docs.withColumn(figures, F.arrow_udf(_figures, RESULT).asNondeterministic()(F.col(text_col)))
    return measured.withColumn(verdict, F.struct(
        *[f(k).alias(k) for k in FIELDS], base.alias("base_failed"), broken.alias("failed"),
        (~base & (F.size(broken) == 0)).alias("kept"))).drop(figures), verdict


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows whose texts pass all rules, columns as given."""
    judged, verdict = judge(docs, text_col)
    return judged.filter(F.col(verdict)["kept"]).drop(verdict)
