"""String neighbourhoods used to find near-equal strings without comparing all pairs.

If ``levenshtein(a, b) <= k`` then a and b share at least one string obtained
by deleting at most ``k`` characters from each (the deletion neighbourhood).
Joining on neighbourhood keys therefore finds every pair within distance k;
the exact distance is checked afterwards with the built-in ``levenshtein``.
All expressions here are higher-order built-ins evaluated in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def explode_deletion_keys_1(df, src: str, out: str):
    """Rows of ``df`` repeated once per distinct member of ``src``'s
    one-deletion neighbourhood (``src`` itself included), in column ``out``.

    Deleting any character of a run of equal characters gives the same
    string, so one deletion per run is emitted: exactly the distinct keys,
    generated with a codegen'd explode + substring instead of array lambdas.
    """
    s = F.col(src)
    n = F.length(s)
    pos = F.explode(F.sequence(F.lit(-1), F.greatest(n - 1, F.lit(-1)))).alias("_dpos")
    p = F.col("_dpos")
    key = F.when(p < 0, s).otherwise(F.concat(s.substr(F.lit(1), p), s.substr(p + 2, n)))
    run_start = (p <= 0) | (s.substr(p + 1, F.lit(1)) != s.substr(p, F.lit(1)))
    return (df.select("*", pos).filter(run_start)
              .withColumn(out, key).drop("_dpos"))


def _cuts(length: Column, k: int) -> list[tuple[Column, Column]]:
    """(start from 0, length) of the k + 1 even segments of a string of that length."""
    parts = k + 1
    short, longer = F.floor(length / parts).cast("int"), (length % parts).cast("int")
    out, start = [], F.lit(0)
    for i in range(parts):
        size = short + F.when(longer > i, 1).otherwise(0)
        out.append((start, size))
        start = start + size
    return out


def segments(s: Column, k: int) -> Column:
    """array: the string's ``k + 1`` even segments as keys of its length, the
    segment number and the segment."""
    n = F.length(s)
    return F.array(*[F.concat_ws(":", n.cast("string"), F.lit(str(i)), s.substr(start + 1, size))
                     for i, (start, size) in enumerate(_cuts(n, k))])


def probe_segments(s: Column, k: int) -> Column:
    """array: keys under which every string not longer than ``s`` within edit
    distance ``k`` has a segment that occurs in ``s``.

    Of the k + 1 segments of the shorter string one is untouched with at most i
    edits before it and at most k - i after it (i: its number from 0; otherwise the
    edits before each segment would add up to more than k). So it is moved by at
    most i places counted from the front, and by at most k - i from the back: with
    a length difference d its shift is in [-i, i] and in [d - (k - i), d + (k - i)].
    That leaves 12 keys for distance 2, instead of 45 for all shifts up to k."""
    n, keys = F.length(s), []
    for less in range(k + 1):
        m = n - less
        for i, (start, size) in enumerate(_cuts(m, k)):
            for shift in range(max(-i, less - (k - i)), min(i, less + (k - i)) + 1):
                at = start + shift
                keys.append(F.when((m >= 0) & (at >= 0) & (at + size <= n),
                                   F.concat_ws(":", m.cast("string"), F.lit(str(i)), s.substr(at + 1, size))))
    return F.array_distinct(F.array_compact(F.array(*keys)))
