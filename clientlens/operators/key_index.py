"""A Bloom index of the keys in each period of a partitioned fact (Q13, K5).

A refresh must find the periods that hold rows which its batch replaces, also
where a key has moved to another day. Instead of the fact's whole key column it
reads this index: ``BITS_PER_KEY`` bits a key.

Per period the keys are dealt by hash to a power of two of segments (about
``SEGMENT_KEYS`` keys each, chosen by the period's number of keys); a segment is a
Bloom filter of ``SEGMENT_BITS`` bits, held as 64-bit words and built with
``bit_or``. A batch key meets the segment of its hash in every period that the
batch does not rewrite anyway, by an equi-join on (segments, segment) with the bit
test as its condition: only hits leave the join. Hits are checked against the
key column of the periods they name, so a false one (about one in a million per
key and period) costs a read and changes nothing.

The index of a period is rebuilt from the period's rows whenever it changes. It
follows the notes of ``changes``: a stop between the fact's swap and the index
leaves the note, and the next refresh rebuilds those periods first, so a key is
never missing from the index while a batch is matched.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientlens.functions.joins import by_merge
from clientlens.operators import changes
from clientlens.operators.changes import in_periods, outside_periods
from clientlens.sources import readers, sinks

BITS_PER_KEY, HASHES = 32, 12
SEGMENT_BITS = 1 << 15
SEGMENT_KEYS = SEGMENT_BITS // BITS_PER_KEY
WORDS = SEGMENT_BITS // 64


def _segment(key: str, segments: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("segment"), F.col(key)), segments).cast("int")


def _positions(key: str) -> Column:
    """The bits of a key in its segment: four 15-bit slices of each hash."""
    out = []
    for i in range(HASHES):
        h = F.xxhash64(F.lit(i // 4), F.col(key))
        out.append(F.shiftrightunsigned(h, 16 * (i % 4)).bitwiseAND(SEGMENT_BITS - 1).cast("int"))
    return F.array(*out)


def build(rows: DataFrame, key: str, part: str) -> DataFrame:
    """(``part``, segments, segment, words) of the keys in ``rows``."""
    sizes = rows.groupBy(part).agg(F.count(F.lit(1)).alias("n")).select(
        F.col(part).alias("p"), F.greatest(F.lit(1), F.expr(
            f"cast(pow(2, ceil(log2(greatest(n, 1) / {SEGMENT_KEYS}))) as int)")).alias("segments"))
    keys = rows.select(part, key).join(sizes, F.col(part).eqNullSafe(F.col("p"))).select(
        part, "segments", _segment(key, F.col("segments")).alias("segment"), F.explode(_positions(key)).alias("at"))
    one = F.expr("shiftleft(1L, at & 63)")
    words = keys.groupBy(part, "segments", "segment", F.shiftright("at", 6).alias("word")).agg(F.bit_or(one).alias("bits"))
    # at most WORDS entries a segment; words without a bit are added as zeros
    held = words.groupBy(part, "segments", "segment").agg(F.collect_list(F.struct("word", "bits")).alias("held"))
    free = F.array_except(F.sequence(F.lit(0), F.lit(WORDS - 1)), F.transform("held", lambda x: x["word"]))
    every = F.concat("held", F.transform(free, lambda i: F.struct(i.alias("word"), F.lit(0).cast("long").alias("bits"))))
    return held.select("segments", "segment", F.transform(F.sort_array(every), lambda x: x["bits"]).alias("words"), part)


def _table(path: str) -> str:
    return os.path.join(path, "segments")


def read(spark: SparkSession, path: str, part: str) -> DataFrame:
    return spark.read.schema(f"segments int, segment int, words array<bigint>, {part} date").parquet(_table(path))


def follow(spark: SparkSession, target: DataFrame, path: str, key: str, part: str) -> None:
    """Bring the index up to the table: all of it if there is none, else the
    periods whose change was announced."""
    folders, periods = changes.pending(spark, path)
    if not readers.table_exists(spark, _table(path)):
        sinks.write_table(build(target, key, part), _table(path), [part])
    elif periods:
        # a period without rows is overwritten by an empty segment
        none = spark.createDataFrame([(p,) for p in periods], f"{part} date").select(
            F.lit(1).alias("segments"), F.lit(0).alias("segment"), F.array_repeat(F.lit(0).cast("long"), WORDS).alias("words"), part)
        own = build(target.filter(in_periods(part, periods)), key, part)
        held = own.select(F.col(part).alias("p")).distinct()
        sinks.write_partitions(own.unionByName(none.join(held, F.col(part).eqNullSafe(F.col("p")), "left_anti")), _table(path), [part])
    changes.forget(spark, folders)


def probe(index: DataFrame, batch: DataFrame, key: str, part: str) -> DataFrame:
    """(key, ``part``) pairs that may be in the table; none that is there is missing."""
    kinds = [r[0] for r in index.select("segments").distinct().collect()]             # powers of two
    keys = batch.select(key).distinct().select(F.col(key).alias("probed"), _positions(key).alias("at"), F.explode(F.array(*[
        F.struct(F.lit(s).alias("segments"), _segment(key, F.lit(s)).alias("segment")) for s in kinds] or [
        F.lit(None).cast("struct<segments:int,segment:int>")])).alias("s"))
    every = F.forall("at", lambda b: F.getbit(F.element_at("words", F.shiftright(b, 6) + 1), b.bitwiseAND(63)) == 1)
    return index.join(by_merge(keys), (F.col("segments") == F.col("s.segments")) & (F.col("segment") == F.col("s.segment")) & every).select(
        F.col("probed").alias(key), part)


def touched(target: DataFrame, index: DataFrame, batch: DataFrame, key: str, part: str) -> list:
    """Periods whose content a batch changes: its own, and those that hold rows
    with a key of the batch."""
    own = [r[0] for r in batch.select(part).distinct().collect()]                       # one per period
    hits = probe(index.filter(outside_periods(part, own)), batch, key, part).checkpoint()
    named = [r[0] for r in hits.select(part).distinct().collect()]
    if not named:
        return changes.ordered(own)
    # exact: the key column of the named periods only
    held = (target.filter(in_periods(part, named)).select(F.col(key).alias("k"), F.col(part).alias("p"))
            .join(by_merge(hits), (F.col("k") == F.col(key)) & F.col("p").eqNullSafe(F.col(part)), "left_semi"))
    return changes.ordered([*own, *[r[0] for r in held.select("p").distinct().collect()]])
