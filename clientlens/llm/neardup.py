"""Operator 4: near-duplicate documents by BagMinHash.

A document is the multiset of its shingles of five words (lower-cased; a
shorter text is one shingle). Two documents are linked when the weighted
Jaccard similarity of their multisets (sum of minima over sum of maxima) is
0.8 or more; classes are the connected components of the links.

Signature (BagMinHash, Ertl 2018): every shingle owns a Poisson process over
time and weight; a document of weight w sees the points below w, each point
belongs to one of the signature's slots, and a slot keeps its earliest point.
The weight axis is cut hierarchically at powers of two, so a shingle of weight
w costs a number of processes logarithmic in w, and points are only drawn up
to the time by which all slots are filled: about ``slots * log(slots)`` points
per document whatever its length.

Jobs: (1) signatures, written with the rows; (2) texts with equal words share
one representative; (3) the representatives meet in buckets of equal bands,
each bucket having two leaders; (4) leaders and members are verified
by exact multiset overlap, streamed group by group, a leader with many members
being split over tasks; rows that miss a leader narrowly and are not in its
class are tested against the rows linked to it, as far as the triangle
inequality leaves a chance; (5) the rows of a bucket that are linked to neither
leader are compared with each other, in tiles of bounded size, unless they are
in one class already; (6) components. So every pair that shares a bucket is
decided, while a group of n copies costs about 2 n pairs: only rows that both
leaders leave over are compared all with all, inside tasks.

Each pair of similarity s shares a band with probability
1 - (1 - s^5)^32, which is 1 - 3e-6 at 0.8 and 1 - 7e-9 at 0.85.

Edge cases: a null text is in a class of its own; texts without words are
alike only if equal; rows are told apart by a row number, so repeated rows and
null or repeated ids work (of repeated rows one stays); the class id is the
smallest id in it; columns of any name pass through ``deduplicate`` untouched;
an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from clientlens.llm import common
from clientlens.llm.decontam import words_of

SHINGLE, SIMILAR = 5, 0.8
BANDS, BAND_ROWS = 32, 5
GROUP_ROWS = 256             # members that one task verifies against a copy of their leader
TILE_ROWS, TILE_SHINGLES = 512, 1 << 20     # about as many rows and shingles has a side of a tile

_GOLD, _SILVER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def shingles(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash, weight) of every distinct shingle of every
    text, in order of the text number; wordless texts have none."""
    words, counts = [], []
    for raw in raws:
        own = words_of(raw.decode(errors="replace").lower().encode())
        words += own
        counts.append(len(own))
    counts = np.array(counts, np.int64)
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    doc = np.repeat(np.arange(len(raws)), counts)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(h))
    at = np.flatnonzero(left >= SHINGLE)
    s, d = common.rolling(h, SHINGLE)[at], doc[at]
    begins = np.cumsum(counts) - counts
    for i in np.flatnonzero((counts > 0) & (counts < SHINGLE)).tolist():
        own = common.rolling(h[begins[i]:begins[i] + counts[i]], int(counts[i]))
        s, d = np.append(s, common.mix64(own + np.uint64(counts[i]))), np.append(d, i)
    order = np.lexsort((s, d))
    s, d = s[order], d[order]
    first = np.append(True, (s[1:] != s[:-1]) | (d[1:] != d[:-1]))
    at = np.flatnonzero(first)
    return d[at], s[at], np.diff(np.append(at, len(s)))


def bag_signatures(doc: np.ndarray, h: np.ndarray, w: np.ndarray, docs: int, slots: int) -> np.ndarray:
    """(docs x slots) times of the earliest point of each slot. ``doc``, ``h``
    and ``w``: text number, hash and weight of the elements; every text needs
    one at least."""
    levels = np.where(w > 1, np.ceil(np.log2(np.maximum(w, 1))), 0).astype(np.int64) + 1
    e = np.repeat(np.arange(len(h)), levels)
    level = np.arange(len(e)) - np.repeat(np.cumsum(levels) - levels, levels)
    # weights (low, low + width] of each process: (0,1], (1,2], (2,4], (4,8] ...
    low = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    width = np.maximum(low, 1)
    seed = common.mix64(h[e] + _SILVER * level.astype(np.uint64))
    of, top = doc[e], w[e]
    limit = (np.log(slots) + 2.5) * slots / np.maximum(np.bincount(doc, weights=w, minlength=docs), 1)

    def waits(s, k):
        u = (common.mix64(s + k * _GOLD) >> np.uint64(11)).astype(np.float64)
        return -np.log((u + 1) * 2.0 ** -53)

    sig = np.full(docs * slots, np.inf)
    t = waits(seed, np.zeros(len(seed), np.uint64)) / width
    drawn = np.zeros(len(seed), np.int64)
    while True:
        live = np.flatnonzero(t <= limit[of])
        if not len(live):
            late = (sig.reshape(docs, slots) > limit[:, None]).any(axis=1)
            if not late.any():
                return sig.reshape(docs, slots)
            limit[late] *= 1.5
            continue
        many = int(np.clip((1 << 15) // len(live), 1, 64))
        k = (drawn[live][:, None] + np.arange(1, many + 1)).astype(np.uint64)
        s = seed[live][:, None]
        times = np.cumsum(np.hstack([t[live][:, None], waits(s, k) / width[live][:, None]]), axis=1)
        t[live], times = times[:, -1], times[:, :-1]
        drawn[live] += many
        g = common.mix64(common.mix64(s + k * _SILVER) + _GOLD)
        slot = ((g >> np.uint64(32)) % np.uint64(slots)).astype(np.int64)
        high = (g & np.uint64(0xFFFFFFFF)) % width[live][:, None].astype(np.uint64)
        seen = low[live][:, None] + high.astype(np.int64) < top[live][:, None]
        np.minimum.at(sig, (of[live][:, None] * slots + slot)[seen], times[seen])


def signature_rows(raws: list[bytes | None], bands: int = BANDS, rows: int = BAND_ROWS):
    """Per text: fingerprint of its words (None for a null text), number of
    shingles, band hashes (empty without words)."""
    prints, sizes, hashes = [], np.zeros(len(raws), np.int64), [[]] * len(raws)
    for raw in raws:
        own = words_of(raw.decode(errors="replace").lower().encode()) if raw is not None else None
        prints.append(None if own is None else xxhash.xxh3_128_digest(b"w" + b" ".join(own) if own else b"t" + raw))
    doc, h, w = shingles([r or b"" for r in raws])
    if len(doc):
        some, dense = np.unique(doc, return_inverse=True)
        sizes += np.bincount(doc, weights=w, minlength=len(raws)).astype(np.int64)
        sig = bag_signatures(dense, h, w, len(some), bands * rows).view(np.uint64).reshape(len(some), bands, rows)
        out = np.tile(common.mix64(np.arange(1, bands + 1, dtype=np.uint64) * _GOLD), (len(some), 1))
        for r in range(rows):
            out = common.mix64(out * np.uint64(31) + sig[:, :, r])
        for i, b in zip(some.tolist(), out.view(np.int64).tolist()):
            hashes[i] = b
    return prints, sizes.tolist(), hashes


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two (sorted hashes, weights) multisets."""
    at = np.searchsorted(a[0], b[0])
    at[at == len(a[0])] = 0
    both = a[0][at] == b[0]
    least = np.minimum(a[1][at], b[1])[both].sum()
    return float(least / (a[1].sum() + b[1].sum() - least))


def _text_key(text: F.Column) -> F.Column:
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def prepared(docs: DataFrame, text_col: str, keep_text: bool) -> tuple[DataFrame, str, str]:
    """``docs`` with a row number and a struct of fingerprint, shingles and
    bands, as a written table; the two columns' names. Without ``keep_text`` the
    text is left out, and a 128-bit hash of it in the struct finds it again."""
    row, key = common.free_name(docs, "row", "key")

    def sign(texts: pa.Array) -> pa.Array:
        raws, out = common.raw_texts(texts), ([], [], [])
        for a, b in common.blocks(raws):
            for whole, part in zip(out, signature_rows(raws[a:b])):
                whole += part
        return pa.StructArray.from_arrays(
            [pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.int64()))],
            names=["print", "n", "bands"])

    udf = F.arrow_udf(sign, "print binary, n bigint, bands array<bigint>").asNondeterministic()
    signed = docs.withColumn(row, F.monotonically_increasing_id()).withColumn(key, udf(F.col(text_col)))
    if not keep_text:
        signed = signed.withColumn(key, F.col(key).withField("text", _text_key(F.col(text_col)))).drop(text_col)
    return common.written(signed, "signed"), row, key


def candidate_texts(docs: DataFrame, text_col: str, signed: DataFrame, row: str, key: str, wanted: DataFrame) -> DataFrame:
    """(row, text) of the wanted rows. Texts that were not kept are read again and
    found by their hash; of copies each task sends one."""
    if text_col in signed.columns:
        return signed.select(F.col(row).alias("row"), F.col(text_col).alias("text")).join(wanted, "row", "left_semi")
    places = signed.select(F.col(row).alias("row"), F.col(key)["text"].alias("at")).join(wanted, "row", "left_semi")
    texts = docs.select(F.col(text_col).alias("text"), _text_key(F.col(text_col)).alias("at"))
    return texts.join(places, "at").groupBy("row").agg(F.first("text").alias("text"))


def verify(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """(a, b, j) of the pairs (a, b) whose texts have a similarity j of ``least``
    or more. ``texts``: (row, text)."""
    groups = (pairs.groupBy("a").agg(F.count("*").alias("c"))
              .select("a", F.ceil(F.col("c") / GROUP_ROWS).cast("int").alias("salts")))
    leaders = groups.select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                            F.lit(0).alias("role"), F.col("a").alias("row"))
    members = pairs.join(groups, "a").select("a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"),
                                             F.lit(1).alias("role"), F.col("b").alias("row"))

    def check(batches):
        leader, own = None, None
        for batch in batches:
            a, role, row = (batch.column(c).to_pylist() for c in ("a", "role", "row"))
            raws = common.raw_texts(batch.column("text"))
            out = []
            for x, r, y, raw in zip(a, role, row, raws):
                _, h, w = shingles([raw])
                if r == 0:
                    leader, own = x, (h, w)
                elif leader == x and (j := overlap(own, (h, w))) >= least:
                    out.append((x, y, j))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(
                (pa.int64(), pa.int64(), pa.float64()))], names=["a", "b", "j"])

    return (leaders.unionByName(members).join(texts, "row").select("a", "salt", "role", "row", "text")
            .repartition("a", "salt").sortWithinPartitions("a", "salt", "role").mapInArrow(check, "a bigint, b bigint, j double"))


def both_ways(pairs: DataFrame) -> DataFrame:
    return pairs.select("a", "b", "j").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "j"))


def link_misses(misses: DataFrame, links: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(a, b, j) links between rows b that miss a row a and rows b that are
    linked to it (both (a, b, j)), one at least for every miss that has any in a
    tile. The two sides of a meet in tiles of about ``GROUP_ROWS`` rows each, so
    a text is sent once per tile and pairs exist only inside a task."""
    count = lambda side: side.groupBy("a").agg(F.ceil(F.count("*") / GROUP_ROWS).cast("int").alias("k"))
    tiles = count(misses).withColumnRenamed("k", "kx").join(count(links).withColumnRenamed("k", "ky"), "a")

    def side(rows: DataFrame, own: str, other: str, role: int) -> DataFrame:
        mine = F.pmod(F.xxhash64("b"), F.col("k" + own)).cast("int").alias("t" + own)
        every = F.explode(F.sequence(F.lit(0), F.col("k" + other) - 1)).alias("t" + other)
        return rows.join(tiles, "a").select("a", mine, every, F.lit(role).alias("role"), F.col("b").alias("row"), "j")

    def check(batches):
        tile, held = None, []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("a", "tx", "ty", "role", "row", "j")]
            out = []
            for a, tx, ty, role, row, j, raw in zip(*cols, common.raw_texts(batch.column("text"))):
                if (a, tx, ty) != tile:
                    tile, held = (a, tx, ty), []
                _, h, w = shingles([raw])
                if role == 0:
                    held.append((j, row, (h, w), w.sum()))
                    continue
                n = w.sum()
                for jy, y, own, size in held:
                    if jy - j <= 1 - threshold + 1e-9 and min(n, size) >= threshold * max(n, size):
                        s = overlap(own, (h, w))
                        if s >= threshold:
                            out.append((row, y, s))
                            break
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(
                (pa.int64(), pa.int64(), pa.float64()))], names=["a", "b", "j"])

    rows = side(links, "y", "x", 0).unionByName(side(misses, "x", "y", 1))
    return (rows.join(texts, "row").select("a", "tx", "ty", "role", "row", "j", "text").repartition("a", "tx", "ty")
            .sortWithinPartitions("a", "tx", "ty", "role").mapInArrow(check, "a bigint, b bigint, j double"))


def overlaps(held: list[tuple[np.ndarray, np.ndarray]]):
    """A function of one (sorted hashes, weights) multiset that gives its
    weighted Jaccard similarity with each one of ``held``."""
    h, w = (np.concatenate([x[i] for x in held]) for i in (0, 1))
    of = np.repeat(np.arange(len(held)), [len(x[0]) for x in held])
    size = np.bincount(of, weights=w, minlength=len(held))
    order = np.argsort(h, kind="stable")
    h, w, of = h[order], w[order], of[order]
    begins = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    keys, lengths = h[begins], np.diff(np.append(begins, len(h)))

    def similar(own: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        at = np.searchsorted(keys, own[0])
        at[at == len(keys)] = 0
        both = keys[at] == own[0]
        at, n = at[both], lengths[at[both]]
        i = np.repeat(begins[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        least = np.bincount(of[i], weights=np.minimum(w[i], np.repeat(own[1][both], n)), minlength=len(held))
        return least / (size + own[1].sum() - least)

    return similar


def link_rest(rest: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(a, b) links among the rows of each group (first, most) of ``rest``, which
    has their number of shingles n and class too: all pairs of different classes
    are compared, and enough links are given to join all classes that any pair
    links. A group is dealt to tiles of about ``TILE_ROWS`` rows, a task compares
    two tiles, so a group of k tiles sends each text k times."""
    group = ["first", "most"]
    alike = rest.groupBy(group).agg(
        F.count("*").alias("c"), F.sum("n").alias("s"), F.min("class").alias("low"), F.max("class").alias("high"),
        F.sum(F.xxhash64("row").cast("decimal(38,0)")).alias("rows"), F.expr("bit_xor(xxhash64(row, n))").alias("more"))
    # groups of the same rows once
    groups = (alike.filter("low != high").groupBy("c", "s", "rows", "more").agg(F.min(F.struct(*group)).alias("g"))
              .select("g.*", F.ceil(F.greatest(F.col("c") / TILE_ROWS, F.col("s") / TILE_SHINGLES)).cast("int").alias("k")))
    tile = F.pmod(F.xxhash64("row"), F.col("k")).cast("int")
    sent = (rest.join(groups, group).select(*group, "row", "class", tile.alias("t"), F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("u"))
            .select(*group, F.least("t", "u").alias("x"), F.greatest("t", "u").alias("y"), "t", "row", "class"))

    def compare(one: list, two: list | None) -> list[tuple[int, int]]:
        """``one`` with ``two``, or with itself; (tile, row, class, multiset) each."""
        out, up = [], {}

        def top(c):
            while up.get(c, c) != c:
                c = up[c]
            return c
        if not one or two == []:
            return out
        similar, of = overlaps([r[3] for r in one]), np.array([r[2] for r in one])
        for i, (_, row, own_class, own) in enumerate(one if two is None else two):
            mine = top(own_class)
            others = of != mine
            if two is None:
                others[i:] = False
            if not others.any():
                continue
            for k in np.flatnonzero(others & (similar(own) >= threshold)).tolist():
                if (theirs := int(of[k])) != mine:
                    out.append((row, one[k][1]))
                    up[theirs] = mine
                    of[of == theirs] = mine
        return out

    def check(batches):
        now, sides = None, ([], [])
        done = lambda: compare(sides[0], None if now[2] == now[3] else sides[1]) if now else []
        record = lambda out: pa.RecordBatch.from_arrays(
            [pa.array([o[i] for o in out], pa.int64()) for i in (0, 1)], names=["a", "b"])
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("first", "most", "x", "y", "t", "row", "class")]
            out = []
            for first, most, x, y, t, row, c, raw in zip(*cols, common.raw_texts(batch.column("text"))):
                if (first, most, x, y) != now:
                    out += done()
                    now, sides = (first, most, x, y), ([], [])
                sides[t != x].append((t, row, c, shingles([raw])[1:]))
            yield record(out)
        yield record(done())

    return (sent.join(texts, "row").select(*group, "x", "y", "t", "row", "class", "text").repartition(*group, "x", "y")
            .sortWithinPartitions(*group, "x", "y").mapInArrow(check, "a bigint, b bigint"))


def components(edges: DataFrame) -> DataFrame:
    """(row, label): the smallest row of the component, for every row of an
    edge (a, b), by alternating large and small stars; each round is written."""
    def kept(stars: DataFrame) -> tuple[DataFrame, tuple]:
        seen = Observation()
        table = common.written(stars.observe(seen, F.count("*").alias("n"), F.sum(
            F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")), "edges")
        return table, (seen.get["n"], seen.get["s"])

    now, state = kept(edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.withColumnRenamed("m", "v")).distinct())
        before, old = state, now
        now, state = kept(small)
        common.release(old)
        if state == before:
            break
    return now.select(F.col("u").alias("row"), F.col("v").alias("label")).unionByName(
        now.select(F.col("v").alias("row"), F.col("v").alias("label"))).distinct()


def classes(docs: DataFrame, text_col: str = "text", threshold: float = SIMILAR,
            keep_text: bool = True) -> tuple[DataFrame, DataFrame, str]:
    """The written rows of ``docs`` (without the text if it need not be kept),
    (row, class) for each of them (class: the smallest row in it) and the name of
    the row column."""
    common.prepare(docs.sparkSession)
    signed, row, key = prepared(docs, text_col, keep_text)
    k = F.col(key)
    slim = signed.select(F.col(row).alias("row"), k["print"].alias("print"), k["n"].alias("n"), k["bands"].alias("bands"))
    reps = slim.filter("print is not null").groupBy("print").agg(F.min("row").alias("rep"))
    reps = common.written(reps, "representatives")

    bands = (slim.filter("n > 0").select("row", "n", "bands").join(reps.select(F.col("rep").alias("row")), "row", "left_semi")
             .select("row", "n", F.explode("bands").alias("bucket")))
    # Two leaders of each bucket: its smallest row, and the row that meets the
    # most rows in all its buckets. The centre of a group of edited copies shares
    # more bands with each of them than they do with each other, so it leads the
    # buckets that it is in, and every copy is compared with it.
    sizes = bands.groupBy("bucket").agg(F.count("*").alias("c")).filter("c > 1")
    multi = common.written(bands.join(sizes, "bucket"), "buckets")
    meets = multi.groupBy("row").agg((F.sum("c") * (1 << 20)).alias("meets"))
    rank = F.col("meets") + F.xxhash64("row").bitwiseAND((1 << 20) - 1)
    led = multi.join(meets, "row").groupBy("bucket").agg(
        F.min("row").alias("first"), F.min_by("n", "row").alias("first_n"),
        F.max_by("row", rank).alias("most"), F.max_by("n", rank).alias("most_n"))
    members = common.written(multi.join(led, "bucket").drop("bucket", "c").distinct(), "members")
    common.release(multi)
    texts = common.written(candidate_texts(docs, text_col, signed, row, key, members.select("row").distinct()), "candidates")

    # a similarity is at most the ratio of the sizes
    miss = 2 * threshold - 1 - 1e-9

    def near_in_size(p: DataFrame) -> DataFrame:
        return (p.filter(F.least("a_n", "b_n") >= F.lit(miss) * F.greatest("a_n", "b_n"))
                .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())

    led = members.select("row", "n", F.explode(F.array_distinct(F.array(*[
        F.struct(F.col(x).alias("a"), F.col(x + "_n").alias("a_n")) for x in ("first", "most")]))).alias("l"))
    pairs = common.written(near_in_size(led.filter(F.col("row") != F.col("l.a")).select(
        "l.a", "l.a_n", F.col("row").alias("b"), F.col("n").alias("b_n"))), "pairs")

    # Distances 1 - j are a metric: a row that misses a leader can be linked to
    # a row that the leader is linked to only if its own distance from the
    # leader is less than one more link's. Such near misses that are not in the
    # leader's class are tested against those rows, until no link is new.
    found = fresh = common.written(verify(pairs, texts, miss), "similar")
    misses = both_ways(found.filter(F.col("j") < threshold))
    edges = found.filter(F.col("j") >= threshold).select("a", "b")
    labels = None
    while True:
        old, labels = labels, common.written(components(edges), "labels")
        if old is not None:
            common.release(old)
        of = lambda name: labels.select(F.col("row").alias(name), F.col("label").alias(name + "_class"))
        apart = (misses.join(of("a"), "a").join(of("b"), "b", "left").filter("b_class is null or b_class != a_class")
                 .select("a", "b", "j"))
        fresh = common.written(link_misses(apart, both_ways(fresh.filter(F.col("j") >= threshold)), texts, threshold), "links")
        if fresh.isEmpty():
            break
        edges = edges.unionByName(fresh.select("a", "b"))

    # A pair of bucket-mates is decided if one of them is linked to a leader of
    # the bucket. What both leaders leave over is compared with each other;
    # buckets with the same two leaders go together.
    linked = both_ways(found.filter(F.col("j") >= threshold)).select("a", F.col("b").alias("row")).distinct()
    rest = members.filter("row != first and row != most").select("row", "n", "first", "most")
    for leader in ("first", "most"):
        rest = rest.join(linked.withColumnRenamed("a", leader), ["row", leader], "left_anti")
    rest = rest.join(labels, "row", "left").select("first", "most", "row", "n", F.coalesce("label", "row").alias("class"))
    more = common.written(link_rest(common.written(rest, "rest"), texts, threshold), "rest-links")
    if not more.isEmpty():
        old, labels = labels, common.written(components(edges.unionByName(more)), "labels")
        common.release(old)
    common.release(texts, members, pairs)
    of_print = reps.join(labels.withColumnRenamed("row", "rep"), "rep", "left").select(
        "print", F.coalesce("label", "rep").alias("class"))
    return signed.drop(key), (slim.select("row", "print").join(of_print, "print", "left")
                              .select("row", F.coalesce("class", "row").alias("class"))), row


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = SIMILAR) -> DataFrame:
    """One row per document: its id, ``class_id`` (the smallest id of its
    class), ``class_size`` and whether it is the one that stays (``kept``)."""
    rows, found, row = classes(docs.select(id_col, text_col), text_col, threshold, keep_text=False)
    ids = common.written(rows.select(F.col(row).alias("row"), F.col(id_col).alias("id")).join(found, "row"), "classes")
    # the smallest id stays, of rows with that id the first; an id sorts before none
    stays = ids.groupBy("class").agg(F.min("id").alias("class_id"), F.count("*").alias("class_size"),
                                     F.min(F.struct(F.col("id").isNull(), "id", "row"))["row"].alias("stay"))
    return (ids.join(stays, "class")
            .select(F.col("id").alias(id_col), "class_id", "class_size", (F.col("row") == F.col("stay")).alias("kept")))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = SIMILAR) -> DataFrame:
    """``docs`` with one row of each class, the one with the smallest id."""
    rows, found, row = classes(docs, text_col, threshold)
    ids = rows.select(F.col(row).alias("row"), F.col(id_col).alias("id")).join(found, "row")
    stays = ids.groupBy("class").agg(F.min(F.struct(F.col("id").isNull(), "id", "row"))["row"].alias(row))
    return rows.join(stays.select(row), row, "left_semi").drop(row)
