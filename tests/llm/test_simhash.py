import random
import re

import numpy as np
import pytest
import xxhash
from .helpers import AWKWARD, LONG, awkward, empty
from pyspark.sql import functions as F

from clientlens.llm import common, simhash
from clientlens.llm.queries import op12_simhash_near_duplicates


def plain_print(text):
    """The fingerprint by its definition, hash by hash and bit by bit."""
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def plain_components(prints, within=3):
    up = list(range(len(prints)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= within:
                up[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(prints))]


def groups(labels):
    out = {}
    for i, x in enumerate(labels):
        out.setdefault(x, set()).add(i)
    return sorted(map(sorted, out.values()))


def test_fingerprints_follow_the_definition():
    rng = random.Random(5)
    texts = [t for _, t in AWKWARD] + [" ".join(rng.choice(["a", "B", "cé", "\x1cd"]) for _ in range(k)) for k in range(1, 40)]
    got = simhash.simhash([None if t is None else t.encode() for t in texts])
    assert got.tolist() == [plain_print(t) for t in texts]


def test_a_long_text_in_parts_has_the_fingerprint_of_the_whole(monkeypatch):
    whole = simhash.simhash([LONG.encode(), b"one two", b"x" * 500])
    monkeypatch.setattr(common, "PIECE_BYTES", 100)
    monkeypatch.setattr(common.pieces, "__defaults__", (100,))
    assert simhash.simhash([LONG.encode(), b"one two", b"x" * 500]).tolist() == whole.tolist()


def family(rng, n, bits):
    """Fingerprints around a few centres, so that chains of links form."""
    out = set()
    centres = [rng.getrandbits(64) for _ in range(max(1, n // 40))]
    while len(out) < n:
        x = rng.choice(centres)
        for _ in range(rng.randint(0, bits)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("within,node_rows", [(3, 1 << 18), (3, 12), (1, 6), (0, 4), (5, 1 << 18)])
def test_links_give_the_components_of_all_pairs(spark, within, node_rows):
    common.prepare(spark)
    rng = random.Random(within)
    prints = family(rng, 400, 4) + [x ^ 1 << 63 for x in family(rng, 40, 2)]
    # many in one node: the first 16 bits alike
    prints = sorted({*prints, *[(0xABCD << 48) | rng.getrandbits(10) for _ in range(150)], 0, (1 << 64) - 1})
    df = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "print bigint")
    up = {p: p for p in prints}

    def top(p):
        while up[p] != p:
            p = up[p]
        return p
    for a, b in simhash.links(df, "print", within, node_rows).collect():
        a, b = a % (1 << 64), b % (1 << 64)
        up[max(top(a), top(b))] = min(top(a), top(b))
    assert groups([top(p) for p in prints]) == groups(plain_components(prints, within))


def test_walk_holds_few_pairs_at_a_time(monkeypatch):
    monkeypatch.setattr(simhash, "FRONT", 16)
    monkeypatch.setattr(simhash, "LEAF_PAIRS", 4)
    rng = random.Random(1)
    r = np.array(sorted({rng.getrandbits(12) for _ in range(300)}), np.uint64)
    walk = simhash.Walk(r, 1)
    walk.walk(np.array([[0], [len(r)], [0], [len(r)], [0]]), 0)
    label = np.arange(len(r))
    i, j = walk.links()
    label[i] = j
    assert groups(label.tolist()) == groups(plain_components([int(x) for x in r], 1))


def test_awkward_rows_and_empty_tables(spark):
    rows = simhash.near_duplicates(awkward(spark)).collect()
    want = [plain_print(t) for _, t in AWKWARD]
    assert sorted(r.fingerprint for r in rows) == sorted(f"{p:016x}" for p in want)
    none = {r.doc_id: r.component_id for r in rows if r.fingerprint == "0" * 16}
    assert none[2] == none[3] == none[8] == 2
    assert [r.component_id for r in rows if r.doc_id is None] == [None]
    assert simhash.near_duplicates(empty(spark)).collect() == []
    signed, name = simhash.fingerprints(awkward(spark).withColumn("__fingerprint", F.lit("taken")))
    assert name not in awkward(spark).columns and signed.filter("__fingerprint = 'taken'").count() == len(AWKWARD)


def test_query_over_all_documents(spark):
    d = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").orderBy("doc_id").collect()]
    prints = [plain_print(t) for _, t in docs]
    labels = plain_components(prints)
    low = {}
    for (i, _), x in zip(docs, labels):
        low[x] = min(i, low.get(x, i))
    want = sorted((i, f"{p:016x}", low[x]) for (i, _), p, x in zip(docs, prints, labels))
    assert sorted(map(tuple, op12_simhash_near_duplicates(spark, d).collect())) == want
    assert len(low) < len(docs)
