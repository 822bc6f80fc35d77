import math
import random
import re
from collections import Counter

import pytest
from .helpers import AWKWARD, awkward, empty, sf_dir
from pyspark.sql import functions as F

from clientlens.llm import common, lexical
from clientlens.llm.queries import op13_lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for t in TERM.findall(text or "")]


def plain(docs, items, top=10):
    """(item, rank, id, score) by the formula, every document scored."""
    tf = [(i, Counter(terms(t))) for i, t in docs]
    tf = [(i, c, sum(c.values())) for i, c in tf if c]
    n_docs, words = len(tf), sum(n for _, _, n in tf)
    df = Counter(t for _, c, _ in tf for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in tf:
            m = 100 - 75 + (75 * n * n_docs) // words
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in terms(text) if t in c)
            if s > 0:
                scored.append((-s, i is None, i if i is not None else 0, i))
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def found(docs, items, index=None, **options):
    got = lexical.search(index or lexical.build(docs), docs, items, **options).collect()
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got), key=str)


def corpus(rng, n):
    """Documents of 1 to 300 words over a skewed vocabulary, with many copies of
    one text and texts that differ from it by a word."""
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    texts = [" ".join(rng.choices(words, weights, k=rng.choice([1, 5, 30, 300]))) for _ in range(n)]
    hot = texts[0] + " rare1 rare2 rare2 rare2"
    return texts + [hot] * 60 + [hot + f" x{i}" for i in range(20)]


@pytest.mark.parametrize("options", [{}, {"block_terms": 7}, {"probes": 10, "top": 3}])
def test_ranks_equal_brute_force(spark, monkeypatch, options):
    rng = random.Random(3)
    docs = list(enumerate(corpus(rng, 300)))
    rng.shuffle(docs)
    items = [(1, "rare1 Rare2 rare2 w0"), (2, "w1 w1 w399 nowhere"), (3, "nowhere at all"), (4, "w0"),
             (5, " ".join(rng.choices([f"w{i}" for i in range(400)], k=200))), (5, "w7 w8"), (6, None), (7, "")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    got = found(df, spark.createDataFrame(items, "item_id bigint, text string"), **options)
    assert got == plain(docs, items, options.get("top", 10))


def test_bounds_are_never_below_the_score(spark, monkeypatch):
    """Signatures far too small: everything looks present, and the ranks hold."""
    monkeypatch.setattr(lexical, "KEY_BITS", 1)
    rng = random.Random(4)
    docs = list(enumerate(corpus(rng, 60)))
    task = lexical._Builder()
    task.add([i for i, _ in docs], [t.encode() for _, t in docs])
    tf = {i: Counter(terms(t)) for i, t in docs}
    df = Counter(t for c in tf.values() for t in c)
    rows = [(q, t, 1 + q, df[t]) for q, wanted in enumerate((["w0", "rare1", "rare2"], ["w3"], ["w1", "w2", "w50"])) for t in wanted if df[t]]
    sent = lexical._Items(rows, len(docs), sum(sum(c.values()) for c in tf.values()))
    seen = 0
    place = {q: i for i, q in enumerate(sent.items)}
    for ids, lengths, tops, _, width, slices in task.blocks():
        ub = sent.bounds(lengths, tops, width, slices)
        for j, i in enumerate(ids):
            exact = dict(sent.scores(docs[i][1].encode(), sent.items, place))
            for q in sent.items:
                assert ub[place[q], j] >= exact.get(q, 0)
            seen += 1
    assert seen == len(docs)


def test_bounds_exclude_most_rows(spark):
    rng = random.Random(5)
    words = [f"t{i}" for i in range(5000)]
    docs = [(i, " ".join(rng.choices(words, k=60))) for i in range(2000)]
    items = [(q, " ".join(docs[q][1].split()[:12])) for q in range(5)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    index = lexical.build(df)
    pairs = [(q, t, 1, 24) for q, text in items for t in set(text.split())]
    sent = lexical._Items(pairs, 2000, 120_000)
    run, schema = lexical._candidates(sent, "bigint", {q: (6_000_000_000, 10 ** 9) for q, _ in items})
    blocks = index.filter("ids is not null").select("ids", "lengths", "tops", "prints", "width", "slices")
    near = blocks.mapInArrow(run, schema).count()
    assert 5 <= near < 0.05 * 5 * 2000
    assert found(df, spark.createDataFrame(items, "item_id bigint, text string"), index) == plain(docs, items)


def test_candidates_joined_or_sent(spark, monkeypatch):
    rng = random.Random(6)
    docs = list(enumerate(corpus(rng, 80)))
    items = [(1, "rare1"), (2, "w2 w3 w4")]
    df, asked = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(lexical, "SENT_ROWS", 0)
    assert found(df, asked) == plain(docs, items)


def test_many_small_blocks_and_vocabularies(spark, monkeypatch):
    monkeypatch.setattr(common, "PIECE_BYTES", 64)
    monkeypatch.setattr(common.pieces, "__defaults__", (64,))
    task = lexical._Builder()
    docs = corpus(random.Random(7), 20)
    task.add(list(range(len(docs))), [t.encode() for t in docs])
    assert [(r[1], r[2]) for r in task.rows] == [(len(terms(t)), max(Counter(terms(t)).values())) for t in docs]
    df = Counter(t for d in docs for t in set(terms(d)))
    names, counts = task.counts()
    assert {t.decode(): c for t, c in zip(names, counts.tolist())} == df


def test_awkward_rows_and_empty_tables(spark):
    items = [(1, "alpha beta ünïcödé"), (None, "word"), (2, "日本語 x a"), (3, "row id words word29999")]
    asked = spark.createDataFrame(items, "item_id bigint, text string").withColumn("q", F.lit("taken"))
    assert found(awkward(spark), asked) == plain(AWKWARD, items)
    assert found(empty(spark), asked) == []
    assert found(awkward(spark), asked.limit(0)) == []


def test_query(spark):
    docs = [(i, t) for i, t in enumerate(corpus(random.Random(8), 100))]
    items = [(9, "rare2 w1"), (10, "w5 w6 w6")]
    d = sf_dir(documents=spark.createDataFrame(docs, "doc_id bigint, text string"),
               benchmark=spark.createDataFrame(items, "item_id bigint, text string"))
    got = op13_lexical_search(spark, d)
    assert dict(got.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, items)
