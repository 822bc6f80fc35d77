import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clientlens.llm import langid
from clientlens.llm.queries import QUERIES

from .helpers import awkward, empty

SYLLABLES = {"aa": ["ka", "lo", "mi", "ten", "ra"], "bb": ["sch", "ung", "ein", "ver", "keit"], "cc": ["eau", "ois", "ment", "que", "ré"]}


def _texts(n, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(SYLLABLES))
        words = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(4, 60))]
        rows.append((i, " ".join(words).capitalize() + ".", lang))
    return rows


def _labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_counts_equal_plain_n_grams():
    """Every n-gram of letters, words kept apart, falls into its hashed cell."""
    def cell(gram):
        value = 0
        for c in gram:
            value = (value * 0x110000 + ord(c)) % 2 ** 64
        return (value + len(gram)) % 2 ** 64 * 0x9E3779B97F4A7C15 % 2 ** 64 >> (64 - langid.DIMS_LOG2)

    texts = ["Aé b1b", None, "", "1 2", "ß\nñandú  X", "\U00020000\U0001F642z"]
    got, has = langid.counts(texts)
    for t, row, h in zip(texts, got, has):
        clean, out = " ", np.zeros(1 << langid.DIMS_LOG2)
        for c in " " + (t or "").lower() + " ":
            c = c if c.isalpha() else " "
            clean += c if c != " " or clean[-1] != " " else ""
        for n in (1, 2, 3):
            for i in range(len(clean) - n + 1):
                if n > 1 or clean[i] != " ":
                    out[cell(clean[i:i + n])] += 1
        assert h == any(c.isalpha() for c in t or "")
        if h:
            assert (row == out).all(), t


def test_held_out_accuracy_rejection_and_und(spark):
    rows = _texts(400)
    docs = _labelled(spark, rows)
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))), centroids=2, sample_per_lang=60)
    assert sorted(set(model.langs)) == ["aa", "bb", "cc"]
    more = docs.unionByName(_labelled(spark, [(1000, None, "aa"), (1001, "12 !", "aa"), (1002, "", None), (None, rows[0][1], None),
                                              (1003, "жщ яю " * 40, "aa"), (1004, rows[0][1] * 2000, "aa")]))
    found, name = langid.identify(more, model)
    got = {r.doc_id: r for r in found.collect()}
    out = [r for r in found.filter(langid.held_out(F.col("doc_id"))).collect() if r.doc_id < 1000]
    assert len(out) > 80 and np.mean([r.lang == r[name].lang for r in out]) > 0.97
    assert not any(r[name].rejected for r in out)
    for i in (1000, 1001, 1002):
        assert got[i][name].lang == "und" and got[i][name].rejected and got[i][name].score == 0
    assert got[1003][name].rejected and got[1003][name].lang in model.langs
    assert got[1004][name].lang == rows[0][2] and got[None][name].lang == rows[0][2]
    assert all(0 <= r[name].score <= 1 for r in got.values())


def test_rejection_does_not_depend_on_length(spark):
    """Unknown scripts and random letters go at every length, no known text does."""
    rng = random.Random(5)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))))
    alphabets = {"cyrillic": (0x430, 0x44F), "greek": (0x3B1, 0x3C9), "arabic": (0x627, 0x64A), "han": (0x4E00, 0x9FA5), "latin": (97, 122)}
    kept = {}
    for name, (a, b) in alphabets.items():
        for n in (20, 100, 400, 2000, 5000):
            texts = [" ".join("".join(chr(rng.randint(a, b)) for _ in range(rng.randint(2, 9))) for _ in range(n)) for _ in range(3)]
            if not all(r[2] for r in model.predict(texts)):
                kept[name, n] = [(r[0], round(r[1], 3)) for r in model.predict(texts)]
    assert not kept
    known = [r.text for r in docs.filter(langid.held_out(F.col("doc_id")) & F.col("text").isNotNull()).collect()]
    assert sum(r[2] for r in model.predict(known)) <= 0.005 * len(known)


def test_the_fit_does_not_depend_on_partitions(spark):
    docs = _labelled(spark, _texts(120))
    a, b = langid.fit(docs.repartition(7)), langid.fit(docs.coalesce(1))
    assert a.langs == b.langs and np.allclose(a.idf, b.idf) and np.allclose(a.centroids, b.centroids, atol=1e-5)


def test_a_language_of_many_copies_is_sampled_whole(spark):
    """The sample counts distinct texts: 30,000 rows of 30 texts leave all 30."""
    rows = [(i, f"ka lo mi ten ra {'ka' * (i % 30 + 1)}", "aa") for i in range(30)]
    copies = _labelled(spark, rows).crossJoin(spark.range(1000).select(F.col("id").alias("copy"))).drop("copy")
    few = _labelled(spark, rows)
    other = _labelled(spark, [r for r in _texts(60) if r[2] == "bb"])
    a, b = (langid.fit(x.unionByName(other), sample_per_lang=30) for x in (copies, few))
    assert a.langs == b.langs and set(a.langs) == {"aa", "bb"}


def test_prediction_ignores_lang_source_and_id(spark):
    rows = _texts(60)
    model = langid.fit(_labelled(spark, rows))
    changed = _labelled(spark, [(i + 7, t, "bb") for i, t, _ in rows])
    one, name = langid.identify(_labelled(spark, rows), model)
    two, _ = langid.identify(changed, model)
    assert sorted((r.text, r[name].lang) for r in one.collect()) == sorted((r.text, r[name].lang) for r in two.collect())


def test_held_out_rule(spark):
    import zlib
    got = {r.doc_id: r.h for r in spark.range(50).withColumnRenamed("id", "doc_id").withColumn(
        "h", langid.held_out(F.col("doc_id"))).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(50)}


def test_awkward_and_empty(spark):
    model = langid.fit(_labelled(spark, _texts(60)))
    kept = langid.keep_identified(awkward(spark), model)
    assert kept.columns == awkward(spark).columns
    assert {2, 3, 5, 8}.isdisjoint(r.doc_id for r in kept.collect())
    assert langid.keep_identified(empty(spark), model).count() == 0
    nothing = langid.fit(_labelled(spark, [(1, None, "aa"), (2, "x", None)]))
    found, name = langid.identify(awkward(spark), nothing)
    assert {r[name].lang for r in found.collect()} == {"und"}


@pytest.mark.parametrize("sf, least", [("/root/testdata/sf0.01", 0.97)])
def test_query_on_the_given_documents(spark, sf, least):
    got = QUERIES["op3_language_id"](spark, sf).join(spark.read.parquet(sf + "/documents.parquet").select("doc_id", "lang"), "doc_id")
    out = got.filter("held_out and lang is not null").collect()
    assert len(out) > 200 and np.mean([r.lang == r.lang_pred for r in out]) >= least


def test_long_texts_in_parts_count_like_whole_ones(monkeypatch):
    """N-grams across a cut are counted once, cells too; runs without blanks are cut between words."""
    rng = random.Random(2)
    texts = [t for _, t, _ in _texts(30)] + [None, "", "x" * 300, "日本。語" * 200, "".join(rng.choice("ab1 .é\n") for _ in range(900))]
    whole, has = langid.counts(texts)
    cells = langid.cell_counts(texts)
    for size in (7, 50, 1000):
        monkeypatch.setattr(langid, "BLOCK_CHARS", size)
        got, again = langid.counts(texts)
        assert np.array_equal(got, whole) and np.array_equal(has, again)
        assert all(np.array_equal(a, b) for a, b in zip(langid.cell_counts(texts), cells))


def test_memory_is_bounded_by_characters():
    """One very long text costs a task a part of it at a time."""
    import tracemalloc
    text = " ".join("".join(SYLLABLES["aa"][j % 5] for j in range(i % 7 + 1)) for i in range(2_000_000))
    assert len(text) > 15_000_000
    model = langid.Model(np.ones(langid._DIMS), ["aa"], np.ones((1, langid._DIMS), np.float32) / 64, np.zeros(1),
                         {"aa": (np.packbits(np.ones(1 << langid.SEEN_LOG2, np.uint8)).tobytes(), 0.5)})
    langid.counts(["warm"])
    tracemalloc.start()
    assert model.predict([text, None, "ka lo"])[0][0] == "aa"
    assert tracemalloc.get_traced_memory()[1] < 400e6
    tracemalloc.stop()
