from collections import Counter

import numpy as np
import pytest

from clientlens.llm import neardup
from clientlens.llm.decontam import words_of
from .helpers import AWKWARD, awkward, empty


def _bag(text):
    w = words_of(text.lower().encode())
    return Counter(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))) if w else Counter()


def _jaccard(a, b):
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 0.0


def _brute_classes(rows, threshold=0.8):
    """Smallest row number of each row's component, all pairs compared."""
    bags = [None if t is None else _bag(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if bags[i] is None or bags[j] is None:
                continue
            if (bags[i] and _jaccard(bags[i], bags[j]) >= threshold) or (not bags[i] and rows[i][1] == rows[j][1]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(rows))]


def test_signatures_are_unbiased_and_independent_of_the_batch():
    rng = np.random.default_rng(1)
    error = []
    for trial in range(60):
        a = [f"{trial}w{i}" for i in rng.integers(200, size=150)]
        b = list(a)
        for i in rng.integers(150, size=8):
            b[i] = f"new{i}"
        a, b = a + [f"rep{trial}"] * 100, b + [f"rep{trial}"] * 60
        raws = [" ".join(a).encode(), " ".join(b).encode()]
        doc, h, w = neardup.shingles(raws)
        both = neardup.bag_signatures(doc, h, w, 2, 160)
        alone = neardup.bag_signatures(doc[doc == 1] * 0, h[doc == 1], w[doc == 1], 1, 160)
        assert (alone[0] == both[1]).all()
        true = _jaccard(_bag(raws[0].decode()), _bag(raws[1].decode()))
        assert neardup.overlap((h[doc == 0], w[doc == 0]), (h[doc == 1], w[doc == 1])) == pytest.approx(true)
        error.append((both[0] == both[1]).mean() - true)
    # 60 x 160 slots: a standard error of half a percent
    assert abs(np.mean(error)) < 0.02 and np.std(error) < 0.06


def _near_copies(seed=0):
    """Groups of near and exact copies, chains, shared passages, hot groups."""
    rng = np.random.default_rng(seed)
    word = lambda: f"w{rng.integers(100_000)}"
    rows, passage = [], " ".join(word() for _ in range(60))
    for _ in range(25):
        base = [word() for _ in range(int(rng.integers(3, 200)))]
        for copy in range(int(rng.integers(1, 6))):
            own = list(base)
            for i in rng.integers(len(own), size=copy):
                own[i] = word()
            rows.append(" ".join(own))
            base = own if rng.random() < 0.3 else base
    rows += [" ".join(word() for _ in range(int(rng.integers(20, 90)))) + " " + passage for _ in range(40)]
    hot = [word() for _ in range(120)]
    for i in range(150):
        own = list(hot)
        own[int(rng.integers(120))] = word()
        rows.append(" ".join(own if i % 3 else hot))
    rows += ["Same Words, here", "same words here", "!!", "!!", "??", "", "", None, None]
    order = rng.permutation(len(rows))
    return [(int(100 + i), rows[k]) for i, k in enumerate(order)]


def test_classes_equal_brute_force(spark):
    rows = _near_copies()
    want = {rows[i][0]: rows[c][0] for i, c in enumerate(_brute_classes(rows))}
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: r for r in neardup.near_duplicates(df).collect()}
    assert {k: r.class_id for k, r in got.items()} == want
    assert all(r.kept == (r.class_id == k) for k, r in got.items())
    sizes = Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] for r in got.values())


def test_deduplicate_keeps_one_of_each_class(spark):
    docs = awkward(spark, AWKWARD + [(9, AWKWARD[0][1].upper()), (10, AWKWARD[6][1])])
    kept = neardup.deduplicate(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == [1, 2, 3, 4, 5, 6, 7, 8, 10]           # an id stays before a row without one


def test_empty(spark):
    assert neardup.deduplicate(empty(spark)).count() == 0
    assert neardup.near_duplicates(empty(spark)).count() == 0


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 30)] + [(50, 40), (40, 45), (60, 60), (40, 50)], "a bigint, b bigint")
    got = dict(neardup.components(edges).collect())
    assert got == {**{i: 1 for i in range(1, 31)}, 40: 40, 45: 40, 50: 40}


def _template_family(rows=600, pairs=60):
    """Rows on one template, unrelated ones at 80 / 106 = 0.755, and pairs of
    rows at 83 / 103 = 0.806."""
    rng = np.random.default_rng(3)
    own = lambda n: [f"o{rng.integers(1 << 40)}" for _ in range(n)]
    template = [f"t{i}" for i in range(84)]
    texts = [template + own(13) for _ in range(rows - pairs)]
    texts += [t[:87] + own(10) for t in texts[:pairs]]
    return [(i, " ".join(texts[k])) for i, k in enumerate(rng.permutation(rows).tolist())]


def test_overlaps_equal_overlap():
    rng = np.random.default_rng(2)
    bags = [neardup.shingles([" ".join(f"w{i}" for i in rng.integers(4, size=n)).encode()])[1:] for n in (3, 40, 300, 60, 1)]
    similar = neardup.overlaps(bags)
    for b in bags:
        assert similar(b).tolist() == pytest.approx([neardup.overlap(a, b) for a in bags])


def test_template_family_equals_brute_force(spark, monkeypatch):
    """Rows that both leaders of a bucket leave over are compared too."""
    monkeypatch.setattr(neardup, "TILE_ROWS", 100, raising=False)
    rows = _template_family()
    want = {rows[i][0]: rows[c][0] for i, c in enumerate(_brute_classes(rows))}
    assert len(set(want.values())) == len(rows) - 60
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(df).collect()}
    assert len(set(got.values())) == len(rows) - 60, f"{len(rows) - len(set(got.values()))} of 60 pairs linked"
    assert got == want
