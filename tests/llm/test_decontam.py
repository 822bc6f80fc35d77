import re

import pytest

from clientlens.llm import decontam
from .helpers import awkward, empty


def _items(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def _brute(text, items):
    """(words, hit word numbers, item ids), window by window."""
    def words(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    w, hit, found = words(text), set(), set()
    for item, t in items:
        v = words(t)
        for s in range(max(len(v) - 9, 1) if v else 0):
            g = v[s:s + 10]
            for i in range(len(w) - len(g) + 1):
                if w[i:i + len(g)] == g:
                    hit.update(range(i, i + len(g)))
                    if item is not None:
                        found.add(str(item))
    return len(w), hit, sorted(found)


ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "SHORT Item"),
         (3, "ein zwei drei vier fünf sechs sieben acht neun zehn"), (4, None), (5, "?!"),
         (None, "no id here"), (2, "short item"), (10, "two three four five six seven eight nine ten eleven")]
DOCS = [
    (1, "zero One, two three four FIVE six seven eight nine ten. eleven twelve thirteen"),
    (2, "one two three four five six seven eight nine"),
    (3, "a short item, a short\nitem and no id here"),
    (4, "ein zwei drei vier fünf sechs sieben acht neun zehn"),
    (5, "ein zwei drei vier fÜnf sechs sieben acht neun zehn"),
    (6, None), (7, ""), (7, ""), (None, "short item"),
    (8, "word " * 20_000 + "short item"),
]


@pytest.mark.parametrize("block_pairs", [200_000, 2])
def test_hits_equal_brute_force(spark, block_pairs):
    found, hits = decontam.find(awkward(spark, DOCS), _items(spark, ITEMS), block_pairs=block_pairs)
    rows = found.select("doc_id", "text", hits).collect()
    assert len(rows) == len(DOCS)
    for doc_id, text, h in rows:
        n, hit, items = _brute(text, ITEMS)
        assert h.n_words == n
        assert {i for s in h.spans for i in range(s.first, s.last + 1)} == hit
        assert h["items"] == items


def test_remove_documents_and_spans(spark):
    docs, bench = awkward(spark, DOCS), _items(spark, ITEMS)
    kept = decontam.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 5, 6, 7, 7]
    cut = {r.doc_id: r.text for r in decontam.decontaminate(docs, bench, remove="span").collect()}
    assert cut[1] == "zero  thirteen" and cut[3] == "a , a  and " and cut[2] == DOCS[1][1] and cut[6] is None


def test_empty_tables(spark):
    assert decontam.decontaminate(empty(spark), _items(spark, ITEMS)).count() == 0
    assert decontam.decontaminate(awkward(spark), _items(spark, [])).count() == awkward(spark).count()
