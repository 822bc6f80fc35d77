import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from clientlens.llm import binpack, packing
from clientlens.llm.queries import QUERIES
from clientlens.llm.tokens import EOS, encoder

from .helpers import AWKWARD, awkward, empty, sf_dir

TOKENIZER = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def _ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [EOS]


ODD = ["İstanbul ΣΑΣ ﬁne é a b\x1cc don't I'LL'S ² Ⅷ ½ 日本語テキスト \U0001F642x​\x85y", "", " \n", "ñandú́ ǅ ŉ ÉÀ×÷",
       "a.b,c!!! ...x 12ab34 '", "it's we'll 'tis ''s rock'n'roll", "é ́x  y z", "word " * 50, "x" * 500]


def test_encoder_equals_the_tokenizer():
    import duckdb
    texts = ODD + [t for t, in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    for t in texts:
        assert np.frombuffer(encoder().encode(t.encode()), "<u2").tolist() == _ids(t)[:-1], t[:80]


def test_hilbert_index_is_a_walk_through_all_cells():
    """Every cell once, neighbours on the curve are neighbours in space."""
    for dims, bits in ((2, 4), (3, 3)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        order = np.argsort(packing.hilbert_index(cells, bits))
        assert sorted(packing.hilbert_index(cells, bits)) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


def _check_pieces(rows, texts, capacity=2048):
    """Each document's pieces cover its ids once, sequences have no gap."""
    want = sorted((zlib.crc32(np.array(_ids(t), "<u4").tobytes()), len(_ids(t))) for t in texts)
    assert sum(r.length for r in rows) == sum(n for _, n in want)
    by_sequence = {}
    for r in rows:
        assert 0 < r.length <= capacity
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return by_sequence


def _by_document(rows):
    """(id, its ids put together from the pieces) for rows with distinct ids."""
    docs = {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append((r.start, bytes(r.ids), r.length))
    out = {}
    for i, parts in docs.items():
        parts.sort()
        assert [p[0] for p in parts] == list(np.cumsum([0] + [p[2] for p in parts])[:-1])
        out[i] = np.frombuffer(b"".join(p[1] for p in parts), "<u4").tolist()
    return out


@pytest.mark.parametrize("pack", ["curve", "matrix"])
def test_documents_come_back_whole(spark, pack):
    rows = [(i, t) for i, t in enumerate(ODD + ["w%d " % i * (i * 40) for i in range(40)] + [None])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    if pack == "curve":
        got = packing.pack(df, capacity=256).collect()
    else:
        got = binpack.pieces(binpack.pack_matrix(df, capacity=256, window_tokens=3000)).collect()
        assert all(r.first_position == 0 for r in got)
    _check_pieces(got, [t for _, t in rows], 256)
    assert _by_document(got) == {i: _ids(t) for i, t in rows}
    assert all(r.doc_tokens == len(_ids(dict(rows)[r.doc_id])) for r in got)


def test_curve_packing_fills_all_but_the_last_sequence(spark):
    df = spark.createDataFrame([(i, f"some words {i} " * (i % 50)) for i in range(300)], "doc_id bigint, text string")
    used = [sum(n for _, n in p) for _, p in sorted(_check_pieces(
        packing.pack(df).collect(), [f"some words {i} " * (i % 50) for i in range(300)]).items())]
    assert all(u == 2048 for u in used[:-1])


def test_similar_documents_are_neighbours_on_the_curve():
    rng = np.random.default_rng(0)
    topics = [rng.integers(2, 40_000, size=60) for _ in range(12)]
    docs = [rng.choice(topics[i % 12], size=200) for i in range(240)]
    order = np.argsort(packing.curve_keys(docs), kind="stable")
    same = np.mean(order[1:] % 12 == order[:-1] % 12)
    assert same > 0.5                                    # by chance: one in twelve


@pytest.mark.parametrize("query", ["op9_packing", "op10_token_matrix"])
def test_queries_on_awkward_rows(spark, query):
    rows = QUERIES[query](spark, sf_dir(documents=awkward(spark))).collect()
    _check_pieces(rows, [t for _, t in AWKWARD])
    whole = sorted(((r.doc_id, r.doc_tokens, r.ids_crc32) for r in rows if r.length == r.doc_tokens), key=str)
    want = sorted(((i, len(_ids(t)), zlib.crc32(np.array(_ids(t), "<u4").tobytes())) for i, t in AWKWARD
                   if len(_ids(t)) < 100), key=str)
    assert [w for w in whole if w[1] < 100] == want
    assert QUERIES[query](spark, sf_dir(documents=empty(spark))).count() == 0


def test_best_fit_decreasing_equals_a_plain_search():
    rng = np.random.default_rng(2)
    for capacity in (1, 7, 64, 100):
        lengths = rng.integers(1, capacity + 1, size=300).tolist()
        room, want = [], []
        for i in sorted(range(300), key=lambda i: -lengths[i]):
            fits = [r for r in range(len(room)) if room[r] >= lengths[i]]
            if not fits:
                room.append(capacity)
                want.append([])
                fits = [len(room) - 1]
            best = min(fits, key=lambda r: room[r])
            room[best] -= lengths[i]
            want[best].append(i)
        got = binpack.best_fit_decreasing(lengths, capacity)
        assert sorted(i for r in got for i in r) == list(range(300))
        assert all(sum(lengths[i] for i in r) <= capacity for r in got)
        assert sorted(sum(lengths[i] for i in r) for r in got) == sorted(sum(lengths[i] for i in r) for r in want)


def test_matrix_rows(spark):
    df = spark.createDataFrame([(i, "word " * i) for i in range(1, 60)], "doc_id bigint, text string").coalesce(1)
    rows = binpack.pack_matrix(df, capacity=64).collect()
    for r in rows:
        ids, pos = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.positions, "<u4")
        assert len(ids) == len(pos) == 64 and r.cu_seqlens[0] == 0 and len(r.cu_seqlens) == len(r.doc_ids) + 1
        for a, b in zip(r.cu_seqlens, r.cu_seqlens[1:]):
            assert pos[a:b].tolist() == list(range(b - a))
        assert pos.max() < 64 and len(r.starts) == len(r.doc_ids)
        assert (ids[r.cu_seqlens[-1]:] == binpack.PAD).all() and (pos[r.cu_seqlens[-1]:] == 0).all()
