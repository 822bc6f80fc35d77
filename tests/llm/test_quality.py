import re
from collections import Counter

import numpy as np

from clientlens.llm import quality
from .helpers import awkward, empty


def _brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    out = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or ""))}
    seen, dup, chars = set(), 0, 0
    for line in (text or "").split("\n"):
        own = re.findall(r"[^\x20\x09-\x0D]+", line)
        if own and line in seen:
            dup, chars = dup + 1, chars + sum(map(len, own))
        seen.add(line)
    out |= {"n_dup_lines": dup, "dup_line_chars": chars}
    for n in quality.COVERAGE_PCT:
        grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
        many = Counter(grams)
        inside = {i + j for i, g in enumerate(grams) if many[g] > 1 for j in range(n)}
        out[f"dup_{n}gram_chars"] = sum(len(words[i]) for i in inside)
        if n == quality.BASE_N:
            out["n_repeat_words"] = len(inside)
    return out


def _texts():
    rng = np.random.default_rng(0)
    texts = [None, "", " \n", "one", "a b c d e a b c d e", "x\x0by\x0cz w", "läne\nläne\nläne\n\n\nother\nläne ",
             "# $ % | <a> & *"]
    for _ in range(30):
        texts.append("".join(f"w{rng.integers(6)}" + rng.choice([" ", "\n", "\t", "  "]) for _ in range(rng.integers(1, 120))))
    return texts


def test_measure_equals_brute_force():
    texts = _texts()
    got = quality.measure([None if t is None else t.encode() for t in texts])
    for i, t in enumerate(texts):
        assert {f: int(got[f][i]) for f in quality.FIELDS} == _brute(t), t


def test_verdicts(spark):
    clean = " ".join(f"word{i}" for i in range(50))
    rows = [(1, clean), (2, clean + "\n" + clean), (3, "short text"), (4, None), (5, clean + "".join(f" #{i}#" for i in range(20))), (5, clean)]
    judged, verdict = quality.judge(awkward(spark, rows))
    got = {(r.doc_id, r.text): r[verdict] for r in judged.collect()}
    assert got[1, clean].kept and not got[1, clean].failed
    assert got[2, clean + "\n" + clean].base_failed and not got[2, clean + "\n" + clean].kept
    assert got[3, "short text"].base_failed and got[4, None].base_failed
    assert got[5, rows[4][1]].failed == ["n_symbols"] and not got[5, rows[4][1]].base_failed
    kept = quality.keep_good(awkward(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 5] and kept.columns == awkward(spark, rows).columns


def test_awkward_and_empty(spark):
    assert sorted(r.doc_id for r in quality.keep_good(awkward(spark)).collect()) == [1, 1, 6]
    assert quality.keep_good(empty(spark)).count() == 0


def _words(first, n):
    return [f"{first}{i}" for i in range(n)]


def test_each_coverage_rule_decides(spark):
    """Texts that pass the base rules and break one kind of limit, and the same in short."""
    # a run of k words twice in a text of many: for k words only windows of up to k repeat
    def twice(k, share, word="w"):
        n = round(2 * k / share)
        run = _words("longish" + word, k)
        return " ".join(run + _words("x", (n - 2 * k) // 2) + run + _words("y", (n - 2 * k) // 2))
    rows = [(k, twice(k, 0.18)) for k in (5, 6, 7, 8, 9)] + [(10, twice(10, 0.15)), (50, twice(50, 0.15))]
    line = " ".join(_words("line", 4))
    rows.append((100, "\n".join(" ".join(_words(f"a{i}", 6)) + "\n" + line for i in range(60))))
    sentence = " ".join(_words("s", 9))
    rows.append((200, f"{sentence} " + " ".join(_words("t", 76)) + f" {sentence}"))     # a short text states one sentence twice
    judged, verdict = quality.judge(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = {r.doc_id: r[verdict] for r in judged.collect()}
    assert not any(v.base_failed for v in got.values())
    for k in (5, 6, 7, 8, 9, 10):
        # the rule for k words is the longest that such a text can break
        assert f"dup_{k}gram_chars" in got[k].failed and not got[k].kept
        assert not {f"dup_{n}gram_chars" for n in range(k + 1, 11)} & set(got[k].failed)
    assert got[50].failed and "dup_line_chars" in got[100].failed
    assert got[200].kept and got[200].n_words < quality.SHORT_WORDS
