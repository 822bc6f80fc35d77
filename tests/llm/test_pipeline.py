"""The pipeline against its stages' rules applied in plain Python."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from clientlens.llm import common, langid, quality

from .helpers import awkward, empty, sf_dir
from .test_decontam import _brute as benchmark_hits
from .test_neardup import _brute_classes
from .test_packing import _by_document, _ids
from .test_quality import _brute as quality_figures

SF = "/root/testdata/sf0.001"


def _good(text):
    f = quality_figures(text)
    over = any(100 * f[f"dup_{n}gram_chars"] > pct * f["word_chars"] for n, pct in quality.COVERAGE_PCT.items())
    return not (f["n_words"] < 10 or 100 * f["n_repeat_words"] > 20 * f["n_words"] or over
                or 100 * f["dup_line_chars"] > quality.LINE_CHARS_PCT * f["word_chars"]
                or 100 * f["n_symbols"] > quality.SYMBOLS_PCT * f["n_words"])


def test_stages_equal_plain_python(spark):
    docs = common.table(spark, SF, "documents").limit(150)          # a fixture: brute force compares all pairs
    bench = common.table(spark, SF, "benchmark")
    d = sf_dir(documents=docs, benchmark=bench)
    docs = common.table(spark, d, "documents")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    items = [(r.item_id, r.text) for r in bench.collect()]
    frames = {}
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        now = common.written(stage(spark, now, d), "test-stage")
        frames[name] = now
        if name != "packing":
            assert now.columns == docs.columns
    kept = [r for r in rows if _good(r[1])]
    assert sorted(r.doc_id for r in frames["quality rules"].collect()) == [i for i, _ in kept]
    model = langid.fit(frames["quality rules"].filter(~langid.held_out(F.col("doc_id"))))
    kept = [r for r, p in zip(kept, model.predict([t for _, t in kept])) if not p[2]]
    assert sorted(r.doc_id for r in frames["language id"].collect()) == [i for i, _ in kept]
    kept = [r for i, (r, c) in enumerate(zip(kept, _brute_classes(kept))) if i == c]
    assert sorted(r.doc_id for r in frames["near-duplicate removal"].collect()) == [i for i, _ in kept]
    kept = [r for r in kept if not benchmark_hits(r[1], items)[1]]
    assert sorted(r.doc_id for r in frames["benchmark decontamination"].collect()) == [i for i, _ in kept]
    assert 0 < len(kept) < len(rows)
    assert _by_document(frames["packing"].collect()) == {i: _ids(t) for i, t in kept}
    assert np.array_equal(sorted(r.doc_id for r in corpus_pipeline.run(spark, d).select("doc_id").distinct().collect()),
                          [i for i, _ in kept])


def test_awkward_and_empty_documents(spark):
    bench = spark.createDataFrame([(1, "a row without an id but with words")], "item_id bigint, text string")
    cols = [F.lit("aa").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars")]
    rows = awkward(spark, extra=False).select("doc_id", "text", *cols)
    left = corpus_pipeline.run(spark, sf_dir(documents=rows, benchmark=bench)).select("doc_id").distinct().collect()
    assert [r.doc_id for r in left] == [1]           # 6 repeats one word's letters: far from the language of the others
    none = empty(spark).select("doc_id", "text", *cols)
    assert corpus_pipeline.run(spark, sf_dir(documents=none, benchmark=bench.limit(0))).count() == 0
