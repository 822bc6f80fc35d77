"""Registered queries of the corpus operators, each over its whole table, and
their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientlens.llm import (binpack, common, decontam, langid, lexical, licenses, neardup, packing, quality, sharding,
                            simhash, urlgraph, warc, whitening)

Query = Callable[[SparkSession, str], DataFrame]


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside windows of the benchmark items."""
    found, hits = decontam.find(common.table(spark, sf_dir, "documents").select("doc_id", "text"),
                                common.table(spark, sf_dir, "benchmark"))
    h = F.col(hits)
    n_hit = F.aggregate(h["spans"], F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return found.select("doc_id", h["n_words"].alias("n_words"), n_hit.alias("n_hit"),
                        F.size(h["items"]).cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort(h["items"]), ","), 256).alias("items_sha256"),
                        (F.size(h["spans"]) > 0).alias("contaminated"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page: its rule's, else its host's."""
    return urlgraph.judge(common.table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; a third of them is held out of the fit."""
    docs = common.table(spark, sf_dir, "documents")
    out = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs.filter(~out))
    marked, found = langid.identify(docs.select("doc_id", "text"), model)
    f = F.col(found)
    return marked.select("doc_id", out.alias("held_out"), f["lang"].alias("lang_pred"), f["score"].alias("score"),
                         f["rejected"].alias("rejected"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return neardup.near_duplicates(common.table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and the repetition-coverage verdict of every document."""
    judged, verdict = quality.judge(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    v = F.col(verdict)
    return judged.select("doc_id", *[v[c].alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licences that every document states."""
    scanned, result = licenses.scan(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    r = F.col(result)
    return scanned.select("doc_id", r["sentences"].alias("n_sentences"), F.size(r["known"]).cast("long").alias("n_known"),
                          F.array_join(r["known"], ",").alias("sentence_ids"), F.array_join(r["licenses"], ",").alias("licenses"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived, and the archives read back in splits."""
    pages = common.table(spark, sf_dir, "pages")
    kind = dict(pages.dtypes)["page_id"]
    return warc.archive_and_read(pages).select(
        F.col("page").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt to 16 shards by a uniform shuffle with exact counts."""
    docs = common.table(spark, sf_dir, "documents")
    dealt = sharding.shard(docs.select("doc_id", "text"))
    placed = F.col([c for c in dealt.columns if c not in ("doc_id", "text")][0])
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return dealt.select("doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
                        F.lit("rows").alias("law"), placed["shard"].alias("shard"), placed["slot"].alias("slot"),
                        F.lit(None).cast("int").alias("grown_shard"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed along the Hilbert curve of their hashed vectors."""
    return _pieces(packing.pack(common.table(spark, sf_dir, "documents")))


def op10_token_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed id matrix of all documents, cut into its segments again."""
    return _pieces(binpack.pieces(binpack.pack_matrix(common.table(spark, sf_dir, "documents"))), "first_position")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened coordinates of every embedding."""
    rows, name, fit = whitening.whiten(common.table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding",
                                       components=whitening.COMPONENTS)
    w = F.col(name)
    each = rows.select("vec_id", w["deviation"].alias("deviation"), F.posexplode(w["whitened"]).alias("at", "whitened"))
    shares = [float(x) for x in fit.explained] if fit else [0.0]
    return each.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(fit.n if fit else 0).cast("long").alias("n"),
                       "deviation", "whitened", F.element_at(F.array(*map(F.lit, shares)), F.col("at") + 1).alias("explained"),
                       F.lit(fit.error if fit else 0.0).alias("identity_error"))


def op12_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(common.table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    docs = common.table(spark, sf_dir, "documents")
    return lexical.search(lexical.build(docs), docs, common.table(spark, sf_dir, "benchmark"))


def _pieces(pieces: DataFrame, *more: str) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", *more)


QUERIES: dict[str, Query] = {
    name: fn for name, fn in list(globals().items()) if name.startswith("op") and name[2:3].isdigit() and callable(fn)
}
