"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import build_lexicon, decode_ids, encode_texts
from tidemark.llm.decontaminate import contamination_report, decontaminate
from tidemark.llm.embeddings import near_duplicates
from tidemark.llm.filter_audit import audit_filters
from tidemark.llm.html_text import extract_text
from tidemark.llm.lm_score import score_texts
from tidemark.llm.mixing import mix_sources
from tidemark.llm.ngram_join import ngram_components
from tidemark.llm.oracle import ORACLE_SQL as ORACLE_SQL
from tidemark.llm.quality import fit_quality, score_quality
from tidemark.llm.ranked_search import build_index, search
from tidemark.llm.secrets import scan_secrets, secret_report
from tidemark.llm.toxicity import fit_toxicity, fold, score_toxicity
from tidemark.llm.warc import plan_records, read_warc, write_warc
from tidemark.session import scratch_path, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to weights 1, 2, 3, repeating, by source; three epochs at most."""
    # The key stays with the operator: its logarithm may differ in the last bit between engines.
    return mix_sources(table(spark, sf_dir, "documents")).drop("key")


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lattice scores of every document, learned outside fold 0 of 10."""
    held_out = fold(F.col("doc_id"), 10) == 0
    docs = table(spark, sf_dir, "documents")
    scored = score_texts(docs, train=~held_out)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share three quarters of their five-word shingles."""
    return ngram_components(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of 13 words found in every document."""
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return contamination_report(found)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels outside fold 2 of 4."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_toxicity(docs, labels, train=fold(F.col("doc_id"), 4) != 2)
    return score_toxicity(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_windows", "n_hits",
    )


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings of equal label at cosine 0.98."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probability of every document, learned from ratings outside fold 2 of 4."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_quality(docs, labels, train=fold(F.col("doc_id"), 4) != 2)
    return score_quality(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "expected_grade", "tail_probability"
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back."""
    path = scratch_path(spark, "warc")
    write_warc(plan_records(table(spark, sf_dir, "pages")), path)
    return read_warc(spark, path).drop("url")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and spans of secrets in every document."""
    return secret_report(scan_secrets(table(spark, sf_dir, "documents")))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_text(table(spark, sf_dir, "pages"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return search(build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all orders over all documents, by language."""
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the text they decode to."""
    docs = table(spark, sf_dir, "documents")
    decoded = decode_ids(encode_texts(docs, build_lexicon(docs)))
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_mixing": op1_mixing,
    "op2_lm_score": op2_lm_score,
    "op3_ngram_join": op3_ngram_join,
    "op4_decontamination": op4_decontamination,
    "op5_toxicity": op5_toxicity,
    "op6_embeddings": op6_embeddings,
    "op7_quality": op7_quality,
    "op8_warc": op8_warc,
    "op9_secrets": op9_secrets,
    "op10_html": op10_html,
    "op11_search": op11_search,
    "op12_filter_audit": op12_filter_audit,
    "op13_bpe": op13_bpe,
}
