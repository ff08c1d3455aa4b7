"""The corpus pipeline: documents in, a weighted mix of clean ones out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents:

1. toxicity: documents scored 0.3 or more, learned from the labels table, go;
2. near_duplicates: of each component of the n-gram Jaccard join the smallest doc_id stays;
3. decontamination: contaminated documents (a hit word, and 1 hit in 20 words at least) go;
4. secrets: found secrets are replaced by [SECRET], no document goes;
5. mixing: the words that the mix takes of each document that is left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import contamination_report, decontaminate
from tidemark.llm.mixing import mix_sources
from tidemark.llm.ngram_join import ngram_components
from tidemark.llm.secrets import scan_secrets
from tidemark.llm.toxicity import fit_toxicity, score_toxicity
from tidemark.session import cut, measured_broadcast, scratch_path, table

MARK = "[SECRET]"


def _key() -> Column:
    """What tells rows apart: rows without an id are no repeats of each other, nor are rows of one id with other texts."""
    return F.xxhash64("doc_id", "text")


def _keyed(docs: DataFrame) -> DataFrame:
    """row (the key) and text: all that operators need, so no other column of `docs` can clash with theirs."""
    return docs.select(_key().alias("row"), "text")


def _packed(docs: DataFrame) -> DataFrame:
    """row (the key) and doc, a struct of all columns, whatever their names."""
    return docs.select(_key().alias("row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of `docs` whose key is not among the doc_id of `gone`, which an operator gave for `_keyed` rows."""
    gone = cut(gone.select(F.col("doc_id").alias("row")).distinct())
    return _packed(docs).join(measured_broadcast(gone, 1_000_000), "row", "left_anti").select("doc.*")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects what the compression-distance classifier scores 0.3 or more.

    Null and empty texts get the score of texts without hits and stay; repeated rows are judged alike; an empty table
    stays empty; other columns pass through, whatever their names. The same holds for the next two stages.
    """
    model = fit_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return _without(docs, score_toxicity(_keyed(docs), model, id_col="row").filter("score >= 0.3"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group, one without an id where no other is; of repeated rows, one.

    Null and empty texts are in no group and stay, once for each id where rows repeat.
    """
    groups = cut(ngram_components(_keyed(docs), id_col="row").filter("n_shingles > 0"))
    several = cut(groups.filter("doc_id <> component_id").select("component_id").distinct())
    members = groups.join(measured_broadcast(several, 1_000_000), "component_id", "left_semi").distinct()
    ids = docs.select(_key().alias("row"), F.col("doc_id").alias("id"))
    named = members.join(ids, F.col("doc_id") == F.col("row")).drop("row")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "doc_id"))["doc_id"]
    keepers = named.groupBy("component_id").agg(first.alias("keeper"))
    gone = members.join(keepers, "component_id").filter("doc_id <> keeper")
    again = groups.groupBy("doc_id").count().filter("count > 1").limit(1).count()
    kept = _without(docs, gone)
    return kept.dropDuplicates(["doc_id", "text"]) if again else kept


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the benchmark contaminates. Null and empty texts hold no words and stay."""
    report = contamination_report(decontaminate(_keyed(docs), table(spark, sf_dir, "benchmark"), id_col="row"))
    return _without(docs, report.filter("contaminated"))


def masked(text: Column, found: Column) -> Column:
    """`text` with each maximal run of overlapping spans replaced by MARK. Spans come sorted by start."""
    state = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc: Column, x: Column) -> Column:
        fresh = x["s"] >= acc["at"]
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (x["s"] - acc["at"]).cast("int"))
        return F.struct(
            F.when(fresh, F.concat(acc["out"], gap, F.lit(MARK))).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], x["e"]).alias("at"),
        )

    rest = F.aggregate(found, state, step)
    whole = F.concat(rest["out"], F.substring(text, (rest["at"] + 1).cast("int"), F.length(text)))
    return F.when(F.size(found) > 0, whole).otherwise(text)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in place; n_chars follows the text.

    Texts without secrets, null and empty ones among them, stay as they are; repeated rows are masked alike; an empty
    table stays empty; other columns pass through, whatever their names.
    """
    found = scan_secrets(_keyed(docs), id_col="row").filter(F.size("found") > 0).dropDuplicates(["doc_id"])
    found = cut(found.select(F.col("doc_id").alias("row"), "found"))
    joined = _packed(docs).join(measured_broadcast(found, 1_000_000), "row", "left")
    text, hit = masked(F.col("doc")["text"], F.col("found")), F.col("found").isNotNull()
    shown = joined.select("doc", hit.alias("hit"), F.when(hit, text).otherwise(F.col("doc")["text"]).alias("shown"))
    new = {"text": F.col("shown"), "n_chars": F.when(F.col("hit"), F.length("shown").cast("long")).otherwise(F.col("doc")["n_chars"])}
    return shown.select(*[new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document; sources weigh 1, 2, 3, repeating.

    Null and empty texts have size 0 and nothing is taken of them; a null source is a source of its own; repeated rows
    count each time; an empty table gives an empty mix.
    """
    return mix_sources(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mixing", mixing),
]

#: Compression lengths have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; stages hand over written tables in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
