"""File sources and sinks (S-01...S-07): typed CSV and JSON tables, append logs, and the state of a snapshot of tables."""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.operators.facts import records_of, set_hash

#: Null has a sign of its own, so that it and empty text stay apart.
CSV = {"header": "true", "escape": '"', "multiLine": "true", "encoding": "UTF-8", "nullValue": r"\N"}


def text_schema(*names: str) -> StructType:
    """A schema of nullable strings."""
    return StructType([StructField(n, StringType()) for n in names])


#: S-06: tables that are kept as files, by name; all columns are text, as they were collected.
CATALOGUE: dict[str, StructType] = {
    "items": text_schema("Item_ID", "Source_ID", "Published_Date", "Organisation", "Threat", "Sector", "Location", "Title", "Public_Link"),
    "incidents": text_schema("Incident_ID", "Organisation", "Best_Date", "Threat", "Sector", "Location", "Item_IDs"),
    "registry": text_schema("Incident_ID", "Anchor_Item_ID", "Redirect_To", "First_Seen"),
    "facts": text_schema("Item_ID", "Source_ID", "Summary", "Rich_Facts_JSON", "Content_Hash"),
    "provenance": text_schema("Item_ID", "Field", "Previous_Value", "Final_Value", "Origin", "Decision"),
    "runs": text_schema("Run_ID", "As_Of", "Mode", "Items", "Incidents"),
}


def _missing(e: AnalysisException) -> bool:
    return e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """S-01: a CSV table of a schema, by column name; a missing path is an empty table, a missing column is null."""
    try:
        rows = spark.read.options(**CSV).csv(path)
    except AnalysisException as e:
        if not _missing(e):
            raise
        return spark.createDataFrame([], schema)
    there = set(rows.columns)
    return rows.select(*[(F.col(f"`{f.name}`") if f.name in there else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def write_csv(df: DataFrame, path: str, schema: StructType, mode: str = "overwrite") -> None:
    """S-02: the schema's columns in its order. Spark commits the files of a job together."""
    df.select(schema.names).write.options(**CSV, emptyValue='""').mode(mode).csv(path)


def append_csv(df: DataFrame, path: str, schema: StructType) -> None:
    """S-05: rows added to a log."""
    write_csv(df, path, schema, "append")


def write_json(df: DataFrame, path: str) -> None:
    """S-03: one object a line with sorted keys; null fields are left out."""
    df.select(*sorted(df.columns)).write.mode("overwrite").json(path)


def read_json_records(spark: SparkSession, path: str, schema: StructType, containers: tuple[str, ...] = ("incidents", "records", "items")) -> DataFrame:
    """S-04: records of JSON documents (a file each) that are a list or hold one under a container's name."""
    whole = spark.read.option("wholetext", "true").text(path)
    each = whole.select(F.explode(records_of(F.col("value"), containers)).alias("r"))
    return each.select(F.from_json("r", schema).alias("r")).select("r.*")


def load_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """S-06: a table of the catalogue."""
    return read_csv(spark, f"{root}/{name}", CATALOGUE[name])


def save_table(df: DataFrame, root: str, name: str) -> None:
    """S-06: a table of the catalogue, replaced as a whole. Do not give it a frame that reads the same table."""
    write_csv(df, f"{root}/{name}", CATALOGUE[name])


def snapshot_state(spark: SparkSession, root: str, names: tuple[str, ...]) -> DataFrame:
    """S-07: name, rows, digest of tables of the catalogue."""
    each = [set_hash(t, *[F.col(c) for c in t.columns]).withColumn("name", F.lit(n)) for n in names for t in [load_table(spark, root, n)]]
    return reduce(DataFrame.unionByName, each).select("name", "rows", "digest")


def snapshot_faults(spark: SparkSession, root: str, expected: DataFrame) -> DataFrame:
    """S-07: name, fault of tables that differ from the stored state, or that are missing while others are there."""
    names = tuple(r.name for r in expected.select("name").collect())
    now = snapshot_state(spark, root, names).select("name", F.col("rows").alias("_rows"), F.col("digest").alias("_digest"))
    both = expected.join(now, "name")
    fault = F.when((F.col("_rows") == 0) & (F.col("rows") > 0), "MISSING").when(F.col("_rows") != F.col("rows"), "COUNT").when(F.col("_digest") != F.col("digest"), "DIGEST")
    return both.select("name", fault.alias("fault")).filter("fault IS NOT NULL")


def parse_catalogue(text: str) -> list[dict]:
    """S-22: source specs from JSON text; each needs an id, and ids are not repeated."""
    specs = json.loads(text)
    ids = [s["id"] for s in specs]
    if len(ids) != len(set(ids)) or not all(re.fullmatch(r"[A-Z0-9_]+", i) for i in ids):
        raise ValueError("source ids must be upper case and different")
    return specs


def source_table(spark: SparkSession, specs: list[dict]) -> DataFrame:
    """S-22: id, layer, active, kind of the source specs."""
    rows = [(s["id"], s.get("layer", ""), bool(s.get("active", True)), s.get("kind", "")) for s in specs]
    return spark.createDataFrame(rows, "id string, layer string, active boolean, kind string")


def active_sources(sources: DataFrame, layers: list[str] | None = None) -> DataFrame:
    """S-22: active sources, of the given layers if any are given."""
    rows = sources.filter("active")
    return rows.filter(F.col("layer").isin(layers)) if layers else rows
