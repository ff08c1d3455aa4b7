"""Session helpers shared by every module: builder, table access, lineage cuts, measured broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session with adaptive execution and a UTC clock; `conf` overrides any setting."""
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    return SparkSession.builder.master(master).config(map=settings).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Only a local session may do without and gets one of its own."""
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for a written table."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Compute `df` once and cut its lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _width(df: DataFrame) -> Column:
    """About how many bytes a row of `df` takes: 16 a column, and what strings, binaries and nested values hold."""
    total = F.lit(16 * len(df.columns)).cast("long")
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(column), F.lit(0))
        elif kind.startswith("array") and "<" not in kind[6:]:
            total = total + F.greatest(F.size(column), F.lit(0)) * 16
        elif "<" in kind:
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) * 2
    return total


def measured_broadcast(small: DataFrame, max_rows: int = 1_000_000, max_bytes: int = 64 << 20) -> DataFrame:
    """`small` with a broadcast hint if it has at most `max_rows` rows and about `max_bytes` bytes, else as it is.

    Give it a checkpointed frame: measuring is an action.
    """
    n, size = small.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(_width(small)), F.lit(0))).first()
    return F.broadcast(small) if n <= max_rows and size <= max_bytes else small
