"""Where query modules register their queries and SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None, *tables: str) -> Callable[[Callable[..., DataFrame]], Query]:
    """Registers a function of the named tables, as DataFrames, under `name`, with its SQL."""

    def register(f: Callable[..., DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(*[table(spark, sf_dir, t) for t in tables])
            # Days leave as ISO text, which compares alike in any engine.
            days = [c for c, kind in df.dtypes if kind == "date"]
            return df.withColumns({c: F.col(c).cast("string") for c in days}) if days else df

        run.__name__, run.__doc__ = name, f.__doc__
        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = sql
        return run

    return register
