"""Reading tables and narrowing frames by sets of ids."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Ids that may be sent to every executor: 8 MB of longs. More are joined by a shuffle.
SMALL_IDS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def rows_per_batch(spark: SparkSession, rows: int) -> Iterator[None]:
    """At most so many rows in a batch for the Python workers of what is run inside: memory follows rows times texts."""
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def _side(ids: DataFrame, limit: int) -> DataFrame:
    """A one-column frame of distinct ids, broadcast if it has been counted to be small."""
    ids = ids.toDF("_llm_id")
    return F.broadcast(ids) if ids.count() <= limit else ids


def keep_ids(df: DataFrame, ids: DataFrame, column: str = "doc_id", limit: int = SMALL_IDS) -> DataFrame:
    return df.join(_side(ids, limit), F.col(column) == F.col("_llm_id"), "left_semi")


def drop_ids(df: DataFrame, ids: DataFrame, column: str = "doc_id", limit: int = SMALL_IDS) -> DataFrame:
    """Rows whose id is not among ``ids``; rows with a null id stay."""
    return df.join(_side(ids, limit), F.col(column) == F.col("_llm_id"), "left_anti")
