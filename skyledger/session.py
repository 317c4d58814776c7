"""Session settings and the shared folder used for staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = 8, app: str = "skyledger", **conf: str) -> SparkSession:
    """A session for tests and single-machine runs; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Cleaning alone compiles more classes than the default cache of 100 holds.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where that is unset, a checkpoint folder set on the context counts; only a
    local master may fall back to a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path below one folder per application, which can be dropped when the application is done."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/skyledger/{application}/{label}-{uuid.uuid4().hex[:12]}"


# Folders that a task writes side by side; rows of more folders than that are sorted by them first.
OPEN_FOLDERS = "spark.sql.maxConcurrentOutputFileWriters", "4"


@contextmanager
def _unsorted_folders(spark: SparkSession) -> Iterator[None]:
    key, most = OPEN_FOLDERS
    before = spark.conf.get(key, None)
    spark.conf.set(key, most)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stage(df: DataFrame, label: str, *layout: str) -> DataFrame:
    """Cut the lineage: write a table once, hand back its scan.

    A written table survives lost executors, and unlike a checkpointed RDD its
    readers still prune columns and push filters down. ``layout`` names columns
    whose values, a few, get a folder each, for readers that want one value.
    """
    path = fresh_path(df.sparkSession, label)
    if layout:
        with _unsorted_folders(df.sparkSession):
            df.write.partitionBy(*layout).parquet(path)
    else:
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def overlapping(action: Callable, items: Iterable, workers: int = 6) -> list:
    """Run independent small jobs side by side, so the cluster is not idle between them."""
    with ThreadPoolExecutor(workers) as pool:
        return list(pool.map(action, items))


def stage_all(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    staged = overlapping(lambda item: stage(item[1], item[0]), tables.items())
    return dict(zip(tables, staged))
