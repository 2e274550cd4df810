"""Session setup, shared working folder and size-checked broadcasts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"
BROADCAST_MAX_ROWS = 200_000
SPREAD_MAX_ROWS = 5_000_000
SPREAD_ROWS_PER_TASK = 2_000


def build_session(
    cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "trafficlens", **settings: str
) -> SparkSession:
    """Local session for tests and the benchmark. On a cluster pass the cluster's own session.

    Further settings are given with underscores for dots.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name.replace("_", "."), value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by the session, else one beside the session's warehouse tables."""
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
        local = (spark.conf.get("spark.master", None) or "local").startswith("local")
        if not local and folder.startswith("file:"):
            raise ValueError(f"name a shared folder in {CHECKPOINT_CONF}: executors do not share {folder}")
    return folder.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a result must stay identical between two uses (range boundaries,
    model scores). A written table survives lost executors and keeps column pruning.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"
    for made in _open_scratch.get():
        made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: The open blocks of this thread or task, so that jobs side by side keep to their own tables.
_open_scratch: ContextVar[tuple[list[str], ...]] = ContextVar("open_scratch", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that :func:`materialize` writes inside the block, when it ends.

    For jobs whose results are stored elsewhere; a frame that still reads such a table cannot
    be used afterwards.
    """
    made: list[str] = []
    before = _open_scratch.set((*_open_scratch.get(), made))
    try:
        yield
    finally:
        _open_scratch.reset(before)
        for path in made:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Hint a broadcast only after counting; larger inputs keep Spark's own join choice.

    ``df`` is evaluated by the check, so pass a materialized or cheap table.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def spread(df: DataFrame, rows: int) -> DataFrame:
    """Spread a small input over the cores before heavy per-row work.

    A small table often sits in one file and so in one task. Large inputs are split
    by the scan already and are not shuffled.
    """
    tasks = min(df.sparkSession.sparkContext.defaultParallelism, rows // SPREAD_ROWS_PER_TASK)
    return df.repartition(tasks) if 1 < tasks and rows <= SPREAD_MAX_ROWS else df
