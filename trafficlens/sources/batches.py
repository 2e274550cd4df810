"""Batches that are stored whole or not at all, and only once.

A batch's good and bad rows are written by one job into a folder of that attempt; the batch counts
from the moment its marker file exists, which names the folder. A failure before that leaves
nothing that a reader sees, and a batch whose marker exists is not written again.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.functions import columns as fx

COMPLETE = "_complete"


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def append_batch(df: DataFrame, root: str, batch_id: str, required: Sequence[str]) -> bool:
    """Store a batch; False if it is stored already. Rows that lack a required value are kept apart.

    The input is evaluated once. NaN counts as a missing value.
    """
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9.-]*", batch_id):
        raise ValueError(f"a batch id holds letters, digits, dots and hyphens, not {batch_id!r}")
    spark = df.sparkSession
    files, marker = _place(spark, f"{root}/committed/{batch_id}")
    if files.exists(marker):
        return False
    complete = F.lit(True)
    for name in required:
        value = fx.named(name)
        present = value.isNotNull()
        if df.schema[name].dataType.typeName() in ("double", "float"):
            present = present & ~F.isnan(value)
        complete = complete & present
    attempt = f"batch={batch_id}/attempt={uuid.uuid4().hex}"
    df.withColumn(COMPLETE, complete).write.partitionBy(COMPLETE).parquet(f"{root}/batches/{attempt}")
    return commit(spark, root, batch_id, attempt)


def commit(spark: SparkSession, root: str, batch_id: str, attempt: str) -> bool:
    """Make a written attempt the batch's rows; False if another attempt is."""
    files, marker = _place(spark, f"{root}/committed/{batch_id}")
    # Creating without overwriting succeeds for one writer only.
    try:
        out = files.create(marker, False)
    except Exception:
        if files.exists(marker):
            return False
        raise
    out.write(bytearray(attempt.encode()))
    out.close()
    return True


def committed(spark: SparkSession, root: str) -> list[str]:
    """Folders of the stored batches, one short line each."""
    files, place = _place(spark, f"{root}/committed")
    if not files.exists(place):
        return []
    return sorted(r["value"] for r in spark.read.text(f"{root}/committed").collect() if r["value"])


def read_batches(spark: SparkSession, root: str, complete: bool = True) -> DataFrame:
    """Good rows, or else those that lack a required value, of all stored batches."""
    folders = committed(spark, root)
    if not folders:
        raise ValueError(f"no batch is stored under {root}")
    rows = spark.read.option("basePath", f"{root}/batches").parquet(*[f"{root}/batches/{f}" for f in folders])
    return rows.filter(F.col(COMPLETE) == complete).drop("batch", "attempt", COMPLETE)
