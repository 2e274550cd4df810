"""Reports that follow new sessions and new scores without reading old sessions.

Under ``root`` every load stores its part of the sums per hour and per endpoint, beside the report
keys of its sessions or the newest score of each scored session. A score changes the anomaly counts
by its difference to the newest score before it, so the parts of all loads add up to the report over
everything. A load counts once, from its marker on. Loads are added by one writer at a time.

As in the views, the newest prediction of the detector counts (anomalous wins at equal times; one
without a time is older than any other), scores of unknown sessions wait for them, repeated session
rows count each, and NaN and infinities are missing in sums and means. Sessions and scores without
an id never meet. A re-scored session reads the keys and newest scores stored so far, which are narrow.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.functions.columns import number_of, percent
from trafficlens.plans.views import DETECTOR, NEVER
from trafficlens.session import materialize
from trafficlens.sources import batches

KEYS = {
    "hours": {"date": F.to_date, "hour": F.hour},
    "endpoints": {"source_ip": "srcIP", "dest_ip": "dstIP", "source_port": "srcPort", "dest_port": "dstPort"},
}
SUMS = ("packets", "bytes", "duration")


def _names() -> list[str]:
    return [name for keys in KEYS.values() for name in keys]


def _report_keys(sessions: DataFrame) -> list[Column]:
    hours = [of("TSesStart").alias(name) for name, of in KEYS["hours"].items()]
    return hours + [F.col(column).alias(name) for name, column in KEYS["endpoints"].items()]


def _place(spark: SparkSession, root: str, kind: str, name: str) -> list[str]:
    """Folders of one table of the stored loads of a kind."""
    return [f"{root}/{name}/{place}" for place in batches.committed(spark, root) if place.startswith(kind)]


def _read(spark: SparkSession, root: str, kind: str, name: str) -> DataFrame | None:
    places = _place(spark, root, kind, name)
    return spark.read.option("recursiveFileLookup", True).parquet(*places) if places else None


def _stored(spark: SparkSession, root: str, load: str) -> bool:
    return any(f"load={load}/" in place for place in batches.committed(spark, root))


def _newest(scores: DataFrame) -> DataFrame:
    """(session_id, rank, flag) with the newest score of each session."""
    return scores.groupBy("session_id").agg(F.max("rank").alias("rank"), F.max_by("flag", "rank").alias("flag"))


def _write(spark: SparkSession, root: str, kind: str, load: str, tables: dict[str, DataFrame]) -> bool:
    place = f"{kind}/load={load}/attempt={uuid.uuid4().hex}"
    for name, rows in tables.items():
        rows.write.parquet(f"{root}/{name}/{place}")
    return batches.commit(spark, root, load, place)


def add_sessions(sessions: DataFrame, root: str, load: str) -> bool:
    """Add new sessions to the reports; False if the load is stored already."""
    spark = sessions.sparkSession
    if _stored(spark, root, load):
        return False

    def amount(*columns: str) -> Column:
        parts = [number_of(sessions, c) for c in columns]
        return sum(parts[1:], parts[0])

    rows = materialize(sessions.select(
        F.col("id").alias("session_id"),
        *_report_keys(sessions),
        F.col("TSesStart").alias("started"),
        amount("PktPerSesIn", "PktPerSesOut").alias("packets"),
        amount("BPerSesIn", "BPerSesOut").alias("bytes"),
        amount("SessDuration").alias("duration"),
    ), "kept-sessions")
    scores = _read(spark, root, "scores", "scores")
    flag = F.lit(0)
    if scores is not None:
        rows, flag = rows.join(_newest(scores).select("session_id", "flag"), "session_id", "left"), F.coalesce("flag", F.lit(0))
    sums = [F.count("*").alias("session_count"), F.sum(flag).alias("anomalies"), F.max("started").alias("last_session_time")]
    for name in SUMS:
        sums += [F.sum(name).alias(name), F.count(name).alias(f"{name}_n")]
    tables = {table: rows.groupBy(*keys).agg(*sums) for table, keys in KEYS.items()}
    return _write(spark, root, "sessions", load, tables | {"keys": rows.select("session_id", *_names())})


def add_scores(predictions: DataFrame, root: str, load: str, model: str = DETECTOR) -> bool:
    """Add predictions, later or earlier ones than those stored; False if the load is stored already."""
    spark = predictions.sparkSession
    if _stored(spark, root, load):
        return False
    time = F.unix_micros(F.col("log_time").cast("timestamp"))
    rank = F.coalesce(2 * time, F.lit(NEVER)) + F.col("prediction")
    rows = predictions.filter((F.col("model_type") == model) & F.col("session_id").isNotNull()).select(
        "session_id", rank.alias("rank"), F.when(F.col("prediction") == 1, 1).otherwise(0).alias("flag"))
    new = _newest(rows)
    before = _read(spark, root, "scores", "scores")
    if before is None:
        changed = new.withColumn("change", F.col("flag"))
    else:
        old = _newest(before).select("session_id", F.col("rank").alias("old_rank"), F.col("flag").alias("old_flag"))
        changed = new.join(old, "session_id", "left").filter("old_rank IS NULL OR rank > old_rank")
        changed = changed.withColumn("change", F.col("flag") - F.coalesce("old_flag", F.lit(0))).drop("old_rank", "old_flag")
    changed = materialize(changed, "kept-scores")
    tables = {"scores": changed.select("session_id", "rank", "flag")}
    keys = _read(spark, root, "sessions", "keys")
    if keys is not None:
        moved = keys.join(changed.filter("change <> 0").select("session_id", "change"), "session_id")
        moved = materialize(moved, "kept-changes")
        for table, names in KEYS.items():
            tables[table] = moved.groupBy(*names).agg(F.sum("change").alias("anomalies"))
        kind = "scores"
    else:
        kind = "scores-waiting"
    return _write(spark, root, kind, load, tables)


def _totals(spark: SparkSession, root: str, table: str) -> DataFrame:
    sessions = _read(spark, root, "sessions", table)
    if sessions is None:
        raise ValueError(f"no sessions are stored under {root}")
    changes = _read(spark, root, "scores/", table)
    parts = sessions if changes is None else sessions.unionByName(changes, allowMissingColumns=True)
    sums = [F.sum(c).alias(c) for c in ("session_count", "anomalies", *SUMS, *[f"{n}_n" for n in SUMS])]
    return parts.groupBy(*KEYS[table]).agg(*sums, F.max("last_session_time").alias("last_session_time"))


def _mean(name: str) -> Column:
    return F.try_divide(F.col(name), F.col(f"{name}_n"))


def traffic_summary(spark: SparkSession, root: str) -> DataFrame:
    """The hourly report over all sessions and scores added so far."""
    return _totals(spark, root, "hours").select(
        "date", "hour", "session_count",
        F.col("packets").alias("total_packets"), F.col("bytes").alias("total_bytes"),
        _mean("packets").alias("avg_packets_per_session"), _mean("bytes").alias("avg_bytes_per_session"),
        F.col("anomalies").alias("anomaly_count"),
        F.round(percent(F.col("anomalies"), F.col("session_count")), 2).alias("anomaly_percentage"),
    )


def session_stats(spark: SparkSession, root: str) -> DataFrame:
    """The report on endpoint pairs with more than one session."""
    return _totals(spark, root, "endpoints").filter("session_count > 1").select(
        *KEYS["endpoints"], "session_count",
        F.col("packets").alias("total_packets"), F.col("bytes").alias("total_bytes"),
        _mean("packets").alias("avg_packets"), _mean("bytes").alias("avg_bytes"), _mean("duration").alias("avg_duration_seconds"),
        F.col("anomalies").alias("anomaly_sessions"), "last_session_time",
        F.round(percent(F.col("anomalies"), F.col("session_count")), 2).alias("anomaly_rate"),
    )
