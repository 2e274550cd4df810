"""Rule labels on arriving rows: the gap to the former row of a source, across micro-batches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from trafficlens.operators import rules
from trafficlens.streaming.incremental import with_event_time

STATE = "last long, ats array<long>, ids array<long>, sizes array<double>"
ROWS = "id long, source_id {source}, at long, packet_size double, diff_seconds double"


def _gaps(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Keep rows until the watermark has passed them, then give them out in order of time and id."""
    last, ats, ids, sizes = state.get if state.exists else (None, [], [], [])
    held = list(zip(ats, ids, sizes))
    for part in parts:
        held += zip(part["at"].tolist(), part["id"].tolist(), part["packet_size"].tolist())
    # Rows at the watermark itself may still have company.
    passed = state.getCurrentWatermarkMs() * 1000
    held.sort(key=lambda r: r[:2])
    ready = [r for r in held if r[0] < passed]
    rest = held[len(ready) :]
    out = []
    for at, row, size in ready:
        out.append((row, key[0], at, size, 0.0 if last is None else (at - last) / 1e6))
        last = at
    if rest:
        state.setTimeoutTimestamp(max(rest[0][0] // 1000 + 1, passed // 1000 + 1))
    state.update((last, [r[0] for r in rest], [r[1] for r in rest], [r[2] for r in rest]))
    if out:
        yield pd.DataFrame(out, columns=["id", "source_id", "at", "packet_size", "diff_seconds"])


def rule_label_stream(
    stream: DataFrame, source: str = "source_ip", time_column: str = "timestamp", size: str = "packet_size", row_id: str = "id",
    delay: str = "2 hours", large: float = rules.LARGE_PACKET, small: float = rules.SMALL_PACKET, rapid: float = rules.RAPID_GAP_SECONDS,
) -> DataFrame:
    """Labels of all rows that the watermark has passed, equal to the batch labels of these rows.

    The state of a source is its last instant and the rows younger than the watermark, so it is bounded by
    the rows of one source within ``delay``. Rows that come more than ``delay`` late are left out, and
    so are rows without a source or a time. A source's state stays; it is one number once its rows are out.
    """
    kind = stream.schema[source].dataType.simpleString()
    timed = with_event_time(stream, time_column, delay).filter(F.col(source).isNotNull() & F.col(time_column).isNotNull())
    rows = timed.select(
        F.col(source).alias("source_id"), F.col(row_id).cast("long").alias("id"), F.unix_micros(time_column).alias("at"),
        F.col(size).cast("double").alias("packet_size"), F.col(time_column).alias("event_time"))
    found = rows.groupBy("source_id").applyInPandasWithState(
        _gaps, T._parse_datatype_string(ROWS.format(source=kind)), T._parse_datatype_string(STATE), "append", GroupStateTimeout.EventTimeTimeout)
    labelled = rules.label_gaps(found, "packet_size", large, small, rapid)
    return labelled.withColumn(time_column, F.timestamp_micros("at")).drop("at")
