"""Rows that arrive in parts: late ones, repeated batches, equal times, failures in between."""

from __future__ import annotations

import random
import threading
from datetime import datetime, timedelta

import pytest

from trafficlens import session
from trafficlens.operators import rules
from trafficlens.sources import batches, readers, schemas
from trafficlens.streaming import gaps, incremental

START = datetime(2024, 3, 1)
SCHEMA = "id long, timestamp timestamp_ntz, source_ip string, packet_size double"


def packets(n=400, seed=2):
    r = random.Random(seed)
    return [(i, START + timedelta(seconds=60 * i + r.randrange(50)), r.choice(["a", "b", "c", "c", "c"]), float(r.randrange(1, 6000))) for i in range(n)]


def streamed(spark, place, parts, per_trigger=1):
    """The parts as a stream of one file each, in the order given."""
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{place}/in")
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", per_trigger).parquet(f"{place}/in")


def label_rows(spark, place, stream):
    found = gaps.rule_label_stream(stream, delay="10 minutes")
    found.writeStream.format("parquet").option("path", f"{place}/out").option("checkpointLocation", f"{place}/check").trigger(
        availableNow=True).start().awaitTermination()
    return {r["id"]: (r["source_id"], r["diff_seconds"], r["anomaly_flag"]) for r in spark.read.parquet(f"{place}/out").collect()}


def test_labels_across_micro_batches_equal_the_batch_labels(spark, tmp_path):
    rows, place = packets(), str(tmp_path)
    r = random.Random(0)
    parts = []
    for i in range(0, len(rows), 100):
        part = rows[i : i + 100]
        r.shuffle(part)
        parts.append(part)
    # Swap rows over the borders of files, by less than the delay.
    for first, second in zip(parts, parts[1:]):
        moved = [x for x in first if x[1] > max(y[1] for y in first) - timedelta(minutes=4)]
        first[:] = [x for x in first if x not in moved]
        second += moved
    got = label_rows(spark, place, streamed(spark, place, parts))
    want = rules.rule_labels(spark.createDataFrame(rows, SCHEMA)).collect()
    bound = max(x[1] for x in rows) - timedelta(minutes=10)
    closed = {w["id"]: (w["source_ip"], pytest.approx(w["diff_seconds"]), w["anomaly_flag"]) for w in want if w["timestamp"] < bound - timedelta(seconds=1)}
    assert len(closed) > 350 and {i: got[i] for i in closed} == closed
    assert all(w["timestamp"] <= bound for w in want if w["id"] in got)


def test_late_rows_and_rows_without_source_are_left_out(spark, tmp_path):
    rows, place = packets(120), str(tmp_path)
    late = (900, START + timedelta(minutes=1, seconds=30), "c", 9000.0)
    lost = [(901, START + timedelta(minutes=50), None, 1.0), (902, None, "a", 1.0)]
    got = label_rows(spark, place, streamed(spark, place, [rows[:60] + lost, rows[60:], [late]]))
    without = {w["id"]: w["diff_seconds"] for w in rules.rule_labels(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not {900, 901, 902} & set(got)
    assert got and all(got[i][1] == pytest.approx(without[i]) for i in got)


def hours(df):
    return sorted((r["hour"], r["packet_count"], round(r["total_packet_size"] or 0, 6), r["min_packet_size"], r["max_packet_size"]) for r in df.collect())


def test_hours_are_corrected_by_late_rows_in_any_order(spark, tmp_path):
    rows = [*packets(300), (999, None, "a", 5.0), (998, START, "a", float("nan"))]
    whole = hours(incremental.partial_hours(spark.createDataFrame(rows, SCHEMA), "timestamp", "packet_size"))
    for seed in (1, 2):
        place = str(tmp_path / str(seed))
        mixed = random.Random(seed).sample(rows, len(rows))
        run = lambda s, p=place: incremental.merge_hours(s, f"{p}/out", f"{p}/check", "timestamp", "packet_size").awaitTermination()
        run(streamed(spark, place, [mixed[:100], mixed[100:150]]))
        incremental.compact_hours(spark, f"{place}/out")
        run(streamed(spark, place, [mixed[150:]]))
        assert hours(incremental.read_hours(spark, f"{place}/out")) == whole
        # A batch that is run again replaces itself; one that did not end is not read.
        again = spark.createDataFrame(mixed[150:], SCHEMA)
        incremental.partial_hours(again, "timestamp", "packet_size").write.mode("overwrite").parquet(f"{place}/out/batches/batch=2")
        (tmp_path / str(seed) / "out" / "merged" / "upto=7").mkdir()
        assert hours(incremental.read_hours(spark, f"{place}/out")) == whole
        incremental.compact_hours(spark, f"{place}/out")
        assert hours(incremental.read_hours(spark, f"{place}/out")) == whole


def test_batches_count_once_and_only_when_whole(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "table")
    df = spark.createDataFrame([(1, 1.0, "x"), (2, None, "y"), (3, float("nan"), "z")], "id long, v double, t string")
    with pytest.raises(ValueError):
        batches.read_batches(spark, root)
    failing = df.selectExpr("id", "v", "raise_error('broken') AS t")
    with pytest.raises(Exception):  # noqa: B017
        batches.append_batch(failing, root, "a", ["v"])
    assert batches.committed(spark, root) == []
    assert batches.append_batch(df, root, "a", ["v"]) is True
    assert batches.append_batch(df, root, "a", ["v"]) is False
    assert batches.append_batch(df.filter("id = 1").withColumn("id", df.id + 10), root, "b", ["v"]) is True
    assert sorted(r["id"] for r in batches.read_batches(spark, root).collect()) == [1, 11]
    assert sorted(r["id"] for r in batches.read_batches(spark, root, False).collect()) == [2, 3]
    assert batches.read_batches(spark, root).columns == ["id", "v", "t"]
    with pytest.raises(ValueError):
        batches.append_batch(df, root, "../b", ["v"])


def test_composite_mark_takes_rows_of_the_marks_own_time(spark):
    kind = "t timestamp_ntz, id long"
    at = [START + timedelta(hours=h) for h in range(3)]
    nothing = spark.createDataFrame([], kind)
    first = readers.rows_since(spark.createDataFrame([(at[0], 1), (at[1], 2), (None, 9)], kind), nothing, "t", "id")
    mark = readers.composite_mark(first, "t", "id", nothing)
    assert sorted(r["id"] for r in first.collect()) == [1, 2] and [tuple(r) for r in mark.collect()] == [(at[1], 2)]
    everything = spark.createDataFrame([(at[0], 1), (at[1], 2), (at[1], 3), (at[2], 4), (None, 9)], kind)
    second = readers.rows_since(everything, mark, "t", "id")
    assert sorted(r["id"] for r in second.collect()) == [3, 4]
    # A load that brings rows of the mark's time only adds to it; an empty one keeps it.
    more = readers.composite_mark(everything.filter("id = 3"), "t", "id", mark)
    assert sorted(r["id"] for r in more.collect()) == [2, 3]
    assert sorted(r["id"] for r in readers.composite_mark(nothing, "t", "id", more).collect()) == [2, 3]


def test_codes_stay_text(spark, tmp_path):
    lines = ["zip;unit;phone;big;plain;real;science;odd;neg", "007;1D;+49;12345678901234567890;7;1.5;1.0E10;NaN;-3", "012;2F;+1;1;0;.5;2e-3;2.5;0", "1;3;4;2;-12;0.0;5;-Infinity;14"]
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n")
    found = {f.name: f.dataType.simpleString() for f in schemas.infer_csv_schema(spark, str(tmp_path / "in.csv"))}
    assert found == {"zip": "string", "unit": "string", "phone": "string", "big": "string", "plain": "bigint", "real": "double", "science": "double",
                     "odd": "double", "neg": "bigint"}


def test_jobs_in_two_threads_remove_their_own_tables_only(spark):
    done, kept, errors = threading.Event(), [], []

    def other():
        try:
            with session.scratch(spark):
                kept.append(session.materialize(spark.range(5), "other"))
                done.wait(60)
                assert kept[0].count() == 5
        except Exception as error:  # noqa: BLE001
            errors.append(error)
            done.set()

    thread = threading.Thread(target=other)
    with session.scratch(spark):
        thread.start()
        while not kept and not errors:
            done.wait(0.1)
        session.materialize(spark.range(3), "mine")
    done.set()
    thread.join(60)
    assert not errors
