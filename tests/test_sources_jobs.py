from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from trafficlens.operators import iforest, monitoring, rollups
from trafficlens.plans import jobs, tables
from trafficlens.sources import readers, schemas, writers
from trafficlens.streaming import incremental as inc

T0 = datetime(2025, 12, 10)


def test_infer_and_read_wide_csv(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text(
        "id;srcIP;srcMAC;TSesStart;rate;flag;empty\n"
        "1;10.0.0.1;7;0;1.5;true;\n2;10.0.0.2;8;bad;2;false;\n3;10.0.0.3;9;3600;;true;\n"
    )
    found = schemas.infer_csv_schema(spark, str(path))
    kinds = {f.name: f.dataType.simpleString() for f in found}
    assert kinds == {
        "id": "bigint", "srcIP": "string", "srcMAC": "bigint", "TSesStart": "string", "rate": "double",
        "flag": "boolean", "empty": "string",
    }
    stored = {f.name: f.dataType.simpleString() for f in schemas.storage_schema(found)}
    assert stored["srcMAC"] == "bigint" and stored["flag"] == "int"
    df, bad = readers.split_bad_records(readers.read_wide_csv(spark, str(path), found))
    rows = df.orderBy("id").selectExpr("id", "cast(TSesStart as string) t", "rate").collect()
    assert [tuple(r) for r in rows] == [
        (1, "1970-01-01 00:00:00", 1.5), (2, None, 2.0), (3, "1970-01-01 01:00:00", None),
    ]
    assert bad.count() == 0
    assert [r["flag"] for r in schemas.to_storage(df).orderBy("id").collect()] == [1, 0, 1]


def test_rows_of_another_width_are_set_aside(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("a,b\n1,2\n3\n4,5,6\nx,7\n")
    schema = "a int, b int"
    df = readers.read_csv(spark, str(path), schemas.T.StructType.fromDDL(schema))
    good, bad = readers.split_bad_records(df)
    assert [tuple(r) for r in good.collect()] == [(1, 2)]
    assert good.count() == 1 and [r["a"] for r in good.select("a").collect()] == [1]
    assert bad.count() == 3
    assert sorted(r[readers.BAD_RECORD] for r in bad.collect()) == ["3", "4,5,6", "x,7"]


def test_conform_needs_every_column(spark):
    df = spark.createDataFrame([(1,)], "k int")
    target = schemas.T.StructType.fromDDL("a long, b string")
    got = readers.conform(df, {"a": "k", "b": F.lit("x")}, target)
    assert got.schema.simpleString() == "struct<a:bigint,b:string>" and tuple(got.first()) == (1, "x")
    with pytest.raises(ValueError, match="no mapping for: b"):
        readers.conform(df, {"a": "k"}, target)


def test_high_water_mark_fallback_and_filter(spark):
    df = spark.createDataFrame([(1, T0), (2, T0 + timedelta(hours=1))], "id int, t timestamp")
    empty = df.filter("id > 9")
    assert readers.rows_after(df, "t", readers.high_water_mark(empty, "t", "2020-01-01")).count() == 2
    mark = readers.high_water_mark(df.filter("id = 1"), "t", "2020-01-01")
    assert [r["id"] for r in readers.rows_after(df, "t", mark).collect()] == [2]


def test_literal_mark_reaches_the_scan(spark, folder):
    new = readers.rows_after(tables.traffic(spark, folder), "log_time", "2024-01-20 00:00:00")
    plan = new.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts," in plan and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_load_layouts(spark, tmp_path):
    path = tmp_path / "n.csv"
    path.write_text("source_ip,dest_ip,timestamp,packet_size\na,b,2025-12-10 00:00:00,5\n")
    with open(path, "a") as file:
        file.write("broken line\n")
    aside = str(tmp_path / "aside")
    got, rejected = readers.load_layouts(spark, {"packets": (str(path), schemas.layout("packets"), ["source_ip", "packet_size"])}, aside)
    assert [tuple(r) for r in got["packets"].collect()] == [("a", 5)] and rejected == {"packets": 1}
    assert [r[0] for r in spark.read.parquet(f"{aside}/packets").collect()] == ["broken line"]


def test_types_come_from_all_rows(spark, tmp_path):
    path = tmp_path / "long.csv"
    lines = [f"{i};{i};;x" for i in range(10_000)] + [f"{i};{i}.5;{i};7" for i in range(500)]
    path.write_text("id;a;late;text\n" + "\n".join(lines) + "\n")
    found = schemas.infer_csv_schema(spark, str(path))
    assert [f.dataType.simpleString() for f in found] == ["bigint", "double", "bigint", "string"]
    good, bad = readers.split_bad_records(readers.read_csv(spark, str(path), found, sep=";"))
    assert (good.count(), bad.count(), good.filter("a > -1").count()) == (10_500, 0, 10_500)


def test_count_write_and_filter_agree_on_bad_rows(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("a,b,c\n" + "".join(f"{i},{i}.5,{'x' if i % 3 else 4}\n" for i in range(90)))
    df = readers.read_csv(spark, str(path), schemas.T.StructType.fromDDL("a int, b double, c int"))
    good, bad = readers.split_bad_records(df)
    good.write.parquet(str(tmp_path / "good"))
    kept, rejected = readers.set_aside(df, str(tmp_path / "aside"))
    assert good.count() == kept.count() == spark.read.parquet(str(tmp_path / "good")).count() == 30
    assert bad.count() == rejected == spark.read.parquet(str(tmp_path / "aside")).count() == 60


def test_many_columns_are_inferred_in_one_pass(spark, tmp_path):
    path, names = tmp_path / "wide.csv", [f"c{i}" for i in range(904)]
    path.write_text(";".join(names) + "\n" + "".join(";".join(str(i + j / 2 if i % 2 else j) for i in range(904)) + "\n" for j in range(4)))
    found = schemas.infer_csv_schema(spark, str(path))
    assert {f.dataType.simpleString() for f in found} == {"bigint", "double"} and len(found) == 904


def test_append_quarantine_and_overwrite(spark, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, s string")
    for _ in range(2):
        writers.append_with_quarantine(df, good, bad, ["s"])
    assert spark.read.parquet(good).count() == 2 and spark.read.parquet(bad).count() == 2
    writers.replace_table(df, good)
    assert spark.read.parquet(good).count() == 2


def test_csv_export_and_append(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "a")], "id int, s string")
    writers.export_csv(df, path)
    writers.append_csv(df, path)
    assert spark.read.option("header", True).csv(path).count() == 2


def test_predictions_are_laid_out_by_date(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([(1, T0), (2, T0 + timedelta(days=1))], "session_id int, log_time timestamp")
    writers.write_predictions(df, path)
    assert {p.name for p in Path(path).glob("event_date=*")} == {"event_date=2025-12-10", "event_date=2025-12-11"}


def test_run_log_round_trip(spark, tmp_path):
    path = str(tmp_path / "runs")
    start = datetime(2025, 12, 10, tzinfo=timezone.utc)
    writers.append_run(spark, path, "a", "supervised", start, start + timedelta(seconds=4), True, ["x"], None, {"f1": 1}, {"rows": "9"})
    writers.append_run(spark, path, "b", "unsupervised", start, start + timedelta(seconds=2), False, [], "boom")
    runs = writers.read_runs(spark, path)
    got = monitoring.run_log_summary(runs).first()
    assert (got["total_runs"], got["successful_runs"], got["average_execution_time"], got["last_run"]) == (2, 1, 3.0, "b")
    assert [r["run_id"] for r in monitoring.recent_runs(runs, 1).collect()] == ["b"]
    first = runs.filter("run_id = 'a'").first()
    assert first["steps_completed"] == ["x"] and first["metrics"] == {"f1": 1.0}


def test_metric_history_keeps_newest(spark, tmp_path):
    path = str(tmp_path / "m")
    rows = [(T0 + timedelta(days=i), 0.5, 0.5, 0.5, 0.5, i) for i in range(105)]
    writers.append_metrics(spark.createDataFrame(rows, schemas.layout("performance_history")), path)
    kept = writers.read_metrics(spark, path)
    assert kept.count() == 100 and kept.agg(F.min("sample_size")).first()[0] == 5


def test_missing_tables(spark):
    spark.range(1).createOrReplaceTempView("summary_stats")
    assert schemas.missing_tables(spark, ["summary_stats", "predictions_x"]) == ["predictions_x"]
    spark.catalog.dropTempView("summary_stats")


def test_catalog_table(spark):
    writers.save_catalog_table(spark.range(3), "stored_summary")
    writers.save_catalog_table(spark.range(5), "stored_summary")
    assert spark.table("stored_summary").count() == 5
    assert schemas.missing_tables(spark, ["stored_summary", "absent"]) == ["absent"]
    spark.sql("DROP TABLE stored_summary")


def session_rows(spark, n=300):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.2)
        start = T0 + timedelta(minutes=i)
        rows.append((i, f"10.0.0.{i % 5}", "10.1.0.1", 1, 2, start, 5.0, float(rng.normal(10 + 30 * y, 2)), 1.0, float(rng.normal(100, 9)), 2.0, y if i % 10 else None))
    return spark.createDataFrame(
        rows,
        "id long, srcIP string, dstIP string, srcPort int, dstPort int, TSesStart timestamp, SessDuration double, "
        "PktPerSesIn double, PktPerSesOut double, BPerSesIn double, BPerSesOut double, label int",
    )


def test_batch_run_end_to_end(spark, tmp_path):
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    done = jobs.run_batch(spark, session_rows(spark), out, with_views=True, validate=True, run_log=log, trees=5, max_depth=3)
    assert done.steps == ["ingest", "validate", "anomaly_detection", "supervised_learning", "summary", "export", "views"]
    summary = done.frames["summary_stats"].first()
    assert summary["total_records"] == 300 and summary["anomaly_count"] + summary["normal_count"] == 300
    assert abs(summary["anomaly_count"] - 30) <= 1 and summary["supervised_predictions"] == 300
    assert summary["model_accuracy"] > 85
    exported = spark.read.option("header", True).csv(f"{out}/export/anomaly_results")
    assert exported.count() == 300 and exported.columns == ["original_id", "anomaly_score", "is_anomaly"]
    assert done.frames["traffic_summary"].agg(F.sum("session_count")).first()[0] == 300
    assert writers.read_runs(spark, log).first()["success"] is True
    model = iforest.IsolationForest.load(spark, f"{out}/models/isolation_forest")
    assert "label" not in model.features and "id" not in model.features


def test_batch_run_without_labels(spark, tmp_path):
    done = jobs.run_batch(spark, session_rows(spark, 60).drop("label"), str(tmp_path / "o"))
    assert "supervised_learning" not in done.steps
    assert done.frames["summary_stats"].first()["supervised_predictions"] == 0


def test_failed_run_stops_and_is_recorded(spark, tmp_path):
    log = str(tmp_path / "log")
    text_only = spark.createDataFrame([(1, "a")], "id long, s string")
    with pytest.raises(ValueError, match="no numeric feature"):
        jobs.run_batch(spark, text_only, str(tmp_path / "o"), run_log=log)
    run = writers.read_runs(spark, log).first()
    assert run["success"] is False and run["steps_completed"] == ["ingest"] and "no numeric" in run["error_message"]


def http_rows(spark, n=200):
    rows = [(i, T0 + timedelta(minutes=i), f"10.0.0.{i % 9}", ["GET", "POST"][i % 2], 500 if i % 4 == 0 else 200, float(900 if i % 4 == 0 else 100 + i % 7)) for i in range(n)]
    return spark.createDataFrame(
        rows, "id long, log_time timestamp, source_ip string, request_method string, response_code int, bytes_sent double"
    )


def test_mode_runs(spark, tmp_path):
    out, log, hist = (str(tmp_path / x) for x in ("o", "log", "hist"))
    done = jobs.run_mode(
        spark, http_rows(spark), out, "supervised", encode=["request_method"], run_log=log, history=hist, trees=5, max_depth=3
    )
    assert done.steps[-1] == "prediction_saving" and done.metrics["accuracy"] > 0.95
    assert writers.read_metrics(spark, hist).count() == 1
    for _ in range(2):
        got = jobs.run_mode(spark, http_rows(spark), out, "unsupervised", encode=["request_method"], run_log=log, trees=10)
    both = got.frames["predictions"]
    assert both.columns == schemas.layout("predictions").names
    assert {r["model_type"]: r["count"] for r in both.groupBy("model_type").count().collect()} == {"random_forest": 200, "isolation_forest": 200}
    assert both.filter("log_time is null or prediction is null or is_anomaly != prediction").isEmpty()
    with pytest.raises(ValueError, match="unknown mode"):
        jobs.run_mode(spark, http_rows(spark), out, "other", run_log=log)
    summary = monitoring.run_log_summary(writers.read_runs(spark, log)).first()
    assert (summary["total_runs"], summary["successful_runs"], summary["supervised_runs"]) == (4, 3, 1)


def test_dirty_numbers_do_not_end_a_run(spark, tmp_path):
    dirty = session_rows(spark, 120).withColumn("BPerSesIn", F.expr("case id % 9 when 0 then double('infinity') when 1 then double('nan') else BPerSesIn end"))
    done = jobs.run_batch(spark, dirty, str(tmp_path / "o"), with_views=True, trees=3, max_depth=2)
    assert done.frames["summary_stats"].first()["total_records"] == 120
    assert done.frames["sessions"].filter("BPerSesIn is null").count() == 28
    assert done.frames["predictions"].groupBy("model_type").count().count() == 2


def test_jobs_leave_no_working_tables(spark, tmp_path, monkeypatch):
    from trafficlens import session

    place = tmp_path / "work"
    monkeypatch.setattr(session, "work_dir", lambda spark: str(place))
    done = jobs.run_batch(spark, session_rows(spark, 80), str(tmp_path / "o"), trees=3, max_depth=2)
    jobs.run_mode(spark, http_rows(spark), str(tmp_path / "p"), "supervised", encode=["request_method"], trees=3, max_depth=2)
    assert done.frames["predictions"].count() == 160
    assert place.exists() and not [p for p in place.iterdir() if not p.name.startswith(".")]


def test_working_folder_without_a_setting(spark):
    from types import SimpleNamespace

    from trafficlens.session import work_dir

    named = SimpleNamespace(conf=SimpleNamespace(get=lambda key, *default: {"spark.checkpoint.dir": "file:///shared/"}.get(key, *default)))
    assert work_dir(named) == "file:///shared"
    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda key, *default: {"spark.sql.warehouse.dir": "/w/"}.get(key, *default)))
    assert work_dir(bare) == "/w/_work"


def test_hourly_sync(spark, tmp_path):
    rows = [("a", "b", T0 + timedelta(hours=i // 3), 10 + i % 3) for i in range(72)] + [("a", "b", T0 + timedelta(hours=30), 9000)]
    df = spark.createDataFrame(rows, schemas.layout("packets"))
    train = df.select(F.monotonically_increasing_id().alias("id"), "packet_size", F.hour("timestamp").alias("hour"))
    model = iforest.fit_forest(train, "id", ["packet_size", "hour"], trees=20)
    audit = jobs.hourly_sync(df, model, str(tmp_path / "s"), threshold=4500).first()
    assert (audit["traffic_rows"], audit["prediction_rows"], audit["aligned_hours"], audit["traffic_anomalies"]) == (73, 31, 25, 1)


def test_chart_data(spark):
    df = spark.createDataFrame([(T0, 5, -0.1, 1), (T0, 7, 0.1, 0)], "timestamp timestamp, packet_size int, anomaly_score double, is_anomaly int")
    charts = jobs.chart_data(df)
    assert set(charts) == {"traffic_over_time", "anomaly_distribution", "packet_sizes", "scores_over_time", "correlation"}
    assert {r["colour"] for r in charts["scores_over_time"].collect()} == {"red", "blue"}
    assert charts["correlation"].count() == 9
    assert jobs.chart_data(df.select("is_anomaly")).keys() == {"anomaly_distribution"}


def stream_input(spark, folder, tmp_path):
    path = str(tmp_path / "in")
    tables.traffic(spark, folder).drop("k").repartition(4).write.parquet(path)
    return path


def test_hourly_stream_equals_batch_on_closed_hours(spark, folder, tmp_path):
    path = stream_input(spark, folder, tmp_path)
    schema = spark.read.parquet(path).schema
    stream = inc.hourly_stream(inc.read_new_files(spark, path, schema), "log_time", "packet_size")
    inc.run_hourly(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = {r["hour"]: (r["packet_count"], round(r["total_packet_size"], 6)) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = rollups.hourly_metrics(spark.read.parquet(path).withColumn("log_time", F.col("log_time").cast("timestamp")), "log_time", ["packet_size"])
    want = {r["hour"]: (r["packet_size_count"], round(r["packet_size_sum"], 6)) for r in batch.collect()}
    last = max(want) - timedelta(hours=3)
    assert {h: v for h, v in want.items() if h <= last} == {h: v for h, v in got.items() if h <= last}


def test_incremental_scoring_takes_only_new_files(spark, folder, tmp_path):
    path = stream_input(spark, folder, tmp_path)
    frame = spark.read.parquet(path)
    model = iforest.fit_forest(frame, "id", ["packet_size"], trees=10)
    out, cp = str(tmp_path / "scored"), str(tmp_path / "cp")

    def run():
        stream = inc.read_new_files(spark, path, frame.schema)
        inc.score_new_rows(stream, model, out, cp).awaitTermination()
        return inc.read_scored(spark, out)

    assert run().count() == 1000
    assert run().count() == 1000
    frame.limit(10).withColumn("id", F.col("id") + 5000).write.mode("append").parquet(path)
    scored = run()
    assert scored.count() == 1010 and scored.select("session_id").distinct().count() == 1010
    direct = iforest.score_forest(frame, model).filter("id = 7").first()["anomaly_score"]
    assert scored.filter("session_id = 7").first()["anomaly_score"] == direct
    assert scored.columns == schemas.layout("predictions").names
