"""Composed jobs: whole batch run, mode-driven run, hourly sync, chart data.

Stages hand DataFrames on inside one session and meet at written tables. The first
failing stage stops the run; a run record is written either way.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from urllib.parse import quote

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlens.functions import columns as fx
from trafficlens.operators import classifiers, correlation, evaluation, iforest, quality, rollups
from trafficlens.operators.cleaning import flags_to_int, sanitize_numbers
from trafficlens.operators.encoding import apply_encoder, fit_encoder
from trafficlens.operators.features import preprocess
from trafficlens.operators.monitoring import performance_record
from trafficlens.operators.sampling import hash_split, sample_rows
from trafficlens.plans.views import DETECTOR, register_views
from trafficlens.session import materialize, scratch
from trafficlens.sources import writers
from trafficlens.sources.readers import conform
from trafficlens.sources.schemas import layout, require_columns

# Columns that are identity, target or model output, never features.
NOT_FEATURES = frozenset(
    {
        "id",
        "label",
        "label_2",
        "label_poly",
        "label_poly_o",
        "prediction",
        "anomaly_score",
        "is_anomaly",
        "session_id",
    }
)


CLASSIFIER = "random_forest"  # fixed value


@dataclass
class RunOutcome:
    """What a run produced: finished steps, written frames, scalar facts."""

    steps: list[str] = field(default_factory=list)
    frames: dict[str, DataFrame] = field(default_factory=dict)
    stats: dict[str, str] = field(default_factory=dict)
    metrics: dict[str, float] = field(default_factory=dict)


def feature_columns(df: DataFrame) -> list[str]:
    names = [
        f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name.lower() not in NOT_FEATURES
    ]
    if not names:
        raise ValueError("no numeric feature columns")
    return names


def has_labels(df: DataFrame, label: str) -> bool:
    """Whether the label column exists and holds any value."""
    return label in df.columns and bool(df.filter(F.col(label).isNotNull()).limit(1).count())


def sanitized(df: DataFrame) -> DataFrame:
    """Flags as 0/1; NaN, infinities and oversized values of floating columns become NULL."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return sanitize_numbers(flags_to_int(df), floating)


def _stored(df: DataFrame, path: str) -> DataFrame:
    writers.replace_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def score_sessions(sessions: DataFrame, features: Sequence[str], contamination: float | str = 0.1):
    """Anomaly results of the session table, and the fitted forest."""
    scored, model = iforest.detect(sessions, "id", features, contamination)
    rows = scored.select(
        F.col("id").alias("original_id"), "anomaly_score", F.col("prediction").alias("is_anomaly")
    )
    return rows, model


def classify_sessions(
    sessions: DataFrame, features: Sequence[str], label: str = "label", **options
) -> tuple[DataFrame, DataFrame, PipelineModel]:
    """Train on the hash-split train side. Returns predictions for all rows, scored held-out rows, model.

    Every row is scored once; both results read the stored scores.
    """
    rows = hash_split(sessions.withColumn(label, F.coalesce(F.col(label), F.lit(0)).cast("int")), "id")
    model = classifiers.fit_random_forest(rows.filter("split = 'train'").drop("split"), features, label, **options)
    chance = F.array_max(classifiers.vector_to_array(F.col("probability")))
    scored = materialize(
        model.transform(rows).select("id", label, "split", F.col("prediction").cast("int").alias("prediction"), chance.alias("confidence_score")),
        "session-scores")
    predicted = scored.select(F.col("id").alias("original_id"), F.col("prediction").alias("predicted_label"), "confidence_score")
    return predicted, scored.filter("split = 'test'").select("id", label, "prediction"), model


def summary_row(results: DataFrame, supervised: DataFrame | None, accuracy: float | None) -> DataFrame:
    """The stored one-row summary."""
    count = supervised.agg(F.count("*").alias("n")).scalar() if supervised is not None else F.lit(0)
    score = fx.number_of(results, "anomaly_score")
    base = results.agg(
        F.count("*").alias("total_records"),
        F.count_if(F.col("is_anomaly") == 1).alias("anomaly_count"),
        F.count_if(F.col("is_anomaly") == 0).alias("normal_count"),
        F.avg(score).alias("avg_anomaly_score"),
        F.min(score).alias("min_anomaly_score"),
        F.max(score).alias("max_anomaly_score"),
    )
    target = layout("summary_stats")
    mapping = {f.name: f.name for f in target} | {
        "supervised_predictions": count,
        "anomaly_percentage": fx.percent(F.col("anomaly_count"), F.col("total_records"), 2),
        "model_accuracy": F.lit(None if accuracy is None else round(accuracy * 100, 2)),
        "processing_date": F.current_date(),
    }
    return conform(base, mapping, target)


def run_batch(
    spark: SparkSession,
    source: DataFrame,
    out: str,
    label: str = "label",
    contamination: float | str = 0.1,
    with_views: bool = False,
    validate: bool = False,
    run_log: str | None = None,
    **forest_options,
) -> RunOutcome:
    """Ingest, detect, classify when labels exist, summarise, export.

    ``with_views`` also registers the reports; ``validate`` reconciles the stored rows
    with the source and fails on a difference.
    """
    require_columns(source, "id")
    outcome = RunOutcome()
    begun = datetime.now(timezone.utc)
    try:
        with scratch(spark):
            _batch_stages(spark, source, out, label, contamination, with_views, validate, outcome, forest_options)
    except Exception as error:
        _record(spark, run_log, "batch", begun, False, outcome, str(error))
        raise
    _record(spark, run_log, "batch", begun, True, outcome, None)
    return outcome


def _batch_stages(spark, source, out, label, contamination, with_views, validate, outcome, forest_options) -> None:
    sessions = _stored(sanitized(source), f"{out}/sessions")
    outcome.frames["sessions"] = sessions
    outcome.steps.append("ingest")
    if validate:
        check = quality.reconcile_counts(source, sessions).first()
        outcome.stats["rows"] = str(check["target_rows"])
        if not check["counts_match"]:
            raise RuntimeError(f"stored {check['target_rows']} of {check['source_rows']} rows")
        outcome.frames["sample"] = sample_rows(sessions, "id", 5)
        outcome.steps.append("validate")

    features = feature_columns(sessions)
    found, forest = score_sessions(sessions, features, contamination)
    results = _stored(found, f"{out}/anomaly_results")
    forest.save(spark, f"{out}/models/isolation_forest")
    outcome.frames["anomaly_results"] = results
    outcome.steps.append("anomaly_detection")

    supervised, accuracy = None, None
    if has_labels(sessions, label):
        predicted, held_out, model = classify_sessions(sessions, features, label, **forest_options)
        supervised = _stored(predicted, f"{out}/supervised_predictions")
        classifiers.save_model(model, f"{out}/models/random_forest")
        scores = evaluation.weighted_scores(held_out, label, "prediction").first()
        accuracy = scores["accuracy"]
        outcome.metrics.update({k: float(v) for k, v in scores.asDict().items() if k != "sample_size"})
        outcome.frames["supervised_predictions"] = supervised
        outcome.steps.append("supervised_learning")

    summary = _stored(summary_row(results, supervised, accuracy), f"{out}/summary_stats")
    outcome.frames["summary_stats"] = summary
    outcome.steps.append("summary")

    for name in ("anomaly_results", "supervised_predictions", "summary_stats"):
        if name in outcome.frames:
            writers.export_csv(outcome.frames[name], f"{out}/export/{name}")
    outcome.steps.append("export")

    now = F.lit(datetime.now(timezone.utc))
    found = results.select(
        F.col("original_id").alias("session_id"), F.col("is_anomaly").alias("prediction"), "anomaly_score", now.alias("log_time"))
    predictions = store_predictions(found, out, DETECTOR)
    if supervised is not None:
        guessed = supervised.select(
            F.col("original_id").alias("session_id"), F.col("predicted_label").alias("prediction"), "confidence_score", now.alias("log_time"))
        predictions = store_predictions(guessed, out, CLASSIFIER)
    outcome.frames["predictions"] = predictions
    if with_views:
        outcome.frames.update(register_views(sessions, predictions))
        outcome.steps.append("views")


def store_predictions(rows: DataFrame, out: str, model: str) -> DataFrame:
    """Put one model's rows into the table of all predictions, in place of its former ones.

    ``rows`` has session_id and prediction, and any of anomaly_score, confidence_score and log_time.
    The table has the fixed layout, one folder per model and date, and both models' rows.
    """
    target = layout("predictions")
    flag = F.col("prediction").cast("int")
    known: dict[str, str | Column] = {f.name: f.name if f.name in rows.columns else F.lit(None) for f in target}
    known |= {
        "model_type": F.lit(model), "prediction": flag, "is_anomaly": flag, "traffic_type": fx.traffic_label(flag),
        "risk_level": fx.risk_band(F.col("anomaly_score")) if "anomaly_score" in rows.columns else F.lit(None),
    }
    placed = conform(rows, known, target).drop("model_type")
    writers.write_predictions(placed, f"{out}/predictions/model_type={model}", mode="overwrite")
    return read_predictions(rows.sparkSession, out)


def read_predictions(spark: SparkSession, out: str) -> DataFrame:
    """All models' predictions in the fixed layout."""
    target = layout("predictions")
    stored = T.StructType([*target.fields, T.StructField("event_date", T.DateType())])
    return spark.read.schema(stored).parquet(f"{out}/predictions").select(*target.names)


def run_mode(
    spark: SparkSession,
    traffic: DataFrame,
    out: str,
    mode: str,
    encode: Sequence[str] = (),
    run_log: str | None = None,
    history: str | None = None,
    **options,
) -> RunOutcome:
    """Preprocess HTTP traffic, then train and evaluate ('supervised') or detect ('unsupervised').

    Supervised rows without a label are scored with the saved model instead, and with the codes of
    the ``encode`` columns that were stored with it: a value the model has not seen gets the code
    after all others.
    """
    outcome = RunOutcome()
    begun = datetime.now(timezone.utc)
    try:
        if mode not in ("supervised", "unsupervised"):
            raise ValueError(f"unknown mode: {mode}")
        if traffic.isEmpty():
            raise ValueError("no input rows")
        outcome.steps.append("ingest")
        with scratch(spark):
            clean = preprocess(sanitized(traffic))
            if encode:
                clean = _with_codes(materialize(clean, "clean-rows"), f"{out}/models/{mode}_codes", encode, mode)
            ready = _stored(clean, f"{out}/preprocessed")
            outcome.steps.append("preprocessing")
            stage = _supervised if mode == "supervised" else _unsupervised
            stage(spark, ready, out, outcome, history, options)
    except Exception as error:
        _record(spark, run_log, mode, begun, False, outcome, str(error))
        raise
    _record(spark, run_log, mode, begun, True, outcome, None)
    return outcome


def _with_codes(rows: DataFrame, path: str, columns: Sequence[str], mode: str) -> DataFrame:
    """Text columns by their codes: from these rows and stored, or the stored ones where a saved model scores."""
    spark, learns = rows.sparkSession, mode == "unsupervised" or has_labels(rows, "label")
    for column in columns:
        place = f"{path}/{quote(column, safe='')}"
        if learns:
            writers.replace_table(fit_encoder(rows, column), place)
        coded = apply_encoder(rows, spark.read.parquet(place), column, "_encoded")
        rows = coded.withColumn(column, F.col("_encoded")).drop("_encoded")
    return rows


def _supervised(spark, ready, out, outcome, history, options) -> None:
    features = [c for c in feature_columns(ready) if c != "response_code"]
    path = f"{out}/models/classifier"
    if has_labels(ready, "label"):
        model, held_out = classifiers.train_and_evaluate(ready, "id", features, **options)
        classifiers.save_model(model, path)
        outcome.steps.append("model_training")
        record = performance_record(held_out, "label", "prediction")
        if history:
            writers.append_metrics(record, history)
        outcome.metrics.update(
            {k: float(v) for k, v in record.first().asDict().items() if k not in ("timestamp", "sample_size")}
        )
        outcome.steps.append("model_evaluation")
    else:
        model = classifiers.load_model(path)
    scored = classifiers.predict_binary(ready, model, "id", CLASSIFIER)
    outcome.frames["predictions"] = store_predictions(scored.withColumn("log_time", F.lit(datetime.now(timezone.utc))), out, CLASSIFIER)
    outcome.steps.append("prediction_saving")


def _unsupervised(spark, ready, out, outcome, history, options) -> None:
    features = feature_columns(ready)
    scored, model = iforest.detect(ready, "id", features, **options)
    model.save(spark, f"{out}/models/isolation_forest")
    outcome.steps.append("anomaly_detection")
    rows = scored.select(F.col("id").alias("session_id"), "prediction", "anomaly_score", F.lit(datetime.now(timezone.utc)).alias("log_time"))
    outcome.frames["predictions"] = store_predictions(rows, out, DETECTOR)
    outcome.steps.append("prediction_saving")


def hourly_sync(
    packets: DataFrame, model: iforest.IsolationForest, out: str, threshold: float, time_column: str = "timestamp"
) -> DataFrame:
    """Predict every hour from its mean packet size, replace both tables, return the alignment audit."""
    hours = rollups.hourly_resample(packets, time_column, "packet_size")
    inputs = hours.select(
        F.col("hour").alias("log_time"), F.col("mean_packet_size").alias("packet_size"), F.hour("hour").alias("hour")
    )
    scored = iforest.score_forest(inputs, model)
    predictions = scored.select("log_time", "prediction", "anomaly_score", "traffic_type")
    stored_packets = _stored(packets, f"{out}/packets")
    stored_predictions = _stored(predictions, f"{out}/predictions")
    return quality.alignment_audit(
        stored_packets, stored_predictions, time_column, "log_time", "packet_size", threshold
    )


ENDPOINTS = ("source_ip", "dest_ip")  # fixed value


def hybrid_hourly(
    packets: DataFrame,
    labels: DataFrame | None = None,
    contamination: float = 0.1,
    time_column: str = "timestamp",
    **forest_options,
) -> DataFrame:
    """Hourly detection, combined with a classifier where labels exist.

    The detector scores the hourly features. The classifier learns from packets whose
    instant has a label (endpoint codes from one shared vocabulary, and size) and is on the
    training side of a hash split by instant. It scores all other packets, and its hourly mean
    decides. Without matching labels, and in hours without such packets, the detector stands alone.
    """
    kind = packets.schema[time_column].dataType.simpleString()
    hours = materialize(rollups.hourly_features(packets, time_column), "hourly-features")
    features = [c for c in hours.columns if c != "hour"]
    own, _ = iforest.detect(hours, "hour", features, contamination)
    nothing = packets.sparkSession.createDataFrame(
        [], f"hour {kind}, supervised_prediction int, supervised_score double, supervised_label string"
    )
    if labels is None:
        return rollups.hybrid_hours(own, nothing)
    encoder = fit_encoder(packets, *ENDPOINTS)
    coded = packets
    for column in ENDPOINTS:
        coded = apply_encoder(coded, encoder, column)
    # Written once: counting, every step of the fit and scoring read it.
    coded = materialize(hash_split(coded, time_column), "coded-packets")
    inputs = [f"{c}_encoded" for c in ENDPOINTS] + ["packet_size"]
    known = quality.labels_by_time(coded, labels, time_column).filter("prediction IS NOT NULL")
    train = known.filter("split = 'train'")
    if train.isEmpty():
        return rollups.hybrid_hours(own, nothing)
    train = train.withColumnRenamed("prediction", "label")
    model = classifiers.fit_random_forest(train, inputs, "label", **forest_options)
    learned = labels.filter("prediction IS NOT NULL").select(time_column).distinct()
    unseen = coded.filter("split = 'test'").unionByName(coded.filter("split = 'train'").join(learned, time_column, "left_anti"))
    scored = model.transform(unseen).select(
        time_column,
        F.col("prediction").cast("int").alias("prediction"),
        classifiers.chance_of_one().alias("anomaly_score"),
    )
    return rollups.hybrid_hours(own, rollups.hourly_predictions(scored, time_column))


def chart_data(df: DataFrame) -> dict[str, DataFrame]:
    """The data behind each chart whose columns exist."""
    has = set(df.columns).issuperset
    charts: dict[str, DataFrame] = {}
    if has({"timestamp", "packet_size"}):
        charts["traffic_over_time"] = df.select("timestamp", "packet_size").orderBy("timestamp")
    if has({"is_anomaly"}):
        charts["anomaly_distribution"] = rollups.distribution(df, "is_anomaly")
    if has({"traffic_type"}):
        charts["traffic_types"] = rollups.distribution(df, "traffic_type")
    if has({"packet_size"}):
        charts["packet_sizes"] = rollups.size_histogram(df, "packet_size")
    if has({"timestamp", "anomaly_score"}):
        charts["scores_over_time"] = df.select(
            "timestamp", "anomaly_score", fx.point_colour(F.col("anomaly_score")).alias("colour")
        ).orderBy("timestamp")
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    if len(numeric) > 1:
        charts["correlation"] = correlation.correlation_long(df, numeric)
    return charts


def _record(spark, run_log, mode, begun, success, outcome, error) -> None:
    if run_log:
        ended = datetime.now(timezone.utc)
        run_id = f"{mode}_{begun:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:6]}"
        writers.append_run(
            spark, run_log, run_id, mode, begun, ended, success, outcome.steps, error, outcome.metrics, outcome.stats
        )
