"""Supervised pipelines on pyspark.ml: forest, boosted trees, traffic types."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import IndexToString, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlens.functions import columns as fx
from trafficlens.operators import wide
from trafficlens.operators.cleaning import column_mode
from trafficlens.operators.sampling import SEED, split_frames
from trafficlens.session import spread

# Fixed values.
TREES = 100
DEEPEST = 30  # the deepest tree Spark grows
#: Bounds: rows boosted trees are fitted on (chosen by a hash of the row), classes, values of an encoded column.
FIT_ROWS = 50_000
MAX_CLASSES = 1_000
MAX_VALUES = 100_000


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight per class: rows / (classes x rows of the class). One row per class."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("row_count"))
    totals = counts.agg(F.struct(F.sum("row_count").alias("n"), F.count("*").alias("k")).alias("t")).scalar()
    weight = totals.getField("n") / (totals.getField("k") * F.col("row_count"))
    return counts.withColumn("weight", weight.cast("double"))


def with_class_weight(df: DataFrame, label: str, output: str = "weight") -> DataFrame:
    """Attach the balanced weight. Labels of a classifier are few, so they become one map literal."""
    rows = class_weights(df, label).select(label, "weight").limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in {label}")
    if not rows:
        return df.withColumn(output, F.lit(1.0))
    pairs = [F.lit(v) for r in rows for v in (r[0], float(r[1]))]
    return df.withColumn(output, F.create_map(*pairs)[F.col(label)])


def bounded(df: DataFrame, most: int = FIT_ROWS) -> DataFrame:
    """At most about ``most`` rows to fit on, chosen by a hash of the whole row."""
    total = df.count()
    if total <= most:
        return df
    key = F.xxhash64(*[fx.named(f.name) for f in df.schema if f.dataType.typeName() not in ("map", "udt")])
    return df.filter(F.pmod(key, F.lit(1 << 30)) < int((1 << 30) * most / total))


@contextmanager
def _fit_rows(df: DataFrame, most: int | None) -> Iterator[DataFrame]:
    """The rows, all or ``most``, evenly dealt out and held while a model is fitted: its many passes do not read the table again."""
    some = (df if most is None else bounded(df, most)).persist()
    try:
        yield spread(some, some.count())
    finally:
        some.unpersist()


def _few(df: DataFrame, column: str, most: int) -> None:
    found = df.select(fx.named(column)).distinct().limit(most + 1).count()
    if found > most:
        raise ValueError(f"{column} has more than {most} values")


def _assemble(rows: DataFrame, features: Sequence[str], encoded: Sequence[str] = ()) -> list:
    """Mean imputation with the means of ``rows``, assembler and scaler, saved with the model.

    The means of all columns come from one pass. Tree splits do not depend on the scale; scaling
    keeps parity.
    """
    stats = wide.feature_stats(rows, features)
    filled = [f"_filled_{i}" for i in range(len(features))]
    entries = ", ".join(
        f"coalesce({wide.number_sql(c)}, {float(m)!r}D) AS {f}" for c, m, f in zip(features, stats.mean, filled))
    return [
        SQLTransformer(statement=f"SELECT *, {entries} FROM __THIS__"),
        VectorAssembler(inputCols=[*filled, *encoded], outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True),
    ]


def fit_random_forest(
    train: DataFrame,
    features: Sequence[str],
    label: str = "label",
    trees: int = TREES,
    max_depth: int = 10,
    balanced: bool = False,
    seed: int = SEED,
    fit_rows: int | None = None,
) -> PipelineModel:
    """Random forest on integer labels 0..k-1. Raise ``max_depth`` up to 30 for near-unbounded trees.

    It is fitted on all rows, or on at most about ``fit_rows`` rows where that is asked for.
    """
    if not 0 <= max_depth <= DEEPEST:
        raise ValueError(f"a tree's depth is at most {DEEPEST}, not {max_depth}")
    forest = RandomForestClassifier(
        featuresCol="features",
        labelCol=label,
        numTrees=trees,
        maxDepth=max_depth,
        seed=seed,
        **({"weightCol": "weight"} if balanced else {}),
    )
    with _fit_rows(train, fit_rows) as rows:
        if balanced:
            rows = with_class_weight(rows, label)
        return Pipeline(stages=[*_assemble(rows, features), forest]).fit(rows)


def fit_boosted_trees(
    train: DataFrame, features: Sequence[str], label: str = "label", rounds: int = 100, seed: int = SEED,
    max_depth: int = 6, step: float = 0.3, fit_rows: int = FIT_ROWS,
) -> PipelineModel:
    """Gradient-boosted trees for a 0/1 label, fitted on at most about ``fit_rows`` rows."""
    boosted = GBTClassifier(featuresCol="features", labelCol=label, maxIter=rounds, maxDepth=max_depth, stepSize=step, seed=seed)
    with _fit_rows(train, fit_rows) as rows:
        return Pipeline(stages=[*_assemble(rows, features), boosted]).fit(rows)


def chance_of_one() -> Column:
    """Probability of class 1; 0 when the training rows held class 0 only."""
    return F.coalesce(F.get(vector_to_array(F.col("probability")), F.lit(1)), F.lit(0.0))


def predict_binary(df: DataFrame, model: PipelineModel, id_column: str, model_type: str) -> DataFrame:
    """Prediction rows: session id, label, probability of class 1 and confidence of the prediction."""
    out = model.transform(df)
    chance = chance_of_one()
    flag = F.col("prediction").cast("int")
    return out.select(
        F.col(id_column).alias("session_id"),
        F.lit(model_type).alias("model_type"),
        flag.alias("prediction"),
        chance.alias("probability"),
        fx.binary_confidence(flag, chance).alias("confidence_score"),
        fx.traffic_label(flag).alias("traffic_type"),
        flag.alias("is_anomaly"),
    )


def train_and_evaluate(
    df: DataFrame, id_column: str, features: Sequence[str], label: str = "label", **options
) -> tuple[PipelineModel, DataFrame]:
    """Hash split, fit on the train side, return the model and the scored held-out rows."""
    train, test = split_frames(df, id_column)
    model = fit_random_forest(train, features, label, **options)
    scored = model.transform(test).withColumn("probability_1", chance_of_one())
    return model, scored.withColumn("prediction", F.col("prediction").cast("int"))


def feature_importance(model: PipelineModel, features: Sequence[str]) -> dict[str, float]:
    trained = next(s for s in reversed(model.stages) if hasattr(s, "featureImportances"))
    return dict(zip(features, (float(v) for v in trained.featureImportances.toArray())))


TYPE_FEATURES = ("source_port", "destination_port", "packet_size", "duration")  # fixed value


def fit_traffic_types(
    df: DataFrame,
    target: str = "traffic_type",
    features: Sequence[str] = TYPE_FEATURES,
    protocol: str | None = "protocol",
    trees: int = TREES,
    max_depth: int = 10,
    seed: int = SEED,
    fit_rows: int | None = None,
) -> PipelineModel:
    """Multi-class traffic-type model: encode the protocol, impute, scale, classify, decode.

    Missing targets take the most frequent one. A protocol not seen in training has its own code.
    It is fitted on all rows, or on at most about ``fit_rows`` rows where that is asked for.
    """
    known = df.withColumn(target, F.coalesce(F.col(target), column_mode(df, target)))
    with _fit_rows(known, fit_rows) as rows:
        _few(rows, target, MAX_CLASSES)
        encoded: list[str] = []
        stages: list = []
        if protocol:
            _few(rows, protocol, MAX_VALUES)
            stages.append(
                StringIndexer(
                    inputCol=protocol,
                    outputCol="protocol_encoded",
                    stringOrderType="alphabetAsc",
                    handleInvalid="keep",
                )
            )
            encoded.append("protocol_encoded")
        classes = StringIndexer(
            inputCol=target, outputCol="_target", stringOrderType="alphabetAsc", handleInvalid="error"
        ).fit(rows)
        forest = RandomForestClassifier(
            featuresCol="features", labelCol="_target", numTrees=trees, maxDepth=max_depth, seed=seed
        )
        names = IndexToString(inputCol="prediction", outputCol="predicted_traffic_type", labels=classes.labels)
        return Pipeline(stages=[*stages, *_assemble(rows, features, encoded), forest, names]).fit(classes.transform(rows))


def predict_traffic_types(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Decoded type and the probability of the chosen class."""
    out = model.transform(df)
    confidence = F.array_max(vector_to_array(F.col("probability")))
    return out.select(*df.columns, "predicted_traffic_type", confidence.alias("prediction_confidence"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
