"""Classifier evaluation, all derived from the confusion counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlens.functions.columns import ratio
from trafficlens.operators.ordering import running_totals


def confusion_matrix(df: DataFrame, label: str, prediction: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Rows per (label, prediction); counts combine map-side."""
    return df.groupBy(*by, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("row_count")
    )


def class_scores(confusion: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class; an undefined ratio is 0."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("row_count")).otherwise(F.lit(0))
    zero = F.lit(0).cast("long")

    def side(cls: Column, support: Column, hits: Column, predicted: Column) -> Column:
        return F.struct(
            cls.cast("string").alias("class_name"),
            support.alias("support"),
            hits.alias("hits"),
            predicted.alias("predicted"),
        )

    sides = F.array(
        side(F.col("label"), F.col("row_count"), hit, zero),
        side(F.col("prediction"), zero, zero, F.col("row_count")),
    )
    flat = confusion.select(*by, F.explode(sides).alias("s")).select(*by, "s.*")
    totals = flat.groupBy(*by, "class_name").agg(
        F.sum("support").alias("support"), F.sum("hits").alias("hits"), F.sum("predicted").alias("predicted")
    )
    return totals.withColumns(
        {
            "precision": ratio(F.col("hits"), F.col("predicted")),
            "recall": ratio(F.col("hits"), F.col("support")),
            "f1_score": ratio(F.col("hits") * 2, F.col("predicted") + F.col("support")),
        }
    )


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row per class, then 'accuracy', 'macro avg' and 'weighted avg', from one scan.

    A rollup over the per-class rows yields the total row that the three summary rows come from.
    """
    scores = class_scores(confusion_matrix(df, label, prediction))
    metrics = ("precision", "recall", "f1_score")
    rolled = scores.rollup("class_name").agg(
        F.grouping("class_name").alias("is_total"),
        F.sum("support").alias("support"),
        F.sum("hits").alias("hits"),
        *[F.avg(m).alias(f"macro_{m}") for m in metrics],
        *[ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(f"weighted_{m}") for m in metrics],
    )
    accuracy = ratio(F.col("hits"), F.col("support"))

    def line(name: Column, *values: Column) -> Column:
        return F.struct(
            name.alias("class_name"),
            *[v.alias(m) for v, m in zip(values, metrics)],
            F.col("support").alias("support"),
        )

    macro = [F.col(f"macro_{m}") for m in metrics]
    weighted = [F.col(f"weighted_{m}") for m in metrics]
    lines = F.when(
        F.col("is_total") == 1,
        F.array(
            line(F.lit("accuracy"), accuracy, accuracy, accuracy),
            line(F.lit("macro avg"), *macro),
            line(F.lit("weighted avg"), *weighted),
        ),
    ).otherwise(F.array(line(F.col("class_name"), *macro)))
    return rolled.select(F.inline(lines))


def weighted_scores(df: DataFrame, label: str, prediction: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 with the sample size, per group."""
    scores = class_scores(confusion_matrix(df, label, prediction, by), by)
    size = F.sum("support")
    return scores.groupBy(*by).agg(
        ratio(F.sum("hits"), size).alias("accuracy"),
        *[
            ratio(F.sum(F.col(m) * F.col("support")), size).alias(m)
            for m in ("precision", "recall", "f1_score")
        ],
        F.coalesce(size, F.lit(0)).alias("sample_size"),
    )


def binary_scores(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy, and precision, recall and F1 of class 1."""
    y, p = F.col(label), F.col(prediction)
    counts = df.agg(
        F.count("*").alias("n"),
        F.count_if(y == p).alias("right"),
        F.count_if((y == 1) & (p == 1)).alias("hits"),
        F.count_if(p == 1).alias("predicted"),
        F.count_if(y == 1).alias("support"),
    )
    return counts.select(
        ratio(F.col("right"), F.col("n")).alias("accuracy"),
        ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(F.col("hits") * 2, F.col("predicted") + F.col("support")).alias("f1_score"),
    )


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under the ROC curve (ties count half), NULL when only one class occurs.

    Rows first collapse to one per score; the running count of negatives over the
    ordered scores is taken per range, so no task sees all scores.
    """
    y = F.col(label)
    per_score = (
        df.filter(y.isNotNull() & F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.count_if(y == 1).alias("pos"), F.count_if(y != 1).alias("neg"))
    )
    ranked = running_totals(per_score, ["score"], {"neg_so_far": "neg"})
    # Positives beat every negative below their score and tie with half of those at it.
    wins = F.sum(F.col("pos") * (F.col("neg_so_far") - F.col("neg") / 2.0))
    totals = ranked.agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("negatives"),
        wins.alias("wins"),
    )
    pairs = F.col("positives").cast("double") * F.col("negatives").cast("double")
    return totals.select("positives", "negatives", F.try_divide("wins", pairs).alias("auc"))
