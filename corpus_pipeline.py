"""A pipeline that turns raw documents into a training mix.

Each stage takes what the former one kept, so its result may be written and read again in between.
All stages but the last return the columns of ``documents``. Input columns beyond those pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.llm import benchmark_leaks, mixing, order_minhash, repeats, toxicity
from trafficlens.llm.common import documents, materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores below the toxicity threshold."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    name = "_toxicity"
    while name in docs.columns:
        name = "_" + name
    return toxicity.score(docs, model, name=name).where(F.col(name) < toxicity.THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document, by id, of each class of near duplicates."""
    return order_minhash.keep_one(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 20 words and more that occur earlier; ``n_chars`` follows the text."""
    cut = repeats.remove_repeats(docs)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return benchmark_leaks.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, with their size in words, the number of copies to take and the words taken."""
    mixed = mixing.mix(docs, carry=True).where("copies > 0")
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in ("size", "copies", "taken")]
    return mixed.select(*kept, "size", "copies", "taken")


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("repeated passages", cut_repeated_passages),
    ("benchmark leaks", drop_benchmark_leaks),
    ("source mix", mix_sources),
]

#: No stage but the last two can be told in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read by the next."""
    docs = documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
