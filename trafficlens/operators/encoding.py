"""Label encoding with a distributed vocabulary, and shared vocabularies."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.functions.columns import named
from trafficlens.operators.ordering import dense_ids
from trafficlens.session import broadcast_if_small, materialize
from trafficlens.sources import batches

HOT_SHARE = 1000
SALTS = 4096


def vocabulary(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct non-null text values of one or more columns, with their frequency.

    The frequency comes from map-side combined counts, so a value that fills a
    third of the table costs one row per map task.
    """
    merged = df.select(F.col(columns[0]).cast("string").alias("value"))
    for c in columns[1:]:
        merged = merged.unionAll(df.select(F.col(c).cast("string").alias("value")))
    return merged.filter(F.col("value").isNotNull()).groupBy("value").agg(F.count("*").alias("frequency"))


def fit_encoder(df: DataFrame, *columns: str) -> DataFrame:
    """Vocabulary with codes 0..k-1 in ascending value order; persist it and reuse it for scoring."""
    return materialize(dense_ids(vocabulary(df, *columns), ["value"], "code", start=0), "vocabulary")


def extend_codes(df: DataFrame, path: str, version: int, *columns: str) -> bool:
    """Add the values of one load to the codes under ``path``; False if the version is stored already.

    Codes that were given stay as they are. New values get the next codes, in ascending value order.
    A version holds its load's counts and only the codes it gave, so earlier versions stay readable.
    Versions are whole numbers from 1, added in order by one writer; a load that fails leaves nothing to see.
    """
    spark = df.sparkSession
    stored = _versions(spark, path)
    if version in stored:
        return False
    if version != len(stored) + 1:
        raise ValueError(f"version {len(stored) + 1} comes next, not {version}")
    counts = materialize(vocabulary(df, *columns), "vocabulary")
    known = read_codes(spark, path).select("value", "code") if stored else spark.createDataFrame([], "value string, code long")
    found = counts.join(known, "value", "left")
    first = known.agg(F.coalesce(F.max("code") + 1, F.lit(0)).alias("k")).first()["k"]
    added = dense_ids(found.filter(F.col("code").isNull()).drop("code"), ["value"], "code", start=first)
    again = found.filter(F.col("code").isNotNull()).withColumn("code", F.lit(None).cast("long"))
    place = f"version={version}/attempt={uuid.uuid4().hex}"
    added.unionByName(again).select("value", "frequency", F.col("code").cast("long")).write.parquet(f"{path}/codes/{place}")
    return batches.commit(spark, path, str(version), place)


def _versions(spark: SparkSession, path: str) -> dict[int, str]:
    """Folder of each stored version."""
    return {int(place.split("/")[0].split("=")[1]): place for place in batches.committed(spark, path)}


def read_codes(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The vocabulary as of a version, by default the newest, in the form that :func:`apply_encoder` takes."""
    stored = _versions(spark, path)
    if not stored or (version is not None and version not in stored):
        raise ValueError(f"no version {version or ''} of codes is stored under {path}")
    parts = [f"{path}/codes/{place}" for v, place in stored.items() if version is None or v <= version]
    rows = spark.read.option("recursiveFileLookup", True).schema("value string, frequency long, code long").parquet(*parts)
    return rows.groupBy("value").agg(F.sum("frequency").alias("frequency"), F.min("code").alias("code"))


def apply_encoder(df: DataFrame, encoder: DataFrame, column: str, output: str | None = None) -> DataFrame:
    """Replace values by codes. Values the encoder has not seen get the extra code k; NULL stays NULL.

    A small vocabulary is broadcast. A large one is joined by shuffle, except for
    values holding at least 1/1000 of the fitted rows: there are at most 1000 of
    those, so they are broadcast and never meet in one task. Rows settled by that, and
    NULL keys, are dealt out by hash in the one shuffle join.
    """
    target = output or f"{column}_encoded"
    unseen = encoder.agg(F.count("*").alias("k")).scalar()
    text = F.col(column).cast("string")
    codes = encoder.select(F.col("value").alias("_value"), F.col("code").alias("_code"), "frequency")
    small = broadcast_if_small(encoder)

    def with_code(rows: DataFrame, lookup: DataFrame) -> DataFrame:
        return rows.join(lookup.drop("frequency"), F.col("_text") == F.col("_value"), "left")

    rows = df.withColumn("_text", text)
    if small is not encoder:
        joined = with_code(rows, F.broadcast(codes))
    else:
        total = encoder.agg(F.sum("frequency").alias("n")).scalar()
        hot = codes.filter(F.col("frequency") * HOT_SHARE >= total)
        keyed = rows.join(
            F.broadcast(hot.select(F.col("_value").alias("_hot"), F.col("_code").alias("_hot_code"))),
            F.col("_text") == F.col("_hot"),
            "left",
        )
        # Settled and missing keys match nothing further; salted, they spread over the tasks. The salt
        # stands in a column of its own, so it cannot meet a value.
        settled = F.col("_hot").isNotNull() | F.col("_text").isNull()
        salt = F.when(settled, F.pmod(F.xxhash64(*[named(c) for c in df.columns]), F.lit(SALTS)).cast("int")).otherwise(F.lit(-1))
        keyed = keyed.withColumns({"_salt": salt, "_key": F.when(settled, F.lit("")).otherwise(F.col("_text"))})
        lookup = codes.select(F.lit(-1).alias("_salt"), F.col("_value").alias("_key"), "_code")
        found = keyed.join(lookup, ["_salt", "_key"], "left")
        joined = found.withColumns({"_value": F.col("_key"), "_code": F.coalesce("_hot_code", "_code")})
        joined = joined.drop("_hot", "_hot_code", "_salt", "_key")
    code = F.when(F.col("_text").isNotNull(), F.coalesce(F.col("_code"), unseen))
    return joined.withColumn(target, code).drop("_text", "_value", "_code")


def decode(df: DataFrame, encoder: DataFrame, code_column: str, output: str) -> DataFrame:
    """Codes back to values; the vocabulary of class labels is small and size-checked."""
    names = encoder.select(F.col("code").alias("_code"), F.col("value").alias(output))
    keyed = df.withColumn("_key", F.col(code_column).cast("long"))
    lookup = broadcast_if_small(names)
    return keyed.join(lookup, F.col("_key") == F.col("_code"), "left").drop("_key", "_code")


def label_encode(df: DataFrame, column: str, output: str | None = None) -> DataFrame:
    """Fit and apply in one call."""
    encoded = apply_encoder(df, fit_encoder(df, column), column, "_encoded")
    target = output or f"{column}_encoded"
    return encoded.withColumn(target, F.col("_encoded")).drop("_encoded")
