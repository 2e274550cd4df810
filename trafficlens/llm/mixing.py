"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

A document of a source with target T and size S is wanted T / S times. Its whole copies are
certain. For the remaining fraction p the documents of a source are ranked by
(u / (1 - u)) / (p / (1 - p)), u a random number of the document, and the first of them are taken
until their sizes come nearest to what the whole copies leave open. Inclusion probabilities differ
between sources and are equal inside one.

The order within a source is cut without sorting it: sizes are summed per (source, rank bin),
the bins are summed up in order, and only the bin in which the target falls is sorted.

Null source: a source of its own, last in order. Null text: size 0, taken 0 or whole copies of
nothing. Repeated rows are separate documents with the same random number; such ties fall into
the mix together or are cut in the order of row numbers inside the tie. An empty table gives an
empty result. Columns of the input stay out of the result but for the id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trafficlens.llm.common import WORD, documents, materialize
from trafficlens.session import broadcast_if_small

CAP = 3.0
SHARES = (1, 2, 3)
BINS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(key: Column, seed: str) -> Column:
    """A number in (0, 1) from 52 bits of the MD5 of the key."""
    digits = F.substring(F.md5(F.concat(F.lit(seed), key).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, cap: float = CAP, shares: tuple[int, ...] = SHARES) -> DataFrame:
    """Target per source: shares of the total, cut at ``cap`` times the source, excess reshared.

    ``sizes`` has one row per source (source, source_size). Sources are capped in the order of
    source_size / weight; the rest share what is left by weight, so one running sum finds the cut.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weight = F.element_at(F.array(*[F.lit(float(s)) for s in shares]), ((F.row_number().over(order) - 1) % len(shares) + 1).cast("int"))
    ranked = sizes.withColumn("weight", weight)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rising = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        ranked.withColumn("total", F.sum("source_size").over(whole))
        .withColumn("left_words", F.col("total") - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * cap)
        .withColumn("left_weight", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("open", F.col("left_words") * F.col("weight") > F.col("source_size") * cap * F.col("left_weight"))
    )
    # The first source that stays below its cap, and all after it, share what the capped ones leave.
    first = F.min_by(F.col("left_words") / F.col("left_weight"), F.when(~F.col("open"), F.col("source_size") / F.col("weight"))).over(whole)
    level = F.when(F.max(~F.col("open")).over(whole), first)
    return ranked.withColumn("level", level).select(
        "source", "source_size",
        F.when(F.col("level").isNull() | F.col("open"), F.col("source_size") * cap)
        .otherwise(F.col("weight") * F.col("level")).alias("target"),
    )


def mix(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text",
        cap: float = CAP, shares: tuple[int, ...] = SHARES, seed: str = "mix", bins: int = BINS, carry: bool = False) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies and taken (words).

    With ``carry`` the whole input row comes along as a struct ``row``; only rows of the bin with the
    cut are shuffled.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"),
        word_count(F.col(f"`{text}`")).alias("size"), *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []),
    )
    # Counted once and written, for the sums below.
    light = materialize(rows.select("doc_id", "source", "size"), "mix-sizes")
    sizes = light.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(sizes, cap, shares).withColumnRenamed("source", "of_source"), "mix-targets")
    targets = broadcast_if_small(targets)

    def ranked(df: DataFrame) -> DataFrame:
        wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
        odds = (F.col("u") / (1 - F.col("u"))) * ((1 - F.col("p")) / F.col("p"))
        return (
            df.join(targets, F.col("source").eqNullSafe(F.col("of_source")), "left").drop("of_source")
            .withColumn("wanted", F.least(wanted, F.lit(cap)))
            .withColumn("whole", F.floor("wanted")).withColumn("p", F.col("wanted") - F.col("whole"))
            .withColumn("u", uniform(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), seed))
            .withColumn("rank", F.when(F.col("p") > 0, odds / (1 + odds)))
            .withColumn("bin", F.least(F.floor(F.col("rank") * bins), F.lit(bins - 1)))
        )

    by_bin = ranked(light).where("rank IS NOT NULL").groupBy("source", "bin").agg(
        F.sum("size").alias("bin_size"), F.max("p").alias("p"), F.max("source_size").alias("source_size"))
    upto = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        by_bin.withColumn("before", F.coalesce(F.sum("bin_size").over(upto), F.lit(0)))
        .withColumn("need", F.col("p") * F.col("source_size"))
        .where("before < need AND need <= before + bin_size")
        .groupBy("source").agg(F.min_by("before", "bin").alias("before"), F.min("bin").alias("cut_bin"), F.max("need").alias("need"))
    )
    cut = broadcast_if_small(materialize(cut.withColumnRenamed("source", "cut_source"), "mix-cuts"))
    joined = ranked(rows if carry else light).join(cut, F.col("source").eqNullSafe(F.col("cut_source")), "left")
    # Only the bin with the cut is put in order: about 1/bins of a source.
    inside = F.col("bin") == F.col("cut_bin")
    place = Window.partitionBy("source").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    edge = joined.where(inside).withColumn("sum_before", F.col("before") + F.coalesce(F.sum("size").over(place), F.lit(0)))
    # A document is in if more than half of it lies below the target.
    edge = edge.withColumn("extra", (F.col("sum_before") + F.col("size") / 2.0 <= F.col("need")).cast("int"))
    rest = joined.where(~F.coalesce(inside, F.lit(False))).withColumn("extra", F.coalesce((F.col("bin") < F.col("cut_bin")).cast("int"), F.lit(0)))
    keep = ["doc_id", "source", "size", "source_size", "target", "whole", "extra", *(["row"] if carry else [])]
    both = edge.select(*keep).unionByName(rest.select(*keep))
    copies = (F.col("whole") + F.col("extra")).cast("int")
    return both.withColumn("copies", copies).withColumn("taken", F.col("size") * copies).drop("whole", "extra")


ORACLE = f"""WITH s AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM documents),
w AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1)::DOUBLE AS weight
  FROM s GROUP BY source),
c AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(source_size) OVER r, 0) * 3.0::DOUBLE AS left_words,
         sum(weight) OVER () - coalesce(sum(weight) OVER r, 0) AS left_weight
  FROM w WINDOW r AS (ORDER BY source_size / weight, source IS NULL, encode(source)
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (
  SELECT *, left_words * weight > source_size * 3.0::DOUBLE * left_weight AS is_open FROM c),
t AS (
  SELECT source, source_size, CASE WHEN is_open OR level IS NULL THEN source_size * 3.0::DOUBLE ELSE weight * level END AS target
  FROM (SELECT *, min_by(left_words / left_weight, source_size / weight) FILTER (NOT is_open) OVER () AS level FROM l)),
q AS (
  SELECT s.doc_id, s.size, t.source, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size, 3.0::DOUBLE) ELSE 0.0::DOUBLE END AS wanted,
         (('0x' || substr(md5('mix' || s.doc_id::VARCHAR), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source),
o AS (
  SELECT *, floor(wanted) AS whole, wanted - floor(wanted) AS p,
         CASE WHEN wanted - floor(wanted) > 0
              THEN (u / (1 - u)) * ((1 - (wanted - floor(wanted))) / (wanted - floor(wanted))) END AS odds FROM q),
a AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source, odds IS NULL ORDER BY odds, doc_id, size
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM o)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN odds IS NOT NULL AND before + size / 2.0::DOUBLE <= p * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM a"""


def op10_mixing(spark, folder: str) -> DataFrame:
    """Every document with its size, its source's size and target, and the words the mix takes."""
    return mix(documents(spark, folder)).select("doc_id", "size", "source_size", "target", "taken")
