"""Awkward inputs shared by the tests of this folder."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside; as columns of the input they must do no harm.
CLASHING = ("doc", "row", "size", "score", "label", "_0", "_text", "n", "copies", "start", "host", "rank", "class", "_marks", "features")


def documents(spark, texts, ids=None, sources=None):
    ids = range(len(texts)) if ids is None else ids
    sources = ["s"] * len(texts) if sources is None else sources
    rows = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in zip(ids, texts, sources)]
    return spark.createDataFrame(rows, SCHEMA)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(f"other {c}").alias(c) for c in CLASHING if c not in df.columns])


def words(n, seed=0, vocabulary=5000):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def crc_rest(doc, modulus):
    import zlib

    return zlib.crc32(str(doc).encode()) % modulus
