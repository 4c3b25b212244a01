"""Small tables with every awkward case, and the given tables."""

from __future__ import annotations

import os

from pyspark.sql import types as T

SF_DIR = "/root/testdata/sf0.001"
HAS_TABLES = os.path.isdir(SF_DIR)

#: Extra columns that bear names the operators use inside.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    T.StructField("score", T.StringType()), T.StructField("block", T.StringType()),
    T.StructField("shard", T.StringType()), T.StructField("_id", T.StringType()), T.StructField("_doc", T.StringType())])

LONG = " ".join(f"word{i * 7919 % 1013} and{i % 17}" for i in range(30_000))
BASE = "the quick brown fox jumps over the lazy dog while seven wizards mix a potion of herbs and salt. " * 3


def awkward_rows():
    rows = [
        (5, BASE, "en", "a"), (3, BASE, "en", "a"), (3, BASE, "en", "a"), (9, BASE.replace("seven", "eleven"), "en", "b"),
        (1, None, "en", "b"), (2, "", "de", None), (4, " \t\n ", None, None), (6, "wort", "de", "c"),
        (7, LONG, "en", "c"), (8, "x" * 300, "en", "c"), (10, "éèê  ß \U0001f600 " * 20, "fr", "a"),
        (11, "zwei worte", "de", "c"), (12, "12 34 !!", None, "c"), (None, "no id here at all", None, None),
        (-4, "minus " * 40, "en", "a"), (13, "x" * 300, "en", "b"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), "s", "b", "h", "i", "d") for i, t, lang, s in rows]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")
