"""Tokens that very many regions share, and rows without an id."""

import random

import numpy as np
import pytest

from pyspark.sql import functions as F
from shelfdiff.llm import suffix_dedup, suffixes
from tests.llm.test_suffixes import brute, got

DOCS = "doc_id bigint, text string"


def rows_with_a_run(n, seed):
    """One run of bytes in other surroundings in every text, some surroundings in several."""
    rng = random.Random(seed)
    run = "the same run of some sixty bytes stands here, in all of them."
    rows, old = [], [""]
    for i in rng.sample(range(10 * n), n):
        ends = [rng.choice(old) if rng.random() < 0.3 else "".join(rng.choice("abcdefgh ") for _ in range(60)) for _ in range(2)]
        old += ends
        rows.append((i, ends[0] + run[:rng.choice([20, 30, 61])] + ends[1]))
    return rows + [(None, t) for _, t in rows[:5]]


@pytest.mark.parametrize("most", [0, 10])
def test_no_token_of_a_bucket_has_more_regions(spark, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(suffix_dedup, "HOT_REGIONS", most, raising=False)
    rows, seen = rows_with_a_run(200, most), []
    df = spark.createDataFrame(rows, DOCS)
    group = type(df).groupBy

    def spy(self, *columns):
        seen.append((columns, self))
        return group(self, *columns)
    monkeypatch.setattr(type(df), "groupBy", spy)
    found = suffix_dedup.repeated_strings(df)
    monkeypatch.setattr(type(df), "groupBy", group)
    assert got(found) == brute(rows)
    _, regions = [frame for columns, frame in seen if columns == ("bucket",)]
    times = {}
    for r in regions.collect():
        part = suffix_dedup._unpack(r.data)
        if "content" in part:
            for t in suffixes.tokens_in(part["content"], part["offset"].astype(np.int64)).tolist():
                times[t] = times.get(t, 0) + 1
    assert max(times.values(), default=0) <= most


def test_rows_without_an_id_are_shared_out(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 4000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame([(None, f"{k} " * 100) for k in range(200)], DOCS)
        found = suffix_dedup.repeated_strings(df).withColumn("task", F.spark_partition_id())
        assert found.select("task").distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
