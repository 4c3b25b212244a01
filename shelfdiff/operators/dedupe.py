"""One row per key, with the first row winning, and nothing folded silently."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedupe(rows: DataFrame, keys: list[str], order: list[str | Column],
           guard: str | None = None, tolerated: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(first row per key, conflicts)``.

    A key whose rows differ in ``guard`` is a conflict (null equals null only): it may stand
    for two products. Differences in ``tolerated`` are allowed and counted. Spark cuts each
    input partition to one row per key before the shuffle, so a key that holds a third of all
    rows ships a handful of them.
    """
    best = Window.partitionBy(*keys).orderBy(*order)
    kept = rows.withColumn("_rn", F.row_number().over(best)).filter("_rn = 1").drop("_rn")
    measures = [F.count(F.lit(1)).alias("rows")]
    if guard is not None:
        present = F.count(guard)
        measures += [F.min(guard).alias("lowest"), F.max(guard).alias("highest"),
                     (present < F.count(F.lit(1))).alias("_some_null"),
                     (present > 0).alias("_some_value")]
    if tolerated is not None:
        measures.append((F.min(tolerated) != F.max(tolerated)).alias("renamed"))
    groups = rows.groupBy(*keys).agg(*measures)
    if guard is None:
        return kept, groups.filter("rows > 1")
    differs = F.coalesce(F.col("lowest") != F.col("highest"), F.lit(False)) | (
        F.col("_some_null") & F.col("_some_value"))
    return kept, groups.filter(differs).drop("_some_null", "_some_value")


def dedupe_promo_last(rows: DataFrame, keys: list[str], promo: Column, sequence: Column,
                      pos: str = "pos") -> DataFrame:
    """First row per key when promotional categories come last, then by sequence number."""
    return dedupe(rows, keys, [promo, F.coalesce(sequence, F.lit(0)), pos])[0]


def dedupe_pages(rows: DataFrame, by: list[str], key: str = "external_id",
                 page: str = "page") -> DataFrame:
    """Keep keys on the page that first shows them; a page with nothing new ends its list."""
    first_seen = rows.groupBy(*by, key).agg(F.min(page).alias("_first"))
    marked = rows.join(first_seen, [*by, key]).withColumn("_new", F.col(page) == F.col("_first"))
    stale = (marked.groupBy(*by, page).agg(F.count_if("_new").alias("_fresh"))
             .filter("_fresh = 0").groupBy(*by).agg(F.min(page).alias("_end")))
    return (marked.filter("_new").join(stale, by, "left")
            .filter(F.col("_end").isNull() | (F.col(page) < F.col("_end")))
            .drop("_first", "_new", "_end"))


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once where each must be unique."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
