"""Samples, probe verdicts, and the figures a person looks at before a taxonomy changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfdiff import fixed_values as fixed


def sample_per_group(df: DataFrame, by: list[str], n: int = fixed.SAMPLE_PER_SOURCE,
                     seed: int = 0, value: str = "image_url",
                     keep_rank: str | None = None) -> DataFrame:
    """Up to ``n`` rows per group in a seeded random order; blank values take no part.

    Spark keeps at most ``n`` rows per group and task before the shuffle, so a huge group costs
    no more than its sample. ``keep_rank`` names a column for the place in that order.
    """
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(value), F.col("external_id")))
    order = Window.partitionBy(*by).orderBy(draw, F.col(value), F.col("external_id"))
    drawn = (df.filter(F.col(value) != "").withColumn("_rn", F.row_number().over(order))
             .filter(F.col("_rn") <= n))
    return drawn.withColumnRenamed("_rn", keep_rank) if keep_rank else drawn.drop("_rn")


def pass_rate(probes: DataFrame, by: str = "source_id",
              minimum: float = fixed.MIN_PASS_RATE) -> DataFrame:
    """Per group checked, ok, pass_rate and verdict, from rows ``(group, ok, blocked)``.

    A group that may not be probed counts as not checked. The verdict uses the exact rate.
    """
    blocked = F.max(F.coalesce("blocked", F.lit(False)))
    rows = probes.groupBy(by).agg(F.count(F.lit(1)).alias("_n"),
                                  F.count_if(F.coalesce("ok", F.lit(False))).alias("ok"),
                                  blocked.alias("_blocked"))
    checked = F.when(F.col("_blocked"), F.lit(0)).otherwise(F.col("_n"))
    rate = F.when(F.col("checked") > 0, F.col("ok") / F.col("checked")).otherwise(F.lit(0.0))
    verdict = (F.when(F.col("checked") == 0, "unknown").when(rate >= minimum, "ok")
               .otherwise("broken"))
    return (rows.withColumn("checked", checked.cast("bigint"))
            .select(by, "checked", "ok", F.bround(rate, 2).alias("pass_rate"),
                    verdict.alias("verdict")))


def allocate(sizes: DataFrame, total: int, weights: dict[str, int] | None = None) -> DataFrame:
    """How many rows to sample per source, from ``(source_id, size)``: one row per source.

    Weighted sources get their number, capped by what they have. The rest share what is left
    by size, at least one each, halves to the even number.
    """
    weights = weights or {}
    sizes = sizes.filter("size > 0")
    weight = F.lit(None).cast("bigint")
    if weights:
        pairs = [F.lit(x) for item in weights.items() for x in item]
        weight = F.try_element_at(F.create_map(*pairs), F.col("source_id")).cast("bigint")
    fixed_part = (sizes.withColumn("weight", weight)
                  .withColumn("fixed", F.when(F.col("weight").isNotNull(), F.least("weight", "size"))))
    everything = Window.partitionBy()
    remaining = F.lit(total) - F.coalesce(F.sum("fixed").over(everything), F.lit(0))
    pool = F.sum(F.when(F.col("fixed").isNull(), F.col("size"))).over(everything)
    share = F.greatest(F.lit(1), F.bround(F.col("remaining") * F.col("size") / F.col("pool")))
    planned = F.when(F.col("fixed").isNotNull(), F.col("fixed")).when(
        F.col("remaining") > 0, F.least(share, F.col("size")))
    return (fixed_part.withColumn("remaining", remaining).withColumn("pool", pool)
            .select("source_id", "size", planned.cast("bigint").alias("n"))
            .filter("n IS NOT NULL"))


def sample_allocated(df: DataFrame, plan: DataFrame, total: int, seed: int = 0,
                     value: str = "external_id") -> DataFrame:
    """Draw the planned number of rows per source.

    A weighted source may be planned with more than ``total``, so ranks go as far as the plan does.
    """
    most = plan.agg(F.max("n")).first()[0] or total
    drawn = sample_per_group(df, ["source_id"], most, seed, value, keep_rank="_rank")
    return (drawn.join(plan.select("source_id", "n"), "source_id")
            .filter(F.col("_rank") <= F.col("n")).drop("n", "_rank"))


def category_distribution(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per group: rows, categories used, the catch-all's count and share, the largest category."""
    by = by or []
    counts = df.groupBy(*by, "category").agg(F.count(F.lit(1)).alias("n"))
    out = counts.groupBy(*by).agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("used"),
        F.coalesce(F.sum(F.when(F.col("category") == fixed.OTHER_CATEGORY, F.col("n"))),
                   F.lit(0)).alias("other"),
        F.max("n").alias("largest_count"),
        F.min_by("category", F.struct(-F.col("n"), F.col("category"))).alias("largest"))
    return (out.withColumn("other_share", F.round(F.col("other") / F.col("total"), 4))
            .withColumn("largest_share", F.round(F.col("largest_count") / F.col("total"), 4)))


def edit_quality(df: DataFrame, taxonomy: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per group: edited, outside the channel's list, with blurb, out of scope."""
    by = by or []
    allowed = (taxonomy.select("channel", "category").distinct()
                          .withColumn("_listed", F.lit(True)))
    rows = df.join(allowed, ["channel", "category"], "left")
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~F.col("category").eqNullSafe(F.col("category_raw"))).alias("edited"),
        F.count_if(F.col("_listed").isNull()).alias("outside"),
        F.count_if(F.coalesce(F.col("blurb") != "", F.lit(False))).alias("blurbs"),
        F.count_if(F.coalesce("out_of_scope", F.lit(False))).alias("out_of_scope"))


def source_pivot(df: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """Category counts, one row per source and one column per category."""
    return df.groupBy("source_id").pivot("category", categories).count().na.fill(0)


def item_listing(df: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Items by source and category, marked when the category is not on the channel's list."""
    allowed = (taxonomy.select("channel", "category").distinct()
                          .withColumn("_listed", F.lit(True)))
    return (df.join(allowed, ["channel", "category"], "left")
            .select("source_id", "category", "name", "blurb",
                    F.col("_listed").isNotNull().alias("in_list"))
            .orderBy("source_id", "category", "name"))


def order_violations(df: DataFrame, by: str, date: str, seq: str) -> DataFrame:
    """Launch dates with a key below one of the launch date before: is key order launch order?

    Within a date rows may come in any order, so only the highest key of a date and the lowest
    of the next can show a decrease. The window therefore sees one row per date, not per item.
    """
    per_date = df.groupBy(by, date).agg(F.min(seq).alias("_low"), F.max(seq).alias("_high"))
    earlier = Window.partitionBy(by).orderBy(date)
    return (per_date.withColumn("previous_high", F.lag("_high").over(earlier))
            .filter(F.col("_low") < F.col("previous_high"))
            .select(by, date, F.col("_low").alias("low"), "previous_high"))
