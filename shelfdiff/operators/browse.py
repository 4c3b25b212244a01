"""What the page asks of one published week."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfdiff.operators import filters


def with_channel_label(df: DataFrame, channels: DataFrame) -> DataFrame:
    """Adds the channel's display name; a code without one shows itself."""
    return (df.join(channels.select("channel", F.col("label").alias("_label")),
                    "channel", "left")
            .withColumn("channel_label", F.coalesce("_label", "channel")).drop("_label"))


def facets(publication: DataFrame, channels: DataFrame) -> DataFrame:
    """Values to choose from, with counts over the unfiltered week, best first.

    ``(week, facet, value, label, count)``; nulls are no values, and a facet with a single
    value offers no choice and is left out. Equal counts follow Korean collation.
    """
    long = publication.select("week", F.stack(
        F.lit(3), F.lit("channel"), F.col("channel"), F.lit("brand"), F.col("brand"),
        F.lit("category"), F.col("category")).alias("facet", "value"))
    counts = (long.filter(F.col("value") != "").groupBy("week", "facet", "value")
              .agg(F.count(F.lit(1)).alias("count")))
    choices = counts.groupBy("week", "facet").agg(F.count(F.lit(1)).alias("_n")).filter("_n >= 2")
    named = (channels.select(F.lit("channel").alias("facet"),
                                        F.col("channel").alias("value"), F.col("label")))
    return (counts.join(choices, ["week", "facet"], "left_semi")
            .join(named, ["facet", "value"], "left")
            .select("week", "facet", "value", F.coalesce("label", "value").alias("label"), "count")
            .orderBy("week", "facet", F.col("count").desc(), F.collate(F.col("label"), "ko")))


def filtered_items(publication: DataFrame, channels: tuple[str, ...] = (),
                   categories: tuple[str, ...] = (), brands: tuple[str, ...] = (),
                   query: str = "") -> DataFrame:
    """Items that pass all facets and the search."""
    out = filters.facet_filter(publication, channels, categories, brands)
    return filters.text_search(out, query) if query.strip() else out


def shown_counts(publication: DataFrame, shown: DataFrame) -> DataFrame:
    """Per week how many of how many are shown."""
    total = publication.groupBy("week").agg(F.count(F.lit(1)).alias("total"))
    some = shown.groupBy("week").agg(F.count(F.lit(1)).alias("shown"))
    return total.join(some, "week", "left").select(
        "week", F.coalesce("shown", F.lit(0)).alias("shown"), "total")


def distinct_channels(publication: DataFrame) -> DataFrame:
    """Channels of a week in the order they first appear."""
    first = publication.groupBy("week", "channel").agg(F.min("pos").alias("_first"))
    order = Window.partitionBy("week").orderBy("_first")
    return first.withColumn("ord", F.row_number().over(order)).drop("_first")
