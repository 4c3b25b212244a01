"""Descriptions and tags for new items: from the list, else from a detail table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfdiff import fixed_values as fixed
from shelfdiff.functions.text import strip
from shelfdiff.session import by_shuffle

PAIR = ["source_id", "week"]
KEY = [*PAIR, "external_id"]


def _tags(column: str):
    return F.coalesce(column, F.array().cast("array<string>"))


def _described():
    return F.coalesce(strip(F.col("description")) != "", F.lit(False))


def from_list(added: DataFrame) -> DataFrame:
    """Rows whose list entry has a description are taken as they are, with their tags."""
    return added.filter(_described()).select(*KEY, "description", _tags("tags").alias("tags"))


def detail_worklist(added: DataFrame, dim: DataFrame) -> DataFrame:
    """Rows still without a description, of sources that have detail pages, with a key."""
    detail = dim.filter("detail").select("source_id")
    return (added.filter(~_described() & (F.col("external_id") != ""))
            .join(detail, "source_id", "left_semi"))


def detail_cap(worklist: DataFrame,
               limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(rows to look up, source-weeks over the limit)``.

    So many new items mean a broken match, hence the second table, for a report. With a ``limit``
    nothing of such a source-week is looked up, as a partial lookup could not be explained; without
    one everything is, and the report goes by ``fixed_values.MAX_DETAIL_ROWS``.
    """
    over = (worklist.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("rows"))
            .filter(F.col("rows") > (fixed.MAX_DETAIL_ROWS if limit is None else limit)))
    if limit is None:
        return worklist, over
    return worklist.join(over.select(*PAIR), PAIR, "left_anti"), over


def merge_details(worklist: DataFrame, details: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(enriched, failures)``; a missing detail or another name on it is a failure.

    Tags come from the detail, or from the list where the detail has none. Of several details of
    one item the first by name, description and tags counts.
    """
    first = Window.partitionBy(*KEY).orderBy("name", "description", "tags")
    details = details.withColumn("_nth", F.row_number().over(first)).filter("_nth = 1")
    found = details.select(*KEY, F.lit(True).alias("_found"), F.col("name").alias("_name"),
                           F.col("description").alias("_description"), F.col("tags").alias("_tags"))
    joined = worklist.join(by_shuffle(found), KEY, "left")
    renamed = F.coalesce((F.col("_name") != "") & (F.col("_name") != F.col("name")), F.lit(False))
    reason = (F.when(F.col("_found").isNull(), "missing").when(renamed, "renamed"))
    tags = F.when(F.size("_tags") > 0, F.col("_tags")).otherwise(_tags("tags"))
    enriched = joined.filter(reason.isNull()).select(
        *KEY, F.col("_description").alias("description"), tags.alias("tags"))
    failures = joined.filter(reason.isNotNull()).select(*KEY, "name", reason.alias("reason"))
    return enriched, failures


def enrich(added: DataFrame, details: DataFrame, dim: DataFrame,
           limit: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(enriched, failures, source-weeks over the limit)``; see ``detail_cap`` for the limit."""
    todo, over = detail_cap(detail_worklist(added, dim), limit)
    looked_up, failures = merge_details(todo, details)
    if limit is None:
        return from_list(added).unionByName(looked_up), failures, over
    stopped = over.select(*PAIR)
    taken = from_list(added).join(stopped, PAIR, "left_anti")
    return taken.unionByName(looked_up), failures, over


def enrich_stats(added: DataFrame, enriched: DataFrame, failures: DataFrame) -> DataFrame:
    """Per source-week: total, enriched, with_description, failures."""
    rows = (added.select(*PAIR, F.lit("total").alias("kind"), F.lit(False).alias("described"))
            .unionByName(enriched.select(*PAIR, F.lit("enriched").alias("kind"),
                                         F.coalesce(F.col("description") != "", F.lit(False))
                                         .alias("described")))
            .unionByName(failures.select(*PAIR, F.lit("failure").alias("kind"),
                                         F.lit(False).alias("described"))))
    kind = F.col("kind")
    return rows.groupBy(*PAIR).agg(
        F.count_if(kind == "total").alias("total"),
        F.count_if(kind == "enriched").alias("enriched"),
        F.count_if("described").alias("with_description"),
        F.count_if(kind == "failure").alias("failures"))
