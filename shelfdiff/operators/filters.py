"""Row filters that account for what they drop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfdiff.functions.text import search_normalize


def scope_exclude(rows: DataFrame, excluded: DataFrame,
                  by: str = "category") -> tuple[DataFrame, DataFrame]:
    """``(kept, dropped per category)``; dropping is never silent."""
    kept = rows.join(excluded.select(by), by, "left_anti")
    counts = rows.groupBy(by).agg(F.count(F.lit(1)).alias("dropped"))
    return kept, counts.join(excluded.select(by), by, "left_semi")


def unknown_categories(rows: DataFrame, known: DataFrame, by: str = "category") -> DataFrame:
    """Categories that no list knows, with their row counts. A person has to place them."""
    counts = rows.groupBy(by).agg(F.count(F.lit(1)).alias("rows"))
    known = known.select(by).distinct()
    return counts.join(known, counts[by].eqNullSafe(known[by]), "left_anti")


def class_filter(rows: DataFrame, class_col: str, wanted: list[str],
                 mixed_col: str) -> tuple[DataFrame, DataFrame]:
    """Keep the wanted class. Others are skipped in a mixed list and rejected in a pure one."""
    fits = F.coalesce(F.col(class_col).isin(wanted), F.lit(False))
    return rows.filter(fits), rows.filter(~fits & ~F.coalesce(F.col(mixed_col), F.lit(False)))


def category_subset(items: DataFrame, codes: DataFrame,
                    dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(items of the requested codes, requested codes nobody knows)``."""
    known = dim.join(codes, "code", "left_semi").select(
        "source_id", F.col("name").alias("category_raw"))
    return (items.join(known, ["source_id", "category_raw"], "left_semi"),
            codes.join(dim, "code", "left_anti"))


def nameless(rows: DataFrame, by: list[str], name: str = "name") -> tuple[DataFrame, DataFrame]:
    """``(rows with a name, nameless count per group)``; any count rejects the group's batch."""
    missing = F.col(name).isNull() | (F.col(name) == "")
    skipped = (rows.groupBy(*by).agg(F.count_if(missing).alias("skipped")).filter("skipped > 0"))
    return rows.filter(~missing), skipped


def facet_filter(publication: DataFrame, channels: tuple[str, ...] = (),
                 categories: tuple[str, ...] = (), brands: tuple[str, ...] = ()) -> DataFrame:
    """AND across facets, OR inside one; an empty facet does not restrict."""
    out = publication
    for column, chosen in (("channel", channels), ("category", categories), ("brand", brands)):
        if chosen:
            out = out.filter(F.col(column).isin(list(chosen)))
    return out


def text_search(publication: DataFrame, query: str) -> DataFrame:
    """Items whose name or blurb contains the query, without regard to case and spaces."""
    needle = search_normalize(F.lit(query))
    hay = search_normalize(F.concat("name", F.lit(" "), F.coalesce("blurb", F.lit(""))))
    return publication.filter(F.contains(hay, needle))
