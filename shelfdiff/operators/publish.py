"""Publication: permanent ids, the published row, validation, and the merge of all sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfdiff import fixed_values as fixed
from shelfdiff.functions import values
from shelfdiff.functions import weeks as W
from shelfdiff.session import by_shuffle

PAIR = ["source_id", "week"]
KEY = [*PAIR, "external_id"]


def drop_out_of_scope(added: DataFrame, edits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(kept, dropped)`` by the edits' out_of_scope flag."""
    dropped = edits.filter("out_of_scope").select(*KEY).distinct()
    return added.join(by_shuffle(dropped), KEY, "left_anti"), added.join(by_shuffle(dropped), KEY, "left_semi")


def compared_publication(publication: DataFrame, counts: DataFrame) -> DataFrame:
    """The earlier publication each source-week was compared with, under the current week.

    Uses the diff's own ``previous_week``; ids are inherited inside one source only.
    """
    compared = counts.filter("previous_week IS NOT NULL").select(
        "source_id", F.col("week").alias("_now"), F.col("previous_week").alias("week"))
    return (publication.filter(F.col("external_id") != "").join(compared, PAIR)
            .withColumn("week", F.col("_now")).drop("_now"))


def tag_fallback(*candidates: Column) -> Column:
    """First non-empty tag list; [] when all are empty."""
    filled = [F.when(F.size(c) > 0, c) for c in candidates]
    return F.coalesce(*filled, F.array().cast("array<string>"))


def carry_forward_ids(items: DataFrame, previous_pub: DataFrame) -> DataFrame:
    """Adds ``id`` and ``first_seen``: inherited where published before, else made now."""
    earlier = previous_pub.select(*KEY, F.col("id").alias("_id"),
                                  F.col("first_seen").alias("_first_seen"))
    return (items.join(by_shuffle(earlier), KEY, "left")
            .withColumn("id", F.coalesce(
                F.when(F.col("_id") != "", F.col("_id")),
                values.make_id(F.col("source_id"), F.col("external_id"))))
            .withColumn("first_seen", F.coalesce(
                F.when(F.col("_first_seen") != "", F.col("_first_seen")), F.col("week")))
            .drop("_id", "_first_seen"))


def publish(added: DataFrame, edits: DataFrame, enriched: DataFrame, previous_pub: DataFrame,
            dim: DataFrame) -> DataFrame:
    """Published rows of the added items that are in scope.

    ``edits`` is the result of ``apply_edits``, ``previous_pub`` that of
    ``compared_publication``. The registry is small and inside the plan, so Spark broadcasts it. Items
    of a source that is not in it have no brand and channel, which ``validate`` reports.
    """
    kept, _ = drop_out_of_scope(added, edits)
    edit = edits.select(*KEY, F.col("category").alias("_category"), F.col("tags").alias("_edit_tags"),
                        F.col("blurb").alias("_blurb"))
    facts = enriched.select(*KEY, F.col("tags").alias("_facts_tags"))
    rows = (carry_forward_ids(kept, previous_pub).join(by_shuffle(edit), KEY, "left")
            .join(by_shuffle(facts), KEY, "left").join(dim, "source_id", "left"))
    return rows.select(
        "id", "week", "brand", "channel", "name", "price",
        F.coalesce(F.when(F.col("_category") != "", F.col("_category")), F.col("category_raw"))
        .alias("category"),
        tag_fallback(F.col("_edit_tags"), F.col("_facts_tags"), F.col("tags")).alias("tags"),
        F.col("_blurb").alias("blurb"), "image_url", "source_url", "source_id", "external_id",
        F.coalesce("alt_ids", F.create_map().cast("map<string,string>")).alias("alt_ids"),
        "first_seen", F.col("week").alias("last_seen"))


def validate(publication: DataFrame, week: Column | None = None,
             required: tuple[str, ...] = fixed.REQUIRED_FIELDS) -> DataFrame:
    """All problems as ``(problem, id, name, detail)``; any row stops the publication.

    ``week`` is the expected week of every row (default: the row's own). Checks the form of
    the week, doubled ids, required fields that are null or empty, and foreign weeks.
    """
    expected = F.col("week") if week is None else week
    rows = publication.withColumn("_expected", expected)

    def problem(df: DataFrame, kind: str, detail: Column) -> DataFrame:
        return df.select(F.lit(kind).alias("problem"), "id", "name", detail.alias("detail"))

    form = (rows.select("_expected").distinct()
            .filter(~W.has_week_format(F.col("_expected")))
            .select(F.lit("week_format").alias("problem"), F.lit(None).cast("string").alias("id"),
                    F.lit(None).cast("string").alias("name"), F.col("_expected").alias("detail")))
    doubled = (rows.groupBy("_expected", "id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
               .select(F.lit("duplicate_id").alias("problem"), "id",
                       F.lit(None).cast("string").alias("name"),
                       F.col("n").cast("string").alias("detail")))
    missing = F.array_compact(F.array(*[
        F.when(F.col(f).isNull() | (F.col(f) == ""), F.lit(f)) for f in required]))
    lacking = problem(rows.filter(F.size(missing) > 0), "missing_field", F.array_join(missing, ","))
    foreign = problem(rows.filter(~F.col("week").eqNullSafe(F.col("_expected"))), "foreign_week",
                      F.col("week"))
    return form.unionByName(doubled).unionByName(lacking).unionByName(foreign)


def source_problems(rows: DataFrame, dim: DataFrame, week: Column | None = None,
                    required: tuple[str, ...] = fixed.REQUIRED_FIELDS) -> DataFrame:
    """All problems of published rows as ``(source_id, problem, id, name, detail)``.

    Those of ``validate``, each with the source it belongs to, and sources that are not registered. A doubled id
    concerns every source that has it, whether inside one source or across several.
    """
    expected = F.col("week") if week is None else week
    none = F.lit(None).cast("string")

    def problem(df: DataFrame, kind: str, detail: Column, id: Column = F.col("id"), name: Column = F.col("name")):
        return df.select("source_id", F.lit(kind).alias("problem"), id.alias("id"), name.alias("name"),
                         detail.cast("string").alias("detail"))
    missing = F.array_compact(F.array(*[F.when(F.col(f).isNull() | (F.col(f) == ""), F.lit(f)) for f in required]))
    # an id has as many sources as the registry at most
    doubled = (rows.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.collect_set("source_id").alias("_in"))
               .filter("n > 1").select("id", "n", F.explode("_in").alias("source_id")))
    unknown = rows.select("source_id").distinct().join(dim.select("source_id"), "source_id", "left_anti")
    lacking = rows.join(dim.select("source_id"), "source_id", "left_semi").filter(F.size(missing) > 0)
    form = ~F.coalesce(W.has_week_format(expected), F.lit(False))
    return reduce(DataFrame.unionByName, [
        problem(unknown, "unknown_source", F.col("source_id"), none, none),
        problem(doubled, "duplicate_id", F.col("n"), name=none),
        problem(lacking, "missing_field", F.array_join(missing, ",")),
        problem(rows.filter(form).select("source_id", expected.alias("_w")).distinct(), "week_format", F.col("_w"),
                none, none),
        problem(rows.filter(~F.col("week").eqNullSafe(expected)), "foreign_week", F.col("week"))])


def merge(rows: DataFrame, dim: DataFrame, week: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """``(published, problems)``: the rows of the sources without a problem, and the problems of the others.

    Sources stand or fall as a whole and by themselves: a broken or unregistered source, or sources that claim one
    id, hold nobody else up.
    """
    problems = source_problems(rows, dim, week)
    broken = problems.select("source_id").distinct()
    return rows.filter("source_id IS NOT NULL").join(broken, "source_id", "left_anti"), problems


def publication_counts(publication: DataFrame, by: tuple[str, ...] = ("week",)) -> DataFrame:
    """``total`` and ``with_blurb``."""
    return publication.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.coalesce(F.col("blurb") != "", F.lit(False))).alias("with_blurb"))


def week_publication(publication: DataFrame) -> DataFrame:
    """The weekly header: sources in order and counts. Items stay in their table.

    The source list is as long as the registry at most.
    """
    sources = publication.groupBy("week").agg(
        F.sort_array(F.collect_set("source_id")).alias("sources"))
    return sources.join(publication_counts(publication), "week").withColumn(
        "generated_at", W.scraped_at())
