"""Set difference of two snapshots: added, removed, changed, review, conflicts, counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfdiff import fixed_values as fixed
from shelfdiff.functions import weeks as W
from shelfdiff.operators import match, similarity
from shelfdiff.session import by_shuffle, cut_lineage, kept_table, scratch_path, scratch_scope, write_scratch

PAIR = ["source_id", "week"]
COUNTS = ("previous", "current", "matched", "added", "removed", "changed", "review", "conflicts")
SLICE = "_slice"
SLICE_ROWS = 20_000_000


@dataclass
class Diff:
    """The six results. Item tables keep the columns of the snapshot they come from."""

    added: DataFrame
    removed: DataFrame
    changed: DataFrame
    review: DataFrame
    conflicts: DataFrame
    counts: DataFrame
    matches: DataFrame
    over_limit: DataFrame | None = None


def lookback(meta: DataFrame, max_weeks: int = fixed.MAX_LOOKBACK_WEEKS) -> DataFrame:
    """For every snapshot the latest earlier one within ``max_weeks``, or null.

    Works on one row per (week, source), so a window per source stays small: a source has as
    many rows as there are weeks.
    """
    window = (Window.partitionBy("source_id").orderBy("_week_idx")
              .rangeBetween(-max_weeks, -1))
    return (meta.select("week", "source_id").distinct()
            .withColumn("_week_idx", W.week_index(F.col("week")))
            .withColumn("previous_week", F.last("week").over(window))
            .drop("_week_idx"))


def gap_weeks(looked_back: DataFrame) -> DataFrame:
    """Adds how many weeks a diff spans; 0 for a baseline week."""
    return looked_back.withColumn(
        "gap_weeks", F.coalesce(W.week_gap(F.col("previous_week"), F.col("week")), F.lit(0)))


def pair_snapshots(items: DataFrame, looked_back: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(previous, current) items; both carry the current week in ``week``.

    A snapshot is the previous one of at most one other, so nothing is duplicated.
    """
    compared = looked_back.filter("previous_week IS NOT NULL").select(
        "source_id", "week", "previous_week")
    current = items.join(by_shuffle(compared.select(*PAIR)), PAIR, "left_semi")
    previous = (items.withColumnRenamed("week", "previous_week")
                .join(by_shuffle(compared), ["source_id", "previous_week"]).drop("previous_week"))
    return previous, current


def attach(matches: DataFrame, prev: DataFrame, cur: DataFrame,
           columns: tuple[str, ...]) -> DataFrame:
    """Matched pairs with ``columns`` of both sides as ``cur`` and ``prev`` structs."""
    def side(items: DataFrame, name: str) -> DataFrame:
        return items.select(*PAIR, F.col("pos").alias(f"{name}_pos"),
                            F.struct(*columns).alias(name))

    return (matches.join(by_shuffle(side(cur, "cur")), [*PAIR, "cur_pos"])
            .join(by_shuffle(side(prev, "prev")), [*PAIR, "prev_pos"]))


def _differences(fields: tuple[str, ...]) -> Column:
    """Tracked fields that differ, as a map field -> (from, to)."""
    entries = F.array(*[F.struct(
        F.lit(f).alias("key"),
        F.struct(F.col(f"prev.{f}").cast("string").alias("from"),
                 F.col(f"cur.{f}").cast("string").alias("to")).alias("value")) for f in fields])
    return F.map_filter(F.map_from_entries(entries),
                        lambda _, v: ~v["from"].eqNullSafe(v["to"]))


def _disagreements() -> Column:
    """Keys of the current row that the previous row has with another value."""
    def other(key: Column) -> Column:
        return F.try_element_at(F.col("prev.alt_ids"), key)

    return F.map_filter("cur.alt_ids", lambda k, v: (v != "") & (other(k) != "") & (other(k) != v))


def changed(pairs: DataFrame, fields: tuple[str, ...] = fixed.TRACKED_FIELDS) -> DataFrame:
    """Matched pairs in which a tracked field differs, with from and to per field."""
    return pairs.withColumn("fields", _differences(fields)).filter(F.size("fields") > 0)


def key_conflicts(pairs: DataFrame) -> DataFrame:
    """Matched pairs that disagree on another key; both sides are compared as text.

    Only keys the previous row has under ``alt_ids`` can conflict, so external_id never does.
    """
    entries = pairs.select(*PAIR, "cur_pos", "prev_pos", "matched_by", F.col("cur.name"),
                           F.col("prev.alt_ids").alias("_before"),
                           F.explode(_disagreements()).alias("conflicting_key", "current"))
    before = F.try_element_at("_before", F.col("conflicting_key"))
    return entries.withColumn("previous", before).drop("_before")


def unmatched(items: DataFrame, taken: DataFrame, pos: str) -> DataFrame:
    """Rows whose position is not among ``taken``."""
    return items.join(by_shuffle(taken.select(*PAIR, F.col(pos).alias("pos"))), [*PAIR, "pos"], "left_anti")


def diff_counts(prev: DataFrame, cur: DataFrame, pairs: DataFrame, review: DataFrame,
                fields: tuple[str, ...] = fixed.TRACKED_FIELDS) -> DataFrame:
    """One row per source-week with the eight counts.

    Every input is read once: what is neither matched nor in review was added or removed, and
    changes and conflicts are counted on the matched pairs in passing.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def facts(df: DataFrame, **measures: Column) -> DataFrame:
        return df.select(*PAIR, *[measures.get(c, none).cast("bigint").alias(c) for c in (
            "previous", "current", "matched", "changed", "review", "conflicts")])

    disagreeing = F.coalesce(F.when(F.col("cur.alt_ids").isNotNull(), F.size(_disagreements())), none)
    differing = F.when(F.size(_differences(fields)) > 0, one).otherwise(none)
    rows = (facts(prev, previous=one).unionByName(facts(cur, current=one))
            .unionByName(facts(pairs, matched=one, changed=differing, conflicts=disagreeing))
            .unionByName(facts(review, review=one)))
    sums = rows.groupBy(*PAIR).agg(*[F.sum(c).alias(c) for c in rows.columns if c not in PAIR])
    return (sums.withColumn("added", F.expr("current - matched - review"))
            .withColumn("removed", F.expr("previous - matched - review"))
            .select(*PAIR, *COUNTS))


def diff_pair(prev: DataFrame, cur: DataFrame,
              fields: tuple[str, ...] = fixed.TRACKED_FIELDS,
              threshold: float = fixed.SIMILARITY_THRESHOLD,
              limit: int | None = None) -> Diff:
    """Compare two snapshots per source. Both sides carry the current week in ``week``."""
    matches, in_review, pairs = _settle(prev, cur, fields, threshold, limit)
    in_review, pairs = cut_lineage(in_review), cut_lineage(pairs)
    return _results(prev, cur, matches, in_review, pairs, diff_counts(prev, cur, pairs, in_review, fields), fields)


def _compared(fields: tuple[str, ...]) -> tuple[str, ...]:
    return tuple(dict.fromkeys([*fields, "name", "alt_ids"]))


def _settle(prev: DataFrame, cur: DataFrame, fields: tuple[str, ...], threshold: float,
            limit: int | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(matches, pairs in review, matched pairs with both sides)``: what all results follow from."""
    matches = match.layered_match(prev, cur)
    in_review = similarity.review(unmatched(cur, matches, "cur_pos"), unmatched(prev, matches, "prev_pos"),
                                  threshold, limit)
    return matches, in_review, attach(matches, prev, cur, _compared(fields))


def _results(prev: DataFrame, cur: DataFrame, matches: DataFrame, in_review: DataFrame, pairs: DataFrame,
             counts: DataFrame, fields: tuple[str, ...]) -> Diff:
    left_cur = unmatched(cur, matches, "cur_pos")
    left_prev = unmatched(prev, matches, "prev_pos")
    added = unmatched(left_cur, in_review, "cur_pos")
    removed = unmatched(left_prev, in_review, "prev_pos")
    changed_ = changed(pairs, fields)
    conflicts = key_conflicts(pairs)
    review = attach(in_review, prev, cur, _compared(fields)).withColumn("fields", _differences(fields))
    over_limit = similarity.pair_limit(left_cur, left_prev).filter("skipped").drop("skipped")
    return Diff(added, removed, changed_, review, conflicts, counts, matches, over_limit)


def baseline_weeks(meta: DataFrame, looked_back: DataFrame) -> DataFrame:
    """Snapshots with nothing to compare with: all counts 0 but ``current``."""
    zeros = [F.lit(0).cast("bigint").alias(c) for c in COUNTS if c != "current"]
    return (meta.join(by_shuffle(looked_back.filter("previous_week IS NULL")), PAIR, "left_semi")
            .select(*PAIR, F.col("count").alias("current"), *zeros))


def slices_for(rows: int, slice_rows: int = SLICE_ROWS) -> int:
    """Into how many slices a diff of so many items goes."""
    return max(1, -(-rows // slice_rows))


def slice_of(slices: int) -> Column:
    """The slice of a source: with all its weeks, as each is compared with an earlier one."""
    return F.pmod(F.xxhash64("source_id"), F.lit(slices)).cast("int")


def diff(items: DataFrame, meta: DataFrame, max_weeks: int = fixed.MAX_LOOKBACK_WEEKS,
         threshold: float = fixed.SIMILARITY_THRESHOLD,
         limit: int | None = None, slices: int | None = None) -> Diff:
    """All source-weeks of ``items``, each against its lookback snapshot.

    ``counts`` carries ``previous_week``, ``gap_weeks`` and ``baseline``; baseline weeks occur
    in no other result, so a first week is never published as news.

    Sources go through in ``slices`` (default: by their counted items), one after the other. What a slice needs on the
    way, many times its items, is deleted before the next; matches, review, pairs and counts are kept. So the
    disk holds the scratch of one slice at a time, however many sources there are. A table kept by a column
    ``_slice`` (``slice_of``) is read a slice at a time.
    """
    spark, fields = items.sparkSession, fixed.TRACKED_FIELDS
    looked_back = kept_table(lookback(meta, max_weeks), "lookback")
    if slices is None:
        slices = slices_for(meta.agg(F.sum("count")).first()[0] or 0)
    nth = F.col(SLICE) if SLICE in items.columns else slice_of(slices)
    paths = [scratch_path(spark, name) for name in ("matches", "review", "pairs", "counts")]
    for i in range(slices):
        with scratch_scope(spark):
            sides = pair_snapshots(items.filter(nth == i).drop(SLICE), looked_back.filter(slice_of(slices) == i))
            prev, cur = (kept_table(side, "snapshot") for side in sides)
            found = [write_scratch(df, f"{path}/{SLICE}={i}")
                     for df, path in zip(_settle(prev, cur, fields, threshold, limit), paths)]
            found.append(write_scratch(diff_counts(prev, cur, found[2], found[1], fields), f"{paths[3]}/{SLICE}={i}"))
    matches, in_review, pairs, counts = (
        spark.read.schema(df.schema).parquet(path).drop(SLICE) for df, path in zip(found, paths))
    prev, cur = pair_snapshots(items.drop(SLICE), looked_back)
    result = _results(prev, cur, matches, in_review, pairs, counts, fields)
    first = baseline_weeks(meta, looked_back).withColumn("baseline", F.lit(True))
    counts = result.counts.withColumn("baseline", F.lit(False)).unionByName(first)
    result.counts = gap_weeks(counts.join(by_shuffle(looked_back), PAIR, "left"))
    return result
