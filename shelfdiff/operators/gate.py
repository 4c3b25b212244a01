"""Can a source-week be trusted? All checks run for all sources in one pass.

Every check returns its findings as rows; ``gate_verdict`` keeps the first reason per
source-week. Nothing is raised here, so one failing source never stops the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfdiff import fixed_values as fixed
from shelfdiff.operators.ordering import number_in_group
from shelfdiff.session import by_shuffle

PAIR = ["source_id", "week"]


def name_counts(items: DataFrame) -> DataFrame:
    """Rows per category name: what is kept with a snapshot, so that later weeks need not read its items."""
    return items.groupBy(*PAIR, "category_raw").agg(F.count(F.lit(1)).alias("n"))


def category_counts(rows: DataFrame, dim: DataFrame) -> DataFrame:
    """Rows per category code; names that are not in ``dim`` are left out.

    ``rows`` are items or their ``name_counts``. Items are counted by name first, so the join sees one row per category
    and not one per item.
    """
    by_name = rows if "n" in rows.columns else name_counts(rows)
    return (by_name.join(dim.select("source_id", F.col("name").alias("category_raw"), "code"),
                         ["source_id", "category_raw"])
            .groupBy(*PAIR, "code").agg(F.sum("n").alias("n")))


def _expected(counts: DataFrame, dim: DataFrame, looked_back: DataFrame, low: float, high: float,
              tolerance: float) -> DataFrame:
    """What each source-week is measured against: the lookback counts, else bootstrap counts."""
    usual = (counts.withColumnRenamed("week", "previous_week").withColumnRenamed("n", "want")
             .join(looked_back.filter("previous_week IS NOT NULL"),
                   ["source_id", "previous_week"])
             .select(*PAIR, "code", "want", F.lit(low).alias("low"), F.lit(high).alias("high")))
    first = (looked_back.filter("previous_week IS NULL")
             .join(dim.filter("bootstrap_count IS NOT NULL"), "source_id")
             .select(*PAIR, "code", F.col("bootstrap_count").alias("want"),
                     F.lit(1 - tolerance).alias("low"), F.lit(1 + tolerance).alias("high")))
    return usual.unionByName(first)


def check_categories(items: DataFrame, dim: DataFrame, looked_back: DataFrame,
                     low: float = fixed.DROP_RATIO, high: float = fixed.SPIKE_RATIO,
                     tolerance: float = fixed.BOOTSTRAP_TOLERANCE) -> DataFrame:
    """Categories whose count left its range; an absent category counts as 0.

    ``items`` (or their ``name_counts``) holds the weeks under test and the weeks they look back to,
    ``looked_back`` one row ``(source_id, week, previous_week)`` per source-week under test.
    """
    counts = category_counts(items, dim)
    expected = _expected(counts, dim, looked_back, low, high, tolerance)
    got = F.coalesce("n", F.lit(0))
    inside = ((F.col("want") * F.col("low") <= got) & (got <= F.col("want") * F.col("high")))
    return (expected.filter("want > 0").join(by_shuffle(counts), [*PAIR, "code"], "left")
            .filter(~inside)
            .select(*PAIR, "code", "want", got.cast("bigint").alias("got")))


def new_categories(items: DataFrame, dim: DataFrame, looked_back: DataFrame) -> DataFrame:
    """Codes that the baseline does not know: worth a warning, not a failure."""
    counts = category_counts(items, dim)
    expected = _expected(counts, dim, looked_back, 0.0, 0.0, 0.0)
    return (counts.join(by_shuffle(looked_back.select(*PAIR)), PAIR, "left_semi")
            .join(by_shuffle(expected.select(*PAIR, "code")), [*PAIR, "code"], "left_anti"))


def check_volume(meta: DataFrame, looked_back: DataFrame, drop: float = fixed.DROP_RATIO,
                 spike: float = fixed.SPIKE_RATIO) -> DataFrame:
    """``verdict`` per source-week: empty, drop, spike or ok. The limits themselves pass."""
    before = meta.select("source_id", F.col("week").alias("previous_week"),
                         F.col("count").alias("before"))
    ratio = F.col("count") / F.col("before")
    verdict = (F.when(F.col("count") == 0, "empty")
               .when(F.col("before").isNull() | (F.col("before") == 0), "ok")
               .when(ratio < drop, "drop")
               .when(ratio > spike, "spike")
               .otherwise("ok"))
    return (meta.join(by_shuffle(looked_back), PAIR)
            .join(by_shuffle(before), ["source_id", "previous_week"], "left")
            .select(*PAIR, "previous_week", "before", "count", verdict.alias("verdict")))


def check_duplicates(items: DataFrame) -> DataFrame:
    """Source-weeks in which an external_id occurs more than once, and the surplus rows."""
    per_key = items.groupBy(*PAIR, "external_id").agg(F.count(F.lit(1)).alias("n"))
    return (per_key.groupBy(*PAIR).agg(F.sum(F.col("n") - 1).alias("duplicates"))
            .filter("duplicates > 0"))


def gate_verdict(meta: DataFrame, items: DataFrame, dim: DataFrame, looked_back: DataFrame,
                 drop: float = fixed.DROP_RATIO, spike: float = fixed.SPIKE_RATIO,
                 tolerance: float = fixed.BOOTSTRAP_TOLERANCE,
                 duplicates: DataFrame | None = None) -> DataFrame:
    """``(source_id, week, ok, reason)``: categories, then volume, then duplicate keys.

    ``items`` may be ``name_counts`` kept with the snapshots; ``duplicates`` is then the result of
    ``check_duplicates`` for the source-weeks under test.
    """
    duplicates = check_duplicates(items) if duplicates is None else duplicates
    broken = (check_categories(items, dim, looked_back, drop, spike, tolerance)
              .groupBy(*PAIR).agg(F.lit("categories").alias("by_category")))
    volume = (check_volume(meta, looked_back, drop, spike).filter("verdict <> 'ok'")
              .select(*PAIR, F.col("verdict").alias("by_volume")))
    twice = duplicates.select(*PAIR, F.lit("duplicates").alias("by_key"))
    reason = F.coalesce("by_category", "by_volume", "by_key")
    return (looked_back.select(*PAIR).join(by_shuffle(broken), PAIR, "left").join(by_shuffle(volume), PAIR, "left")
            .join(by_shuffle(twice), PAIR, "left")
            .select(*PAIR, reason.isNull().alias("ok"), reason.alias("reason")))


def failed_sources(verdict: DataFrame) -> DataFrame:
    """Source-weeks that failed, one row each: all others go on without them."""
    return verdict.filter("NOT ok").select("week", "source_id", "reason").orderBy("week", "source_id")


def accept_new(candidates: DataFrame, existing: DataFrame, refresh: bool = False) -> DataFrame:
    """Source-weeks to take: a snapshot is taken once, unless the stored one is only held."""
    if refresh:
        return candidates
    return candidates.join(existing.filter("held_from IS NULL").select(*PAIR), PAIR, "left_anti")


def hold_previous(failed: DataFrame, meta: DataFrame, looked_back: DataFrame) -> DataFrame:
    """Rows of ``meta`` that let failed source-weeks stand on their lookback snapshot.

    A good snapshot that is already stored for the week is never replaced. ``held_from`` keeps the first origin over
    repeated holds, and times, counts and the place of the data (``run``, ``data_week``, where ``meta`` has them) stay
    those of the held week: a held week is a reference, no item is read or copied.
    """
    good = meta.filter("held_from IS NULL").select(*PAIR)
    fill = (failed.select(*PAIR).distinct().join(good, PAIR, "left_anti")
            .join(looked_back.filter("previous_week IS NOT NULL"), PAIR)
            .select("source_id", F.col("week").alias("_into"), F.col("previous_week").alias("week")))
    rows = meta.join(fill, PAIR)
    return (rows.withColumn("held_from", F.coalesce("held_from", "week")).withColumn("week", F.col("_into"))
            .select(*meta.columns))


def check_declared_total(rows: DataFrame, totals: DataFrame, by: list[str],
                         required: bool = True) -> DataFrame:
    """Lists whose received rows differ from the total the source declares.

    ``rows`` holds everything received, kept or excluded. A missing total is a problem when
    ``required``.
    """
    received = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("received"))
    joined = totals.select(*by, "total").join(received, by, "full_outer").withColumn(
        "received", F.coalesce("received", F.lit(0)))
    missing = F.col("total").isNull() if required else F.lit(False)
    differs = F.coalesce(F.col("received") != F.col("total"), F.lit(False))
    return joined.filter(missing | differs)


def check_all_list(rows: DataFrame, totals: DataFrame, by: list[str], list_col: str,
                   all_code: str) -> DataFrame:
    """Groups whose lists together do not make up the list of everything."""
    received = (rows.filter(F.col(list_col) != all_code).groupBy(*by)
                .agg(F.count(F.lit(1)).alias("received")))
    declared = (totals.filter(F.col(list_col) == all_code)
                .select(*by, F.col("total").alias("declared")))
    return (declared.join(received, by, "left")
            .withColumn("received", F.coalesce("received", F.lit(0)))
            .filter(F.coalesce(F.col("received") != F.col("declared"), F.lit(True))))


def repeated_pages(rows: DataFrame, by: list[str], page: str = "page",
                   key: str = "external_id") -> DataFrame:
    """Pages with exactly the key set of the page before: pagination does not move on.

    Each key counts for its own page and for the next; a page repeats when every key has both
    marks. No page is ever collected.
    """
    keys = rows.select(*by, F.col(page).alias("page"), F.col(key).alias("key")).distinct()
    marks = (keys.select(*by, "page", "key", F.lit(1).alias("own"), F.lit(0).alias("before"))
             .unionByName(keys.select(*by, (F.col("page") + 1).alias("page"), "key",
                                      F.lit(0).alias("own"), F.lit(1).alias("before"))))
    per_key = marks.groupBy(*by, "page", "key").agg(F.max("own").alias("own"),
                                                    F.max("before").alias("before"))
    return (per_key.groupBy(*by, "page")
            .agg(F.count(F.lit(1)).alias("keys"),
                 F.count_if((F.col("own") == 1) & (F.col("before") == 1)).alias("shared"))
            .filter("keys = shared").select(*by, "page", "keys"))


def page_overflow(rows: DataFrame, by: list[str], page_size: int, max_pages: int,
                  page: str = "page") -> DataFrame:
    """Lists that run past ``max_pages``, or go on after their first short page."""
    sizes = rows.groupBy(*by, page).agg(F.count(F.lit(1)).alias("n"))
    per_list = sizes.groupBy(*by).agg(
        F.max(page).alias("last_page"),
        F.min(F.when(F.col("n") < page_size, F.col(page))).alias("short_page"))
    over = F.col("last_page") > max_pages
    after = F.coalesce(F.col("last_page") > F.col("short_page"), F.lit(False))
    return per_list.filter(over | after).select(
        *by, "last_page", "short_page", over.alias("over_max"), after.alias("after_short"))


def empty_lists(rows: DataFrame, expected: DataFrame, by: list[str]) -> DataFrame:
    """Lists that cannot be empty but have no rows."""
    return expected.select(*by).distinct().join(rows.select(*by).distinct(), by, "left_anti")


def paged(rows: DataFrame, by: list[str], pos: str, page_size: int) -> DataFrame:
    """Number the rows of each list and cut the lists into pages (1-based)."""
    numbered = number_in_group(rows, by, pos)
    return numbered.withColumn("page", (F.floor((F.col("rn") - 1) / page_size) + 1).cast("bigint"))
