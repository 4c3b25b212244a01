"""The weekly run over a table store: take snapshots, diff, enrich, publish, report.

All sources go through every step together. A step reads what the step before wrote, so a run
can stop after any of them and be taken up again; writing a partition twice leaves it as once.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfdiff import fixed_values as fixed
from shelfdiff import schemas
from shelfdiff.functions import weeks as W
from shelfdiff.operators import curate, diff, enrich, gate, publish, report
from shelfdiff.session import cut_lineage, scratch_scope
from shelfdiff.sources import registry, snapshots, tables

PAIR = ["source_id", "week"]


@dataclass
class Store:
    """Where the tables live: a folder every executor can reach."""

    spark: SparkSession
    path: str

    @property
    def snapshots(self) -> str:
        return f"{self.path}/snapshot"

    def items(self, weeks: list[str] | None = None) -> DataFrame:
        return snapshots.read(self.spark, self.snapshots, "items", weeks)

    def control(self, weeks: list[str] | None = None) -> DataFrame:
        return snapshots.read(self.spark, self.snapshots, "control", weeks)

    def meta(self, weeks: list[str] | None = None) -> DataFrame:
        return snapshots.manifest(self.spark, self.snapshots, weeks).select(*schemas.SNAPSHOT_META.names)

    def added(self, week: str) -> DataFrame:
        return tables.read_table(self.spark, f"{self.path}/diff/added", schemas.SNAPSHOT_ITEM, [week])

    def removed(self, week: str) -> DataFrame:
        return tables.read_table(self.spark, f"{self.path}/diff/removed", schemas.SNAPSHOT_ITEM,
                                 [week])

    def counts(self, week: str) -> DataFrame:
        return tables.read_table(self.spark, f"{self.path}/diff/counts", schemas.DIFF_COUNTS, [week])

    def enriched(self, week: str) -> DataFrame:
        return tables.read_table(self.spark, f"{self.path}/enriched", schemas.ENRICHED, [week])

    def publication(self, weeks: list[str] | None = None) -> DataFrame:
        return tables.read_table(self.spark, f"{self.path}/published", schemas.PUBLISHED_ITEM, weeks)

    def problems(self, week: str) -> DataFrame:
        return tables.read_table(self.spark, f"{self.path}/problems", schemas.PROBLEM, [week])

    def save(self, df: DataFrame, name: str, week: str, by: list[str] | None = None,
             keep: list[str] | None = None) -> None:
        """Write a table of the whole week: what an earlier run left of the week is gone, but for sources in ``keep``."""
        tables.write_table(df, f"{self.path}/{name}", by, week, None, keep)


def _window_of(week: str, spark: SparkSession, n: int = fixed.MAX_LOOKBACK_WEEKS) -> list[str]:
    """The week and the ``n`` before it: the partitions a step may read."""
    shifted = [W.shift_week(F.lit(week), -i) for i in range(n + 1)]
    row = spark.range(1).select(*shifted).first()
    if row[0] is None:
        raise ValueError(f"not a week: {week!r}")
    return list(row)


def _in_scope(step):
    """The step's checkpoints are gone when it is done; what it returns are stored tables and local rows."""
    @wraps(step)
    def run(store: Store, *args, **kwargs):
        with scratch_scope(store.spark):
            return step(store, *args, **kwargs)
    return run


@_in_scope
def take_snapshots(store: Store, week: str, collected: DataFrame, category_dim: DataFrame,
                   attempted: DataFrame | None = None, refresh: bool = False) -> DataFrame:
    """Judge what was collected, store the good, hold the previous for the rest.

    ``collected`` are item rows of ``week`` with their ``_`` label columns, ``attempted`` the
    sources that were tried (a source without rows fails). Returns the verdicts.

    What was collected is written under a run of its own and judged from there, against the category counts kept with
    earlier snapshots. One commit then makes the passed sources and the holds stand; whatever ends the step before
    it, and whatever the gate refuses, leaves the week as it was.
    """
    spark, root = store.spark, store.snapshots
    span = _window_of(week, spark)
    stored = snapshots.manifest(spark, root, span)
    collected = collected.filter(F.col("week") == week)
    sources = (collected.select("source_id") if attempted is None
               else attempted.select("source_id")).distinct()
    wanted = cut_lineage(gate.accept_new(sources.withColumn("week", F.lit(week)), stored.filter(
        F.col("week") == week), refresh))
    run = snapshots.stage(collected.join(wanted, PAIR, "left_semi"), root)
    found = cut_lineage(snapshots.staged_rows(spark, root, run))
    fresh = (wanted.join(found, PAIR, "left").withColumn("count", F.coalesce("count", F.lit(0)))
             .select(*stored.columns))

    earlier = stored.filter(F.col("week") < week)
    both = earlier.unionByName(fresh)
    looked_back = cut_lineage(diff.lookback(both).filter(F.col("week") == week))
    compared = earlier.join(looked_back.select("source_id", F.col("previous_week").alias("week")), PAIR, "left_semi")
    counts = snapshots.staged(spark, root, run, "categories").unionByName(
        snapshots.read_rows(root, "categories", compared))
    verdict = cut_lineage(gate.gate_verdict(
        both, counts, category_dim, looked_back,
        duplicates=gate.check_duplicates(snapshots.staged(spark, root, run, "items")))
        .join(wanted, PAIR, "left_semi"))
    passed = found.join(verdict.filter("ok"), PAIR, "left_semi")
    held = gate.hold_previous(verdict.filter("NOT ok"), stored, looked_back)
    snapshots.commit(passed.unionByName(held), root)
    return spark.createDataFrame([tuple(r) for r in verdict.collect()], verdict.schema)  # a row a source


@_in_scope
def diff_week(store: Store, week: str) -> None:
    """Compare the week's snapshots with their lookback snapshots and store the six results."""
    span = _window_of(week, store.spark)
    meta = store.meta(span)
    now = meta.filter(F.col("week") == week)
    looked_back = diff.lookback(meta).filter(F.col("week") == week)
    prev, cur = diff.pair_snapshots(store.items(span), looked_back)
    result = diff.diff_pair(prev, cur)
    first = diff.baseline_weeks(now, looked_back).withColumn("baseline", F.lit(True))
    counts = diff.gap_weeks(result.counts.withColumn("baseline", F.lit(False)).unionByName(first)
                            .join(looked_back, PAIR, "left"))
    store.save(result.added, "diff/added", week)
    store.save(result.removed, "diff/removed", week)
    store.save(result.changed, "diff/changed", week)
    store.save(result.review, "diff/review", week)
    store.save(result.conflicts, "diff/conflicts", week)
    store.save(counts, "diff/counts", week)
    store.save(result.over_limit, "diff/over_limit", week)


def enrich_week(store: Store, week: str, details: DataFrame, dim: DataFrame) -> DataFrame:
    """Store descriptions and tags of the added items; returns the stats per source."""
    added = store.added(week)
    ready, failures, over = enrich.enrich(added, details, dim)
    store.save(ready, "enriched", week)
    store.save(over, "detail_over_limit", week)
    return enrich.enrich_stats(added, store.enriched(week), failures)


def edit_requests(store: Store, week: str, dim: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(ref_map, payload)`` for an editor of the added items whose channel has a category list."""
    dim = registry.source_dim(store.spark) if dim is None else dim
    return curate.request_batches(curate.editable(store.added(week), dim, registry.taxonomy_dim(store.spark)),
                                  store.enriched(week))


@_in_scope
def publish_week(store: Store, week: str, responses: DataFrame | None,
                 dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Publish the week and store its report: ``(publication, week report)``.

    ``responses`` are the editor's answers ``(source_id, week, batch, response)``; without them
    items go out with their own category. Sources whose rows have a problem, are not registered, or claim an id of
    another source are not published; their problems are stored (``problems``), what an earlier run published of
    them stays, and all other sources go out.
    """
    counts, added, enriched = store.counts(week), store.added(week), store.enriched(week)
    if responses is None:
        edits = store.spark.createDataFrame([], schemas.EDIT)
    else:
        refs, _payload = edit_requests(store, week, dim)
        entries, _failed = curate.parse_responses(responses)
        edits, _missing = curate.rekey(entries, refs)
    applied = cut_lineage(curate.apply_edits(added, edits, enriched))
    span = _window_of(week, store.spark)
    earlier = publish.compared_publication(store.publication(span[1:]), counts)
    candidates = cut_lineage(publish.publish(added, applied, enriched, earlier, dim))
    rows, problems = publish.merge(candidates, dim, F.lit(week))
    problems = cut_lineage(problems.withColumn("week", F.lit(week)))
    # one name a source
    broken = [r.source_id for r in problems.select("source_id").distinct().collect()]
    rows = cut_lineage(rows)
    store.save(rows, "published", week, keep=broken)
    store.save(problems, "problems", week)

    dropped = publish.drop_out_of_scope(added, applied)[1]
    metas = store.meta(span)
    compared = counts.filter("NOT baseline")
    prev, _cur = diff.pair_snapshots(store.items(span), compared.select(*PAIR, "previous_week"))
    reports = report.source_report(counts, store.control([week]), prev, added, store.removed(week),
                                   earlier, dropped, rows, metas, dim)
    store.save(report.week_report(reports, rows), "report", week, ["week"])
    store.save(report.scope_names(dropped), "report_names/out_of_scope", week)
    store.save(report.gone_names(earlier, store.removed(week)), "report_names/gone", week)
    store.save(publish.week_publication(rows), "week", week, ["week"])
    return store.publication([week]), store.spark.read.parquet(f"{store.path}/report").filter(
        F.col("week") == week)
