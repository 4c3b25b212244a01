"""Parquet tables by (week, source_id): snapshots, diffs, parts, publications, raw responses.

A write replaces only the partitions it carries (dynamic overwrite), so one source never
overwrites another; a step also drops partitions it answers for and has no rows for, so a repeated
run leaves the same table. Snapshots are written and found by ``snapshots``.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfdiff import fixed_values as fixed
from shelfdiff import schemas
from shelfdiff.functions import weeks as W

PARTITION = ["week", "source_id"]


def write_table(df: DataFrame, path: str, by: list[str] | None = None, week: str | None = None,
                sources: list[str] | None = None, keep: list[str] | None = None) -> None:
    """Replace the partitions that ``df`` carries and leave the others alone.

    A step that is responsible for a whole ``week``, or for some ``sources`` of it, says so: their
    partitions that got no rows this time are dropped after the write, so a second run with fewer
    rows leaves what it found and nothing older. Sources in ``keep`` are left as they were.

    The rebalance hint lets AQE split a source with a third of all rows over many writers and
    merge the small sources, so file sizes stay even on both ends.
    """
    by = PARTITION if by is None else by
    written = Observation()
    named = F.concat_ws("/", *[F.col(c).cast("string") for c in by])
    (df.observe(written, F.collect_set(named).alias("partitions"))
     .hint("rebalance", *by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))
    if week is not None:
        kept = {f"{week}/{source}" for source in keep or ()}
        drop_partitions(df.sparkSession, path, week, sources, _partitions(written, df) | kept, by)


def _partitions(written: Observation, df: DataFrame) -> set[str]:
    """Partitions of a write; a plan that is known to be empty is never run and observes nothing."""
    try:
        return set(written.get["partitions"])
    except Py4JJavaError:
        if not df.isEmpty():
            raise
        return set()


def drop_partitions(spark: SparkSession, path: str, week: str, sources: list[str] | None = None,
                    but: set[str] = frozenset(), by: list[str] | None = None) -> None:
    """Delete the folders of a week's partitions, or of some sources', except those in ``but``.

    The folders of one week are as many as there are sources, so the driver may list them.
    """
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(f"{path}/week={week}")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return
    if by == ["week"]:
        if week not in but:
            files.delete(place, True)
        return
    unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    for folder in files.listStatus(place):
        name = folder.getPath().getName()
        if name.startswith("source_id="):
            source = unescape(name.removeprefix("source_id="))
            if f"{week}/{source}" not in but and (sources is None or source in sources):
                files.delete(folder.getPath(), True)


def read_table(spark: SparkSession, path: str, schema: T.StructType,
               weeks: list[str] | None = None, sources: list[str] | None = None) -> DataFrame:
    """Read with partition pruning; a table that was never written reads as empty."""
    try:
        df = spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.createDataFrame([], schema)
    if weeks is not None:
        df = df.filter(F.col("week").isin(weeks))
    if sources is not None:
        df = df.filter(F.col("source_id").isin(sources))
    return df


def write_raw(responses: DataFrame, path: str) -> None:
    """Keep every response body, so a broken parse can be replayed without asking again."""
    write_table(responses.select("week", "source_id", "request_id", "ext", "body"), path)


def partitions_of(spark: SparkSession, path: str) -> DataFrame:
    """The (week, source_id) folders of a table, from their names: no file is opened.

    They are as many as weeks times sources, and pass the driver; a table that was never written has none.
    """
    jvm = spark._jvm
    unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    place = jvm.org.apache.hadoop.fs.Path(f"{path}/week=*/source_id=*")
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []
    rows = [(unescape(f.getPath().getParent().getName().removeprefix("week=")),
             unescape(f.getPath().getName().removeprefix("source_id="))) for f in found]
    return spark.createDataFrame(rows, "week string, source_id string")


def expired_raw(partitions: DataFrame, today: Column, days: int = fixed.RAW_RETENTION_DAYS) -> DataFrame:
    """Archive partitions older than ``days``; a name that is no week never expires."""
    return partitions.filter(W.monday_of(F.col("week")) < F.date_sub(today, days))


def retain_raw(spark: SparkSession, path: str, today: Column, days: int = fixed.RAW_RETENTION_DAYS) -> DataFrame:
    """Delete the archive's expired partitions; returns which they were, (week, source_id)."""
    gone = expired_raw(partitions_of(spark, path), today, days).collect()
    by_week: dict[str, set[str]] = {}
    for row in gone:
        by_week.setdefault(row.week, set()).add(row.source_id)
    for week, sources in by_week.items():
        drop_partitions(spark, path, week, sorted(sources))
    return spark.createDataFrame([tuple(r) for r in gone], "week string, source_id string")


def snapshot_meta(items: DataFrame) -> DataFrame:
    """One row per (week, source): how many items, and when the first one was collected."""
    return items.groupBy("week", "source_id").agg(
        F.min_by("scraped_at", "pos").alias("scraped_at"),
        F.count(F.lit(1)).alias("count"),
        F.lit(None).cast("string").alias("held_from"))


def split_control(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Move ``_``-prefixed columns into a side table keyed by external_id.

    Source labels therefore cannot reach the diff. Rows without any such value get no row in
    the side table.
    """
    private = [c for c in items.columns if c.startswith("_")]
    clean = items.drop(*private)
    if not private:
        return clean, items.select("week", "source_id", "external_id").limit(0)
    some = F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(True)) for c in private])
    control = items.filter(some).select(
        "week", "source_id", "external_id", *[F.col(c).alias(c.lstrip("_")) for c in private])
    return clean, control


def split_control_map(attributes: Column) -> tuple[Column, Column]:
    """The same split for an open attribute map: (public, private with underscores stripped)."""
    public = F.map_filter(attributes, lambda k, _: ~k.startswith("_"))
    private = F.transform_keys(F.map_filter(attributes, lambda k, _: k.startswith("_")),
                               lambda k, _: F.ltrim(k, F.lit("_")))
    return public, private


def list_weeks(publication: DataFrame) -> DataFrame:
    """Published weeks, newest first; names that are not weeks are left out."""
    return (publication.select("week").distinct()
            .filter(W.has_week_format(F.col("week"))).orderBy(F.col("week").desc()))


def latest_week(publication: DataFrame) -> DataFrame:
    return (publication.filter(W.has_week_format(F.col("week")))
            .agg(F.max("week").alias("week")))


def read_week(publication: DataFrame, week: str) -> DataFrame:
    return publication.filter(W.has_week_format(F.col("week")) & (F.col("week") == week))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines; a line that is no JSON is dropped, a value of another type than asked is null.

    Whether a line is kept does not depend on the columns that are read.
    """
    lines = spark.read.text(path)
    good = lines.filter(F.try_parse_json("value").isNotNull())
    return good.select(F.from_json("value", schema).alias("row")).select("row.*")
