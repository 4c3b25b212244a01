"""Snapshots that readers find through a manifest, so no write ever touches what stands.

A write puts its items, control rows and category counts under a run of their own, where nobody looks. It counts
from the moment its manifest rows are committed, which is one rename. A manifest row names, for a source-week, the run
and the week its data lies under: a held week is a row that points to another week's data, nothing is copied. Of several
rows the latest commit holds. A refused, broken or repeated write therefore leaves the last committed state.

``manifest`` and the functions that take its rows go by source-weeks, which are few: sources of the registry times the
weeks asked for. They pass the driver; items never do.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfdiff import schemas
from shelfdiff.operators import gate
from shelfdiff.sources import tables

PAIR = ["week", "source_id"]
RUN = T.StructField("run", T.StringType())
DATA = {"items": schemas.SNAPSHOT_ITEM, "control": schemas.CONTROL, "categories": schemas.CATEGORY_COUNT}
MANIFEST = schemas.SNAPSHOT_MANIFEST


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def stage(items: DataFrame, root: str) -> str:
    """Write items, control and category counts of a new run, and return its name. Nobody sees them yet.

    The counts are taken from the items as written, so the collected rows are computed once.
    """
    run = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    spark = items.sparkSession
    clean, control = tables.split_control(items)
    if "labels" not in control.columns:
        control = control.withColumn("labels", F.lit(None).cast(schemas.LABELS))
    for name, df in (("items", clean), ("control", control)):
        tables.write_table(df, f"{root}/{name}/run={run}")
    tables.write_table(gate.name_counts(staged(spark, root, run, "items")), f"{root}/categories/run={run}")
    return run


def staged(spark: SparkSession, root: str, run: str, name: str) -> DataFrame:
    """What a run has written, committed or not."""
    return spark.read.schema(DATA[name]).parquet(f"{root}/{name}/run={run}")


def staged_rows(spark: SparkSession, root: str, run: str) -> DataFrame:
    """Manifest rows of everything a run has written."""
    rows = tables.snapshot_meta(staged(spark, root, run, "items"))
    return rows.select(*PAIR, F.lit(run).alias("run"), F.col("week").alias("data_week"), "scraped_at", "count",
                       "held_from")


def commit(rows: DataFrame, root: str) -> str:
    """Make manifest rows hold from now on, all at once: they are written aside and renamed into place."""
    spark = rows.sparkSession
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    aside = f"{root}/manifest/_aside-{name}"
    rows.select(*MANIFEST.names).coalesce(1).write.parquet(aside)
    files, place = _files(spark, aside)
    if not files.rename(place, _files(spark, f"{root}/manifest/commit={name}")[1]):
        raise RuntimeError(f"manifest rows of {name} could not be put in place")
    return name


def manifest(spark: SparkSession, root: str, weeks: list[str] | None = None,
             sources: list[str] | None = None) -> DataFrame:
    """The row in force for each source-week, as a table inside the plan."""
    every = T.StructType([*MANIFEST.fields, T.StructField("commit", T.StringType())])
    rows = tables.read_table(spark, f"{root}/manifest", every, weeks, sources)
    latest = (rows.groupBy(*PAIR).agg(F.max_by(F.struct(*MANIFEST.names), "commit").alias("row"))
              .select("row.*").collect())
    return spark.createDataFrame([tuple(r) for r in latest], MANIFEST)


def follow(data: DataFrame, rows: DataFrame) -> DataFrame:
    """The data that manifest rows point to, under the weeks of the rows.

    ``data`` has source_id and week, and run where the rows have one.
    """
    where = [c for c in ("run", "source_id") if c in data.columns and c in rows.columns]
    pointers = rows.select("week", "data_week", *where)
    return (data.withColumnRenamed("week", "data_week").join(pointers, [*where, "data_week"])
            .select(*[c for c in data.columns if c != "run"]))


def read(spark: SparkSession, root: str, name: str = "items", weeks: list[str] | None = None,
         sources: list[str] | None = None) -> DataFrame:
    """Items, control or category counts of the source-weeks in force; only runs that hold some of them are read."""
    return read_rows(root, name, manifest(spark, root, weeks, sources))


def read_rows(root: str, name: str, rows: DataFrame) -> DataFrame:
    """``read`` for given manifest rows."""
    spark = rows.sparkSession
    runs = sorted(r.run for r in rows.select("run").distinct().collect())
    if not runs:
        return spark.createDataFrame([], DATA[name])
    files = (spark.read.schema(T.StructType([*DATA[name].fields, RUN])).option("basePath", f"{root}/{name}")
             .parquet(*[f"{root}/{name}/run={run}" for run in runs]))
    return follow(files, rows)


def write(items: DataFrame, root: str) -> str:
    """Stage and commit without a judgement; returns the run."""
    spark = items.sparkSession
    run = stage(items, root)
    commit(staged_rows(spark, root, run), root)
    return run


def vacuum(spark: SparkSession, root: str, older_than_hours: float = 24.0) -> list[str]:
    """Delete runs that no row in force points to and that are old enough not to be still in the writing.

    Returns their names. Superseded manifest rows stay: they are small and tell what held when.
    """
    in_force = {r.run for r in manifest(spark, root).select("run").distinct().collect()}
    before = (time.time() - 3600 * older_than_hours) * 1e9
    gone = set()
    for name in DATA:
        files, place = _files(spark, f"{root}/{name}")
        if not files.exists(place):
            continue
        for folder in files.listStatus(place):
            run = folder.getPath().getName().removeprefix("run=")
            if run not in in_force and int(run.split("-")[0]) < before:
                files.delete(folder.getPath(), True)
                gone.add(run)
    return sorted(gone)
