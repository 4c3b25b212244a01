"""Dimension tables of fixed size, and what can be asked about sources."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfdiff import fixed_values as fixed
from shelfdiff import schemas


def _local(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A table inside the plan: Catalyst knows its size and broadcasts it without a hint."""
    columns = list(zip(*rows))
    return spark.createDataFrame(pa.table(dict(zip(schema.names, map(list, columns)))), schema)


def source_dim(spark: SparkSession) -> DataFrame:
    return _local(spark, fixed.SOURCES, schemas.SOURCE_DIM)


def taxonomy_dim(spark: SparkSession) -> DataFrame:
    rows = [(channel, category, i) for channel, categories in fixed.TAXONOMY.items()
            for i, category in enumerate(categories)]
    return _local(spark, rows, schemas.TAXONOMY_DIM)


def channel_dim(spark: SparkSession) -> DataFrame:
    return _local(spark, fixed.CHANNEL_DISPLAY, schemas.CHANNEL_DIM)


def editor_label_dim(spark: SparkSession) -> DataFrame:
    return _local(spark, fixed.CHANNEL_EDITOR_LABEL, schemas.CHANNEL_DIM)


def unknown_sources(items: DataFrame, dim: DataFrame) -> DataFrame:
    """Source ids that are not registered: an error for the caller to raise."""
    return (items.select("source_id").distinct()
            .join(dim.select("source_id"), "source_id", "left_anti"))


def select_sources(df: DataFrame, only: str | None = None, skip: tuple[str, ...] = ()) -> DataFrame:
    """Run one source, or all but some."""
    if only is not None:
        return df.filter(F.col("source_id") == only)
    return df.filter(~F.col("source_id").isin(list(skip))) if skip else df
