"""Helpers the corpus operators share: running totals in groups of any size, and text as bytes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfdiff.session import cut_lineage

#: Words are runs of anything but blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: Ranges that one group is dealt into by ``running_total``; a range of a group is one unit of work.
RANGES = 4096


#: Different values whose counts ``hashed_sample`` broadcasts.
MOST_VALUES = 10_000


def give_back() -> None:
    """Memory that this process has freed goes back to the system; Spark keeps idle Python workers for other tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not the GNU C library
        pass


def tidied(work: Callable) -> Callable:
    """``work`` on the rows of a group, after which the process gives back what it held for them."""
    def run(pdf):
        try:
            return work(pdf)
        finally:
            give_back()
    return run


def tidied_pair(work: Callable) -> Callable:
    """As ``tidied``, for the rows of two tables that meet in a group."""
    def run(left, right):
        try:
            return work(left, right)
        finally:
            give_back()
    return run


def word_count(text: Column) -> Column:
    """Number of words; null counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def running_total(df: DataFrame, group: list[str], spread: str, value: Column | None = None,
                  ties: list[str] | None = None, before: str = "before", total: str = "total",
                  ranges: int = RANGES) -> DataFrame:
    """Add the sum of ``value`` (default 1) over the rows of the group that come before, and over all.

    Rows of a group stand in the order of ``spread``, a column of uniform 64-bit hashes, then of ``ties``.
    The top bits of the hash deal a group into ``ranges`` ranges, each summed by itself and shifted by what the
    earlier ranges hold, which a table of (group, range) tells. A group with a third of all rows is therefore
    worked on by as many tasks as a small table with as many groups. Rows equal in ``spread`` and ``ties`` are
    told apart in no fixed order. Nulls form a group.
    """
    value = F.lit(1).cast("bigint") if value is None else value
    bits = max(1, (ranges - 1).bit_length())
    ranged = (df.withColumn("_range", F.shiftrightunsigned(F.col(spread), 64 - bits))
              .withColumn("_value", value.cast("bigint")))
    inside = Window.partitionBy(*group, "_range").orderBy(spread, *(ties or []))
    summed = ranged.groupBy(*group, "_range").agg(F.sum("_value").alias("_n"))
    whole = Window.partitionBy(*group)
    offsets = summed.select(
        *[F.col(c).alias(f"_g_{c}") for c in group], F.col("_range").alias("_g_range"),
        F.coalesce(F.sum("_n").over(whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_earlier"),
        F.sum("_n").over(whole).alias(total))
    same = F.col("_range") == F.col("_g_range")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return (ranged.withColumn("_upto", F.sum("_value").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
            .join(offsets, same)
            .withColumn(before, F.col("_earlier") + F.col("_upto") - F.col("_value"))
            .drop("_range", "_value", "_upto", "_earlier", "_g_range", *[f"_g_{c}" for c in group]))


def hashed_sample(df: DataFrame, by: str, spread: str, size: int) -> DataFrame:
    """At most ``size`` rows of each ``by``, those with the lowest ``spread``, a uniform 64-bit hash.

    Rows are counted first, and only those whose hash lies in the part of its range where four times ``size`` are
    to be expected are ranked, so a value with a third of all rows ranks no more rows than a rare one. The counts, a
    row a value, are broadcast if there are at most ``MOST_VALUES``; no row is then shuffled before it is chosen.
    Pass narrow rows. Rows with a null ``by`` are left out.
    """
    rows = df.filter(F.col(by).isNotNull())
    counts = cut_lineage(rows.groupBy(F.col(by).alias("_by")).agg(F.count(F.lit(1)).alias("_n")))
    if counts.count() <= MOST_VALUES:
        counts = F.broadcast(counts)
    share = F.shiftrightunsigned(F.col(spread), 11) / F.lit(float(1 << 53))
    few = (rows.join(counts, F.col(by) == F.col("_by")).filter(share * F.col("_n") <= 4 * size))
    order = Window.partitionBy(by).orderBy(F.shiftrightunsigned(F.col(spread), 1), spread)
    return few.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= size).drop("_by", "_n", "_rank")
