"""Numbering rows inside groups of any size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfdiff.session import by_shuffle, cut_lineage


def number_in_group(df: DataFrame, group: list[str], pos: str = "pos", out: str = "rn") -> DataFrame:
    """Number rows 1, 2, ... by ``pos`` inside ``group`` without one task per group.

    The keys alone are sorted into ranges over all groups. A group's rows in one range are numbered
    by themselves and shifted by the group's rows in earlier ranges, which come from a small count
    table; the numbers then meet their rows by key. A group with a third of all rows is spread over
    as many tasks as it has ranges, whatever the gaps between positions and however the rows arrive.
    ``pos`` is of any type that sorts and unique in its group.
    """
    ranged = cut_lineage(df.select(*group, pos).repartitionByRange(*group, pos)
                         .withColumn("_range", F.spark_partition_id()))
    earlier = (Window.partitionBy(*[f"_g{i}" for i in range(len(group))]).orderBy("_r")
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (ranged.groupBy(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_range").alias("_r"))
               .agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n"))

    def same(pairs):
        return reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in pairs])
    inside = Window.partitionBy(*group, "_range").orderBy(pos)
    numbers = (ranged.withColumn("_in_range", F.row_number().over(inside))
               .join(by_shuffle(offsets), same([*[(c, f"_g{i}") for i, c in enumerate(group)], ("_range", "_r")])))
    numbers = numbers.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate([*group, pos])],
                             (F.col("_in_range") + F.col("_before")).cast("bigint").alias(out))
    keys = [f"_k{i}" for i in range(len(group) + 1)]
    return df.join(by_shuffle(numbers), same(zip([*group, pos], keys))).drop(*keys)
