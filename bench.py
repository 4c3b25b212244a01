"""Time the headline queries: one JSON line on standard output.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores;
BENCH_PAIR_ROWS (default 1000000) sizes the extra matches over a derived catalog pair: one whose rows have keys of their
own, and one of a single source in which three rows in ten share one name, so that their keys contest each other.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from shelfdiff.operators import match
from shelfdiff.plans import all_queries  # noqa: F401
from shelfdiff.plans.catalog import QUERIES
from shelfdiff.session import local_session

HEADLINE = [
    "normalize_name", "strip_markup", "html_list_records", "json_envelope_rows",
    "nested_category_explode", "dedupe_first_price_guard", "dedupe_seen_pages", "page_repeat_check",
    "category_count_check", "lookback_snapshot", "volume_check", "hold_previous", "layered_match",
    "changed_fields", "similarity_candidates", "diff_counts", "contested_match", "request_payload",
    "apply_edit", "publish_projection", "validate_publication", "source_report", "facets",
    "text_search", "sample_per_group", "transcript_render",
]


def big_pair(spark, rows: int, hot: int = 0):
    """Two snapshots of ``rows`` items: a few leave, arrive, or change all their keys; ``hot`` of them share a name."""
    base = spark.range(rows).select(
        F.lit("cu").alias("source_id"), F.lit("2026-W36").alias("week"), F.col("id").alias("pos"),
        F.col("id").cast("string").alias("k"),
        F.when(F.col("id") < hot, "hot").otherwise(F.md5(F.col("id").cast("string"))).alias("name"),
        F.when(F.col("id") >= hot, F.col("id") % 997).alias("price"))

    def side(mark):
        reissued = F.when((F.col("pos") % 50 == 7) & F.lit(mark == "n"), F.lit("r")).otherwise(F.lit(""))
        return base.select(
            "source_id", "week", "pos", F.concat(reissued, "k").alias("external_id"),
            F.create_map(F.lit("barcode"), F.concat(reissued, F.lit("88"), "k")).alias("alt_ids"),
            "name", "price").filter(F.col("pos") % 100 != (1 if mark == "n" else 2))
    return side("o"), side("n")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["week_of"].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    QUERIES["similarity"].run(spark, sf_dir).write.format("noop").mode("overwrite").save()

    times = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)

    extra = {}
    rows = int(os.environ.get("BENCH_PAIR_ROWS", "1000000"))
    if rows and not sys.argv[1:]:
        for name, hot in (("pair", 0), ("contested_pair", 3 * rows // 10)):
            prev, cur = big_pair(spark, rows, hot)
            start = time.perf_counter()
            pairs = match.layered_match(prev, cur).count()
            extra |= {f"{name}_match_sec": round(time.perf_counter() - start, 3), f"{name}_rows": rows,
                      f"{name}_matched": pairs}
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")), **extra}))


if __name__ == "__main__":
    main()
