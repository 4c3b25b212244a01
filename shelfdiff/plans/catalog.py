"""Query registry, and catalog inputs derived from the given tables.

Spark and the SQL twins derive the same inputs: what both dialects understand is written once
as SQL, the rest twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfdiff.functions import weeks as W
from shelfdiff.session import by_shuffle


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(t)`` under ``name``; ``t`` gives access to the tables."""
    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(lambda spark, sf_dir: fn(Tables(spark, sf_dir)), oracle)
        return fn
    return register


class Tables:
    """``t.part``, ``t.lineitem``, ...: the given tables; ``t.sql`` runs SQL over them."""

    NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
             "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        used = {n: getattr(self, n) for n in self.NAMES if "{" + n + "}" in text}
        return self.spark.sql(text, **used)


def duck(text: str) -> str:
    """The same text for DuckDB, where the tables are views."""
    return text.format(**{n: n for n in Tables.NAMES})


# ---------------------------------------------------------------- two snapshots of one catalog
# Parts are the products of three sources. Between the snapshots one brand is launched
# ('Brand#1') and one withdrawn ('Brand#2'), and some products change their price, their name,
# their barcode, or all their keys.

_PRODUCTS = """
SELECT p_partkey AS pos, p_brand, p_name, p_size, p_type AS category_raw,
       CASE p_partkey % 3 WHEN 0 THEN 'cu' WHEN 1 THEN 'orion' ELSE 'starbucks' END AS source_id,
       CAST(p_partkey AS STRING) AS k, substr(md5(CAST(p_partkey AS STRING)), 1, 16) AS base_name,
       CAST(round(p_retailprice * 100) AS BIGINT) AS base_price
FROM {part}
"""

_SHARED = """
       CASE WHEN p_size > 25 THEN 'About ' || p_name END AS description,
       CASE WHEN p_size > 10 THEN p_brand END AS tag,
       'https://img.example/' || k || '.jpg' AS image_url,
       'https://shop.example/' || k AS source_url"""

_FIRST_KEYS = f"""
SELECT source_id, '2026-W36' AS week, pos, k AS external_id,
       CAST(pos + 8800000000000 AS STRING) AS barcode, k AS gd_idx,
       base_name AS name, base_price AS price, category_raw,{_SHARED}
FROM ({_PRODUCTS}) products"""

PREV_SQL = f"""{_FIRST_KEYS} WHERE p_brand <> 'Brand#1'
"""

# The snapshot before that: 'Brand#3' and half of 'Brand#2' are launched behind it.
EARLIER_SQL = f"""{_FIRST_KEYS} WHERE p_brand NOT IN ('Brand#1', 'Brand#3') AND (p_brand <> 'Brand#2' OR pos % 2 = 0)
"""

CUR_SQL = f"""
SELECT source_id, '2026-W36' AS week, pos,
       CASE WHEN pos % 13 = 0 THEN 'r' || k ELSE k END AS external_id,
       CAST(pos + 8800000000000 + CASE WHEN pos % 13 = 0 OR pos % 17 = 0
            THEN 1000000000000 ELSE 0 END AS STRING) AS barcode,
       CASE WHEN pos % 13 = 0 THEN CAST(pos + 10000000 AS STRING) ELSE k END AS gd_idx,
       CASE WHEN pos % 11 = 0 THEN base_name || ' v2' ELSE base_name END AS name,
       base_price + CASE WHEN pos % 7 = 0 THEN 100 ELSE 0 END AS price, category_raw,{_SHARED}
FROM ({_PRODUCTS}) products WHERE p_brand <> 'Brand#2'
"""


def _as_items(df: DataFrame) -> DataFrame:
    return df.select(
        "source_id", "week", "pos", "external_id",
        F.create_map(F.lit("barcode"), F.col("barcode"), F.lit("gd_idx"), F.col("gd_idx"))
        .alias("alt_ids"),
        "name", "price", "category_raw", "description",
        F.array_compact(F.array("tag")).alias("tags"), "image_url", "source_url")


def earlier_items(t: Tables) -> DataFrame:
    return _as_items(t.sql(EARLIER_SQL))


def prev_items(t: Tables) -> DataFrame:
    return _as_items(t.sql(PREV_SQL))


def cur_items(t: Tables) -> DataFrame:
    return _as_items(t.sql(CUR_SQL))


def _pair_cte(prev: str, cur: str) -> str:
    return duck(f"""
prev AS ({prev}), cur AS ({cur}),
edges AS (
  SELECT c.source_id, c.pos AS cur_pos, p.pos AS prev_pos, 0 AS rank, 'barcode' AS k
  FROM cur c JOIN prev p ON c.source_id = p.source_id AND c.barcode = p.barcode
  UNION ALL SELECT c.source_id, c.pos, p.pos, 1, 'gd_idx'
  FROM cur c JOIN prev p ON c.source_id = p.source_id AND c.gd_idx = p.gd_idx
  UNION ALL SELECT c.source_id, c.pos, p.pos, 2, 'external_id'
  FROM cur c JOIN prev p ON c.source_id = p.source_id AND c.external_id = p.external_id
  UNION ALL SELECT c.source_id, c.pos, p.pos, 3, 'name_price'
  FROM cur c JOIN prev p ON c.source_id = p.source_id AND c.name = p.name AND c.price = p.price),
matches AS (SELECT source_id, cur_pos, prev_pos, arg_min(k, rank) AS matched_by
            FROM edges GROUP BY ALL),
left_cur AS (SELECT c.* FROM cur c
             WHERE c.pos NOT IN (SELECT cur_pos FROM matches)),
left_prev AS (SELECT p.* FROM prev p
              WHERE p.pos NOT IN (SELECT prev_pos FROM matches)),
review AS (
  SELECT c.source_id, c.pos AS cur_pos, p.pos AS prev_pos,
         round(2.0 * length(p.name) / (length(p.name) + length(c.name)), 4) AS similarity
  FROM left_cur c JOIN left_prev p ON c.source_id = p.source_id AND c.pos = p.pos
   AND c.category_raw = p.category_raw AND starts_with(c.name, p.name)),
added AS (SELECT * FROM left_cur WHERE pos NOT IN (SELECT cur_pos FROM review)),
removed AS (SELECT * FROM left_prev WHERE pos NOT IN (SELECT prev_pos FROM review)),
pairs AS (
  SELECT m.source_id, m.cur_pos, m.prev_pos, m.matched_by, c.name AS cur_name, c.price AS cur_price,
         c.image_url AS cur_image, c.category_raw AS cur_cat, p.name AS prev_name,
         p.price AS prev_price, p.image_url AS prev_image, p.category_raw AS prev_cat,
         c.barcode AS cur_barcode, p.barcode AS prev_barcode, c.gd_idx AS cur_gd,
         p.gd_idx AS prev_gd
  FROM matches m JOIN cur c ON c.pos = m.cur_pos JOIN prev p ON p.pos = m.prev_pos),
conflicts AS (
  SELECT source_id, cur_pos, prev_pos, matched_by, 'barcode' AS conflicting_key,
         prev_barcode AS previous, cur_barcode AS current, cur_name AS name
  FROM pairs WHERE prev_barcode <> cur_barcode
  UNION ALL SELECT source_id, cur_pos, prev_pos, matched_by, 'gd_idx', prev_gd, cur_gd, cur_name
  FROM pairs WHERE prev_gd <> cur_gd)
""")


PAIR_CTE = _pair_cte(PREV_SQL, CUR_SQL)
EARLIER_CTE = _pair_cte(EARLIER_SQL, PREV_SQL)

# ---------------------------------------------------------------- weekly catalogs of suppliers
# Every supplier is a source, its catalog of a week are the parts it shipped in it. Weeks in
# which a supplier shipped nothing are missing snapshots.

DUCK_WEEK = "printf('%d-W%02d', isoyear({0}), weekofyear({0}))"
DUCK_MONDAY = ("(make_date(cast(substr({0}, 1, 4) AS int), 1, 4) "
               "- cast(isodow(make_date(cast(substr({0}, 1, 4) AS int), 1, 4)) - 1 AS int) "
               "+ 7 * (cast(substr({0}, 7, 2) AS int) - 1))")


def weekly_rows(t: Tables) -> DataFrame:
    """Shipped lines as raw rows: the same part may come several times a week."""
    return (t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
            .select(F.concat(F.lit("sup"), F.col("l_suppkey").cast("string")).alias("source_id"),
                    W.week_of(F.col("l_shipdate")).alias("week"),
                    F.col("l_partkey").alias("pos"),
                    F.col("l_partkey").cast("string").alias("external_id"),
                    F.col("p_type").alias("category_raw"), F.col("p_name").alias("name"),
                    F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("price"),
                    F.col("l_orderkey"), F.col("l_linenumber"),
                    (F.col("l_returnflag") == "R").alias("is_new"),
                    F.col("l_shipdate").alias("scraped_at")))


def weekly_items(t: Tables) -> DataFrame:
    """One row per part and week.

    Lines are dealt by part once, which serves their grouping and the join; texts are made of the grouped rows.
    """
    lines = t.lineitem.select(
        "l_suppkey", "l_partkey", F.date_trunc("week", "l_shipdate").cast("date").alias("_monday"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("price"),
        (F.col("l_returnflag") == "R").alias("is_new"), F.col("l_shipdate").alias("scraped_at"))
    grouped = lines.repartition("l_partkey").groupBy("l_suppkey", "_monday", "l_partkey").agg(
        F.min("price").alias("price"), F.max("is_new").alias("is_new"), F.min("scraped_at").alias("scraped_at"))
    parts = t.part.select("p_partkey", "p_type", "p_name").distinct()
    return (grouped.join(by_shuffle(parts), F.col("l_partkey") == F.col("p_partkey"))
            .select(F.concat(F.lit("sup"), F.col("l_suppkey").cast("string")).alias("source_id"),
                    W.week_of(F.col("_monday")).alias("week"), F.col("l_partkey").alias("pos"),
                    F.col("l_partkey").cast("string").alias("external_id"), F.col("p_type").alias("category_raw"),
                    F.col("p_name").alias("name"), "price", "is_new", "scraped_at"))


WEEKLY_CTE = f"""
rows AS (
  SELECT 'sup' || CAST(l_suppkey AS STRING) AS source_id, {DUCK_WEEK.format('l_shipdate')} AS week,
         l_partkey AS pos, CAST(l_partkey AS STRING) AS external_id, p_type AS category_raw,
         p_name AS name, CAST(round(l_extendedprice * 100) AS BIGINT) AS price, l_orderkey,
         l_linenumber, l_returnflag = 'R' AS is_new, l_shipdate AS scraped_at
  FROM lineitem JOIN part ON l_partkey = p_partkey),
items AS (SELECT source_id, week, pos, external_id, category_raw, name, min(price) AS price,
                 bool_or(is_new) AS is_new, min(scraped_at) AS scraped_at
          FROM rows GROUP BY ALL),
meta AS (SELECT source_id, week, count(*) AS n FROM items GROUP BY ALL),
idx AS (SELECT *, cast(({DUCK_MONDAY.format('week')} - DATE '1970-01-05') / 7 AS int) AS wi
        FROM meta),
look AS (SELECT source_id, week, n, wi, last_value(week) OVER (PARTITION BY source_id ORDER BY wi
                RANGE BETWEEN 4 PRECEDING AND 1 PRECEDING) AS previous_week FROM idx)
"""

# ---------------------------------------------------------------- category dimension
# Types are categories, in the order of their names; no bootstrap count for LARGE.

_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def category_dim(t: Tables) -> DataFrame:
    types = F.array(*[F.lit(name) for name in _TYPES])
    rows = t.supplier.select(F.concat(F.lit("sup"), F.col("s_suppkey").cast("string")).alias("source_id"),
                             F.posexplode(types).alias("i", "name"))
    priority = (F.col("i") + 1).cast("bigint")
    return rows.select("source_id", F.concat(F.lit("c"), priority.cast("string")).alias("code"), "name",
                       priority.alias("priority"),
                       F.when(F.col("name") != "LARGE", 1 + priority % 2).alias("bootstrap_count"))


CATEGORY_CTE = f"""dim AS (
SELECT source_id, 'c' || CAST(priority AS STRING) AS code, name, priority,
       CASE WHEN name <> 'LARGE' THEN 1 + priority % 2 END AS bootstrap_count
FROM (SELECT source_id, unnest({_TYPES}) AS name, unnest([1, 2, 3, 4, 5, 6]::BIGINT[]) AS priority
      FROM (SELECT 'sup' || CAST(s_suppkey AS STRING) AS source_id FROM supplier) s) c)"""
