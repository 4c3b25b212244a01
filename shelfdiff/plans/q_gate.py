"""Queries over filters, deduplication and the trust gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfdiff import schemas
from shelfdiff.operators import dedupe, diff, filters, gate
from shelfdiff.plans import weekly
from shelfdiff.plans.catalog import (CATEGORY_CTE, PAIR_CTE, WEEKLY_CTE, category_dim, cur_items, prev_items, query,
                                     weekly_items, weekly_rows)
from shelfdiff.session import scratch_path
from shelfdiff.sources import snapshots, tables

_ = F.col

# ---------------------------------------------------------------- filters


def _types(t, *names):
    """Those part types that are in ``names``, as a one-column table."""
    return t.part.select(_("p_type").alias("category")).distinct().filter(_("category").isin(*names))


@query("scope_exclude", """
SELECT l_returnflag, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE p_type NOT IN ('LARGE', 'PROMO') GROUP BY ALL
""")
def _scope(t):
    rows = t.lineitem.join(t.part.withColumn("category", _("p_type")), _("l_partkey") == _("p_partkey"))
    kept, _dropped = filters.scope_exclude(rows, _types(t, "LARGE", "PROMO"))
    return kept.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("scope_exclude_counts", """
SELECT p_type AS category, count(*) AS dropped FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE p_type IN ('LARGE', 'PROMO') GROUP BY ALL
""")
def _scope_counts(t):
    rows = t.lineitem.join(t.part.withColumn("category", _("p_type")), _("l_partkey") == _("p_partkey"))
    return filters.scope_exclude(rows, _types(t, "LARGE", "PROMO"))[1]


@query("unknown_category_reject", """
SELECT nullif(p_type, 'SMALL') AS category, count(*) AS rows FROM part
WHERE p_type IN ('SMALL', 'STANDARD') GROUP BY ALL
""")
def _unknown(t):
    rows = t.part.select(F.when(_("p_type") != "SMALL", _("p_type")).alias("category"))
    return filters.unknown_categories(rows, _types(t, "ECONOMY", "LARGE", "MEDIUM", "PROMO"))


@query("mixed_list_filter", """
SELECT l_linestatus, l_returnflag, count(*) AS n, l_returnflag <> 'R' AS rejected FROM lineitem
WHERE l_returnflag = 'R' OR l_linestatus = 'O' GROUP BY ALL
""")
def _mixed(t):
    rows = t.lineitem.withColumn("mixed", _("l_linestatus") == "F")
    kept, rejected = filters.class_filter(rows, "l_returnflag", ["R"], "mixed")
    both = kept.withColumn("rejected", F.lit(False)).unionByName(rejected.withColumn("rejected", F.lit(True)))
    return both.groupBy("l_linestatus", "l_returnflag", "rejected").agg(F.count(F.lit(1)).alias("n"))


@query("category_subset", f"""
WITH {WEEKLY_CTE}, {CATEGORY_CTE}
SELECT source_id, category_raw, count(*) AS n FROM items WHERE category_raw IN ('ECONOMY', 'MEDIUM')
GROUP BY ALL
""")
def _subset(t):
    codes = t.spark.createDataFrame([("c1",), ("c3",), ("c99",)], "code string")
    items, _unknown_codes = filters.category_subset(weekly_items(t), codes, category_dim(t))
    return items.groupBy("source_id", "category_raw").agg(F.count(F.lit(1)).alias("n"))


@query("nameless_rows", """
SELECT c_nationkey, count(*) AS skipped FROM customer WHERE c_acctbal < 0 OR c_mktsegment = 'BUILDING'
GROUP BY ALL
""")
def _nameless(t):
    name = F.when(_("c_acctbal") < 0, "").when(_("c_mktsegment") != "BUILDING", _("c_name"))
    return filters.nameless(t.customer.withColumn("name", name), ["c_nationkey"])[1]


_PUB_SQL = """
SELECT o_orderkey, o_orderpriority AS channel, o_orderstatus AS brand,
       CASE WHEN o_totalprice > 50000 THEN p_type END AS category, p_name AS name,
       CASE WHEN o_totalprice > 200000 THEN p_brand END AS blurb
FROM {orders} JOIN {part} ON o_custkey = p_partkey
"""


def published_orders(t):
    """Orders as published items: priority is the channel, a part gives name and blurb."""
    return t.sql(_PUB_SQL)


def _pub():
    return "pub AS (" + _PUB_SQL.format(orders="orders", part="part") + ")"


@query("facet_filter", f"""
WITH {_pub()} SELECT channel, brand, category, count(*) AS n FROM pub
WHERE channel IN ('1-URGENT', '5-LOW') AND category IN ('PROMO', 'LARGE', 'SMALL') GROUP BY ALL
""")
def _facet_filter(t):
    return filters.facet_filter(published_orders(t), channels=("1-URGENT", "5-LOW"),
                                categories=("PROMO", "LARGE", "SMALL")) \
        .groupBy("channel", "brand", "category").agg(F.count(F.lit(1)).alias("n"))


@query("text_search", f"""
WITH {_pub()} SELECT o_orderkey FROM pub
WHERE contains(lower(replace(name || ' ' || coalesce(blurb, ''), ' ', '')), 'ringbrand#1')
""")
def _text_search(t):
    return filters.text_search(published_orders(t), " Ring BRAND#1").select("o_orderkey")


# ---------------------------------------------------------------- deduplication


@query("dedupe_first_price_guard", """
SELECT source_id, external_id, l_linenumber AS first_line, l_orderkey FROM (
  SELECT 'sup' || CAST(l_suppkey AS STRING) AS source_id, CAST(l_partkey AS STRING) AS external_id,
         l_linenumber, l_orderkey, row_number() OVER (PARTITION BY l_suppkey, l_partkey
           ORDER BY l_linenumber, l_orderkey) AS rn FROM lineitem) x WHERE rn = 1
""")
def _dedupe_price(t):
    kept, _conflicts = dedupe.dedupe(weekly_rows(t), ["source_id", "external_id"],
                                     ["l_linenumber", "l_orderkey"], guard="price", tolerated="name")
    return kept.select("source_id", "external_id", _("l_linenumber").alias("first_line"), "l_orderkey")


@query("dedupe_price_conflicts", """
SELECT l_partkey, count(*) AS rows, min(price) AS lowest, max(price) AS highest FROM (
  SELECT l_partkey, CASE WHEN l_quantity > 2 THEN CAST(round(l_tax * 100) AS BIGINT) END AS price
  FROM lineitem) x GROUP BY ALL
HAVING min(price) <> max(price) OR (count(price) < count(*) AND count(price) > 0)
""")
def _dedupe_price_conflicts(t):
    rows = t.lineitem.withColumn("price", F.when(
        _("l_quantity") > 2, F.round(_("l_tax") * 100).cast("bigint")))
    return dedupe.dedupe(rows, ["l_partkey"], ["l_orderkey"], guard="price")[1]


@query("dedupe_first_name_guard", """
SELECT p_type, p_size, count(*) AS rows, min(p_name) AS lowest, max(p_name) AS highest
FROM part GROUP BY ALL HAVING min(p_name) <> max(p_name)
""")
def _dedupe_name(t):
    return dedupe.dedupe(t.part, ["p_type", "p_size"], ["p_partkey"], guard="p_name")[1]


@query("dedupe_priority_no_guard", """
SELECT p_name, p_type, p_size, p_partkey FROM (
  SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_type = 'PROMO', p_size, p_partkey) AS rn
  FROM part) x WHERE rn = 1
""")
def _dedupe_promo(t):
    kept = dedupe.dedupe_promo_last(t.part, ["p_name"], _("p_type") == "PROMO", _("p_size"), "p_partkey")
    return kept.select("p_name", "p_type", "p_size", "p_partkey")


_PAGES_SQL = """
SELECT date_trunc('month', o_orderdate) AS m, o_custkey, o_orderkey, o_orderstatus,
       CAST(extract(day FROM o_orderdate) AS BIGINT) AS page FROM {orders}
"""


def _day_pages(t):
    """Orders of a month and status as a list, one page per day, customers as keys."""
    return t.sql(_PAGES_SQL).withColumn("m", F.date_format("m", "yyyy-MM")).select(
        "m", "o_orderstatus", "page", (_("o_custkey") % 40).alias("external_id"), "o_orderkey")


_DAY_PAGES = ("pages_of AS (SELECT strftime(m, '%Y-%m') AS m, o_orderstatus, page, o_custkey % 40 AS external_id, "
              "o_orderkey FROM (" + _PAGES_SQL.format(orders="orders") + ") x)")


@query("dedupe_seen_pages", f"""
WITH {_DAY_PAGES},
seen AS (SELECT *, min(page) OVER (PARTITION BY m, o_orderstatus, external_id) AS first_page FROM pages_of),
dead AS (SELECT m, o_orderstatus, min(page) AS stop FROM (
           SELECT m, o_orderstatus, page FROM seen GROUP BY ALL HAVING count(*) FILTER (page = first_page) = 0) d
         GROUP BY ALL)
SELECT s.m, s.o_orderstatus, s.page, s.external_id, s.o_orderkey FROM seen s
LEFT JOIN dead d ON s.m = d.m AND s.o_orderstatus = d.o_orderstatus
WHERE page = first_page AND (stop IS NULL OR page < stop)
""")
def _dedupe_pages(t):
    return dedupe.dedupe_pages(_day_pages(t), ["m", "o_orderstatus"])


@query("reject_duplicate_key", """
SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1
""")
def _duplicate_key(t):
    return dedupe.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


# ---------------------------------------------------------------- trust gate


@query("category_counts", f"""
WITH {WEEKLY_CTE}, {CATEGORY_CTE}
SELECT i.source_id, i.week, d.code, count(*) AS n FROM items i
JOIN dim d ON d.source_id = i.source_id AND d.name = i.category_raw GROUP BY ALL
""")
def _category_counts(t):
    return gate.category_counts(weekly_items(t), category_dim(t))


_EXPECTED = f"""
WITH {WEEKLY_CTE}, {CATEGORY_CTE},
counts AS (SELECT i.source_id, i.week, d.code, count(*) AS n FROM items i
           JOIN dim d ON d.source_id = i.source_id AND d.name = i.category_raw GROUP BY ALL),
expected AS (
  SELECT l.source_id, l.week, c.code, c.n AS want, 0.3::DOUBLE AS low, 3.0::DOUBLE AS high FROM look l
  JOIN counts c ON c.source_id = l.source_id AND c.week = l.previous_week
  UNION ALL
  SELECT l.source_id, l.week, d.code, d.bootstrap_count, (1 - 0.1)::DOUBLE, (1 + 0.1)::DOUBLE FROM look l
  JOIN dim d ON d.source_id = l.source_id
  WHERE l.previous_week IS NULL AND d.bootstrap_count IS NOT NULL),
off_range AS (
  SELECT e.source_id, e.week, e.code, e.want, coalesce(c.n, 0) AS got FROM expected e
  LEFT JOIN counts c ON c.source_id = e.source_id AND c.week = e.week AND c.code = e.code
  WHERE want > 0 AND NOT (want * low <= coalesce(c.n, 0) AND coalesce(c.n, 0) <= want * high))
"""


def _kept(t, df):
    """A table as it lies in a store."""
    path = scratch_path(t.spark, "kept")
    df.write.parquet(path)
    return t.spark.read.parquet(path)


def _gate_inputs(t):
    """What a store keeps with its snapshots: counts by category name, and from them one row a source-week."""
    counts = _kept(t, gate.name_counts(weekly_items(t)))
    meta = _kept(t, counts.groupBy("week", "source_id").agg(F.sum("n").alias("count")))
    return counts, meta, _kept(t, diff.lookback(meta)), category_dim(t)


@query("category_count_check", _EXPECTED + "SELECT * FROM off_range")
def _category_check(t):
    items, _meta, look, dim = _gate_inputs(t)
    return gate.check_categories(items, dim, look)


@query("new_category_report", _EXPECTED + """
SELECT c.source_id, c.week, c.code, c.n FROM counts c LEFT JOIN expected e
ON c.source_id = e.source_id AND c.week = e.week AND c.code = e.code WHERE e.code IS NULL
""")
def _new_categories(t):
    items, _meta, look, dim = _gate_inputs(t)
    return gate.new_categories(items, dim, look)


_VOLUME = """
SELECT l.source_id, l.week, l.previous_week, m.n AS before, l.n AS count,
       CASE WHEN l.n = 0 THEN 'empty' WHEN m.n IS NULL THEN 'ok'
            WHEN l.n::DOUBLE / m.n < 0.3 THEN 'drop' WHEN l.n::DOUBLE / m.n > 3.0 THEN 'spike'
            ELSE 'ok' END AS verdict
FROM look l LEFT JOIN meta m ON m.source_id = l.source_id AND m.week = l.previous_week
"""


@query("volume_check", f"WITH {WEEKLY_CTE} {_VOLUME}")
def _volume(t):
    meta = tables.snapshot_meta(weekly_items(t))
    return gate.check_volume(meta, diff.lookback(meta))


@query("duplicate_key_check", f"""
WITH {WEEKLY_CTE} SELECT source_id, week, count(*) - count(DISTINCT external_id) AS duplicates FROM rows
GROUP BY ALL HAVING count(*) > count(DISTINCT external_id)
""")
def _duplicates(t):
    return gate.check_duplicates(weekly_rows(t))


@query("lookback_snapshot", f"WITH {WEEKLY_CTE} SELECT source_id, week, previous_week FROM look")
def _lookback(t):
    return diff.lookback(tables.snapshot_meta(weekly_items(t)))


@query("gate_verdict", _EXPECTED + f""",
volume AS ({_VOLUME}), dup AS (
  SELECT source_id, week FROM rows GROUP BY ALL HAVING count(*) > count(DISTINCT external_id)),
judged AS (
  SELECT l.source_id, l.week, CASE WHEN o.week IS NOT NULL THEN 'categories' WHEN v.verdict <> 'ok' THEN v.verdict
         WHEN d.week IS NOT NULL THEN 'duplicates' END AS reason
  FROM look l LEFT JOIN (SELECT DISTINCT source_id, week FROM off_range) o
    ON o.source_id = l.source_id AND o.week = l.week
  JOIN volume v ON v.source_id = l.source_id AND v.week = l.week
  LEFT JOIN dup d ON d.source_id = l.source_id AND d.week = l.week)
SELECT source_id, week, reason IS NULL AS ok, reason FROM judged
""")
def _gate_verdict(t):
    counts, meta, look, dim = _gate_inputs(t)
    return gate.gate_verdict(meta, counts, dim, look, duplicates=gate.check_duplicates(weekly_rows(t)))


@query("source_isolation", _EXPECTED + f""",
volume AS ({_VOLUME}), dup AS (
  SELECT source_id, week FROM rows GROUP BY ALL HAVING count(*) > count(DISTINCT external_id))
SELECT l.week, l.source_id, CASE WHEN o.week IS NOT NULL THEN 'categories' WHEN v.verdict <> 'ok' THEN v.verdict
       ELSE 'duplicates' END AS reason
FROM look l LEFT JOIN (SELECT DISTINCT source_id, week FROM off_range) o
  ON o.source_id = l.source_id AND o.week = l.week
JOIN volume v ON v.source_id = l.source_id AND v.week = l.week
LEFT JOIN dup d ON d.source_id = l.source_id AND d.week = l.week
WHERE o.week IS NOT NULL OR v.verdict <> 'ok' OR d.week IS NOT NULL
""")
def _isolation(t):
    return gate.failed_sources(_gate_verdict(t))


def _stored_meta(t):
    """Weekly snapshots as stored: those with nothing new are held from an earlier week."""
    fresh = weekly_items(t).groupBy("source_id", "week").agg(
        F.count(F.lit(1)).alias("count"), F.max("is_new").alias("fresh"),
        F.min("scraped_at").alias("scraped_at"))
    return fresh.withColumn("held_from", F.when(~_("fresh"), F.lit("1994-W52"))).drop("fresh")


_STORED = "stored AS (SELECT source_id, week, count(*) AS n, CASE WHEN NOT bool_or(is_new) " \
          "THEN '1994-W52' END AS held_from FROM items GROUP BY ALL)"


@query("snapshot_once", f"WITH {WEEKLY_CTE}, {_STORED} SELECT source_id, week FROM stored "
                        "WHERE held_from IS NOT NULL")
def _snapshot_once(t):
    meta = _stored_meta(t)
    return gate.accept_new(meta.select("source_id", "week"), meta)


@query("hold_previous", f"""
WITH {WEEKLY_CTE}, {_STORED},
fill AS (SELECT l.source_id, l.week, l.previous_week FROM look l JOIN stored s
         ON s.source_id = l.source_id AND s.week = l.week
         WHERE s.held_from IS NOT NULL AND l.previous_week IS NOT NULL)
SELECT f.source_id, f.week, coalesce(s.held_from, f.previous_week) AS held_from, s.n AS count,
       (SELECT count(*) FROM items i WHERE i.source_id = f.source_id AND i.week = f.previous_week) AS items
FROM fill f JOIN stored s ON s.source_id = f.source_id AND s.week = f.previous_week
""")
def _hold(t):
    items, meta = weekly_items(t), _kept(t, _stored_meta(t).withColumn("data_week", _("week")))
    held = gate.hold_previous(meta.filter("held_from IS NOT NULL"), meta, diff.lookback(meta))
    counts = snapshots.follow(items, held).groupBy("source_id", "week").agg(F.count(F.lit(1)).alias("items"))
    return held.join(counts, ["source_id", "week"]).select("source_id", "week", "held_from", "count", "items")


_LISTS_SQL = """
SELECT strftime(date_trunc('month', l_shipdate), '%Y-%m') AS month, l_returnflag AS list, l_orderkey,
       l_linenumber, l_partkey FROM lineitem
"""


def _listed(t):
    """Lines of a month as the rows of three lists, one per return flag."""
    return t.lineitem.select(F.date_format("l_shipdate", "yyyy-MM").alias("month"),
                             _("l_returnflag").alias("list"), "l_partkey", "l_orderkey", "l_linenumber",
                             "l_quantity")


@query("declared_total_check", f"""
WITH listed AS ({_LISTS_SQL}), n AS (SELECT month, list, count(*) AS received FROM listed GROUP BY ALL),
totals AS (SELECT month, list, CASE WHEN list = 'A' THEN NULL WHEN substr(month, 6, 2) = '02' THEN received + 1
           ELSE received END AS total FROM n)
SELECT month, list, total, received FROM totals JOIN n USING (month, list)
WHERE total IS NULL OR total <> received
""")
def _declared(t):
    rows = _listed(t)
    n = F.count(F.lit(1))
    totals = rows.groupBy("month", "list").agg(
        F.when(_("list") != "A", F.when(_("month").endswith("-02"), n + 1).otherwise(n)).alias("total"))
    return gate.check_declared_total(rows, totals, ["month", "list"])


@query("cross_list_total_check", f"""
WITH listed AS ({_LISTS_SQL})
SELECT month, count(*) + 2 AS declared, count(*) AS received
FROM listed WHERE substr(month, 6, 2) = '03' GROUP BY month
""")
def _all_list(t):
    rows = _listed(t)
    per_month = F.count(F.lit(1)) + F.when(_("month").endswith("-03"), 2).otherwise(0)
    totals = rows.groupBy("month").agg(per_month.alias("total")).withColumn("list", F.lit("ALL"))
    return gate.check_all_list(rows, totals, ["month"], "list", "ALL")


@query("page_repeat_check", f"""
WITH {_DAY_PAGES}, k AS (SELECT DISTINCT m, o_orderstatus, page, external_id // 20 AS key FROM pages_of),
s AS (SELECT m, o_orderstatus, page, list(key ORDER BY key) AS ks FROM k GROUP BY ALL)
SELECT a.m, a.o_orderstatus, a.page, CAST(len(a.ks) AS BIGINT) AS keys FROM s a JOIN s b
ON a.m = b.m AND a.o_orderstatus = b.o_orderstatus AND a.page = b.page + 1 AND a.ks = b.ks
""")
def _page_repeat(t):
    rows = _day_pages(t).withColumn("external_id", F.floor(_("external_id") / 20))
    return gate.repeated_pages(rows, ["m", "o_orderstatus"])


@query("page_overflow_check", f"""
WITH {_DAY_PAGES}, s AS (SELECT m, o_orderstatus, page, count(*) AS n FROM pages_of GROUP BY ALL),
l AS (SELECT m, o_orderstatus, max(page) AS last_page, min(page) FILTER (n < 2) AS short_page FROM s GROUP BY ALL)
SELECT *, last_page > 29 AS over_max, coalesce(last_page > short_page, false) AS after_short FROM l
WHERE last_page > 29 OR coalesce(last_page > short_page, false)
""")
def _page_overflow(t):
    return gate.page_overflow(_day_pages(t), ["m", "o_orderstatus"], page_size=2, max_pages=29)


@query("paged_lists", f"""
WITH listed AS ({_LISTS_SQL}), keyed AS (SELECT DISTINCT month, list, l_partkey FROM listed)
SELECT month, list, page, count(*) AS n, min(l_partkey) AS first_key FROM (
  SELECT *, CAST((row_number() OVER (PARTITION BY month, list ORDER BY l_partkey) - 1) // 40 + 1 AS BIGINT) AS page
  FROM keyed) x GROUP BY ALL
""")
def _paged(t):
    keyed = _listed(t).select("month", "list", "l_partkey").distinct()
    return gate.paged(keyed, ["month", "list"], "l_partkey", 40).groupBy("month", "list", "page").agg(
        F.count(F.lit(1)).alias("n"), F.min("l_partkey").alias("first_key"))


@query("empty_list_check", f"""
WITH {WEEKLY_CTE}, {CATEGORY_CTE}
SELECT source_id, code FROM dim WHERE (source_id, name) NOT IN (
  SELECT source_id, category_raw FROM rows WHERE l_linenumber = 1 AND is_new)
""")
def _empty_lists(t):
    rows = weekly_rows(t).filter((_("l_linenumber") == 1) & _("is_new"))
    seen = rows.select("source_id", _("category_raw").alias("name"))
    missing = gate.empty_lists(seen, category_dim(t), ["source_id", "name"])
    return missing.join(category_dim(t), ["source_id", "name"]).select("source_id", "code")


@query("pair_gate", f"""
WITH {PAIR_CTE} SELECT source_id, week, CAST(0 AS BIGINT) AS duplicates, count(*) AS n FROM cur GROUP BY ALL
""")
def _pair_gate(t):
    cur = cur_items(t)
    found = gate.check_duplicates(cur)
    return tables.snapshot_meta(cur.withColumn("scraped_at", F.current_timestamp())).join(
        found, ["source_id", "week"], "left").select(
        "source_id", "week", F.coalesce("duplicates", F.lit(0)).cast("bigint").alias("duplicates"),
        _("count").alias("n"))


@query("refused_refresh", f"""
WITH {PAIR_CTE},
counted AS (SELECT source_id, count(*) AS items, count(*) FILTER (pos % 10 = 0) AS again, min(pos) AS first_pos
            FROM cur GROUP BY ALL)
SELECT source_id, CASE WHEN again < 0.3 * before THEN 'drop' END AS reason, items, items AS count,
       CAST(NULL AS STRING) AS held_from
FROM counted JOIN (SELECT source_id, count(*) AS before FROM prev GROUP BY ALL) USING (source_id)
""")
def _refused(t):
    store = weekly.Store(t.spark, scratch_path(t.spark, "refused"))
    dim = t.spark.createDataFrame([], schemas.CATEGORY_DIM)
    stamp = F.timestamp_seconds(1_790_000_000 + _("pos"))
    weekly.take_snapshots(store, "2026-W35", prev_items(t).withColumns(
        {"week": F.lit("2026-W35"), "scraped_at": stamp}), dim)
    cur = cur_items(t).withColumn("scraped_at", stamp)
    weekly.take_snapshots(store, "2026-W36", cur, dim)
    verdict = weekly.take_snapshots(store, "2026-W36", cur.filter("pos % 10 = 0"), dim, refresh=True)
    items = store.items(["2026-W36"]).groupBy("source_id").agg(F.count(F.lit(1)).alias("items"))
    return (verdict.select("source_id", "reason").join(items, "source_id")
            .join(store.meta(["2026-W36"]).select("source_id", "count", "held_from"), "source_id"))
