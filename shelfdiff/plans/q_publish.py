"""Queries over publication, report, samples, browsing and conversation logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfdiff import schemas
from shelfdiff.operators import browse, convlog, diff, publish, report, sample
from shelfdiff.plans.catalog import EARLIER_CTE, PAIR_CTE, cur_items, earlier_items, prev_items, query
from shelfdiff.plans.q_diff import APPLIED_CTE, applied_edits, pair_diff, pair_items
from shelfdiff.plans.q_gate import _pub, published_orders
from shelfdiff.plans.q_tables import with_labels
from shelfdiff.session import by_shuffle, cut_lineage, dealt, kept_table, scratch_path, scratch_scope
from shelfdiff.sources import registry, tables

_ = F.col


def _with(sql: str) -> str:
    return f"WITH {PAIR_CTE} {sql}"


# The previous publication: products above size 30, some with an id and first week of their own,
# and the same keys once more under a foreign source.
def previous_publication(t):
    base = prev_items(t).join(by_shuffle(t.part.select(_("p_partkey").alias("pos"), "p_size")), "pos")
    own = base.filter("p_size > 30").select(
        F.when(_("p_size") > 45, "").otherwise(F.concat(F.lit("old--"), "external_id")).alias("id"),
        F.lit("2026-W35").alias("week"), "source_id", "external_id", "name",
        F.when(_("p_size") > 40, F.lit("")).otherwise("2026-W20").alias("first_seen"))
    foreign = own.withColumn("source_id", F.lit("gs25")).withColumn("id", F.lit("foreign"))
    return own.unionByName(foreign)


def compared(t):
    counts = cur_items(t).select("source_id", "week").distinct().withColumn("previous_week", F.lit("2026-W35"))
    return publish.compared_publication(previous_publication(t), counts)


_OLD = """old AS (
  SELECT p.source_id, p.external_id, p.name, CASE WHEN p_size > 45 THEN '' ELSE 'old--' || p.external_id END AS id,
         CASE WHEN p_size > 40 THEN '' ELSE '2026-W20' END AS first_seen
  FROM prev p JOIN part ON p_partkey = p.pos WHERE p_size > 30)"""

_PUBLISHED = f"""{APPLIED_CTE}, {_OLD}, published AS (
  SELECT coalesce(nullif(o.id, ''), c.source_id || '--' || c.external_id) AS id, c.week,
         CASE c.source_id WHEN 'cu' THEN 'CU' WHEN 'orion' THEN '오리온' ELSE '스타벅스' END AS brand,
         CASE c.source_id WHEN 'cu' THEN 'convenience' WHEN 'orion' THEN 'fmcg' ELSE 'cafe' END AS channel,
         c.name, c.price, a.category, coalesce(a.facts_tag, c.tag, '') AS tags, a.blurb, c.source_id,
         c.external_id, coalesce(nullif(o.first_seen, ''), c.week) AS first_seen, c.week AS last_seen,
         c.image_url, c.source_url, c.barcode, c.pos
  FROM cur c JOIN applied a ON a.source_id = c.source_id AND a.external_id = c.external_id
  LEFT JOIN old o ON o.source_id = c.source_id AND o.external_id = c.external_id
  WHERE NOT a.out_of_scope)"""


def published_catalog(t):
    """The whole current catalog published as if all of it were new."""
    edits, ready = applied_edits(t)
    return publish.publish(cur_items(t), edits, ready, compared(t), registry.source_dim(t.spark))


@query("out_of_scope_drop", _with(f"""
, {APPLIED_CTE} SELECT source_id, external_id, name FROM applied WHERE out_of_scope
"""))
def _scope_drop(t):
    edits, _ready = applied_edits(t)
    return publish.drop_out_of_scope(cur_items(t), edits)[1].select("source_id", "external_id", "name")


@query("carry_forward_ids", _with(f"""
, {_OLD} SELECT c.source_id, c.external_id, coalesce(nullif(o.id, ''), c.source_id || '--' || c.external_id) AS id,
  coalesce(nullif(o.first_seen, ''), c.week) AS first_seen
FROM cur c LEFT JOIN old o ON o.source_id = c.source_id AND o.external_id = c.external_id
"""))
def _carry(t):
    return publish.carry_forward_ids(cur_items(t), compared(t)).select(
        "source_id", "external_id", "id", "first_seen")


@query("tag_fallback", """
SELECT p_partkey, CASE WHEN p_size > 30 THEN 'edit' WHEN p_size > 20 THEN 'facts' WHEN p_size > 10 THEN p_brand
       ELSE '' END AS tags FROM part
""")
def _tag_fallback(t):
    empty = F.array().cast("array<string>")
    edit = F.when(_("p_size") > 30, F.array(F.lit("edit"))).otherwise(empty)
    facts = F.when(_("p_size") > 20, F.array(F.lit("facts")))
    own = F.when(_("p_size") > 10, F.array("p_brand")).otherwise(empty)
    return t.part.select("p_partkey", F.array_join(publish.tag_fallback(edit, facts, own), "|").alias("tags"))


@query("publish_projection", _with(f"""
, {_PUBLISHED} SELECT id, week, brand, channel, name, price, category, tags, blurb, source_id, external_id,
  first_seen, last_seen, image_url, source_url, barcode FROM published
"""))
def _publish(t):
    pub = published_catalog(t)
    return pub.withColumn("tags", F.array_join("tags", "|")).withColumn(
        "barcode", _("alt_ids")["barcode"]).drop("alt_ids")


def _broken_publication(t):
    """Products as published rows with doubled ids, empty fields and foreign weeks."""
    week = F.when(_("p_size") == 50, "2026-W35").otherwise("2026-W36")
    return t.part.select(
        F.concat(F.lit("id"), F.when(_("p_size") == 1, _("p_partkey") - 1).otherwise(_("p_partkey"))
                 .cast("string")).alias("id"),
        week.alias("week"), _("p_brand").alias("brand"), F.lit("cafe").alias("channel"),
        F.when(_("p_size") != 2, _("p_name")).alias("name"),
        F.when(_("p_size") != 3, F.lit("http://x")).otherwise("").alias("source_url"),
        F.lit("cu").alias("source_id"), week.alias("first_seen"), week.alias("last_seen"))


@query("validate_publication", """
WITH pub AS (SELECT 'id' || CAST(CASE WHEN p_size = 1 THEN p_partkey - 1 ELSE p_partkey END AS STRING) AS id,
  CASE WHEN p_size <> 2 THEN p_name END AS name, p_size FROM part)
SELECT 'duplicate_id' AS problem, id, NULL AS name, CAST(count(*) AS STRING) AS detail FROM pub
GROUP BY id HAVING count(*) > 1
UNION ALL SELECT 'missing_field', id, name, CASE p_size WHEN 2 THEN 'name' ELSE 'source_url' END FROM pub
WHERE p_size IN (2, 3)
UNION ALL SELECT 'foreign_week', id, name, '2026-W35' FROM pub WHERE p_size = 50
""")
def _validate(t):
    return publish.validate(_broken_publication(t), F.lit("2026-W36"))


@query("merge_sources", _with("""
SELECT 'cu' AS source_id, NULL AS problem, count(*) AS n FROM cur WHERE source_id = 'cu'
UNION ALL SELECT 'gs25', 'missing_field', count(*) FROM cur JOIN part ON p_partkey = pos
  WHERE source_id = 'orion' AND p_size < 9 HAVING count(*) > 0
UNION ALL SELECT 'nowhere', 'unknown_source', 1
UNION ALL SELECT s, 'duplicate_id', count(*) FROM cur, (VALUES ('kyochon'), ('crown')) v(s)
  WHERE source_id = 'cu' AND pos % 15 = 0 GROUP BY s HAVING count(*) > 0
"""))
def _merge(t):
    """Five sources: one is sound, one lacks fields, one is not registered, and two claim the same ids."""
    cur = cur_items(t).join(t.part.select(_("p_partkey").alias("pos"), "p_size"), "pos")

    def rows(source, of, id, url=_("source_url")):
        return cur.filter(of).select(id.alias("id"), "week", F.lit("b").alias("brand"), F.lit("c").alias("channel"), "name",
                                     url.alias("source_url"), F.lit(source).alias("source_id"),
                                     _("week").alias("first_seen"), _("week").alias("last_seen"))
    own, key = _("source_id"), _("external_id")
    every = [rows("cu", own == "cu", F.concat(F.lit("cu--"), key)),
             rows("gs25", own == "orion", F.concat(F.lit("gs25--"), key), F.when(_("p_size") >= 9, _("source_url"))),
             rows("nowhere", own == "starbucks", F.concat(F.lit("no--"), key)),
             rows("kyochon", (own == "cu") & (_("pos") % 5 == 0), F.concat(F.lit("k--"), key)),
             rows("crown", (own == "cu") & (_("pos") % 15 == 0), F.concat(F.lit("k--"), key))]
    published, problems = publish.merge(reduce(DataFrame.unionByName, every), registry.source_dim(t.spark),
                                        F.lit("2026-W36"))
    n = F.count(F.lit(1)).alias("n")
    return (published.groupBy("source_id").agg(n).withColumn("problem", F.lit(None).cast("string"))
            .unionByName(problems.groupBy("source_id", "problem").agg(n)))


@query("publication_counts", f"""
WITH {_pub()} SELECT channel, count(*) AS total, count(blurb) AS with_blurb FROM pub GROUP BY ALL
""")
def _counts(t):
    return publish.publication_counts(published_orders(t), ("channel",))


# ---------------------------------------------------------------- report

_LABELLED = "labelled AS (SELECT source_id, external_id FROM cur WHERE tag IS NOT NULL AND description IS NOT NULL)"

_LABEL_SQL = """
SELECT source_id, count(l) AS labelled_total, count(*) FILTER (l = 1 AND a = 1) AS labelled_and_added,
       count(*) FILTER (l = 1 AND a IS NULL) AS labelled_not_added,
       count(*) FILTER (l IS NULL AND a = 1) AS added_not_labelled
FROM (SELECT source_id, external_id, 1 AS l FROM labelled) x
FULL JOIN (SELECT source_id, external_id, 1 AS a FROM added) y USING (source_id, external_id) GROUP BY source_id
"""


def control(t):
    return tables.split_control(with_labels(t))[1]


@query("new_label_cross_check", _with(f", {_LABELLED} {_LABEL_SQL}"))
def _label(t):
    return report.label_check(control(t), pair_diff(t).added).drop("week")


@query("monotonic_key_metric", _with("""
, top AS (SELECT max(CAST(gd_idx AS BIGINT)) AS m FROM prev WHERE source_id = 'cu')
SELECT 'cu' AS source_id, 'gd_idx' AS key, m AS previous_max,
       count(*) FILTER (CAST(gd_idx AS BIGINT) > m) AS added_above_previous_max,
       count(*) FILTER (CAST(gd_idx AS BIGINT) <= m) AS added_below_previous_max
FROM top LEFT JOIN (SELECT * FROM added WHERE source_id = 'cu') a ON true GROUP BY m
"""))
def _monotonic(t):
    return report.monotonic_metric(prev_items(t), pair_diff(t).added, registry.source_dim(t.spark)).drop("week")


def published_before(t, week="2026-W35"):
    """The publication of the week before, as its own run makes it and stores it.

    What its diff found new goes through details, edits, the drop of what is out of scope, ids and validation. Nothing
    was published before it.
    """
    path, dim = scratch_path(t.spark, "published"), registry.source_dim(t.spark)
    with scratch_scope(t.spark):
        sides = (cut_lineage(dealt(side(t).withColumn("week", F.lit(week)), "pos")) for side in (earlier_items, prev_items))
        added = cut_lineage(diff.diff_pair(*sides).added)
        edits, ready = applied_edits(t, added)
        nothing = tables.read_table(t.spark, path, schemas.PUBLISHED_ITEM)
        rows = cut_lineage(publish.publish(added, edits, ready, nothing, dim))
        tables.write_table(publish.merge(rows, dim, F.lit(week))[0], path, week=week)
    return tables.read_table(t.spark, path, schemas.PUBLISHED_ITEM, [week])


@query("published_then_gone", _with(f"""
, new_before AS (WITH {EARLIER_CTE} SELECT * FROM added),
published_before AS (WITH cur AS (SELECT * FROM new_before), {APPLIED_CTE}
  SELECT source_id, external_id FROM applied WHERE NOT out_of_scope)
SELECT o.source_id, count(*) AS previous_published, count(r.external_id) AS gone
FROM published_before o LEFT JOIN removed r ON r.source_id = o.source_id AND r.external_id = o.external_id GROUP BY ALL
"""))
def _gone(t):
    earlier, result = published_before(t), pair_diff(t)
    # as the run stores them: a row a source, by whose size Spark sees what to broadcast
    counts = kept_table(result.counts.withColumn("previous_week", F.lit("2026-W35")), "counts")
    return report.published_then_gone(publish.compared_publication(earlier, counts), result.removed).drop("week")


@query("published_then_gone_names", _with(f"""
, {_OLD} SELECT o.source_id, o.name FROM old o JOIN removed r
ON r.source_id = o.source_id AND r.external_id = o.external_id
"""))
def _gone_names(t):
    return report.gone_names(compared(t), pair_diff(t).removed).drop("week")


def snapshot_metas(t):
    """Meta rows of both weeks; one source is held in the current week."""
    now = tables.snapshot_meta(with_labels(t)).withColumn("held_from", F.when(_("source_id") == "orion", "2026-W35"))
    before = tables.snapshot_meta(prev_items(t).withColumn("week", F.lit("2026-W35")).withColumn(
        "scraped_at", F.timestamp_seconds(1_780_000_000 + _("pos"))))
    return now.unionByName(before)


_PROVENANCE = """
SELECT c.source_id, 1790000000 + min(c.pos) AS scraped_at, count(*) AS count, '2026-W35' AS previous_week,
  (SELECT 1780000000 + min(pos) FROM prev p WHERE p.source_id = c.source_id) AS previous_scraped_at,
  CASE WHEN c.source_id = 'orion' THEN '2026-W35' END AS held_from
FROM cur c GROUP BY c.source_id
"""


@query("provenance", _with(_PROVENANCE))
def _provenance(t):
    counts = cur_items(t).select("source_id", "week").distinct().withColumn("previous_week", F.lit("2026-W35"))
    out = report.provenance(snapshot_metas(t), counts).drop("week")
    return out.withColumn("scraped_at", F.unix_seconds("scraped_at")).withColumn(
        "previous_scraped_at", F.unix_seconds("previous_scraped_at"))


@query("out_of_scope_report", _with(f"""
, {APPLIED_CTE} SELECT source_id, count(*) AS count FROM applied WHERE out_of_scope GROUP BY ALL
"""))
def _scope_report(t):
    edits, _ready = applied_edits(t)
    return report.scope_report(publish.drop_out_of_scope(cur_items(t), edits)[1]).drop("week")


@query("out_of_scope_names", _with(f"""
, {APPLIED_CTE} SELECT source_id, name FROM applied WHERE out_of_scope
"""))
def _scope_names(t):
    edits, _ready = applied_edits(t)
    return report.scope_names(publish.drop_out_of_scope(cur_items(t), edits)[1]).drop("week")


def source_reports(t):
    """The report of the pair, and the publication it reports on."""
    prev, cur = pair_items(t)
    result = diff.diff_pair(prev, cur)
    added, removed, counts = (cut_lineage(df) for df in (result.added, result.removed, result.counts))
    counts = counts.withColumn("previous_week", F.lit("2026-W35")).withColumn(
        "gap_weeks", F.lit(1)).withColumn("baseline", F.lit(False))
    edits, ready = applied_edits(t)
    dim = registry.source_dim(t.spark)
    earlier = cut_lineage(compared(t))
    publication = cut_lineage(publish.publish(added, edits, ready, earlier, dim))
    dropped = publish.drop_out_of_scope(added, edits)[1]
    rows = report.source_report(counts, control(t), prev, added, removed, earlier, dropped, publication,
                                snapshot_metas(t), dim)
    return rows, publication


_REPORT_CTE = f"""
{_PUBLISHED}, {_LABELLED}, labels_of AS ({_LABEL_SQL}), prov AS ({_PROVENANCE}),
news AS (SELECT a.source_id, a.external_id, p.id, p.blurb FROM added a LEFT JOIN published p
         ON p.source_id = a.source_id AND p.external_id = a.external_id),
reports AS (
  SELECT s.source_id, CAST(1 AS BIGINT) AS gap_weeks,
    (SELECT count(*) FROM added x WHERE x.source_id = s.source_id) AS added,
    (SELECT count(*) FROM matches x WHERE x.source_id = s.source_id) AS matched,
    (SELECT any_value(held_from) FROM prov x WHERE x.source_id = s.source_id) AS held_from,
    (SELECT any_value(labelled_total) FROM labels_of x WHERE x.source_id = s.source_id) AS labelled_total,
    CASE WHEN s.source_id = 'cu' THEN (SELECT count(*) FROM added x WHERE x.source_id = 'cu' AND CAST(gd_idx AS BIGINT)
      > (SELECT max(CAST(gd_idx AS BIGINT)) FROM prev p WHERE p.source_id = 'cu')) END AS above_max,
    (SELECT count(*) FROM old o JOIN removed r ON r.source_id = o.source_id AND r.external_id = o.external_id
     WHERE o.source_id = s.source_id) AS gone,
    (SELECT nullif(count(*), 0) FROM news x WHERE x.source_id = s.source_id AND x.id IS NULL) AS out_of_scope,
    (SELECT count(id) FROM news x WHERE x.source_id = s.source_id) AS published,
    (SELECT count(blurb) FROM news x WHERE x.source_id = s.source_id) AS with_blurb
  FROM (SELECT DISTINCT source_id FROM cur) s)"""


@query("source_report", _with(f", {_REPORT_CTE} SELECT * FROM reports"))
def _source_report(t):
    rows, _publication = source_reports(t)
    return rows.select(
        "source_id", _("gap_weeks").cast("bigint").alias("gap_weeks"), "added", _("diff_counts.matched"),
        _("snapshot.held_from"), _("source_new_label.labelled_total"),
        _("monotonic_id.added_above_previous_max").alias("above_max"), _("published_then_gone.gone"),
        _("out_of_scope.count").alias("out_of_scope"), _("published.total").alias("published"),
        _("published.with_blurb"))


@query("week_report", _with(f"""
, {_REPORT_CTE} SELECT '2026-W36' AS week, 'cu,orion,starbucks' AS sources, (SELECT count(id) FROM news) AS total,
  (SELECT count(blurb) FROM news) AS with_blurb, (SELECT any_value(added) FROM reports WHERE source_id = 'cu') AS cu_added
"""))
def _week_report(t):
    rows, publication = source_reports(t)
    out = report.week_report(rows, publication)
    return out.select("week", F.array_join("sources", ",").alias("sources"), "totals.total", "totals.with_blurb",
                      F.try_element_at("by_source", F.lit("cu"))["added"].alias("cu_added"))


@query("scope_of_new_items", _with(f"""
, {_REPORT_CTE} SELECT source_id, external_id, id IS NOT NULL AS published FROM news
"""))
def _scope_of_new(t):
    result = pair_diff(t)
    edits, _ready = applied_edits(t)
    kept, dropped = publish.drop_out_of_scope(result.added, edits)
    return kept.withColumn("published", F.lit(True)).unionByName(
        dropped.withColumn("published", F.lit(False))).select("source_id", "external_id", "published")


# ---------------------------------------------------------------- samples and figures


@query("sample_per_group", _with("""
SELECT source_id, external_id FROM (SELECT *, row_number() OVER (PARTITION BY source_id
  ORDER BY md5('7|' || image_url || '|' || external_id), image_url, external_id) AS rn
  FROM cur WHERE tag IS NOT NULL) x WHERE rn <= 10
"""))
def _sample(t):
    items = cur_items(t).withColumn("image_url", F.when(F.size("tags") > 0, _("image_url")))
    return sample.sample_per_group(items, ["source_id"], 10, seed=7).select("source_id", "external_id")


@query("pass_rate_verdict", """
SELECT event_type, CASE WHEN event_type = 'error' THEN 0 ELSE count(*) END AS checked,
       count(*) FILTER (value > 20) AS ok,
       CASE WHEN event_type = 'error' THEN 0.0 ELSE round_even(count(*) FILTER (value > 20) / count(*), 2) END AS pass_rate,
       CASE WHEN event_type = 'error' THEN 'unknown' WHEN count(*) FILTER (value > 20) / count(*) >= 0.3 THEN 'ok'
            ELSE 'broken' END AS verdict
FROM events GROUP BY event_type
""")
def _pass_rate(t):
    probes = t.events.select("event_type", (_("value") > 20).alias("ok"), (_("event_type") == "error").alias("blocked"))
    return sample.pass_rate(probes, "event_type", 0.3)


@query("sample_allocation", """
WITH sizes AS (SELECT p_brand AS source_id, count(*) AS size FROM part GROUP BY ALL),
f AS (SELECT *, CASE source_id WHEN 'Brand#1' THEN least(30, size) WHEN 'Brand#2' THEN least(100000000, size) END AS fixed FROM sizes),
r AS (SELECT *, 1000 - sum(fixed) OVER () AS remaining, sum(size) FILTER (fixed IS NULL) OVER () AS pool FROM f)
SELECT source_id, size, CAST(coalesce(fixed, least(size, greatest(1, round_even(remaining * size / pool, 0)))) AS BIGINT) AS n
FROM r WHERE fixed IS NOT NULL OR remaining > 0
""")
def _allocation(t):
    sizes = t.part.groupBy(_("p_brand").alias("source_id")).agg(F.count(F.lit(1)).alias("size"))
    return sample.allocate(sizes, 1000, {"Brand#1": 30, "Brand#2": 100_000_000})


@query("sample_allocated", """
WITH sizes AS (SELECT p_type AS source_id, count(*) AS size FROM part GROUP BY ALL),
f AS (SELECT *, CASE WHEN source_id = 'PROMO' THEN least(size, 80) END AS fixed FROM sizes),
r AS (SELECT *, 60 - sum(fixed) OVER () AS remaining, sum(size) FILTER (fixed IS NULL) OVER () AS pool FROM f),
plan AS (SELECT source_id, coalesce(fixed, least(size, greatest(1, round_even(remaining * size / pool, 0)))) AS n
         FROM r WHERE fixed IS NOT NULL OR remaining > 0)
SELECT source_id, external_id FROM (
  SELECT p_type AS source_id, CAST(p_partkey AS STRING) AS external_id, row_number() OVER (PARTITION BY p_type
    ORDER BY md5('3|' || CAST(p_partkey AS STRING) || '|' || CAST(p_partkey AS STRING)), CAST(p_partkey AS STRING)) AS rn
  FROM part) x JOIN plan USING (source_id) WHERE rn <= n
""")
def _allocated(t):
    rows = t.part.select(_("p_type").alias("source_id"), _("p_partkey").cast("string").alias("external_id"))
    plan = sample.allocate(rows.groupBy("source_id").agg(F.count(F.lit(1)).alias("size")), 60,
                           {"PROMO": 80})
    return sample.sample_allocated(rows, plan, 60, seed=3).select("source_id", "external_id")


def categorized_parts(t):
    """Parts with an assigned category; small ones fall into the catch-all."""
    category = F.when(_("p_size") < 8, "기타").when(_("p_size") > 45, _("p_type")).otherwise(
        F.when(_("p_type") == "PROMO", "음료").otherwise("과자"))
    return t.part.select(
        _("p_brand").alias("source_id"), F.lit("convenience").alias("channel"), category.alias("category"),
        _("p_type").alias("category_raw"), _("p_name").alias("name"), _("p_partkey").alias("external_id"),
        F.when(_("p_size") > 20, F.lit("good")).alias("blurb"), (_("p_size") == 7).alias("out_of_scope"))


_CATEGORIZED = """cat AS (SELECT p_brand AS source_id, CASE WHEN p_size < 8 THEN '기타' WHEN p_size > 45 THEN p_type
  WHEN p_type = 'PROMO' THEN '음료' ELSE '과자' END AS category, p_type AS category_raw, p_name AS name, p_size FROM part)"""


@query("category_distribution", f"""
WITH {_CATEGORIZED}, n AS (SELECT source_id, category, count(*) AS n FROM cat GROUP BY ALL)
SELECT source_id, CAST(sum(n) AS BIGINT) AS total, count(*) AS used,
       CAST(coalesce(sum(n) FILTER (category = '기타'), 0) AS BIGINT) AS other, max(n) AS largest_count,
       first(category ORDER BY n DESC, category) AS largest,
       round(coalesce(sum(n) FILTER (category = '기타'), 0) / sum(n), 4) AS other_share,
       round(max(n) / sum(n), 4) AS largest_share
FROM n GROUP BY source_id
""")
def _distribution(t):
    return sample.category_distribution(categorized_parts(t), ["source_id"])


@query("edit_quality", f"""
WITH {_CATEGORIZED} SELECT source_id, count(*) AS total, count(*) FILTER (category <> category_raw) AS edited,
  count(*) FILTER (category NOT IN ('기타', '음료', '과자')) AS outside, count(*) FILTER (p_size > 20) AS blurbs,
  count(*) FILTER (p_size = 7) AS out_of_scope FROM cat GROUP BY ALL
""")
def _quality(t):
    return sample.edit_quality(categorized_parts(t), registry.taxonomy_dim(t.spark), ["source_id"])


@query("source_category_pivot", """
SELECT p_brand AS source_id, count(*) FILTER (p_type = 'ECONOMY') AS "ECONOMY", count(*) FILTER (p_type = 'LARGE') AS "LARGE",
  count(*) FILTER (p_type = 'MEDIUM') AS "MEDIUM", count(*) FILTER (p_type = 'PROMO') AS "PROMO",
  count(*) FILTER (p_type = 'SMALL') AS "SMALL", count(*) FILTER (p_type = 'STANDARD') AS "STANDARD"
FROM part GROUP BY ALL
""")
def _pivot(t):
    rows = t.part.select(_("p_brand").alias("source_id"), _("p_type").alias("category"))
    return sample.source_pivot(rows, ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"])


@query("item_listing", f"""
WITH {_CATEGORIZED} SELECT source_id, category, name, CASE WHEN p_size > 20 THEN 'good' END AS blurb,
  category IN ('기타', '음료', '과자') AS in_list FROM cat ORDER BY source_id, category, name
""")
def _listing(t):
    return sample.item_listing(categorized_parts(t), registry.taxonomy_dim(t.spark))


@query("key_order_check", """
WITH d AS (SELECT o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS day, min(o_orderkey) AS low, max(o_orderkey) AS high
           FROM orders GROUP BY ALL)
SELECT o_orderpriority, day, low, previous_high FROM (
  SELECT *, lag(high) OVER (PARTITION BY o_orderpriority ORDER BY day) AS previous_high FROM d) x WHERE low < previous_high
""")
def _key_order(t):
    rows = t.orders.withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return sample.order_violations(rows, "o_orderpriority", "day", "o_orderkey")


# ---------------------------------------------------------------- browsing

_FACET_ROWS = f"""WITH {_pub()}, long AS (
  SELECT 'channel' AS facet, channel AS value FROM pub UNION ALL SELECT 'brand', brand FROM pub
  UNION ALL SELECT 'category', category FROM pub)
SELECT facet, value, value AS label, count(*) AS count FROM long WHERE value <> '' GROUP BY ALL"""


@query("facets", _FACET_ROWS)
def _facets(t):
    pub = published_orders(t).withColumn("week", F.lit("2026-W36"))
    return browse.facets(pub, registry.channel_dim(t.spark)).drop("week")


@query("filtered_items", f"""
WITH {_pub()} SELECT o_orderkey, name FROM pub WHERE brand IN ('O', 'P')
AND contains(lower(replace(name || ' ' || coalesce(blurb, ''), ' ', '')), 'blue')
""")
def _filtered(t):
    return browse.filtered_items(published_orders(t), brands=("O", "P"), query="B lue").select("o_orderkey", "name")


@query("shown_counts", f"""
WITH {_pub()} SELECT channel AS week, count(*) FILTER (category = 'PROMO') AS shown, count(*) AS total FROM pub GROUP BY ALL
""")
def _shown(t):
    pub = published_orders(t).withColumn("week", _("channel"))
    return browse.shown_counts(pub, browse.filtered_items(pub, categories=("PROMO",)))


@query("distinct_channels", f"""
WITH {_pub()}, f AS (SELECT brand AS week, channel, min(o_orderkey) AS first FROM pub GROUP BY ALL)
SELECT week, channel, row_number() OVER (PARTITION BY week ORDER BY first) AS ord FROM f
""")
def _channels(t):
    pub = published_orders(t).select(_("brand").alias("week"), "channel", _("o_orderkey").alias("pos"))
    return browse.distinct_channels(pub)


# ---------------------------------------------------------------- conversation logs


def logged(t):
    """Conversations as log records: users speak plain text, assistants in typed blocks."""
    plain = F.to_json(F.array("text"))
    plain = F.substring(plain, F.lit(2), F.length(plain) - 2)
    empty = F.lit(None).cast("string")
    said = F.struct(F.lit("text").alias("type"), "text", empty.alias("thinking"), empty.alias("name"),
                    F.lit(None).cast("struct<path:string,n:bigint>").alias("input"), empty.alias("content"))
    thought = F.struct(F.lit("thinking").alias("type"), empty.alias("text"), _("text").alias("thinking"),
                       empty.alias("name"), F.lit(None).cast("struct<path:string,n:bigint>").alias("input"),
                       empty.alias("content"))
    call = F.struct(F.lit("tool_use").alias("type"), empty.alias("text"), empty.alias("thinking"),
                    F.lit("read").alias("name"),
                    F.struct(F.lit("a b").alias("path"), _("turn").alias("n")).alias("input"), empty.alias("content"))
    answer = F.struct(F.lit("tool_result").alias("type"), empty.alias("text"), empty.alias("thinking"),
                      empty.alias("name"), F.lit(None).cast("struct<path:string,n:bigint>").alias("input"),
                      _("text").alias("content"))
    unknown = F.struct(F.lit("image").alias("type"), "text", empty.alias("thinking"), empty.alias("name"),
                       F.lit(None).cast("struct<path:string,n:bigint>").alias("input"), empty.alias("content"))
    blocks = F.to_json(F.array(thought, said, unknown, call, answer))
    return t.conversations.select(
        "conv_id", "turn", "role", F.when(_("role") == "assistant", blocks).otherwise(plain).alias("content"))


_BLOCKS = """blocks AS (
  SELECT conv_id, turn, role, CAST(0 AS BIGINT) AS block, 'text' AS kind, text FROM conversations WHERE role <> 'assistant'
  UNION ALL SELECT conv_id, turn, role, 0, 'thinking', text FROM conversations WHERE role = 'assistant'
  UNION ALL SELECT conv_id, turn, role, 1, 'text', text FROM conversations WHERE role = 'assistant'
  UNION ALL SELECT conv_id, turn, role, 3, 'tool_use', 'read({"path": "a b", "n": ' || CAST(turn AS STRING) || '})'
  FROM conversations WHERE role = 'assistant'
  UNION ALL SELECT conv_id, turn, role, 4, 'tool_result', text FROM conversations WHERE role = 'assistant')"""


@query("block_flatten", f"WITH {_BLOCKS} SELECT conv_id, turn, block, kind, md5(text) AS digest FROM blocks")
def _blocks(t):
    return convlog.flatten_blocks(logged(t)).select(
        "conv_id", "turn", _("block").cast("bigint").alias("block"), "kind", F.md5("text").alias("digest"))


_TURNS = "turns AS (SELECT conv_id, count(*) FILTER (role = 'user') AS user_turns FROM conversations GROUP BY ALL)"


@query("user_turn_count", f"WITH {_TURNS} SELECT * FROM turns")
def _user_turns(t):
    return convlog.user_turns(convlog.flatten_blocks(logged(t)))


@query("conversation_filter", f"""
WITH {_TURNS} SELECT conv_id, user_turns, row_number() OVER (ORDER BY conv_id) AS number FROM turns
WHERE user_turns >= 3
""")
def _keep(t):
    return convlog.keep_conversations(convlog.user_turns(convlog.flatten_blocks(logged(t))))[0]


@query("conversation_totals", f"""
WITH {_TURNS} SELECT count(*) FILTER (user_turns >= 3) AS kept, count(*) FILTER (user_turns < 3) AS skipped FROM turns
""")
def _totals(t):
    return convlog.keep_conversations(convlog.user_turns(convlog.flatten_blocks(logged(t))))[1]


_CLIP = ("CASE WHEN length({0}) <= {1} THEN {0} ELSE substr({0}, 1, {1}) || chr(10) || "
         "format('… (총 {{:,}}자, 이하 생략)', length({0})) END")


@query("transcript_render", f"""
WITH {_TURNS}, {_BLOCKS}, s AS (SELECT *, regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', '') AS x FROM blocks
  WHERE role IN ('user', 'assistant')),
lines AS (SELECT conv_id, turn, block, CASE kind
  WHEN 'text' THEN '## ' || CASE role WHEN 'user' THEN '나' ELSE 'Claude' END || chr(10) || chr(10) || x || chr(10)
  WHEN 'thinking' THEN '> **생각**' || chr(10) || '> ' || chr(10) || '> '
       || replace({_CLIP.format('x', 1500)}, chr(10), chr(10) || '> ') || chr(10)
  WHEN 'tool_use' THEN '```' || chr(10) || '▶ ' || {_CLIP.format('x', 400)} || chr(10) || '```' || chr(10)
  ELSE '```' || chr(10) || {_CLIP.format('x', 600)} || chr(10) || '```' || chr(10) END AS line
  FROM s WHERE x <> '')
SELECT conv_id, count(*) AS lines, md5('# 세션 ' || substr(CAST(conv_id AS STRING), 1, 8) || chr(10) || chr(10)
  || string_agg(line, chr(10) ORDER BY turn, block)) AS digest
FROM lines GROUP BY conv_id
""")
def _transcript(t):
    path = scratch_path(t.spark, "transcripts")
    convlog.write_transcripts(convlog.flatten_blocks(logged(t)), path)
    said = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "block", "line"))), lambda x: x["line"]), "\n")
    return convlog.read_transcripts(t.spark, path).groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("lines"), F.md5(said).alias("digest"))
