"""Queries over the identity match, the diff, enrichment and editing."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfdiff.functions import weeks as W
from shelfdiff.operators import curate, diff, enrich, match, similarity
from shelfdiff.plans.catalog import PAIR_CTE, WEEKLY_CTE, cur_items, prev_items, query, weekly_items
from shelfdiff.session import by_shuffle, cut_lineage, dealt, kept_table, scratch_path
from shelfdiff.sources import registry, tables

_ = F.col


def _with(sql: str) -> str:
    return f"WITH {PAIR_CTE} {sql}"


def pair_items(t):
    """(previous, current): the two snapshots as a store would hold them, derived once and in even parts."""
    return cut_lineage(dealt(prev_items(t), "pos")), cut_lineage(dealt(cur_items(t), "pos"))


def pair_diff(t):
    return diff.diff_pair(*pair_items(t))


def matched_pairs(t):
    prev, cur = prev_items(t), cur_items(t)
    return diff.attach(match.layered_match(prev, cur), prev, cur,
                       ("name", "price", "image_url", "category_raw", "alt_ids"))


@query("match_keys", _with("""
SELECT source_id, pos, CAST(0 AS BIGINT) AS rank, 'barcode' AS key, barcode AS value FROM cur
UNION ALL SELECT source_id, pos, 1, 'gd_idx', gd_idx FROM cur
UNION ALL SELECT source_id, pos, 2, 'external_id', external_id FROM cur
"""))
def _match_keys(t):
    return match.match_keys(cur_items(t)).select(
        "source_id", "pos", _("rank").cast("bigint").alias("rank"), "key", "value")


@query("name_price_key", _with("""
SELECT source_id, lower(name) AS name, coalesce(CAST(price AS STRING), '-') AS price, count(*) AS n
FROM cur GROUP BY ALL
"""))
def _name_price(t):
    key = match.name_price_key(_("name"), _("price"))
    parts = F.split(key, "\u001f")
    return cur_items(t).groupBy("source_id", parts[0].alias("name"), parts[1].alias("price")).agg(
        F.count(F.lit(1)).alias("n"))


@query("layered_match", _with("SELECT * FROM matches"))
def _layered_match(t):
    return match.layered_match(prev_items(t), cur_items(t)).drop("week")


@query("key_conflicts", _with("SELECT * FROM conflicts"))
def _conflicts(t):
    return diff.key_conflicts(matched_pairs(t)).drop("week")


@query("changed_fields", _with("""
SELECT source_id, cur_pos, matched_by, field, before, after FROM (
  SELECT source_id, cur_pos, matched_by, 'name' AS field, prev_name AS before, cur_name AS after FROM pairs
  UNION ALL SELECT source_id, cur_pos, matched_by, 'price', CAST(prev_price AS STRING), CAST(cur_price AS STRING)
  FROM pairs
  UNION ALL SELECT source_id, cur_pos, matched_by, 'image_url', prev_image, cur_image FROM pairs
  UNION ALL SELECT source_id, cur_pos, matched_by, 'category_raw', prev_cat, cur_cat FROM pairs) x
WHERE before IS DISTINCT FROM after
"""))
def _changed(t):
    rows = diff.changed(matched_pairs(t))
    return rows.select("source_id", "cur_pos", "matched_by", F.explode("fields").alias("field", "v")).select(
        "source_id", "cur_pos", "matched_by", "field", _("v.from").alias("before"), _("v.to").alias("after"))


def _leftovers(t):
    prev, cur = prev_items(t), cur_items(t)
    matches = match.layered_match(prev, cur)
    return (diff.unmatched(cur, matches, "cur_pos"), diff.unmatched(prev, matches, "prev_pos"))


@query("similarity_candidates", _with("SELECT * FROM review"))
def _candidates(t):
    cur, prev = _leftovers(t)
    found = similarity.candidates(cur, prev)
    return found.select("source_id", "cur_pos", "prev_pos", F.bround("similarity", 4).alias("similarity"))


@query("pair_limit_guard", _with("""
SELECT source_id, c.n AS n_cur, p.n AS n_prev, c.n * p.n > 40000 AS skipped
FROM (SELECT source_id, count(*) AS n FROM left_cur GROUP BY ALL) c
JOIN (SELECT source_id, count(*) AS n FROM left_prev GROUP BY ALL) p USING (source_id)
"""))
def _pair_limit(t):
    cur, prev = _leftovers(t)
    return similarity.pair_limit(cur, prev, 40_000).drop("week")


@query("greedy_best_pairs", _with("SELECT * FROM review"))
def _review(t):
    cur, prev = _leftovers(t)
    return similarity.review(cur, prev).drop("week")


@query("added", _with("SELECT source_id, external_id, name FROM added"))
def _added(t):
    return pair_diff(t).added.select("source_id", "external_id", "name")


@query("removed", _with("SELECT source_id, external_id, name FROM removed"))
def _removed(t):
    return pair_diff(t).removed.select("source_id", "external_id", "name")


@query("diff_counts", _with("""
SELECT source_id, week, (SELECT count(*) FROM prev x WHERE x.source_id = s.source_id) AS previous,
  (SELECT count(*) FROM cur x WHERE x.source_id = s.source_id) AS current,
  (SELECT count(*) FROM matches x WHERE x.source_id = s.source_id) AS matched,
  (SELECT count(*) FROM added x WHERE x.source_id = s.source_id) AS added,
  (SELECT count(*) FROM removed x WHERE x.source_id = s.source_id) AS removed,
  (SELECT count(*) FROM pairs x WHERE x.source_id = s.source_id AND (
     prev_name IS DISTINCT FROM cur_name OR prev_price IS DISTINCT FROM cur_price)) AS changed,
  (SELECT count(*) FROM review x WHERE x.source_id = s.source_id) AS review,
  (SELECT count(*) FROM conflicts x WHERE x.source_id = s.source_id) AS conflicts
FROM (SELECT DISTINCT source_id, week FROM cur) s
"""))
def _diff_counts(t):
    return pair_diff(t).counts


@query("diff_sink", _with("""
SELECT source_id, week, count(*) AS added, '2026-W35' AS previous_week, CAST(1 AS BIGINT) AS gap_weeks
FROM added GROUP BY ALL
"""))
def _diff_sink(t):
    path = scratch_path(t.spark, "diff")
    header = pair_diff(t).added.withColumn("previous_week", F.lit("2026-W35")).withColumn(
        "gap_weeks", W.week_gap(_("previous_week"), _("week")).cast("bigint"))
    tables.write_table(header, path)
    return t.spark.read.parquet(path).groupBy("source_id", "week", "previous_week", "gap_weeks").agg(
        F.count(F.lit(1)).alias("added"))


@query("contested_match", """
WITH items AS (
  SELECT CASE p_size % 3 WHEN 0 THEN 'cu' WHEN 1 THEN 'orion' ELSE 'starbucks' END AS source_id,
         p_partkey AS pos, lower(p_name) AS name, CASE WHEN p_size % 2 = 0 THEN p_size END AS price FROM part),
prev AS (SELECT *, row_number() OVER (PARTITION BY source_id, name, price ORDER BY pos) AS rn FROM items),
cur AS (SELECT * REPLACE (price + 6 AS price) FROM prev)
SELECT c.source_id, c.pos AS cur_pos, p.pos AS prev_pos, 'name_price' AS matched_by FROM cur c JOIN prev p
ON c.source_id = p.source_id AND c.name = p.name AND c.price IS NOT DISTINCT FROM p.price AND c.rn = p.rn
""")
def _contested(t):
    """All parts under their 64 names, half of them without a price: fat pools of name and price.

    Rows have no other key, so of every pool the k-th meets the k-th; tangled pools are compared
    with brute force in the tests.
    """
    def side(more):
        price = F.when(_("p_size") % 2 == 0, _("p_size").cast("bigint") + more)
        source = F.when(_("p_size") % 3 == 0, "cu").when(_("p_size") % 3 == 1, "orion").otherwise("starbucks")
        return t.part.select(
            source.alias("source_id"), F.lit("2026-W36").alias("week"), _("p_partkey").alias("pos"),
            F.lit("").alias("external_id"), F.create_map(F.lit("barcode"), F.lit("")).alias("alt_ids"),
            _("p_name").alias("name"), price.alias("price"))
    return match.layered_match(side(0), side(6)).select("source_id", "cur_pos", "prev_pos", "matched_by")


@query("baseline_week", f"""
WITH {WEEKLY_CTE} SELECT source_id, week, n AS current, CAST(0 AS BIGINT) AS added FROM look
WHERE previous_week IS NULL
""")
def _baseline(t):
    meta = tables.snapshot_meta(weekly_items(t))
    return diff.baseline_weeks(meta, diff.lookback(meta)).select("source_id", "week", "current", "added")


@query("gap_weeks", f"""
WITH {WEEKLY_CTE} SELECT l.source_id, l.week, l.previous_week, CAST(coalesce(l.wi - p.wi, 0) AS BIGINT) AS gap_weeks
FROM look l LEFT JOIN idx p ON p.source_id = l.source_id AND p.week = l.previous_week
""")
def _gap(t):
    looked = diff.gap_weeks(diff.lookback(tables.snapshot_meta(weekly_items(t))))
    return looked.withColumn("gap_weeks", _("gap_weeks").cast("bigint"))


@query("weekly_diff", f"""
WITH {WEEKLY_CTE},
compared AS (SELECT * FROM look WHERE previous_week IS NOT NULL),
kept AS (SELECT c.source_id, c.week, count(*) AS matched FROM compared c
  JOIN items a ON a.source_id = c.source_id AND a.week = c.week
  JOIN items b ON b.source_id = c.source_id AND b.week = c.previous_week AND a.external_id = b.external_id
  GROUP BY ALL)
SELECT l.source_id, l.week, l.previous_week, coalesce(p.n, 0) AS previous, l.n AS current,
       coalesce(k.matched, 0) AS matched, l.previous_week IS NULL AS baseline
FROM look l LEFT JOIN meta p ON p.source_id = l.source_id AND p.week = l.previous_week
LEFT JOIN kept k ON k.source_id = l.source_id AND k.week = l.week
""")
def _weekly_diff(t):
    """Every supplier-week against its lookback week; the part key decides, names stay apart."""
    items = weekly_items(t).select(
        "source_id", "week", "pos", "external_id", F.create_map().cast("map<string,string>").alias("alt_ids"),
        F.concat("external_id", F.lit(" "), "name", F.lit(" "), "week").alias("name"), "price",
        "category_raw", F.lit(None).cast("string").alias("image_url"), "scraped_at")
    slices = diff.slices_for(t.lineitem.count())
    items = kept_table(items.withColumn(diff.SLICE, diff.slice_of(slices)), "items", (diff.SLICE,))
    result = diff.diff(items, kept_table(tables.snapshot_meta(items), "meta"), threshold=0.999, slices=slices)
    return result.counts.select("source_id", "week", "previous_week", "previous", "current", "matched",
                                "baseline")


# ---------------------------------------------------------------- enrichment


@query("enrich_from_list", _with("""
SELECT source_id, external_id, description, coalesce(tag, '') AS tags FROM cur WHERE description IS NOT NULL
"""))
def _from_list(t):
    return enrich.from_list(cur_items(t)).select(
        "source_id", "external_id", "description", F.array_join("tags", "|").alias("tags"))


@query("detail_worklist", _with("""
SELECT source_id, external_id FROM cur WHERE description IS NULL AND source_id IN ('cu', 'orion')
"""))
def _worklist(t):
    return enrich.detail_worklist(cur_items(t), registry.source_dim(t.spark)).select("source_id", "external_id")


_WORK = "work AS (SELECT * FROM cur WHERE description IS NULL AND source_id IN ('cu', 'orion'))"


@query("detail_cap_guard", _with(f"""
, {_WORK}, n AS (SELECT source_id, count(*) AS rows FROM work GROUP BY ALL)
SELECT source_id, rows, rows > 300 AS stopped, CASE WHEN rows > 300 THEN 0 ELSE rows END AS looked_up FROM n
"""))
def _cap(t):
    work = enrich.detail_worklist(cur_items(t), registry.source_dim(t.spark))
    todo, over = enrich.detail_cap(work, 300)
    rows = work.groupBy("source_id").agg(F.count(F.lit(1)).alias("rows"))
    some = todo.groupBy("source_id").agg(F.count(F.lit(1)).alias("looked_up"))
    return (rows.join(some, "source_id", "left").join(
        over.select("source_id", F.lit(True).alias("stopped")), "source_id", "left")
        .select("source_id", "rows", F.coalesce("stopped", F.lit(False)).alias("stopped"),
                F.coalesce("looked_up", F.lit(0)).alias("looked_up")))


def details(t, items=None):
    """Detail rows: none for size 1, another name for size 2, own tags for odd sizes."""
    sizes = t.part.select(_("p_partkey").alias("pos"), "p_size")
    base = (cur_items(t) if items is None else items).join(by_shuffle(sizes), "pos")
    return base.filter("p_size <> 1").select(
        "source_id", "week", "external_id",
        F.when(_("p_size") == 2, F.concat("name", F.lit("?"))).when(_("p_size") == 3, "")
        .otherwise(_("name")).alias("name"),
        F.when(_("p_size") != 4, F.concat(F.lit("detail of "), "name")).alias("description"),
        F.when(_("p_size") % 2 == 1, F.array(F.lit("detail"))).otherwise(
            F.array().cast("array<string>")).alias("tags"))


_DETAIL = f"""{_WORK}, looked AS (
  SELECT w.*, p_size, CASE WHEN p_size = 1 THEN 'missing' WHEN p_size = 2 THEN 'renamed' END AS reason
  FROM work w JOIN part ON p_partkey = w.pos)"""


@query("detail_merge", _with(f"""
, {_DETAIL} SELECT source_id, external_id, CASE WHEN p_size <> 4 THEN 'detail of ' || name END AS description,
       CASE WHEN p_size % 2 = 1 THEN 'detail' ELSE coalesce(tag, '') END AS tags
FROM looked WHERE reason IS NULL
"""))
def _merge(t):
    work = enrich.detail_worklist(cur_items(t), registry.source_dim(t.spark))
    return enrich.merge_details(work, details(t))[0].select(
        "source_id", "external_id", "description", F.array_join("tags", "|").alias("tags"))


@query("detail_failures", _with(f"""
, {_DETAIL} SELECT source_id, external_id, name, reason FROM looked WHERE reason IS NOT NULL
"""))
def _failures(t):
    work = enrich.detail_worklist(cur_items(t), registry.source_dim(t.spark))
    return enrich.merge_details(work, details(t))[1].drop("week")


def enriched(t, items=None):
    """(enriched, failures) of ``items``, or of the whole current catalog, without a limit on details."""
    items = cur_items(t) if items is None else items
    ready, failures, _over = enrich.enrich(items, details(t, items), registry.source_dim(t.spark))
    return ready, failures


ENRICHED_CTE = f"""{_DETAIL}, enriched AS (
  SELECT source_id, external_id, description, tag FROM cur WHERE description IS NOT NULL
  UNION ALL SELECT source_id, external_id, CASE WHEN p_size <> 4 THEN 'detail of ' || name END,
                   CASE WHEN p_size % 2 = 1 THEN 'detail' ELSE tag END
  FROM looked WHERE reason IS NULL)"""


@query("enrich_stats", _with(f"""
, {ENRICHED_CTE} SELECT c.source_id, count(*) AS total, count(e.source_id) AS enriched,
  count(e.description) AS with_description,
  (SELECT count(*) FROM looked l WHERE l.reason IS NOT NULL AND l.source_id = c.source_id) AS failures
FROM cur c LEFT JOIN enriched e ON e.source_id = c.source_id AND e.external_id = c.external_id GROUP BY c.source_id
"""))
def _stats(t):
    ready, failures = enriched(t)
    return enrich.enrich_stats(cur_items(t), ready, failures).drop("week")


# ---------------------------------------------------------------- editing


@query("request_batches", _with("""
, refs AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY pos) - 1 AS rn FROM cur)
SELECT source_id, CAST(rn // 20 AS BIGINT) AS batch, 'r' || CAST(rn % 20 AS STRING) AS ref, external_id FROM refs
"""))
def _batches(t):
    refs, _payload = curate.request_batches(cur_items(t), enriched(t)[0])
    return refs.select("source_id", "batch", "ref", "external_id")


@query("request_payload", _with(f"""
, {ENRICHED_CTE}, refs AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY pos) - 1 AS rn FROM cur)
SELECT r.source_id, CAST(rn // 20 AS BIGINT) AS batch, '[' || string_agg(
  '{{"ref":"r' || CAST(rn % 20 AS STRING) || '","name":"' || r.name || '","category_raw":"' || category_raw ||
  '","price":' || CAST(price AS STRING) || ',"description":' || coalesce('"' || e.description || '"', 'null') ||
  '}}', ',' ORDER BY rn) || ']' AS payload
FROM refs r LEFT JOIN enriched e ON e.source_id = r.source_id AND e.external_id = r.external_id GROUP BY ALL
"""))
def _payload(t):
    return curate.request_batches(cur_items(t), enriched(t)[0])[1].drop("week")


def request_refs(t):
    """The references of all items, read by requests and answers alike."""
    return cut_lineage(curate.request_batches(cur_items(t), enriched(t)[0])[0])


def answers(t, refs=None, items=None):
    """What an editor sends back for each batch of ``refs``, which are of ``items`` (or the current catalog).

    By part size: 5 is left out, 6 renamed, 7 out of scope, above 40 a blurb longer than
    allowed, even ones a category. Batches with an odd number are fenced and bare; every
    seventh is no JSON.
    """
    refs = request_refs(t) if refs is None else refs
    size = _("p_size")
    entry = F.struct("slot", F.struct(
        "ref", F.when(size == 6, F.concat("name", F.lit("!"))).otherwise(_("name")).alias("name"),
        F.when(size % 2 == 0, F.concat(F.lit("cat"), (size % 5).cast("string"))).otherwise("").alias("category"),
        F.when(size > 40, F.repeat(F.lit("가"), 45)).when(size > 20, F.lit("good")).alias("blurb"),
        (size == 7).alias("out_of_scope")).alias("e"))
    items = cur_items(t) if items is None else items
    keyed = refs.join(by_shuffle(items.select("source_id", "external_id", "pos")), ["source_id", "external_id"])
    sized = keyed.join(by_shuffle(t.part.select(_("p_partkey").alias("pos"), "p_size")), "pos").filter(size != 5)
    listed = sized.groupBy("source_id", "week", "batch").agg(F.sort_array(F.collect_list(entry)).alias("l"))
    bare = F.concat(F.lit("```json\n"), F.to_json("l.e"), F.lit("\n```"))
    wrapped = F.to_json(F.struct(_("l.e").alias("items")))
    return listed.select("source_id", "week", "batch", F.when(_("batch") % 7 == 6, "sorry").when(
        _("batch") % 2 == 1, bare).otherwise(wrapped).alias("response"))


_EDITS = """
refs AS (SELECT c.*, p_size, row_number() OVER (PARTITION BY source_id ORDER BY pos) - 1 AS rn
         FROM cur c JOIN part ON p_partkey = pos),
entries AS (SELECT *, CAST(rn // 20 AS BIGINT) AS batch, 'r' || CAST(rn % 20 AS STRING) AS ref,
       name || CASE WHEN p_size = 6 THEN '!' ELSE '' END AS e_name,
       CASE WHEN p_size % 2 = 0 THEN 'cat' || CAST(p_size % 5 AS STRING) ELSE '' END AS e_category,
       CASE WHEN p_size > 40 THEN repeat('가', 45) WHEN p_size > 20 THEN 'good' END AS e_blurb,
       p_size = 7 AS e_out FROM refs WHERE p_size <> 5 AND (rn // 20) % 7 <> 6)"""


@query("response_entries", _with(f"""
, {_EDITS} SELECT source_id, batch, ref, e_name AS name, e_category AS category, e_blurb AS blurb,
                  e_out AS out_of_scope FROM entries
"""))
def _entries(t):
    return curate.parse_responses(answers(t))[0].drop("week")


@query("response_failed_batches", _with(f"""
, {_EDITS} SELECT DISTINCT source_id, CAST(rn // 20 AS BIGINT) AS batch FROM refs
WHERE p_size <> 5 AND (rn // 20) % 7 = 6
"""))
def _failed(t):
    return curate.parse_responses(answers(t))[1].drop("week")


@query("response_rekey", _with(f"""
, {_EDITS} SELECT source_id, external_id, e_category AS category FROM entries
"""))
def _rekey(t):
    refs = request_refs(t)
    edits, _missing = curate.rekey(curate.parse_responses(answers(t, refs))[0], refs)
    return edits.select("source_id", "external_id", "category")


@query("response_missing", _with(f"""
, {_EDITS} SELECT source_id, external_id FROM refs
WHERE p_size = 5 AND (source_id, CAST(rn // 20 AS BIGINT)) IN (SELECT source_id, batch FROM entries)
"""))
def _missing(t):
    refs = request_refs(t)
    return curate.rekey(curate.parse_responses(answers(t, refs))[0], refs)[1].select("source_id", "external_id")


def applied_edits(t, items=None):
    """(edits as applied, enriched) for ``items``, or for the whole current catalog, each derived once."""
    listed = items
    items = cut_lineage(dealt(cur_items(t), "pos")) if listed is None else listed
    ready = cut_lineage(enriched(t, listed)[0])
    refs = cut_lineage(curate.request_batches(items, ready)[0])
    edits, _missing_ = curate.rekey(curate.parse_responses(answers(t, refs, listed))[0], refs)
    return cut_lineage(curate.apply_edits(items, edits, ready)), ready


APPLIED_CTE = f"""{ENRICHED_CTE}, {_EDITS}, applied AS (
  SELECT c.source_id, c.external_id, c.pos, c.name, c.category_raw, d.tag AS facts_tag, d.description AS facts,
         CASE WHEN e.e_name = c.name AND e_category <> '' THEN e_category ELSE c.category_raw END AS category,
         CASE WHEN e.e_name = c.name AND d.description IS NOT NULL THEN substr(e_blurb, 1, 40) END AS blurb,
         coalesce(e.e_name = c.name AND e_out, false) AS out_of_scope
  FROM cur c LEFT JOIN entries e ON e.source_id = c.source_id AND e.external_id = c.external_id
  LEFT JOIN enriched d ON d.source_id = c.source_id AND d.external_id = c.external_id)"""


@query("apply_edit", _with(f"""
, {APPLIED_CTE} SELECT source_id, external_id, category, coalesce(facts_tag, '') AS tags, blurb, out_of_scope
FROM applied
"""))
def _apply(t):
    edits, _ready = applied_edits(t)
    return edits.select("source_id", "external_id", "category", F.array_join("tags", "|").alias("tags"),
                        "blurb", "out_of_scope")


@query("taxonomy_lookup", _with("""
SELECT source_id, CASE source_id WHEN 'cu' THEN 16 WHEN 'orion' THEN 11 END AS categories, count(*) AS n
FROM cur GROUP BY ALL
"""))
def _taxonomy(t):
    dim = registry.source_dim(t.spark).withColumn("channel", F.when(
        _("source_id") == "starbucks", "kiosk").otherwise(_("channel")))
    rows = cur_items(t).join(dim, "source_id")
    listed = curate.with_taxonomy(rows, registry.taxonomy_dim(t.spark))
    n = F.when(_("categories").isNotNull(), F.size("categories")).cast("bigint")
    return listed.groupBy("source_id", n.alias("categories")).agg(F.count(F.lit(1)).alias("n"))


@query("taxonomy_check", """
SELECT c_mktsegment AS channel, unnest(CASE c_mktsegment WHEN 'MACHINERY' THEN ['no other category']
  WHEN 'BUILDING' THEN ['repeated category', 'no label'] WHEN 'HOUSEHOLD' THEN ['no categories'] ELSE [] END) AS problem
FROM (SELECT DISTINCT c_mktsegment FROM customer) c
""")
def _taxonomy_check(t):
    segments = t.customer.select(_("c_mktsegment").alias("channel")).distinct()
    words = F.when(_("channel") == "MACHINERY", F.array(F.lit("빵"))).when(
        _("channel") == "BUILDING", F.array(F.lit("빵"), F.lit("빵"), F.lit("기타"))).when(
        _("channel") == "HOUSEHOLD", F.array().cast("array<string>")).otherwise(F.array(F.lit("빵"), F.lit("기타")))
    taxonomy = segments.select("channel", F.explode(words).alias("category"))
    labels = segments.filter("channel <> 'BUILDING'")
    return curate.check_taxonomy(segments, taxonomy, labels)
