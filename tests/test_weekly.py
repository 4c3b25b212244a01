import json

import pytest
from pyspark.sql import functions as F

from shelfdiff import schemas
from shelfdiff.plans import weekly
from shelfdiff.sources import registry

COLUMNS = "source_id string, week string, pos bigint, external_id string, " \
          "alt_ids map<string,string>, name string, price bigint, category_raw string, " \
          "description string, tags array<string>, image_url string, source_url string, " \
          "scraped_at timestamp"


def items(spark, week, rows):
    """rows: (source, key, name, price, description)"""
    data = [(src, week, i, key, {"gd_idx": key} if src == "cu" else {}, name, price, "음료", desc,
             ["tag"] if desc else [], None, f"http://x/{key}", None)
            for i, (src, key, name, price, desc) in enumerate(rows)]
    return (spark.createDataFrame(data, COLUMNS)
            .withColumn("scraped_at", F.lit("2026-09-01 09:00:00").cast("timestamp"))
            .withColumn("_labels", F.struct(
                (F.col("pos") == 0).alias("new"), *[F.lit(None).cast("boolean").alias(c) for c in
                                                    ("best", "limited", "sold_out")],
                F.array().cast("array<string>").alias("badges"),
                F.lit(None).cast("string").alias("new_start_date"))))


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    store = weekly.Store(spark, str(tmp_path_factory.mktemp("store")))
    dim = registry.source_dim(spark)
    categories = spark.createDataFrame([(s, "60", "음료", 0, None) for s in ("cu", "orion", "crown")],
                                       schemas.CATEGORY_DIM)
    base = [("cu", "1", "alpha", 100, None), ("cu", "2", "beta", 100, None),
            ("orion", "1", "gamma", None, None), ("orion", "2", "delta", None, None)]
    out = {"dim": dim, "store": store}
    out["v35"] = weekly.take_snapshots(store, "2026-W35", items(spark, "2026-W35", base), categories)
    weekly.diff_week(store, "2026-W35")
    second = [("cu", "1", "alpha", 120, None), ("cu", "3", "epsilon", 300, "sweet"),
              ("cu", "4", "zeta", 300, None),
              ("crown", "9", "omega", None, None)] + [("orion", "7", "twin", 1, None)] * 2
    attempted = spark.createDataFrame([("cu",), ("orion",), ("crown",), ("kyochon",)], "source_id string")
    out["v36"] = weekly.take_snapshots(store, "2026-W36", items(spark, "2026-W36", second), categories,
                                       attempted)
    weekly.diff_week(store, "2026-W36")
    details = spark.createDataFrame(
        [("cu", "2026-W36", "4", "zeta", "sour", [])],
        "source_id string, week string, external_id string, name string, description string, tags array<string>")
    out["stats"] = weekly.enrich_week(store, "2026-W36", details, dim)
    _refs, payload = weekly.edit_requests(store, "2026-W36")
    out["payload"] = payload
    answer = [{"ref": "r0", "name": "epsilon", "category": "음료", "blurb": "b" * 50, "out_of_scope": False},
              {"ref": "r1", "name": "zeta", "category": "주류", "blurb": None, "out_of_scope": True}]
    responses = spark.createDataFrame([("cu", "2026-W36", 0, "```json\n" + json.dumps(answer) + "\n```")],
                                      "source_id string, week string, batch bigint, response string")
    out["publication"], out["report"] = weekly.publish_week(store, "2026-W36", responses, dim)
    return out


def test_first_week_is_a_baseline(run):
    rows = {r.source_id: r for r in run["store"].counts("2026-W35").collect()}
    assert all(r.baseline and r.current == 2 and r.added == 0 for r in rows.values())
    assert set(rows) == {"cu", "orion"}


def test_a_failing_source_is_held_and_blocks_nobody(run):
    verdict = {r.source_id: r.reason for r in run["v36"].collect()}
    assert verdict == {"cu": None, "orion": "duplicates", "crown": None, "kyochon": "empty"}
    meta = {r.source_id: r.held_from for r in run["store"].meta(["2026-W36"]).collect()}
    assert meta == {"cu": None, "orion": "2026-W35", "crown": None}
    counts = {r.source_id: r for r in run["store"].counts("2026-W36").collect()}
    assert (counts["orion"].matched, counts["orion"].added, counts["orion"].changed) == (2, 0, 0)
    assert (counts["cu"].matched, counts["cu"].added, counts["cu"].removed, counts["cu"].changed) == (1, 2, 1, 1)
    assert counts["crown"].baseline and counts["crown"].gap_weeks == 0


def test_a_second_run_takes_no_second_snapshot(run, spark):
    again = items(spark, "2026-W36", [("cu", "8", "other", 1, None)])
    verdict = weekly.take_snapshots(run["store"], "2026-W36", again,
                                    spark.createDataFrame([], schemas.CATEGORY_DIM))
    assert verdict.count() == 0
    assert {r.external_id for r in run["store"].items(["2026-W36"]).filter("source_id = 'cu'").collect()} == {
        "1", "3", "4"}


def test_enrichment_counts(run):
    row = run["stats"].collect()[0]
    assert (row.total, row.enriched, row.with_description, row.failures) == (2, 2, 2, 0)


def test_payload_keeps_product_keys_at_home(run):
    payload = json.loads(run["payload"].collect()[0].payload)
    assert payload[0] == {"ref": "r0", "name": "epsilon", "category_raw": "음료", "price": 300,
                          "description": "sweet"}
    assert [p["ref"] for p in payload] == ["r0", "r1"]


def test_published_rows(run):
    (row,) = run["publication"].collect()
    assert (row.id, row.brand, row.channel, row.category, row.blurb) == (
        "cu--3", "CU", "convenience", "음료", "b" * 40)
    assert (row.first_seen, row.last_seen, row.tags) == ("2026-W36", "2026-W36", ["tag"])


def test_report_tells_absent_from_zero(run):
    (row,) = run["report"].collect()
    assert row.sources == ["cu", "orion"]
    assert (row.totals.total, row.totals.with_blurb) == (1, 1)
    cu, orion = row.by_source["cu"], row.by_source["orion"]
    assert cu.published_then_gone is None
    assert (cu.out_of_scope["count"], cu.added, cu.gap_weeks) == (1, 2, 1)
    assert cu.monotonic_id.asDict() == {"key": "gd_idx", "previous_max": 2, "added_above_previous_max": 2,
                                        "added_below_previous_max": 0}
    assert orion.monotonic_id is None and orion.out_of_scope is None
    assert orion.snapshot.held_from == "2026-W35" and cu.snapshot.held_from is None
    assert orion.source_new_label.labelled_total == 0  # its label sits on the first row of all
    assert (orion.published.total, cu.source_new_label.labelled_total) == (0, 1)


def test_a_rerun_leaves_no_older_rows(spark, tmp_path):
    """Every step run again with fewer rows, and with none, leaves what it found and nothing older."""
    store, dim = weekly.Store(spark, str(tmp_path / "store")), registry.source_dim(spark)
    categories = spark.createDataFrame([("cu", "60", "음료", 0, None)], schemas.CATEGORY_DIM)
    base = [("cu", str(k), f"name {k}", 100, None) for k in range(4)]
    weekly.take_snapshots(store, "2026-W35", items(spark, "2026-W35", base), categories)
    details = spark.createDataFrame([], "source_id string, week string, external_id string, name string, "
                                        "description string, tags array<string>")
    for extra, want in ([("cu", "8", "eight", 1, "sweet"), ("cu", "9", "nine", 1, "sour")], ["8", "9"]), (
            [("cu", "9", "nine", 1, "sour")], ["9"]), ([], []):
        weekly.take_snapshots(store, "2026-W36", items(spark, "2026-W36", base + extra), categories, refresh=True)
        weekly.diff_week(store, "2026-W36")
        weekly.enrich_week(store, "2026-W36", details, dim)
        published, _report = weekly.publish_week(store, "2026-W36", None, dim)
        for table in (store.added("2026-W36"), store.enriched("2026-W36"), published):
            assert sorted(r.external_id for r in table.collect()) == want
        (counts,) = store.counts("2026-W36").collect()
        assert (counts.added, counts.current) == (len(want), 4 + len(want))
        assert store.items(["2026-W36"]).count() == 4 + len(want)


def test_a_broken_source_holds_up_nobody(spark, tmp_path):
    """Of four sources one lacks a field and one is not registered: two are published, and a mended rerun is whole."""
    store, dim = weekly.Store(spark, str(tmp_path / "store")), registry.source_dim(spark)
    sources = ("cu", "orion", "crown", "nowhere")
    categories = spark.createDataFrame([(s, "60", "음료", 0, None) for s in sources], schemas.CATEGORY_DIM)
    base = [(s, "1", f"{s} one", 100, None) for s in sources]
    weekly.take_snapshots(store, "2026-W35", items(spark, "2026-W35", base), categories)
    details = spark.createDataFrame([], "source_id string, week string, external_id string, name string, "
                                        "description string, tags array<string>")

    def published(mark):
        fresh = [(s, "2", f"{s} two", 100, "sweet") for s in sources]
        week = items(spark, "2026-W36", base + fresh).withColumn("source_url", F.when(
            (F.col("source_id") != "orion") | (F.col("external_id") == "1") | F.lit(mark), F.col("source_url")))
        weekly.take_snapshots(store, "2026-W36", week, categories, refresh=True)
        weekly.diff_week(store, "2026-W36")
        weekly.enrich_week(store, "2026-W36", details, dim)
        rows, _report = weekly.publish_week(store, "2026-W36", None, dim)
        return (sorted(r.id for r in rows.collect()),
                sorted((r.source_id, r.problem) for r in store.problems("2026-W36").collect()))
    lacking = [("nowhere", "unknown_source"), ("orion", "missing_field")]
    assert published(False) == (["crown--2", "cu--2"], lacking)
    assert published(True) == (["crown--2", "cu--2", "orion--2"], lacking[:1])
    # what stands is kept while its source is broken again
    assert published(False) == (["crown--2", "cu--2", "orion--2"], lacking)


def test_channels_without_a_list_are_not_sent_to_an_editor(spark):
    from shelfdiff.operators import curate
    added = items(spark, "2026-W36", [("cu", "1", "a", 1, None), ("orion", "2", "b", 1, None), ("nowhere", "3", "c", 1, None)])
    taxonomy = registry.taxonomy_dim(spark).filter("channel <> 'fmcg'")
    assert [r.source_id for r in curate.editable(added, registry.source_dim(spark), taxonomy).collect()] == ["cu"]


def test_expired_archive_is_dropped_by_folder(spark, tmp_path):
    from shelfdiff.sources import tables
    path, today = str(tmp_path / "raw"), F.lit("2026-09-01").cast("date")
    assert tables.retain_raw(spark, path, today).count() == 0
    rows = [(w, s, "1", "json", "{}") for w in ("2026-W01", "2026-W02", "2026-W20", "2026-W36") for s in ("cu", "a/b")]
    tables.write_raw(spark.createDataFrame(rows, schemas.RAW_RESPONSE), path)
    gone = {tuple(r) for r in tables.retain_raw(spark, path, today).collect()}
    assert gone == {(w, s) for w, s, *_ in rows if w in ("2026-W01", "2026-W02", "2026-W20")}
    left = tables.read_table(spark, path, schemas.RAW_RESPONSE)
    assert {(r.week, r.source_id) for r in left.collect()} == {("2026-W36", "cu"), ("2026-W36", "a/b")}
    assert tables.retain_raw(spark, path, today).count() == 0


def test_steps_leave_no_scratch_behind(spark, tmp_path, monkeypatch):
    from shelfdiff import session
    root = tmp_path / "shared"
    root.mkdir()
    monkeypatch.setattr(session, "_shared_root", lambda _spark: str(root))
    store = weekly.Store(spark, str(tmp_path / "store"))
    categories = spark.createDataFrame([("cu", "60", "음료", 0, None)], schemas.CATEGORY_DIM)
    for week, n in (("2026-W35", 3), ("2026-W36", 4)):
        rows = [("cu", str(k), f"name {k}", 100, None) for k in range(n)]
        assert weekly.take_snapshots(store, week, items(spark, week, rows), categories).first().ok
    weekly.diff_week(store, "2026-W36")
    assert list(root.iterdir()) == []
    assert store.counts("2026-W36").first().added == 1
    with pytest.raises(ValueError), session.scratch_scope(spark):
        spark.range(3).write.parquet(session.scratch_path(spark, "t"))
        raise ValueError
    assert list(root.iterdir()) == []


def test_the_base_of_published_then_gone_is_a_stored_publication(spark, tmp_path, monkeypatch):
    """What the week before found new and in scope, by way of its own steps: no part of the catalog chosen by a column."""
    from shelfdiff import session
    from shelfdiff.plans import catalog, q_publish
    monkeypatch.setattr(session, "_shared_root", lambda _spark: str(tmp_path / "shared"))
    sizes = [(i, b, s) for i, (b, s) in enumerate([("Brand#2", 7), ("Brand#2", 30), ("Brand#2", 40), ("Brand#2", 50), ("Brand#3", 2),
                                                  ("Brand#3", 7), ("Brand#4", 50), ("Brand#1", 50), ("Brand#3", 44)], 1)]
    spark.createDataFrame([(i, "big ring", b, "LARGE", s, 900.0) for i, b, s in sizes],
                          "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double") \
        .coalesce(1).write.parquet(str(tmp_path / "sf" / "part.parquet"))
    t = catalog.Tables(spark, str(tmp_path / "sf"))
    rows = {r.external_id: r for r in q_publish.published_before(t).collect()}
    # of the half of Brand#2 with odd keys and of Brand#3, without size 7, which the editor takes out
    assert sorted(rows) == ["3", "5", "9"]
    assert {(r.week, r.first_seen, r.id) for r in rows.values()} == {
        ("2026-W35", "2026-W35", f"{r.source_id}--{r.external_id}") for r in rows.values()}
    assert (rows["3"].brand, rows["5"].channel, rows["9"].blurb) == ("CU", "cafe", "가" * 40)
    (place,) = (tmp_path / "shared").glob("published-*")
    assert [p.name for p in place.glob("week=*")] == ["week=2026-W35"]
    assert {p.name.split("-")[0] for p in (tmp_path / "shared").iterdir() if any(f.is_file() for f in p.rglob("*"))} == {"published"}
