import pytest
from pyspark.sql import functions as F

from shelfdiff import schemas
from shelfdiff.operators import gate
from shelfdiff.plans import weekly
from shelfdiff.sources import snapshots
from tests.test_weekly import items


def rows(n, source="cu", mark=""):
    return [(source, str(k), f"name {k}{mark}", 100, None) for k in range(n)]


@pytest.fixture()
def store(spark, tmp_path):
    return weekly.Store(spark, str(tmp_path / "store"))


@pytest.fixture()
def dim(spark):
    return spark.createDataFrame([("cu", "60", "음료", 0, None), ("orion", "60", "음료", 0, None)], schemas.CATEGORY_DIM)


def take(store, dim, week, collected, refresh=False):
    found = weekly.take_snapshots(store, week, items(store.spark, week, collected), dim, refresh=refresh)
    return {r.source_id: r.reason for r in found.collect()}


def stands(store, week):
    meta = {r.source_id: (r["count"], r.held_from) for r in store.meta([week]).collect()}
    held = {r.source_id: r.n for r in store.items([week]).groupBy("source_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {k: v[0] for k, v in meta.items()} == held
    return meta


def test_a_refused_refresh_keeps_the_good_snapshot(store, dim):
    take(store, dim, "2026-W35", rows(40))
    take(store, dim, "2026-W36", rows(40))
    assert take(store, dim, "2026-W36", rows(3, mark="!"), refresh=True) == {"cu": "categories"}
    assert stands(store, "2026-W36") == {"cu": (40, None)}
    assert store.items(["2026-W36"]).filter(F.col("name").contains("!")).count() == 0
    # nothing to look back to: the bootstrap counts do not know it, an empty collection is refused all the same
    attempted = store.spark.createDataFrame([("cu",)], "source_id string")
    found = weekly.take_snapshots(store, "2026-W35", items(store.spark, "2026-W35", rows(1)).limit(0), dim, attempted, True)
    assert [r.reason for r in found.collect()] == ["empty"]
    assert stands(store, "2026-W35") == {"cu": (40, None)}


def test_a_refused_refresh_of_a_held_week_stays_held(store, dim):
    take(store, dim, "2026-W35", rows(40))
    assert take(store, dim, "2026-W36", rows(2)) == {"cu": "categories"}
    assert stands(store, "2026-W36") == {"cu": (40, "2026-W35")}
    take(store, dim, "2026-W36", rows(1), refresh=True)
    assert stands(store, "2026-W36") == {"cu": (40, "2026-W35")}
    assert take(store, dim, "2026-W36", rows(41)) == {"cu": None}  # only held: taken without a refresh
    assert stands(store, "2026-W36") == {"cu": (41, None)}


def test_holds_chain_over_weeks_without_a_copy(store, dim):
    take(store, dim, "2026-W32", rows(40) + rows(5, "orion"))
    for week in ("2026-W33", "2026-W34", "2026-W35", "2026-W36"):
        take(store, dim, week, rows(2) + rows(5, "orion"))
        assert stands(store, week) == {"cu": (40, "2026-W32"), "orion": (5, None)}
    held = snapshots.manifest(store.spark, store.snapshots, ["2026-W36"], ["cu"]).first()
    assert held.data_week == "2026-W32"
    written = store.spark.read.parquet(f"{store.snapshots}/items").filter(F.col("run") == held.run)
    assert {(r.week, r.source_id) for r in written.select("week", "source_id").distinct().collect()} == {
        ("2026-W32", "cu"), ("2026-W32", "orion")}


@pytest.mark.parametrize("broken", ["items", "control", "categories", "commit"])
def test_a_crash_between_two_writes_changes_nothing(store, dim, monkeypatch, broken):
    take(store, dim, "2026-W36", rows(40))

    def fail(*_args, **_kwargs):
        raise RuntimeError("lost")
    if broken == "commit":
        monkeypatch.setattr(snapshots, "commit", fail)
    else:
        real = snapshots.tables.write_table

        def until(df, path, *args):
            if f"/{broken}/" in path:
                fail()
            return real(df, path, *args)
        monkeypatch.setattr(snapshots.tables, "write_table", until)
    with pytest.raises(RuntimeError):
        take(store, dim, "2026-W36", rows(45, mark="!"), refresh=True)
    monkeypatch.undo()
    assert stands(store, "2026-W36") == {"cu": (40, None)}
    assert take(store, dim, "2026-W36", rows(39), refresh=True) == {"cu": None}
    assert stands(store, "2026-W36") == {"cu": (39, None)}


def test_vacuum_leaves_what_rows_point_to(store, dim):
    take(store, dim, "2026-W35", rows(40))
    take(store, dim, "2026-W36", rows(2))
    take(store, dim, "2026-W35", rows(41), refresh=True)
    assert snapshots.vacuum(store.spark, store.snapshots) == []  # all too young
    gone = snapshots.vacuum(store.spark, store.snapshots, 0)
    assert len(gone) == 1  # the refused week's run; the first run is still held to
    assert stands(store, "2026-W35") == {"cu": (41, None)} and stands(store, "2026-W36") == {"cu": (40, "2026-W35")}


def test_a_held_row_is_a_reference(spark):
    meta = spark.createDataFrame([("2026-W35", "cu", "r1", "2026-W34", None, 4, "2026-W34")], schemas.SNAPSHOT_MANIFEST)
    look = spark.createDataFrame([("cu", "2026-W36", "2026-W35")], "source_id string, week string, previous_week string")
    held = gate.hold_previous(look, meta, look).first()
    assert (held.week, held.run, held.data_week, held["count"], held.held_from) == (
        "2026-W36", "r1", "2026-W34", 4, "2026-W34")
