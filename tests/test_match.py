import os
import random
import time
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from shelfdiff import schemas, session
from shelfdiff.operators import diff, match, similarity
import pytest

from tests.brute import serial_match, serial_review

COLUMNS = "source_id string, week string, pos bigint, external_id string, " \
          "alt_ids map<string,string>, name string, price bigint, category_raw string, " \
          "image_url string"


def frame(spark, catalogs):
    rows = [(src, "2026-W36", i, it["external_id"], it["alt_ids"], it["name"], it["price"],
             it.get("category_raw"), it.get("image_url"))
            for src, items in catalogs.items() for i, it in enumerate(items)]
    return spark.createDataFrame(rows, COLUMNS)


def random_item(rng, spread):
    alt = {}
    if rng.random() < 0.7:
        alt["barcode"] = str(rng.randrange(spread))
    if rng.random() < 0.5:
        alt["sku"] = "k%d" % rng.randrange(spread)
    if rng.random() < 0.2:
        alt["gd"] = ""
    return {"external_id": "e%d" % rng.randrange(spread) if rng.random() < 0.8 else "",
            "alt_ids": alt, "name": "n %d" % rng.randrange(max(2, spread // 2)),
            "price": rng.choice([None, 100, 200])}


def as_dict(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.source_id, {})[r.cur_pos] = (r.prev_pos, r.matched_by)
    return out


def test_keys_in_order_of_trust(spark):
    item = {"external_id": "17620", "name": "A  B", "price": None,
            "alt_ids": {"gd_idx": "17620", "barcode": "88", "a": "", "z": "9"}}
    keys = match.match_keys(frame(spark, {"s": [item]}), name_price=True).orderBy("rank").collect()
    assert [(k.key, k.value) for k in keys] == [
        ("barcode", "88"), ("gd_idx", "17620"), ("z", "9"), ("external_id", "17620"),
        ("name_price", "a b\x1f-")]


def test_matches_serial_rule_on_random_catalogs(spark):
    rng = random.Random(5)
    prev, cur = {}, {}
    for trial in range(400):
        spread = rng.choice([2, 3, 5, 9, 20])
        size = rng.choice([1, 3, 6, 12])
        prev[f"t{trial}"] = [random_item(rng, spread) for _ in range(rng.randrange(size + 1))]
        cur[f"t{trial}"] = [random_item(rng, spread) for _ in range(rng.randrange(size + 1))]
    for limit, rounds in ((match.SERIAL_LIMIT, 40), (20, 40), (0, 40), (4, 1), (3, 0)):
        got = as_dict(match.layered_match(frame(spark, prev), frame(spark, cur), serial_limit=limit,
                                          max_rounds=rounds))
        for trial in prev:
            want = serial_match(prev[trial], cur[trial])
            assert got.get(trial, {}) == want, (limit, trial, prev[trial], cur[trial])


def test_one_fat_key_pool(spark):
    same = {"external_id": "", "alt_ids": {}, "name": "same", "price": None}
    prev = {"s": [same] * 300}
    cur = {"s": [same] * 200 + [{**same, "name": "other"}] + [same] * 200}
    for limit in (match.SERIAL_LIMIT, 0):
        got = as_dict(match.layered_match(frame(spark, prev), frame(spark, cur), serial_limit=limit))["s"]
        assert got == serial_match(prev["s"], cur["s"])
        assert len(got) == 300


def test_chain_of_displaced_rows(spark):
    """A new row in front of a hot name shifts all that follow, although each has its barcode."""
    def item(barcode):
        return {"external_id": "", "alt_ids": {"barcode": barcode}, "name": "hot", "price": None}

    prev = {"s": [item(f"b{i}") for i in range(60)]}
    cur = {"s": [item("new")] + [item(f"b{i}") for i in range(60)]}
    want = serial_match(prev["s"], cur["s"])
    assert want[1] == (1, "name_price")
    for limit, rounds in ((match.SERIAL_LIMIT, 40), (25, 2)):
        got = as_dict(match.layered_match(frame(spark, prev), frame(spark, cur), serial_limit=limit,
                                          max_rounds=rounds))["s"]
        assert got == want


def test_later_key_of_an_earlier_row_wins(spark):
    prev = {"s": [{"external_id": "", "alt_ids": {"barcode": "1"}, "name": "x", "price": 1}]}
    cur = {"s": [{"external_id": "", "alt_ids": {"barcode": "9"}, "name": "x", "price": 1},
                 {"external_id": "", "alt_ids": {"barcode": "1"}, "name": "y", "price": 1}]}
    got = as_dict(match.layered_match(frame(spark, prev), frame(spark, cur)))
    assert got == {"s": {0: (0, "name_price")}}


def leftovers(spark, catalogs):
    rows = [(src, "2026-W36", pos, cat, name)
            for src, items in catalogs.items() for pos, cat, name in items]
    return spark.createDataFrame(
        rows, "source_id string, week string, pos bigint, category_raw string, name string")


@pytest.mark.parametrize("task_rows", [200_000, 12])
def test_review_equals_all_pairs(spark, task_rows):
    rng = random.Random(11)
    prev, cur = {}, {}

    def variant(word):
        letters = list(word)
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            at = rng.randrange(len(letters) + 1)
            if rng.random() < 0.5 and letters:
                del letters[min(at, len(letters) - 1)]
            else:
                letters.insert(at, rng.choice("abcdé가나\U0001f354"))
        return " ".join("".join(letters).split()).lower()

    for trial in range(60 if task_rows > 100 else 12):
        alphabet = rng.choice(["ab", "abcd", "가나다라마바사아자차카타파하", "abcdefghijklmnop\U0001f354"])
        words = ["".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 2, 5, 7, 12, 16, 25])))
                 for _ in range(8)]
        cats = [None, "x", "y"]
        prev[f"t{trial}"] = [(i, rng.choice(cats), variant(rng.choice(words))) for i in range(12)]
        cur[f"t{trial}"] = [(i, rng.choice(cats), variant(rng.choice(words))) for i in range(12)]
    prev["long"] = [(0, None, "ab " * 90), (1, None, "".join(rng.choice("abcdefgh") for _ in range(230)))]
    cur["long"] = [(0, None, "ab " * 88), (1, None, prev["long"][1][2][:210])]
    prev["long"] = [(i, c, " ".join(n.split())) for i, c, n in prev["long"]]
    cur["long"] = [(i, c, " ".join(n.split())) for i, c, n in cur["long"]]
    found = similarity.review(leftovers(spark, cur), leftovers(spark, prev), task_rows=task_rows)
    got = {}
    for r in found.collect():
        got.setdefault(r.source_id, {})[r.cur_pos] = (r.prev_pos, r.similarity)
    for trial in prev:
        assert got.get(trial, {}) == serial_review(prev[trial], cur[trial], 0.85, 10**6), trial


def test_pair_limit_skips_a_source_week_whole(spark):
    side = {"big": [(i, "c", "same name") for i in range(4)], "small": [(0, "c", "same name")]}
    df = leftovers(spark, side)
    guard = {r.source_id: r.skipped for r in similarity.pair_limit(df, df, 15).collect()}
    assert guard == {"big": True, "small": False}
    found = similarity.candidates(df, df, limit=15)
    assert [r.source_id for r in found.collect()] == ["small"]
    assert similarity.candidates(df, df, limit=16).filter(F.col("source_id") == "big").count() == 16


def test_schema_constants():
    assert schemas.SNAPSHOT_ITEM["price"].dataType.simpleString() == "bigint"


def test_both_snapshots_of_one_table(spark):
    rows = [("s", "w", i, str(i), {"a": str(i % 3)}, "n", 1) for i in range(9)]
    base = spark.createDataFrame(rows, "source_id string, week string, pos long, external_id string, "
                                       "alt_ids map<string,string>, name string, price long")
    prev, cur = base.filter("pos > 1"), base.filter("pos < 7")
    whole = match.layered_match(prev, cur, serial_limit=2).count()
    assert whole == match.layered_match(prev, cur).count() == 7


def test_growing_tables_do_not_go_through_the_driver(spark):
    rows = [("s", "w", i, str(i), {"a": str(i)}, f"name {i}", 1, None, None) for i in range(9)]
    base = spark.createDataFrame(rows, "source_id string, week string, pos long, external_id string, alt_ids "
                                       "map<string,string>, name string, price long, image_url string, category_raw string")
    result = diff.diff_pair(base.filter("pos > 1"), base.filter("pos < 7"))
    for table in (result.added, result.removed, result.changed, result.conflicts, result.counts):
        assert "Broadcast" not in table._jdf.queryExecution().executedPlan().toString()
    assert (result.added.count(), result.removed.count()) == (2, 2)


def _files(root):
    return [os.path.join(folder, f) for folder, _, files in os.walk(root) for f in files]


def test_a_diff_in_slices_is_the_whole_diff_and_deletes_what_a_slice_needed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_shared_root", lambda _spark: str(tmp_path))
    dice = random.Random(5)
    rows = [(f"s{s}", f"2026-W{w}", i, f"{i + 10 * (dice.random() < 0.2)}", {"barcode": str(dice.randrange(9))},
             f"name of item {'x' * dice.randrange(2)}{i}", 1 + (dice.random() < 0.3), "c", None)
            for s in range(7) for w in (31, 33, 34) for i in range(6 - s % 3)]
    items = spark.createDataFrame(rows, COLUMNS)
    meta = items.groupBy("source_id", "week").agg(F.count("*").alias("count"))
    names = ("added", "removed", "changed", "review", "conflicts", "counts", "matches", "over_limit")

    def rows_of(found):
        return {n: sorted(map(str, getattr(found, n).collect())) for n in names}
    whole = rows_of(diff.diff(items, meta))
    kept = {os.path.relpath(f, tmp_path).split("-")[0] for f in _files(tmp_path)}
    assert kept == {"lookback", "matches", "review", "pairs", "counts"}
    assert whole == rows_of(diff.diff(items.withColumn(diff.SLICE, diff.slice_of(3)), meta, slices=3))
    assert len(whole["counts"]) == 21 and whole["review"] and whole["changed"]
    straight = diff.diff_pair(*diff.pair_snapshots(items, diff.lookback(meta)))
    for n in ("added", "removed", "review", "matches"):
        assert sorted(map(str, getattr(straight, n).collect())) == whole[n]


def test_shuffle_files_go_with_the_action_that_made_them(spark, tmp_path):
    places = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()

    def shuffles():
        return {f for place in places for f in _files(place) if os.path.basename(f).startswith("shuffle_")}
    before, key = shuffles(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    told = spark.conf.get(key)
    frame = spark.range(1000).repartition(3, "id")
    kept = [session.cut_lineage(frame), session.write_scratch(frame, str(tmp_path / "t"))]
    for _ in range(50):
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before and [df.count() for df in kept] == [1000, 1000] and frame.count() == 1000
    assert spark.conf.get(key) == told


def test_only_names_within_reach_are_compared(spark):
    schema = "source_id string, week string, pos bigint, category_raw string, name string"
    cur = spark.createDataFrame([("s", "w", 1, "a", "abcdefgh"), ("s", "w", 2, "b", "abcdefgh"), ("s", "w", 3, "a", "abc"),
                                 ("s", "w", 4, None, "")], schema)
    prev = spark.createDataFrame([("s", "w", 5, "a", "zbcdefgh"), ("s", "w", 6, "c", "abcdefgh"), ("s", "w", 7, None, "")], schema)
    sides = similarity._comparable(cur, prev, 0.85, None)
    assert [sorted(r.pos for r in side.collect()) for side in sides] == [[1, 4], [5, 7]]
    got = sorted((r.cur_pos, r.prev_pos) for r in similarity.review(cur, prev, 0.85).collect())
    assert got == [(1, 5), (4, 7)]


def test_a_name_meets_only_lengths_that_occur(spark):
    schema = "source_id string, week string, cat string, name string"
    names = spark.createDataFrame([("s", "w", "c", f"{i:016x}") for i in range(20)], schema)
    met = similarity._partner_lengths(names, names, 0.85)
    assert {(r.other, r.n) for r in met.groupBy("other").agg(F.count("*").alias("n")).collect()} == {(16, 20)}
    pieces = similarity._pieces(met, F.length("name"), F.col("other"), 0.85)
    assert pieces.count() == 20 * 5


@pytest.mark.parametrize("threshold", [0.7, 0.85, 0.999])
def test_no_close_name_is_missed(spark, threshold):
    dice = random.Random(3)

    def changed(name):
        out = [c for c in name if dice.random() > 0.08]
        return "".join(out + [dice.choice("ab") for _ in range(dice.choice([0, 0, 1, 2]))])
    base = ["".join(dice.choice("abc가") for _ in range(dice.choice([1, 2, 5, 9, 16, 21]))) for _ in range(60)]
    sides = [sorted({changed(n) for n in base} | set(base[::k])) for k in (2, 3)]
    cur, prev = (spark.createDataFrame([("s", "w", "c", n) for n in side], "source_id string, week string, cat string, "
                                       "name string") for side in sides)
    want = {(a, b) for a in sides[0] for b in sides[1] if a != b and SequenceMatcher(None, a, b).ratio() >= threshold}
    got = {(r.cur_name, r.prev_name) for r in similarity.name_pairs(cur, prev, threshold).collect()}
    assert got == want


def test_bits_thin_pairs_out_before_characters_are_counted(spark):
    schema = "source_id string, week string, cat string, name string"
    sides = [spark.createDataFrame([("s", "w", "c", f"{i:016x}") for i in range(k, 40)], schema) for k in (0, 5)]
    plan = similarity.name_pairs(*sides, 0.85)._jdf.queryExecution().optimizedPlan().toString()
    (join,) = [line for line in plan.splitlines() if "Join" in line and "bit_count" in line]
    assert join.index("bit_count") < join.index("array_distinct")
    # the bits are there once a name, not computed again for each piece
    assert "shiftleft" not in plan


def test_a_piece_is_looked_for_at_few_places(spark):
    schema = "source_id string, week string, cat string, name string"
    names = spark.createDataFrame([("s", "w", "c", "0123456789abcdef")], schema)
    rows = similarity._pieces(similarity._partner_lengths(names, names, 0.85), F.col("other"), F.length("name"), 0.85)
    places = rows.select(F.size(similarity._shifted_pieces(F.col("name"), F.col("other"))).alias("n")).collect()
    assert sorted(r.n for r in places) == [1, 1, 2, 2, 3]


@pytest.mark.parametrize("threshold", [0.68, 0.75, 0.85])
def test_shifts_of_inserted_and_dropped_blocks_are_found(spark, threshold):
    dice = random.Random(11)

    def changed(name):
        at, cut, more = dice.randrange(len(name) + 1), dice.randrange(5), dice.randrange(5)
        return name[:at] + "".join(dice.choice("ab01") for _ in range(more)) + name[at + cut:]
    base = ["".join(dice.choice("0123ab") for _ in range(dice.choice([6, 11, 16, 19]))) for _ in range(60)]
    sides = [sorted({changed(changed(n)) for n in base} | {changed(n) for n in base}) for _ in range(2)]
    cur, prev = (spark.createDataFrame([("s", "w", "c", n) for n in side], "source_id string, week string, cat string, "
                                       "name string") for side in sides)
    want = {(a, b) for a in sides[0] for b in sides[1] if a != b and SequenceMatcher(None, a, b).ratio() >= threshold}
    got = {(r.cur_name, r.prev_name) for r in similarity.name_pairs(cur, prev, threshold).collect()}
    assert got == want
