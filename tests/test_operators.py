"""Boundaries and traps of the operators, on small frames."""

import json

from pyspark.sql import functions as F

from shelfdiff import schemas
from shelfdiff.operators import (browse, convlog, curate, dedupe, diff, enrich, extract, filters, gate,
                                 ordering, publish, report, sample)
from shelfdiff.sources import registry, tables


def meta(spark, rows):
    return spark.createDataFrame([(w, s, None, n, None) for s, w, n in rows], schemas.SNAPSHOT_META)


def test_volume_limits_themselves_pass(spark):
    cases = {"a": (1000, 299, "drop"), "b": (1000, 300, "ok"), "c": (1000, 3000, "ok"), "d": (1000, 3001, "spike"),
             "e": (100, 301, "spike"), "f": (0, 5, "ok"), "g": (100, 0, "empty"), "h": (None, 7, "ok")}
    rows = [(s, "2026-W35", before) for s, (before, _n, _v) in cases.items() if before is not None]
    rows += [(s, "2026-W36", n) for s, (_before, n, _v) in cases.items()]
    table = meta(spark, rows)
    looked = diff.lookback(table).filter("week = '2026-W36'")
    got = {r.source_id: r.verdict for r in gate.check_volume(table, looked).collect()}
    assert got == {s: v for s, (_b, _n, v) in cases.items()}


def test_lookback_ends_after_four_weeks(spark):
    table = meta(spark, [("a", "2025-W51", 1), ("a", "2026-W03", 1), ("a", "2026-W08", 1), ("b", "2026-W07", 1)])
    got = {(r.source_id, r.week): (r.previous_week, r.gap_weeks) for r in diff.gap_weeks(diff.lookback(table)).collect()}
    assert got == {("a", "2025-W51"): (None, 0), ("a", "2026-W03"): ("2025-W51", 4), ("a", "2026-W08"): (None, 0),
                   ("b", "2026-W07"): (None, 0)}


def category_items(spark, rows):
    data = [(s, w, f"{i}", cat) for i, (s, w, cat, n) in enumerate(rows) for _ in range(n)]
    return spark.createDataFrame(data, "source_id string, week string, external_id string, category_raw string")


def test_category_check_first_week_and_later(spark):
    dim = spark.createDataFrame([("a", "1", "x", 0, 100), ("a", "2", "y", 1, 0), ("a", "3", "z", 2, 10),
                                 ("b", "1", "x", 0, 5)], schemas.CATEGORY_DIM)
    items = category_items(spark, [("a", "2026-W35", "x", 90), ("a", "2026-W35", "z", 12), ("b", "2026-W35", "x", 10),
                                   ("b", "2026-W36", "x", 3), ("b", "2026-W36", "?", 50), ("a", "2026-W36", "x", 26),
                                   ("a", "2026-W36", "y", 1)])
    looked = diff.lookback(items.select("week", "source_id").distinct())
    got = {(r.source_id, r.week, r.code): (r.want, r.got) for r in gate.check_categories(items, dim, looked).collect()}
    assert got == {("a", "2026-W35", "3"): (10, 12), ("b", "2026-W35", "1"): (5, 10),
                   ("a", "2026-W36", "1"): (90, 26), ("a", "2026-W36", "3"): (12, 0)}
    new = {(r.source_id, r.week, r.code) for r in gate.new_categories(items, dim, looked).collect()}
    assert new == {("a", "2026-W36", "2")}


def test_numbering_is_exact_over_range_borders(spark):
    rows = [(g, p) for g, step in (("a", 1), ("b", 7)) for p in range(0, 100 * step, step)]
    df = spark.createDataFrame(rows, "g string, pos bigint")
    out = ordering.number_in_group(df, ["g"]).collect()
    assert {(r.g, r.pos): r.rn for r in out} == {(g, p): p // (1 if g == "a" else 7) + 1 for g, p in rows}


def test_dedupe_guard_sees_null_as_a_value(spark):
    rows = [("k", 0, 100, "n"), ("k", 1, 100, "m"), ("l", 0, None, "n"), ("l", 1, 5, "n"), ("m", 0, None, "n"),
            ("m", 1, None, "n"), ("o", 1, 1, "late"), ("o", 0, 2, "early")]
    df = spark.createDataFrame(rows, "key string, pos int, price bigint, name string")
    kept, conflicts = dedupe.dedupe(df, ["key"], ["pos"], guard="price", tolerated="name")
    assert {r.key: r.name for r in kept.collect()} == {"k": "n", "l": "n", "m": "n", "o": "early"}
    assert {r.key for r in conflicts.collect()} == {"l", "o"}
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()


def test_pages_end_when_nothing_is_new(spark):
    rows = [("l", 1, "a"), ("l", 1, "a"), ("l", 2, "a"), ("l", 2, "b"), ("l", 3, "b"), ("l", 4, "z")]
    df = spark.createDataFrame(rows, "list string, page int, external_id string")
    out = sorted((r.page, r.external_id) for r in dedupe.dedupe_pages(df, ["list"]).collect())
    assert out == [(1, "a"), (1, "a"), (2, "b")]


def test_repeated_and_overflowing_pages(spark):
    rows = [("l", 1, "a"), ("l", 1, "b"), ("l", 2, "b"), ("l", 2, "a"), ("l", 3, "a"), ("l", 5, "a")]
    df = spark.createDataFrame(rows, "list string, page int, external_id string")
    assert [r.page for r in gate.repeated_pages(df, ["list"]).collect()] == [2]
    (row,) = gate.page_overflow(df, ["list"], page_size=2, max_pages=5).collect()
    assert (row.last_page, row.short_page, row.over_max, row.after_short) == (5, 3, False, True)


def test_declared_total_missing_is_a_problem_unless_allowed(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "list string")
    totals = spark.createDataFrame([("a", 2), ("b", None), ("c", 1)], "list string, total bigint")
    assert {r["list"] for r in gate.check_declared_total(rows, totals, ["list"]).collect()} == {"b", "c"}
    assert {r["list"] for r in gate.check_declared_total(rows, totals, ["list"], required=False).collect()} == {"c"}


def test_unknown_category_includes_null(spark):
    rows = spark.createDataFrame([("x",), (None,), ("y",)], "category string")
    known = spark.createDataFrame([("x",)], "category string")
    got = {r.category: r.rows for r in filters.unknown_categories(rows, known).collect()}
    assert got == {None: 1, "y": 1}


def added_rows(spark, rows, source="cu"):
    data = [(source, "2026-W36", i, k, name, None, desc, tags, "raw") for i, (k, name, desc, tags) in enumerate(rows)]
    return spark.createDataFrame(
        data, "source_id string, week string, pos bigint, external_id string, name string, price bigint, "
              "description string, tags array<string>, category_raw string")


def test_detail_cap_stops_everything_or_nothing(spark):
    dim = registry.source_dim(spark)
    exact = added_rows(spark, [(f"k{i}", "n", None, None) for i in range(500)])
    todo, over = enrich.detail_cap(enrich.detail_worklist(exact, dim))
    assert (todo.count(), over.count()) == (500, 0)
    beyond = added_rows(spark, [(f"k{i}", "n", None, None) for i in range(501)] + [("d", "n", "text", None)])
    details = spark.createDataFrame([], "source_id string, week string, external_id string, name string, "
                                        "description string, tags array<string>")
    ready, failures, over = enrich.enrich(beyond, details, dim, 500)
    assert (ready.count(), failures.count(), over.first().rows) == (0, 0, 501)
    ready, failures, over = enrich.enrich(beyond, details, dim)  # no limit: looked up, and reported
    assert (ready.count(), failures.count(), over.first().rows) == (1, 501, 501)
    assert enrich.detail_worklist(added_rows(spark, [("k", "n", None, None)], "starbucks"), dim).count() == 0


def test_detail_with_another_name_is_a_failure(spark):
    work = added_rows(spark, [("1", "a", None, ["list"]), ("2", "b", " ", None), ("3", "c", None, None), ("4", "d", None, ["t"])])
    details = spark.createDataFrame(
        [("cu", "2026-W36", "1", "a", "da", []), ("cu", "2026-W36", "2", "x", "db", ["q"]),
         ("cu", "2026-W36", "4", "", None, ["own"])],
        "source_id string, week string, external_id string, name string, description string, tags array<string>")
    ready, failures = enrich.merge_details(work, details)
    assert {r.external_id: (r.description, r.tags) for r in ready.collect()} == {"1": ("da", ["list"]), "4": (None, ["own"])}
    assert {r.external_id: r.reason for r in failures.collect()} == {"2": "renamed", "3": "missing"}


def responses(spark, texts):
    rows = [("cu", "2026-W36", i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "source_id string, week string, batch bigint, response string")


def test_answers_of_every_shape(spark):
    entry = {"ref": "r0", "name": "n", "category": "c", "blurb": None, "out_of_scope": True}
    texts = [json.dumps({"items": [entry]}), json.dumps([entry, {**entry, "category": "last"}]),
             "```json\n" + json.dumps([{**entry, "ref": 0}, entry]) + "\n```",
             json.dumps([{**entry, "ref": 7}]), json.dumps({"other": []}), '"text"', "broken", None, "[]",
             json.dumps({"items": "x"}), json.dumps([1, None, entry])]
    entries, failed = curate.parse_responses(responses(spark, texts))
    got = {r.batch: (r.ref, r.category, r.out_of_scope) for r in entries.collect()}
    assert got == {0: ("r0", "c", True), 1: ("r0", "last", True), 2: ("r0", "c", True), 10: ("r0", "c", True)}
    assert {r.batch for r in failed.collect()} == {3, 4, 5, 6, 7, 8, 9}


def test_edits_are_applied_with_caution(spark):
    added = added_rows(spark, [(k, "name", None, None) for k in "abcde"])
    edits = spark.createDataFrame(
        [("2026-W36", "cu", "a", "name", "cat", "가" * 41, None), ("2026-W36", "cu", "b", "renamed", "cat", "x", True),
         ("2026-W36", "cu", "c", "name", "", "no ground", False), ("2026-W36", "cu", "d", "name", "cat", "", True)],
        schemas.EDIT)
    facts = spark.createDataFrame([("2026-W36", "cu", k, "fact", ["t"]) for k in "abd"], schemas.ENRICHED)
    got = {r.external_id: (r.category, r.blurb, r.out_of_scope) for r in curate.apply_edits(added, edits, facts).collect()}
    assert got == {"a": ("cat", "가" * 40, False), "b": ("raw", None, False), "c": ("raw", None, False),
                   "d": ("cat", None, True), "e": ("raw", None, False)}


def test_taxonomy_of_the_registry_is_sound(spark):
    problems = curate.check_taxonomy(registry.source_dim(spark), registry.taxonomy_dim(spark),
                                     registry.editor_label_dim(spark))
    assert problems.count() == 0


def test_ids_are_inherited_inside_one_source_only(spark):
    items = added_rows(spark, [("1", "a", None, None), ("2", "b", None, None)])
    earlier = spark.createDataFrame(
        [("cu", "2026-W36", "1", "old", "2026-W01"), ("orion", "2026-W36", "2", "foreign", "2026-W02")],
        "source_id string, week string, external_id string, id string, first_seen string")
    got = {r.external_id: (r.id, r.first_seen) for r in publish.carry_forward_ids(items, earlier).collect()}
    assert got == {"1": ("old", "2026-W01"), "2": ("cu--2", "2026-W36")}


def test_validation_finds_all_problems(spark):
    row = {f: "x" for f in ("id", "week", "source_id", "brand", "channel", "name", "source_url", "first_seen", "last_seen")}
    rows = [{**row, "id": "1", "week": "2026-W36"}, {**row, "id": "1", "week": "2026-W36"},
            {**row, "id": "2", "week": "2026-W35"}, {**row, "id": "3", "week": "2026-W36", "name": "", "source_url": None}]
    pub = spark.createDataFrame(rows, ", ".join(f"{f} string" for f in row))
    got = sorted((r.problem, r.id, r.detail) for r in publish.validate(pub, F.lit("2026-W36")).collect())
    assert got == [("duplicate_id", "1", "2"), ("foreign_week", "2", "2026-W35"), ("missing_field", "3", "name,source_url")]
    assert [r.problem for r in publish.validate(pub.limit(1), F.lit("W36")).collect() if r.problem == "week_format"]


def test_gone_is_absent_without_a_base_and_zero_with_one(spark):
    keys = "source_id string, week string, external_id string, name string"
    removed = spark.createDataFrame([("a", "w", "9", "z")], keys)
    base = spark.createDataFrame([("a", "w", "1", "x")], keys)
    assert report.published_then_gone(base.limit(0), removed).count() == 0
    (row,) = report.published_then_gone(base, removed).collect()
    assert (row.previous_published, row.gone) == (1, 0)


def test_gone_items_are_not_broadcast(spark):
    keys = "source_id string, week string, external_id string, name string"
    removed = spark.createDataFrame([("a", "w", "1", "z"), ("a", "w", "1", "z"), ("a", "w", "9", "z")], keys)
    base = spark.createDataFrame([("a", "w", "1", "x"), ("a", "w", "2", "y")], keys)
    counts, names = report.published_then_gone(base, removed), report.gone_names(base, removed)
    for df in (counts, names):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in counts.collect()] == [("a", "w", 2, 1)] and [r.name for r in names.collect()] == ["x"]


def test_monotonic_metric_counts_non_numbers_as_below(spark):
    kind = "source_id string, week string, alt_ids map<string,string>"
    prev = spark.createDataFrame([("cu", "w", {"gd_idx": "10"}), ("cu", "w", {"gd_idx": "x"}), ("orion", "w", {"gd_idx": "5"})], kind)
    added = spark.createDataFrame([("cu", "w", {"gd_idx": "11"}), ("cu", "w", {"gd_idx": "?"}), ("cu", "w", {})], kind)
    (row,) = report.monotonic_metric(prev, added, registry.source_dim(spark)).collect()
    assert (row.source_id, row.previous_max, row.added_above_previous_max, row.added_below_previous_max) == ("cu", 10, 1, 2)


def test_probe_verdicts(spark):
    rows = [("a", True, False)] * 10 + [("b", i < 5, False) for i in range(10)] + [("c", i < 4, False) for i in range(10)]
    rows += [("d", True, True)]
    df = spark.createDataFrame(rows, "source_id string, ok boolean, blocked boolean")
    got = {r.source_id: (r.checked, r.pass_rate, r.verdict) for r in sample.pass_rate(df).collect()}
    assert got == {"a": (10, 1.0, "ok"), "b": (10, 0.5, "ok"), "c": (10, 0.4, "broken"), "d": (0, 0.0, "unknown")}


def test_allocation_rounds_halves_to_even_and_gives_at_least_one(spark):
    sizes = spark.createDataFrame([("w", 5), ("x", 25), ("y", 75), ("z", 1), ("none", 0)], "source_id string, size bigint")
    got = {r.source_id: r.n for r in sample.allocate(sizes, 12, {"w": 9}).collect()}
    assert got == {"w": 5, "x": 2, "y": 5, "z": 1}


def test_key_order(spark):
    df = spark.createDataFrame([("s", "d1", 5), ("s", "d1", 3), ("s", "d2", 4), ("s", "d3", 9)], "s string, d string, seq bigint")
    assert [(r.d, r.low, r.previous_high) for r in sample.order_violations(df, "s", "d", "seq").collect()] == [("d2", 4, 5)]


def test_facets_count_before_filtering_and_drop_single_values(spark):
    rows = [("w", "cafe", "B1", "빵"), ("w", "mart", "B1", None), ("w", "mart", "B1", "가지")]
    pub = spark.createDataFrame(rows, "week string, channel string, brand string, category string")
    got = [(r.facet, r.label, r["count"]) for r in browse.facets(pub, registry.channel_dim(spark)).collect()]
    assert got == [("category", "가지", 1), ("category", "빵", 1), ("channel", "마트", 2), ("channel", "카페", 1)]


def test_control_rows_only_for_labelled_items(spark):
    df = spark.createDataFrame([("w", "s", "1", "n", True), ("w", "s", "2", "m", None)],
                               "week string, source_id string, external_id string, name string, __flag boolean")
    clean, control = tables.split_control(df)
    assert clean.columns == ["week", "source_id", "external_id", "name"]
    assert [(r.external_id, r.flag) for r in control.collect()] == [("1", True)]


def test_wrong_envelopes_are_rejected_whole(spark):
    bodies = ['{"list":[{"a":1},{"a":2}],"ok":"Y"}', '{"list":[{"a":3}],"ok":"N"}', '{"other":[],"ok":"Y"}', "<html>",
              '{"list":[],"ok":"Y"}', '{"list":{"a":1},"ok":"Y"}']
    df = spark.createDataFrame(list(enumerate(bodies)), "id int, body string")
    rows, rejected = extract.json_rows(df, "struct<a: int>", "$.list", "$.ok", "Y", allow_empty=False)
    assert [(r.id, r.row.a) for r in rows.collect()] == [(0, 1), (0, 2)]
    assert {r.id: r.reason for r in rejected.collect()} == {1: "failure flag", 2: "no list", 3: "not json", 4: "empty list",
                                                             5: "no list"}
    bare = spark.createDataFrame([(0, '[{"a":1}]'), (1, '{"a":1}')], "id int, body string")
    rows, rejected = extract.json_rows(bare, "struct<a: int>")
    assert (rows.count(), rejected.count()) == (1, 1)


def test_log_blocks_of_every_kind(spark):
    content = [{"type": "text", "text": " "}, {"type": "thinking", "thinking": "a\nb"}, "stray", {"type": "image"},
               {"type": "tool_use", "name": "ls", "input": {"z": 1, "a": "가"}}, {"type": "tool_use", "name": "x"},
               {"type": "tool_result", "content": [{"type": "text", "text": "p"}, {"type": "image"}, {"type": "text", "text": "q"}]},
               {"type": "tool_result", "content": "plain"}, {"type": "tool_result"}]
    df = spark.createDataFrame([(1, 0, "user", json.dumps("hi")), (1, 1, "assistant", json.dumps(content, ensure_ascii=False)),
                                (1, 2, "user", json.dumps([{"type": "tool_result", "content": "r"}])), (1, 3, "user", "7")],
                               "conv_id bigint, turn bigint, role string, content string")
    blocks = convlog.flatten_blocks(df)
    got = [(r.turn, r.kind, r.text) for r in blocks.orderBy("turn", "block").collect()]
    assert got == [(0, "text", "hi"), (1, "text", " "), (1, "thinking", "a\nb"), (1, "tool_use", 'ls({"z": 1, "a": "가"})'),
                   (1, "tool_use", "x({})"), (1, "tool_result", "pq"), (1, "tool_result", "plain"), (1, "tool_result", ""),
                   (2, "tool_result", "r")]
    assert convlog.user_turns(blocks).first().user_turns == 1
    (row,) = convlog.render_transcript(blocks).collect()
    assert row.transcript.startswith("# 세션 1\n\n## 나\n\nhi\n\n> **생각**\n> \n> a\n> b\n\n```\n▶ ls(")


def test_a_long_conversation_is_lines_in_files(spark, tmp_path):
    df = spark.range(3000).select(F.lit(7).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"),
                                  F.concat(F.lit('"turn '), F.col("id").cast("string"), F.lit('"')).alias("content"))
    other = df.filter("turn < 3").withColumn("conv_id", F.lit(8))
    blocks = convlog.flatten_blocks(df.unionByName(other))
    convlog.write_transcripts(blocks, str(tmp_path / "t"))
    lines = [r.line for r in convlog.read_transcripts(spark, str(tmp_path / "t"), 7).orderBy("turn", "block").collect()]
    whole = {r.conv_id: r.transcript for r in convlog.render_transcript(blocks).collect()}
    assert len(lines) == 3000 and "\n".join(lines) == whole[7]
    assert whole[7].startswith("# 세션 7\n\n## 나\n\nturn 0\n\n## 나") and whole[7].count("# 세션") == 1


def test_every_response_is_a_row_or_rejected(spark):
    bodies = ['{"list":[{"a":1,"b":"x"},{"a":2}]}', '{"list":[1,2]}', '{"list":["s"]}', '{"list":[{"a":1},5]}',
              '{"list":[{"a":"word"}]}', '{"list":[]}', "no json", '{"list":3}', '{"list":[{"c":1}]}', '{"list":[{"a":null}]}',
              None]
    responses = spark.createDataFrame(list(enumerate(bodies)), "id int, body string")
    rows, rejected = extract.json_rows(responses, "struct<a:bigint,b:string>", "$.list")
    assert [(r.id, r["index"], r.row.a, r.row.b) for r in rows.orderBy("id", "index").collect()] == [
        (0, 0, 1, "x"), (0, 1, 2, None), (8, 0, None, None), (9, 0, None, None)]
    assert {r.id: r.reason for r in rejected.collect()} == {
        1: "bad element", 2: "bad element", 3: "bad element", 4: "bad element", 6: "not json", 7: "no list",
        10: "not json"}


def test_json_lines_do_not_depend_on_the_columns_read(spark, tmp_path):
    (tmp_path / "lines").write_text('{"event_type":"a","n":1}\n{"event_type":5,"n":"x"}\nbad{\n{"n":2}\n')
    rows = tables.read_jsonl(spark, str(tmp_path / "lines"), "event_type string, n int")
    assert rows.count() == len(rows.collect()) == len(rows.select("event_type").collect()) == 3
    assert [(r.event_type, r.n) for r in rows.collect()] == [("a", 1), ("5", None), (None, 2)]


def test_a_doubled_detail_does_not_double_the_item(spark):
    added = spark.createDataFrame([("cu", "W", "1", "n", None, [])],
                                  "source_id string, week string, external_id string, name string, description string, "
                                  "tags array<string>")
    details = spark.createDataFrame([("cu", "W", "1", "n", d, []) for d in ("b", "a")], added.schema)
    ready, failures = enrich.merge_details(added, details)
    assert [r.description for r in ready.collect()] == ["a"] and failures.count() == 0


def test_source_weeks_do_not_go_through_the_driver(spark):
    table = meta(spark, [("a", "2026-W35", 10), ("a", "2026-W36", 2)])
    verdict = gate.check_volume(table, diff.lookback(table))
    assert "Broadcast" not in verdict._jdf.queryExecution().executedPlan().toString()
    assert {(r.week, r.verdict) for r in verdict.collect()} == {("2026-W35", "ok"), ("2026-W36", "drop")}


def times_parsed(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("parseJson")


def test_a_response_is_parsed_once(spark):
    responses = spark.createDataFrame([(1, '{"list":[{"a":1}]}')], "id int, body string")
    rows, rejected = extract.json_rows(responses, "struct<a:bigint>", "$.list", "$.ok", "Y")
    assert times_parsed(rows) == times_parsed(rejected) == 1


def test_an_answer_is_parsed_once(spark):
    answers = spark.createDataFrame([("s", "w", 0, '{"items":[{"ref":"r0","name":"a"}]}')],
                                    "source_id string, week string, batch bigint, response string")
    entries, failed = curate.parse_responses(answers)
    assert times_parsed(entries) == times_parsed(failed) == 1
