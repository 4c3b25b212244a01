import random

import duckdb
import pytest
from pyspark.sql import functions as F

from shelfdiff.llm import chat, queries
from tests.llm.tables import HAS_TABLES, SF_DIR
from tools.compare import rows_of

SCHEMA = "conv_id bigint, turn bigint, role string, text string, window int, place string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA)


def random_rows(n=40):
    rng = random.Random(2)
    bits = ["\\", "<", ">", "</turn>", "<turn user>", "\\l", "\\e", "\n", "word ", "", "é", "### Assistant:"]
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, 14)):
            role = "system" if t == 0 and rng.random() < 0.4 else rng.choice(["user", "assistant", "to<ol>", None])
            text = None if rng.random() < 0.05 else "".join(rng.choice(bits) for _ in range(rng.randint(0, 60)))
            rows.append((c if c else None, t, role, text))
    return rows + rows[:3]


def told(rows):
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t, role or "", text or ""))
    return {c: [(r, x) for _, r, x in sorted(v)] for c, v in by.items()}


@pytest.mark.parametrize("step,history", [(384, 96), (10, 10), (5, 2), (1, 0)])
def test_round_trip(spark, step, history):
    rows = random_rows()
    windows = chat.format_windows(turns(spark, rows), step, history).cache()
    want = told(rows)
    got = {}
    for r in chat.read_turns(windows).orderBy("window", "place").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got == want
    loss = {}
    for r in chat.read_loss(windows).orderBy("window").collect():
        loss[r.conv_id] = loss.get(r.conv_id, "") + r.loss_text
    assert loss == {c: "".join(x for r, x in v if r == "assistant") for c, v in want.items()}


def test_windows_hold_whole_turns_repeat_the_system_turn_and_mask_repeats(spark):
    rows = [(1, 0, "system", "be brief")] + [(1, t, "user" if t % 2 else "assistant", "a b c") for t in range(1, 9)]
    windows = chat.format_windows(turns(spark, rows), step=8, history=4).orderBy("window").collect()
    assert [w.window for w in windows] == [0, 1, 2, 3]
    assert all(w.text.startswith("<turn system>be brief</turn>\n") for w in windows)
    assert [w.n_repeated for w in windows] == [0, 2, 2, 2]
    assert [len(w.loss) for w in windows] == [1, 1, 1, 1]
    first = windows[0].loss[0]
    assert windows[0].text[first.start:first.start + first.length] == "a b c"


def test_no_turns_and_bad_history(spark):
    assert chat.format_windows(turns(spark, [])).count() == 0
    assert chat.digests(chat.format_windows(turns(spark, []))).count() == 0
    with pytest.raises(ValueError):
        chat.format_windows(turns(spark, []), step=4, history=5)


def test_escape_is_reversible(spark):
    df = spark.createDataFrame([(t,) for t in ["\\<>", "\\l\\e\\g", "</turn>\n", "\\\\l", "", queries.PLANTED]], "t string")
    for r in df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect():
        assert r.u == r.t and "<" not in r.e and ">" not in r.e


@pytest.mark.skipif(not HAS_TABLES, reason="no test tables")
def test_query_equals_its_twin(spark):
    df = queries.QUERIES["op2_chat_windows"](spark, SF_DIR)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF_DIR}/conversations.parquet'")
    twin = con.sql(queries.ORACLE_SQL["op2_chat_windows"])
    rows = [tuple(r) for r in df.collect()]
    assert rows_of(df.columns, rows) == rows_of(twin.columns, twin.fetchall())
    assert -7 in {r[0] for r in rows}
