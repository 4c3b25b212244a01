import hashlib
import random
import sys
import zlib
from functools import lru_cache

import pytest

from shelfdiff.llm import queries, repair
from tests.llm.tables import HAS_TABLES, SF_DIR

SCHEMA = "conv_id bigint, turn bigint, role string, text string, piece int, pos string, n string"
sys.setrecursionlimit(20_000)
BLANK = " \t\n\x0b\x0c\r"


def table(spark, rows):
    return spark.createDataFrame([(*r, 0, "p", "n") for r in rows], SCHEMA)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(symbols):
    """(cost, letters) by looking at every way: symbols are (initial, must go, truncated)."""
    @lru_cache(maxsize=None)
    def best(i, state, room):
        options = []
        if i == len(symbols) and state in ("", "a"):
            options.append((0, ""))
        turn = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
        if room:
            cost, letters = best(i, turn, room - 1)
            options.append((cost + 3, "I" + letters))
        if i < len(symbols):
            initial, gone, cut = symbols[i]
            cost, letters = best(i + 1, state, 2)
            options.append((cost + 4, "D" + letters))
            if not gone:
                if initial == turn or (initial == "s" and state == ""):
                    cost, letters = best(i + 1, initial, 2)
                    options.append((cost + 3 * cut, "K" + letters))
                cost, letters = best(i + 1, turn, 2)
                options.append((cost + 3 + 3 * cut, "R" + letters))
        return min(options, default=(10 ** 9, ""))
    return best(0, "", 2)


def brute(rows):
    out = {}
    hurt = damaged(rows)
    for conv in {r[0] for r in rows}:
        own = [r for r in hurt if r[0] == conv]
        own.sort(key=lambda r: ((r[1] is not None, r[1] or 0), r[2], hashlib.sha256(
            f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, symbols, counts = set(), [], [0, 0, 0]
        for _, _, role, text in own:
            solid = text.strip(BLANK)
            fault = 0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else None
            if fault is not None:
                counts[fault] += 1
            seen.add((role, text))
            symbols.append((role[:1], fault in (0, 1), fault == 2))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(symbols, symbols[1:]))
        cost, letters = cheapest(tuple(symbols))
        state, lines, left = "", [], list(own)
        for c in letters:
            turn = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
            _, _, role, text = (None, None, None, "") if c == "I" else left.pop(0)
            if c == "D":
                continue
            state = role[0] if c == "K" else turn
            lines.append(f"{role if c == 'K' else {'u': 'user', 'a': 'assistant'}[turn]}:{text}")
        out[conv] = (gaps, *counts, illegal, cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def random_rows(conversations=120, longest=14, seed=3):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        for t in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "assistant", "user", "system", "tool", "", None])
            text = rng.choice(["Yes.", "Yes.", "no end", "", " \n", "Why?", "a. b", None, f"text {t}.", "é!", "x." * 50])
            rows.append((None if c == 5 else c, None if rng.random() < 0.05 else t + 3 * (rng.random() < 0.1), role, text))
    return rows + rows[:5]


def told(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
            for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_digests_equal_brute_force(spark, seed):
    rows = random_rows(seed=seed)
    turns = table(spark, rows)
    assert told(repair.digests(repair.damage(turns), turns)) == brute(rows)


def test_pieces_of_long_conversations_meet(spark):
    rows = [r for r in random_rows(3, 400, seed=9)] + [(7, t, "user", f"t {t}.") for t in range(900)]
    turns = table(spark, rows)
    assert told(repair.digests(repair.damage(turns), turns)) == brute(rows)


def test_damage_equals_its_rule(spark):
    rows = random_rows()
    found = [(r.conv_id, r.turn, r.role, r.text) for r in repair.damage(table(spark, rows)).collect() for _ in range(r.times)]
    assert sorted(map(repr, found)) == sorted(map(repr, damaged(rows)))


def test_powers_equal_single_steps():
    for symbol in range(9):
        costs = repair.CLOSE
        for n in range(1, 40):
            costs = repair.ahead(repair.step(symbol), costs)
            assert repair.run_ahead(symbol, n, repair.CLOSE) == costs


def test_unroll_of_random_runs_is_cheapest():
    rng = random.Random(4)
    for _ in range(400):
        symbols = [rng.randrange(9) for _ in range(rng.randint(0, 12)) for _ in range(rng.choice([1, 1, 5]))]
        runs = repair.run_lengths([(s, 1) for s in symbols])
        state, letters = repair.START, ""
        for found, state in repair.unroll(runs, state, repair.CLOSE):
            letters += found
        letters += repair.closing(state)
        plain = tuple(("suax?"[s >> 1], s == 8, s % 2 == 1) for s in symbols)
        assert cheapest(plain)[1] == letters


def test_repaired_rows_are_a_dialogue(spark):
    turns = repair.damage(table(spark, random_rows()))
    rows = repair.repaired(turns, repair.edits(turns)).collect()
    by = {}
    for r in rows:
        if r.edit != "D":
            by.setdefault(r.conv_id, []).append(r.role[0])
    for initials in by.values():
        said = "".join(initials)
        assert said[said.startswith("s"):] == "ua" * (len(said) // 2)


def test_empty_table_and_dropped_conversation(spark):
    none = table(spark, [])
    assert repair.digests(repair.damage(none), none).count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    turns = table(spark, [(gone, 0, "user", "Hi.")])
    assert told(repair.digests(repair.damage(turns), turns)) == {
        gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


@pytest.mark.skipif(not HAS_TABLES, reason="tables not given")
def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert told(queries.op11_min_plus_repair(spark, SF_DIR)) == brute(rows)
