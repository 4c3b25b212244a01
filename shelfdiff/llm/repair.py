"""Conversation structure repair: faults of turns, cheapest edits by a run-length min-plus DP, repaired turns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfdiff.session import cut_lineage

#: White space, ends of sentences, the roles of edits, the costs of the contract.
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
USER, ASSISTANT = "user", "assistant"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

#: States of a repaired conversation: nothing yet, a system turn, a user turn, an assistant turn last. A symbol is the
#: role's initial (s, u, a, another) and whether the turn is truncated, or a turn that must go.
START, SYSTEM, ASKED, ANSWERED = range(4)
GONE = 8
_INF = 1 << 60
_NEXT = {START: ASKED, SYSTEM: ASKED, ASKED: ANSWERED, ANSWERED: ASKED}
#: What it costs to end in a state: a user turn wants an answer, a system turn both.
CLOSE = (0, 2 * INSERT, INSERT, 0)


def damage(turns: DataFrame) -> DataFrame:
    """``turns`` with a fault in about a quarter of them, chosen by crc32 of ``conv_id:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 takes the ends of sentences out of it, 3 repeats the row, 4 makes it the
    user's. Null roles and texts, and nulls in the key, are one space. Returns conv_id, turn, role, text and ``times``
    (how often the row stands), without dropped rows. An empty table stays empty.
    """
    def spelled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spelled("conv_id"), F.lit(":"), spelled("turn"))) % 20
    text = (F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(spelled("text"), "[.!?]", ""))
            .otherwise(spelled("text")))
    return (turns.filter(kind != 0)
            .select("conv_id", "turn", F.when(kind == 4, F.lit(USER)).otherwise(spelled("role")).alias("role"),
                    text.alias("text"), F.when(kind == 3, 2).otherwise(1).alias("times")))


def _marks(turns: DataFrame) -> DataFrame:
    """Rows with the names their turns are joined by: ``conv``, ``mark`` (conversation and turn), ``said`` (role and text)."""
    def spelled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("null"))
    return turns.withColumns({
        "conv": spelled("conv_id"), "mark": F.concat(spelled("conv_id"), F.lit(":"), spelled("turn")),
        "said": F.unhex(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256))})


def faults(turns: DataFrame) -> DataFrame:
    """One row for equal rows of a turn: conv_id, turn, conv, mark, said, role, n, blank, again, cut.

    ``again`` tells that an earlier turn has the same role and text, ``blank`` and ``cut`` (no end of a sentence)
    look at the text. All but the first of the n equal rows repeat it. Texts themselves stay behind. A text that very
    many turns have is counted before it is joined.
    """
    solid = F.rtrim("text", F.lit(BLANKS))
    rows = _marks(turns).select("conv_id", "turn", "conv", "mark", "said", "role", "times",
                                (solid == "").alias("blank"),
                                (~F.substring(solid, -1, 1).isin(list(ENDS))).alias("cut"))
    rows = rows.groupBy("conv_id", "turn", "conv", "mark", "said", "role", "blank", "cut").agg(
        F.sum("times").cast("bigint").alias("n"))
    rows = cut_lineage(rows)
    first = (rows.groupBy("conv", "said").agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("turns"))
             .filter("turns > 1").drop("turns"))
    return (rows.join(first, ["conv", "said"], "left")
            .withColumn("again", F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn")))
            .drop("first"))


@lru_cache(maxsize=None)
def step(symbol: int) -> tuple:
    """Cost of a row from state to state: inserted turns before it, then it is kept, given a new role or deleted."""
    closed = [[0 if p == q else _INF for q in range(4)] for p in range(4)]
    for p in range(4):
        q, cost = p, 0
        for _ in range(2):
            q, cost = _NEXT[q], cost + INSERT
            closed[p][q] = min(closed[p][q], cost)
    own = [[_INF] * 4 for _ in range(4)]
    for p in range(4):
        own[p][p] = DELETE
        for q, cost in _taken(symbol, p):
            own[p][q] = min(own[p][q], cost)
    return times(tuple(map(tuple, closed)), tuple(map(tuple, own)))


def _taken(symbol: int, state: int) -> list[tuple[int, int]]:
    """(state behind, cost) of keeping a row and of giving it a new role, where that is allowed."""
    if symbol == GONE:
        return []
    extra = TRUNCATED if symbol & 1 else 0
    kept = {0: SYSTEM if state == START else None, 1: ASKED if state != ASKED else None,
            2: ANSWERED if state == ASKED else None, 3: None}[symbol >> 1]
    return [*([(kept, extra)] if kept is not None else []), (_NEXT[state], REROLE + extra)]


def times(a: tuple, b: tuple) -> tuple:
    """Min-plus product of two tables of costs."""
    return tuple(tuple(min(a[p][k] + b[k][q] for k in range(4)) for q in range(4)) for p in range(4))


def ahead(a: tuple, costs: tuple) -> tuple:
    """Costs to the end from before a table of costs, given those from behind it."""
    return tuple(min(a[p][k] + costs[k] for k in range(4)) for p in range(4))


@lru_cache(maxsize=None)
def power(symbol: int, k: int) -> tuple:
    """Costs of 2^k rows with one symbol."""
    return step(symbol) if k == 0 else times(power(symbol, k - 1), power(symbol, k - 1))


def run_ahead(symbol: int, n: int, costs: tuple) -> tuple:
    """``ahead`` over a run of ``n`` rows with one symbol, by the binary powers of its table."""
    k = 0
    while n:
        if n & 1:
            costs = ahead(power(symbol, k), costs)
        n >>= 1
        k += 1
    return costs


def run_lengths(items: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(symbol, rows) without equal neighbours."""
    out: list[tuple[int, int]] = []
    for symbol, n in items:
        if out and out[-1][0] == symbol:
            out[-1] = (symbol, out[-1][1] + n)
        elif n:
            out.append((symbol, n))
    return out


def table_of(runs: list[tuple[int, int]]) -> tuple:
    """Costs from state to state over all runs."""
    columns = []
    for q in range(4):
        costs = tuple(0 if p == q else _INF for p in range(4))
        for symbol, n in reversed(runs):
            costs = run_ahead(symbol, n, costs)
        columns.append(tuple(min(c, _INF) for c in costs))
    return tuple(zip(*columns))


@lru_cache(maxsize=1 << 16)
def _choose(symbol: int, state: int, after: tuple) -> tuple[str, int]:
    """Letters of the cheapest edits of one row, of these the ASCII-least, and the state behind it."""
    before, letters = ahead(step(symbol), after), ""
    while True:
        if DELETE + after[state] == before[state]:
            return letters + "D", state
        if INSERT + before[_NEXT[state]] == before[state]:
            letters, state = letters + "I", _NEXT[state]
            continue
        options = _taken(symbol, state)
        for letter, (behind, cost) in zip("KR"[-len(options):], options):
            if cost + after[behind] == before[state]:
                return letters + letter, behind
        raise AssertionError("no edit leads on")


def _level(costs: tuple) -> tuple:
    low = min(costs)
    return tuple(c - low for c in costs)


def unroll(runs: list[tuple[int, int]], state: int, end: tuple) -> Iterator[tuple[str, int]]:
    """Letters of every row and the state behind it, given the costs behind the last one.

    Costs between runs come from the powers; inside a run they are halved down to single rows, so no table of all
    rows is held.
    """
    costs = [_level(end)]
    for symbol, n in reversed(runs):
        costs.append(_level(run_ahead(symbol, n, costs[-1])))
    for (symbol, n), after in zip(runs, reversed(costs[:-1])):
        todo = [(n, after)]
        while todo:
            n, after = todo.pop()
            if symbol == GONE:
                for _ in range(n):
                    yield "D", state
            elif n == 1:
                letters, state = _choose(symbol, state, after)
                yield letters, state
            else:
                half = n // 2
                todo.append((n - half, after))
                todo.append((half, _level(run_ahead(symbol, n - half, after))))


def closing(state: int) -> str:
    """Inserts that end a conversation: as many as the state asks for."""
    return "I" * (CLOSE[state] // INSERT)


def _symbol(role: str, blank: bool, again: bool, cut: bool) -> int:
    if blank or again:
        return GONE
    return 2 * {"s": 0, "u": 1, "a": 2}.get(role[:1], 3) + (1 if cut else 0)


def _pieces(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[str, list[tuple]]]:
    """Rows of sorted batches by conversation: (conv, rows)."""
    name, rows = None, []
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in columns]):
            if row[0] != name:
                if rows:
                    yield name, rows
                name, rows = row[0], []
            rows.append(row)
    if rows:
        yield name, rows


_ROW = ["conv", "piece", "role", "blank", "again", "cut", "n"]


def _runs(rows: list[tuple]) -> list[tuple[int, int]]:
    return run_lengths([item for _, _, role, blank, again, cut, n, *_ in rows
                        for item in ((_symbol(role, blank, again, cut), 1), (GONE, n - 1))])


def _plan(ranged: DataFrame) -> dict[tuple[str, int], tuple]:
    """(state before, costs behind, role initial before, whether the last) of pieces of conversations that a range boundary cuts.

    A partition has two such pieces at most, its first and its last, so what comes to the driver grows with the
    number of partitions and not with the rows.
    """
    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for name, rows in _pieces(batches, _ROW):
            last = (name, rows)
            first = first or last
        out = [first, last] if first is not last else [first]
        out = [(n, r[0][1], table_of(_runs(r)), r[0][2][:1], r[-1][2][:1]) for n, r in filter(None, out)]
        yield pa.RecordBatch.from_pydict({
            "conv": [o[0] for o in out], "piece": [o[1] for o in out], "costs": [sum(o[2], ()) for o in out],
            "head": [o[3] for o in out], "tail": [o[4] for o in out]}, schema=pa.schema(
            [("conv", pa.string()), ("piece", pa.int32()), ("costs", pa.list_(pa.int64())), ("head", pa.string()),
             ("tail", pa.string())]))
    found = sorted(ranged.select(*_ROW).mapInArrow(
        edges, "conv string, piece int, costs array<bigint>, head string, tail string").collect(),
        key=lambda r: (r.conv, r.piece))
    cut: dict[str, list] = {}
    for r in found:
        cut.setdefault(r.conv, []).append(r)
    cut = {name: pieces for name, pieces in cut.items() if len(pieces) > 1}
    if not cut:
        return {}
    behind = {}
    for name, pieces in cut.items():
        costs = CLOSE
        for r in reversed(pieces):
            behind[name, r.piece] = costs
            table = tuple(tuple(r.costs[4 * p:4 * p + 4]) for p in range(4))
            costs = _level(ahead(table, costs))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for name, rows in _pieces(batches, _ROW):
            if (name, rows[0][1]) in behind:
                runs = [r for r in _runs(rows) if r[0] != GONE]
                states = []
                for state in range(4):
                    for _, state in unroll(runs, state, behind[name, rows[0][1]]):
                        pass
                    states.append(state)
                out.append((name, rows[0][1], states))
        yield pa.RecordBatch.from_pydict({"conv": [o[0] for o in out], "piece": [o[1] for o in out],
                                          "ends": [o[2] for o in out]}, schema=pa.schema(
            [("conv", pa.string()), ("piece", pa.int32()), ("ends", pa.list_(pa.int32()))]))
    reached = {(r.conv, r.piece): r.ends for r in ranged.select(*_ROW).mapInArrow(
        ends, "conv string, piece int, ends array<int>").collect()}
    plan = {}
    for name, pieces in cut.items():
        state, before = START, None
        for r in pieces:
            plan[name, r.piece] = (state, behind[name, r.piece], before, r is pieces[-1])
            state, before = reached[name, r.piece][state], r.tail
    return plan


def edits(turns: DataFrame) -> DataFrame:
    """The cheapest edits of every conversation, a row for equal rows of a turn.

    ``turns`` has conv_id, turn, role, text (not null) and times. Returns conv_id, turn, mark, said, ``pos`` (order),
    ``letters`` (I for turns inserted before the first of the rows; K, R or D for itself), ``more`` (rows behind it that
    repeat it, all deleted), ``tail`` (I for turns inserted at the end of the conversation), ``cost``, and the counts
    blank, duplicate, truncated and illegal.

    Rows are sorted by ranges of (conv_id, turn), so a conversation of any length is shared out; its pieces meet by
    their min-plus tables. Inside a turn rows stand by role and by the SHA-256 of role and text. Of edits that cost the
    same the ASCII-least letters win. A null conv_id is a conversation, null turns come first.
    """
    order = ["conv_id", "turn", "role", "said"]
    ranged = cut_lineage(faults(turns).repartitionByRange("conv_id", "turn").sortWithinPartitions(*order)
                         .withColumns({"piece": F.spark_partition_id(), "pos": F.monotonically_increasing_id()}))
    plan = _plan(ranged)
    columns = [*_ROW, "pos"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for name, group in _pieces(batches, columns):
            rows += _edited(group, *plan.get((name, group[0][1]), (START, CLOSE, None, True)))
            if len(rows) > 10_000:
                yield _batch(rows)
                rows = []
        yield _batch(rows)
    found = ranged.select(*columns).mapInArrow(run, ", ".join(f"{n} {k}" for n, k in _EDIT))
    return ranged.select("conv_id", "turn", "mark", "said", "pos").join(found, "pos")


_EDIT = (("pos", "bigint"), ("letters", "string"), ("more", "bigint"), ("tail", "string"), ("cost", "bigint"),
         ("blank", "bigint"), ("duplicate", "bigint"), ("truncated", "bigint"), ("illegal", "bigint"))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(_EDIT)],
                                      names=[n for n, _ in _EDIT])


def _edited(group: list[tuple], state: int, end: tuple, before: str | None, last: bool) -> list[tuple]:
    found = unroll([r for r in _runs(group) if r[0] != GONE], state, end)
    out = []
    for _, _, role, blank, again, cut, n, pos in group:
        letters = "D"
        if not blank and not again:
            letters, state = next(found)
        cost = sum({"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}[c] for c in letters) + DELETE * (n - 1)
        cost += TRUNCATED if cut and letters[-1] in "KR" else 0
        initial = role[:1]
        # equal rows in a row never are a question and its answer
        illegal = (before is not None and before + initial not in ("su", "ua", "au")) + n - 1
        before = initial
        out.append([pos, letters, n - 1, "", cost, n if blank else 0, 0 if blank else n - 1 + again,
                    int(cut and not blank and not again), illegal])
    if last:
        out[-1][3] = closing(state)
        out[-1][4] += CLOSE[state]
    return [tuple(r) for r in out]


def repaired(turns: DataFrame, edited: DataFrame) -> DataFrame:
    """Conversations after ``edited`` edits, in order inside partitions: conv_id, edit, times, role, text.

    A deleted row has no role and text and stands ``times`` times; an inserted turn has the empty text. A partition
    holds whole conversations, sorted by Spark and streamed: only one row is in memory at a time.
    """
    texts = _marks(turns).select("mark", "said", F.col("role").alias("own"), "text")
    rows = (edited.select("conv_id", "pos", "mark", "said", "letters", "more", "tail").join(texts, ["mark", "said"])
            .select("conv_id", "pos", "letters", "more", "tail", "own", F.when(F.col("letters").endswith("D"), F.lit(None))
                    .otherwise(F.col("text")).alias("text")))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "pos")
    schema = pa.schema([("conv_id", pa.int64()), ("edit", pa.string()), ("times", pa.int64()), ("role", pa.string()),
                        ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, name, state = None, None, START
        for batch in batches:
            out = []
            for conv, pos, letters, more, tail, own, text in zip(*[c.to_pylist() for c in batch.columns]):
                if pos == seen:  # equal rows of a turn have one edit
                    continue
                if seen is None or conv != name:
                    name, state = conv, START
                seen = pos
                for letter in letters + "D" * (more > 0) + tail:
                    if letter == "D":
                        continue
                    if letter == "K":
                        state = {"s": SYSTEM, "u": ASKED, "a": ANSWERED}[own[0]]
                        out.append((conv, letter, 1, own, text))
                        continue
                    state = _NEXT[state]
                    role = USER if state == ASKED else ASSISTANT
                    out.append((conv, letter, 1, role, text if letter == "R" else ""))
                    # what is deleted stands before what is inserted at the end
                deleted = (letters[-1] == "D") + more
                if deleted:
                    out.insert(len(out) - len(tail), (conv, "D", deleted, None, None))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)],
                                             schema=schema)
    return rows.mapInArrow(run, "conv_id bigint, edit string, times bigint, role string, text string")


def digests(turns: DataFrame, original: DataFrame) -> DataFrame:
    """One row for every conv_id of ``original``: what is wrong with its rows in ``turns``, and the repair.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit (letters of all edits), repaired_sha256 (of the
    repaired ``role:text`` lines). A conversation without rows has zeros, an empty audit and the hash of the empty
    string. The hash reads a conversation's turns one after the other; nothing but the audit is held.
    """
    edited = cut_lineage(edits(turns))
    counts = edited.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")])
    schema = pa.schema([("c", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, audit, digest, lines = False, [], hashlib.sha256(), 0
        name = None
        for batch in batches:
            out = []
            for conv, edit, n, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if not open_ or conv != name:
                    if open_:
                        out.append((name, "".join(audit), digest.hexdigest()))
                    open_, name, audit, digest, lines = True, conv, [], hashlib.sha256(), 0
                audit.append(edit * n)
                if edit != "D":
                    digest.update((("\n" if lines else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
                    lines += 1
            yield _rows(out, schema)
        yield _rows([(name, "".join(audit), digest.hexdigest())] if open_ else [], schema)
    told = repaired(turns, edited).mapInArrow(run, "c bigint, audit string, repaired_sha256 string")
    every = original.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    met = (every.join(counts.withColumnRenamed("conv_id", "k"), F.col("conv_id").eqNullSafe(F.col("k")), "left")
           .join(told, F.col("conv_id").eqNullSafe(F.col("c")), "left"))
    zero = F.lit(0).cast("bigint")
    return met.select("conv_id", *[F.coalesce(c, zero).alias(c) for c in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost")], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)
