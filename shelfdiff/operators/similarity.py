"""Undecided pairs: leftovers of both sides whose names are nearly the same.

These are never merged or split by themselves; they go to review.
"""

from __future__ import annotations

import heapq
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfdiff import fixed_values as fixed
from shelfdiff.functions import text
from shelfdiff.operators.components import connected_components
from shelfdiff.operators.ordering import number_in_group
from shelfdiff.session import by_shuffle, cut_lineage, kept_table

PAIR = ["source_id", "week"]


def pair_limit(left_cur: DataFrame, left_prev: DataFrame,
               limit: int = fixed.PAIR_LIMIT) -> DataFrame:
    """Leftover pairs per source-week, and whether they are more than ``limit``: a report.

    Counted before categories are looked at: too many leftovers mean that the layers above
    failed, not that there is much to review. Names are compared all the same, unless a caller
    passes the limit on.
    """
    sides = (left_cur.select(*PAIR, F.lit(1).alias("c"), F.lit(0).alias("p"))
             .unionByName(left_prev.select(*PAIR, F.lit(0).alias("c"), F.lit(1).alias("p"))))
    counts = sides.groupBy(*PAIR).agg(F.sum("c").alias("n_cur"), F.sum("p").alias("n_prev"))
    pairs = F.col("n_cur").cast("decimal(19,0)") * F.col("n_prev").cast("decimal(19,0)")
    return counts.withColumn("skipped", pairs > F.lit(limit))


def _slack(total: Column, threshold: float) -> Column:
    """Characters that may stay unmatched for a ratio of at least ``threshold``."""
    return F.floor(F.lit(1.0 - threshold) * total + F.lit(1e-9)).cast("int")


def _lengths(names: DataFrame) -> DataFrame:
    return names.groupBy(*PAIR, "cat").agg(F.collect_set(F.length("name")).alias("lengths"))


def _fits(m: Column, threshold: float) -> Column:
    """Whether a name of length ``m`` may be similar enough to ``name``."""
    n = F.length("name")
    return ((m >= F.ceil(n * threshold / (2.0 - threshold) - F.lit(1e-9)))
            & (m <= F.floor(n * (2.0 - threshold) / threshold + F.lit(1e-9))))


def _partner_lengths(names: DataFrame, others: DataFrame, threshold: float) -> DataFrame:
    """A row for every name and every length of a name of ``others`` in its category that may be similar enough.

    The rows are few and small but become many, so they are dealt to all tasks, whatever their size suggests.
    """
    fits = F.filter("lengths", lambda m: _fits(m, threshold))
    tasks = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (names.join(by_shuffle(_lengths(others)), [*PAIR, "cat"]).withColumn("other", F.explode(fits)).drop("lengths")
            .repartition(tasks, "name", "other"))


def _pieces(pairs: DataFrame, cur: Column, prev: Column, threshold: float) -> DataFrame:
    """A row for each piece of previous names of length ``prev`` against current ones of length ``cur``.

    Names are cut into one piece more than characters of both may stay unmatched. Each such character spoils one piece:
    its own, or that of the last matched character before it. Take the first piece up to whose end there are no more
    spoilers than pieces before it: it has none itself, and exactly as many lie before it as its number ``i`` says. So
    two names that are similar enough share a whole piece whose shift is at most ``i``, odd or even as ``i`` is, and
    the rest of the difference in length is left to the ``slack - i`` spoilers behind it.
    """
    slack = _slack(cur + prev, threshold)
    count, i = slack + 1, F.col("i")
    base, longer = F.floor(prev / count).cast("int"), (prev % count).cast("int")
    # the last `longer` pieces are one character longer
    return (pairs.withColumn("slack", slack).withColumn("i", F.explode(F.sequence(F.lit(0), slack)))
            .withColumn("at", i * base + F.greatest(F.lit(0), i - (count - longer)))
            .withColumn("size", base + (i >= count - longer).cast("int")))


def _shifted_pieces(name: Column, prev: Column) -> Column:
    """The texts of a current name that may be the piece of a row of ``_pieces``, each once."""
    at, size, i = F.col("at"), F.col("size"), F.col("i")
    shifts = F.filter(F.sequence(-i, i, F.lit(2)), lambda s: (
        F.abs(F.length(name) - prev - s) <= F.col("slack") - i) & (at + s >= 0) & (at + s + size <= F.length(name)))
    return F.array_distinct(F.transform(shifts, lambda s: F.substr(name, at + s + 1, size)))


def _character_bits(name: Column) -> Column:
    """64 bits of the characters of a name, the second and further ones of a kind apart.

    Every character without a partner changes at most one bit, so two names differ in no more bits than they have
    unmatched characters.
    """
    def bit(i: Column) -> Column:
        ch, head = F.substr(name, i, F.lit(1)), F.substr(name, F.lit(1), i)
        nth = F.length(head) - F.length(F.replace(head, ch, F.lit("")))
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(ch, nth), F.lit(64)).cast("int"))
    places = F.when(F.length(name) > 0, F.sequence(F.lit(1), F.length(name))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(F.transform(places, bit), F.lit(0).cast("bigint"), lambda acc, b: acc.bitwiseOR(b))


def _shared_characters(a: Column, b: Column) -> Column:
    """Size of the multiset intersection of characters, an upper bound of matched ones."""
    chars = F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(a), F.lit(1))), lambda i: F.substr(a, i, F.lit(1))))

    def times(s: Column, ch: Column) -> Column:
        return F.length(s) - F.length(F.replace(s, ch, F.lit("")))

    return F.aggregate(chars, F.lit(0), lambda acc, ch: acc + F.when(
        ch == "", F.lit(0)).otherwise(F.least(times(a, ch), times(b, ch))))


def _leftovers(left_cur: DataFrame, left_prev: DataFrame,
               limit: int | None) -> tuple[DataFrame, DataFrame]:
    """Both sides as (pair, cat, pos, name), without source-weeks over a limit."""
    def slim(side: DataFrame) -> DataFrame:
        if limit is not None:
            over = pair_limit(left_cur, left_prev, limit).filter("skipped").select(*PAIR)
            side = side.join(over, PAIR, "left_anti")
        return side.select(
            *PAIR, F.coalesce(F.concat(F.lit("="), "category_raw"), F.lit("")).alias("cat"),
            "pos", text.normalize_name(F.col("name")).alias("name"))
    return slim(left_cur), slim(left_prev)


def _within_reach(rows: DataFrame, others: DataFrame, threshold: float) -> DataFrame:
    """Rows with a name of a fitting length on the other side, in their category: no other row can be in a pair."""
    return (rows.join(by_shuffle(_lengths(others)), [*PAIR, "cat"])
            .filter(F.exists("lengths", lambda m: _fits(m, threshold))).drop("lengths"))


def _comparable(left_cur: DataFrame, left_prev: DataFrame, threshold: float,
                limit: int | None) -> tuple[DataFrame, DataFrame]:
    """The leftovers of both sides that any name of the other side may be similar enough to, each derived once."""
    cur, prev = (kept_table(side, "leftovers") for side in _leftovers(left_cur, left_prev, limit))
    return (cut_lineage(_within_reach(cur, prev, threshold).select(*cur.columns)),
            cut_lineage(_within_reach(prev, cur, threshold).select(*prev.columns)))


def name_pairs(cur: DataFrame, prev: DataFrame, threshold: float) -> DataFrame:
    """Pairs of different names (pair, cat, cur_name, prev_name, similarity) that are close enough.

    Each name of a category is compared once, however many rows bear it. Names meet on shared pieces, an exact filter
    (nothing similar enough is missed); the join key holds both lengths and the place of the piece, so a syllable
    that is everywhere does not bring everything together, and only lengths that occur are looked for. Native bounds
    on characters thin the pairs out before they are compared and before the ratio is computed in Arrow batches.
    """
    if threshold <= 2 / 3:
        raise ValueError("pieces need a threshold above 2/3")
    names = [*PAIR, "cat", "name"]
    # the bits are computed here, once a name: further down there is a row for each piece
    c, p = (cut_lineage(side.select(*names).distinct().withColumn("bits", _character_bits(F.col("name")))) for side in (cur, prev))
    n, m = F.length("name"), F.col("other")
    key = [*PAIR, "cat", "cur_length", "prev_length", "i", "piece"]
    theirs = (_pieces(_partner_lengths(p, c, threshold), m, n, threshold)
              .select(*PAIR, "cat", m.alias("cur_length"), n.alias("prev_length"), "i",
                      F.substr("name", F.col("at") + 1, F.col("size")).alias("piece"),
                      F.col("name").alias("prev_name"), F.col("bits").alias("prev_bits")))
    ours = (_pieces(_partner_lengths(c, p, threshold), n, m, threshold)
            .select(*PAIR, "cat", n.alias("cur_length"), m.alias("prev_length"), "i",
                    F.explode(_shifted_pieces(F.col("name"), m)).alias("piece"),
                    F.col("name").alias("cur_name"), F.col("bits").alias("cur_bits")))
    slack = _slack(F.col("cur_length") + F.col("prev_length"), threshold)
    total = F.length("cur_name") + F.length("prev_name")
    needed = total - _slack(total, threshold)
    # one condition in this order: as filters of their own, Spark would count characters of all that meet, before the bits
    thin = (F.col("cur_name") != F.col("prev_name")) & (F.bit_count(F.col("cur_bits").bitwiseXOR(F.col("prev_bits"))) <= slack)
    close = (ours.join(by_shuffle(theirs), key)
             .filter(F.when(thin, 2 * _shared_characters(F.col("cur_name"), F.col("prev_name")) >= needed).otherwise(F.lit(False)))
             .select(*PAIR, "cat", "cur_name", "prev_name").distinct())
    return (close.withColumn("similarity", text.similarity(F.col("cur_name"), F.col("prev_name")))
            .filter(F.col("similarity") >= threshold))


def candidates(left_cur: DataFrame, left_prev: DataFrame,
               threshold: float = fixed.SIMILARITY_THRESHOLD,
               limit: int | None = None) -> DataFrame:
    """Pairs of leftover rows in the same category with a name ratio of at least ``threshold``.

    For looking at: every row of a name is paired with every row of a close one. ``review`` works
    on names and never makes these pairs.
    """
    cur, prev = _comparable(left_cur, left_prev, threshold, limit)
    close = cut_lineage(name_pairs(cur, prev, threshold))
    cur = cur.withColumnRenamed("name", "cur_name").withColumnRenamed("pos", "cur_pos")
    prev = prev.withColumnRenamed("name", "prev_name").withColumnRenamed("pos", "prev_pos")
    same = cur.join(by_shuffle(prev.withColumn("cur_name", F.col("prev_name"))), [*PAIR, "cat", "cur_name"])
    near = (cur.join(by_shuffle(close), [*PAIR, "cat", "cur_name"])
            .join(by_shuffle(prev), [*PAIR, "cat", "prev_name"]))
    columns = [*PAIR, "cur_pos", "prev_pos", "similarity"]
    return near.select(*columns).unionByName(
        same.withColumn("similarity", F.lit(1.0)).select(*columns))


_TASK_ROWS = 200_000
_PACKS = 64
_REVIEW = "source_id string, week string, cur_pos bigint, prev_pos bigint, similarity double"


def review(left_cur: DataFrame, left_prev: DataFrame, threshold: float = fixed.SIMILARITY_THRESHOLD,
           limit: int | None = None, task_rows: int = _TASK_ROWS) -> DataFrame:
    """One-to-one pairs of leftovers, best ratio first, ties in list order.

    Rows that share category and name stand in a queue: whoever pairs with the name takes its first free row. Only
    names with a close or equal name on the other side have a say. Categories of a source-week never touch each
    other, so their rows and pairs of names are dealt to tasks by category; a category with more than ``task_rows`` of
    them is dealt by connected components of its pairs of names, and a single component beyond that goes in rounds.
    All ways give the result of going through all pairs of rows in order.
    """
    group = [*PAIR, "cat"]
    pool = [*group, "name"]
    cur, prev = _comparable(left_cur, left_prev, threshold, limit)
    close = name_pairs(cur, prev, threshold).select(*group, "cur_name", "prev_name", "similarity")
    equal = (cur.select(*pool).distinct().join(by_shuffle(prev.select(*pool).distinct()), pool)
             .select(*group, F.col("name").alias("cur_name"), F.col("name").alias("prev_name"),
                     F.lit(1.0).alias("similarity")))
    edges = cut_lineage(close.unionByName(equal))

    def rows_of(side: DataFrame, mark: str) -> DataFrame:
        named = edges.select(*group, F.col(f"{mark}_name").alias("name")).distinct()
        return side.join(by_shuffle(named), pool, "left_semi").select(*pool, "pos", F.lit(mark).alias("side"))
    rows = cut_lineage(rows_of(cur, "cur").unionByName(rows_of(prev, "prev")))
    none = F.lit(None)
    parts = rows.select(*group, "side", "name", none.cast("string").alias("other"), "pos",
                        none.cast("double").alias("similarity")).unionByName(
        edges.select(*group, F.lit("pair").alias("side"), F.col("cur_name").alias("name"),
                     F.col("prev_name").alias("other"), F.lit(0).cast("bigint").alias("pos"), "similarity"))
    sizes = cut_lineage(parts.groupBy(*group).agg(F.count(F.lit(1)).alias("n")))
    total, largest = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    key = F.xxhash64(*group)
    if largest <= task_rows:
        return _rounded(_in_packs(parts, key, total, task_rows))

    large = sizes.filter(F.col("n") > task_rows).select(*group)
    out = [_in_packs(parts.join(large, group, "left_anti"), key, total, task_rows)]

    def node(side: str, name: str) -> Column:
        return F.xxhash64(*group, F.lit(side), F.col(name))
    inside = edges.join(large, group, "left_semi")
    roots = cut_lineage(connected_components(inside.select(node("cur", "cur_name").alias("a"),
                                                           node("prev", "prev_name").alias("b"))))
    # a pair belongs to the component of its current name
    rooted = (parts.join(large, group, "left_semi")
              .withColumn("node", F.when(F.col("side") == "prev", node("prev", "name")).otherwise(node("cur", "name")))
              .join(by_shuffle(roots), "node").drop("node"))
    rooted = cut_lineage(rooted)
    huge = rooted.groupBy("root").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > task_rows)
    huge = cut_lineage(huge.select(F.col("root").alias("_huge")))
    in_huge = F.col("root") == F.col("_huge")
    out.append(_in_packs(rooted.join(huge, in_huge, "left_anti"), F.col("root"), total, task_rows))
    if not huge.isEmpty():
        rest = cut_lineage(rooted.join(huge, in_huge, "left_semi"))
        sides = [rest.filter(F.col("side") == m).select(*pool, "pos") for m in ("cur", "prev")]
        pairs = rest.filter("side = 'pair' AND name <> other").select(
            *group, F.col("name").alias("cur_name"), F.col("other").alias("prev_name"), "similarity")
        out.append(_review_in_rounds(*sides, pairs))
    return _rounded(reduce(DataFrame.unionByName, out))


def _rounded(pairs: DataFrame) -> DataFrame:
    return pairs.select(*PAIR, "cur_pos", "prev_pos", F.bround("similarity", 4).alias("similarity"))


def _in_packs(parts: DataFrame, key: Column, total: int, task_rows: int) -> DataFrame:
    """What belongs together by ``key`` goes to one task, with as much else as fits about ``task_rows`` rows."""
    packs = max(_PACKS, -(-4 * total // task_rows))
    return (parts.withColumn("_pack", F.pmod(key, F.lit(packs))).groupBy("_pack")
            .applyInPandas(_pair_queues, _REVIEW))


def _pair_queues(pdf: pd.DataFrame) -> pd.DataFrame:
    """Best pair of names first, the first free row of either: a heap of pairs whose keys only grow.

    A pair whose rows were taken meanwhile is put back with the rows that are first now.
    """
    pool = list(zip(pdf["source_id"], pdf["week"], pdf["cat"], pdf["name"]))
    queues: dict = {"cur": {}, "prev": {}}
    pairs = []
    for key, side, other, pos, ratio in zip(pool, pdf["side"], pdf["other"], pdf["pos"], pdf["similarity"]):
        if side == "pair":
            pairs.append((key, (*key[:3], other), ratio))
        else:
            queues[side].setdefault(key, []).append(int(pos))
    for queue in (*queues["cur"].values(), *queues["prev"].values()):
        queue.sort(reverse=True)
    heap = [(-ratio, queues["cur"][a][-1], queues["prev"][b][-1], a, b) for a, b, ratio in pairs]
    heapq.heapify(heap)
    out = []
    while heap:
        ratio, i, j, a, b = heapq.heappop(heap)
        mine, yours = queues["cur"][a], queues["prev"][b]
        if not mine or not yours:
            continue
        if (mine[-1], yours[-1]) == (i, j):
            out.append((a[0], a[1], mine.pop(), yours.pop(), -ratio))
        if mine and yours:
            heapq.heappush(heap, (ratio, mine[-1], yours[-1], a, b))
    return pd.DataFrame(out, columns=["source_id", "week", "cur_pos", "prev_pos", "similarity"])


def _review_in_rounds(cur: DataFrame, prev: DataFrame, close: DataFrame) -> DataFrame:
    """``review`` for components of any size, in rounds over pairs of names.

    Equal names have the highest ratio there is, so their queues are paired off first, the k-th with the k-th. Then
    the pair that comes first for both its names, by ratio and then by the first free rows, is taken; if neither name
    has another partner of that ratio, the shorter queue is used up at once, else one row.
    """
    pool = [*PAIR, "cat", "name"]
    cur, prev = (cut_lineage(number_in_group(side, pool)) for side in (cur, prev))

    def sizes(side: DataFrame, mark: str) -> DataFrame:
        return side.groupBy(*pool).agg(F.max("rn").alias(f"{mark}_n"))

    def named(df: DataFrame, mark: str) -> DataFrame:
        return df.withColumnRenamed("name", f"{mark}_name")
    queues = cut_lineage(sizes(cur, "cur").join(by_shuffle(sizes(prev, "prev")), pool, "outer")
                         .withColumn("done", F.coalesce(F.least("cur_n", "prev_n"), F.lit(0)))
                         .na.fill(0, ["cur_n", "prev_n"]))
    # done counts skip nulls: a queue with one side only has paired nothing
    queues = queues.withColumn("done", F.when((F.col("cur_n") > 0) & (F.col("prev_n") > 0),
                                              F.col("done")).otherwise(F.lit(0)))
    taken = [queues.filter("done > 0").select(
        *PAIR, "cat", F.col("name").alias("cur_name"), F.col("name").alias("prev_name"),
        F.lit(0).cast("bigint").alias("cur_done"), F.lit(0).cast("bigint").alias("prev_done"),
        F.col("done").cast("bigint").alias("take"), F.lit(1.0).alias("similarity"))]

    def state(mark: str) -> DataFrame:
        return named(queues.filter(f"{mark}_n > done").select(
            *pool, F.col(f"{mark}_n").cast("bigint").alias(f"{mark}_n"),
            F.col("done").cast("bigint").alias(f"{mark}_done")), mark)
    edges = cut_lineage(close
                        .join(by_shuffle(state("cur")), [*PAIR, "cat", "cur_name"])
                        .join(by_shuffle(state("prev")), [*PAIR, "cat", "prev_name"]))
    heads = {mark: named(side.select(*pool, (F.col("rn") - 1).alias(f"{mark}_done"),
                                     F.col("pos").alias(f"{mark}_head")), mark)
             for mark, side in (("cur", cur), ("prev", prev))}
    while edges.limit(1).count():
        live = (edges.join(by_shuffle(heads["cur"]), [*PAIR, "cat", "cur_name", "cur_done"])
                .join(by_shuffle(heads["prev"]), [*PAIR, "cat", "prev_name", "prev_done"]))
        by = {m: Window.partitionBy(*PAIR, "cat", f"{m}_name") for m in ("cur", "prev")}
        tied = {m: Window.partitionBy(*PAIR, "cat", f"{m}_name", "similarity") for m in ("cur", "prev")}
        order = [F.desc("similarity"), F.asc("cur_head"), F.asc("prev_head")]
        first = (live.withColumns({
            "cur_rank": F.row_number().over(by["cur"].orderBy(*order)),
            "prev_rank": F.row_number().over(by["prev"].orderBy(*order)),
            "rivals": F.greatest(F.count(F.lit(1)).over(tied["cur"]),
                                 F.count(F.lit(1)).over(tied["prev"]))})
                 .filter("cur_rank = 1 AND prev_rank = 1"))
        free = F.least(F.col("cur_n") - F.col("cur_done"), F.col("prev_n") - F.col("prev_done"))
        won = cut_lineage(first.withColumn("take", F.when(F.col("rivals") == 1, free).otherwise(1))
                          .select(*taken[0].columns))
        taken.append(won)
        if len(taken) > 16:
            taken = [cut_lineage(reduce(DataFrame.unionByName, taken))]
        for mark in ("cur", "prev"):
            step = won.select(*PAIR, "cat", f"{mark}_name", F.col("take").alias("_take"))
            edges = (edges.join(step, [*PAIR, "cat", f"{mark}_name"], "left")
                     .withColumn(f"{mark}_done", F.col(f"{mark}_done") + F.coalesce("_take", F.lit(0)))
                     .drop("_take"))
        edges = cut_lineage(edges.filter("cur_done < cur_n AND prev_done < prev_n"))
    runs = reduce(DataFrame.unionByName, taken)
    rows = (runs.join(named(cur, "cur").withColumnRenamed("pos", "cur_pos"), [*PAIR, "cat", "cur_name"])
            .filter("rn > cur_done AND rn <= cur_done + take")
            .withColumn("prev_rn", F.col("rn") - F.col("cur_done") + F.col("prev_done")).drop("rn"))
    rows = rows.join(named(prev, "prev").withColumnRenamed("pos", "prev_pos")
                     .withColumnRenamed("rn", "prev_rn"), [*PAIR, "cat", "prev_name", "prev_rn"])
    return rows.select(*PAIR, "cur_pos", "prev_pos", "similarity")
