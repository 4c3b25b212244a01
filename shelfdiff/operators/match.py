"""Which current item is which previous item: layered keys, strictly one to one.

Taken in list order, every current row takes the first previous row that is still free, trying
its keys in order of trust. That is a stable assignment in which current rows rank previous
rows by (key rank, previous position) and every previous row prefers the earliest current row.
Its result is unique and does not depend on the order of proposals, so it is computed in bulk:

* pairs that see only each other on every shared key are final after two aggregations;
* the contested rest of a source-week is settled in list order by one task, as long as its
  counted size is small;
* in source-weeks with more contested rows than that, the connected components of rows and key
  pools are settled so, many small ones to a task;
* in a single component with more rows than a task may hold, rows propose in rounds, a whole key
  pool at a time, until nobody is left to propose. Should long chains of displaced rows remain
  after a number of rounds, the rows behind the first of them are settled block by block.

No pool is ever expanded to its pairs, and no unbounded group has to fit one task.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfdiff import fixed_values as fixed
from shelfdiff.functions.text import normalize_name
from shelfdiff.operators.components import connected_components
from shelfdiff.operators.ordering import number_in_group
from shelfdiff.session import by_shuffle, cut_lineage

PAIR = ["source_id", "week"]
POOL = [*PAIR, "key", "value"]
NAME_PRICE = "name_price"
SERIAL_LIMIT = 200_000
PACKS = 64
MAX_ROUNDS = 40
_FREE = (1 << 63) - 1


def name_price_key(name: Column, price: Column) -> Column:
    """The weakest automatic key: normalized name and price; an unknown price equals itself.

    The separator is white space to ``normalize_name``, so no name contains it.
    """
    return F.concat(normalize_name(name), F.lit("\u001f"),
                    F.coalesce(price.cast("string"), F.lit("-")))


def match_keys(items: DataFrame, cross: tuple[str, ...] = fixed.CROSS_SOURCE_KEYS,
               name_price: bool = False) -> DataFrame:
    """Keys of every item in order of trust: ``(source_id, week, pos, rank, key, value)``.

    Keys shared between sources first, the source's other keys by name, external_id last, and
    on request name and price behind them all. Empty values are no keys.
    """
    alt = F.map_filter(F.coalesce(F.col("alt_ids"), F.create_map().cast("map<string,string>")),
                       lambda _, v: v.isNotNull() & (v != ""))
    names = F.array_sort(F.map_keys(alt))
    shared = F.array(*[F.lit(c) for c in cross]).cast("array<string>")
    ordered = F.concat(F.filter(shared, lambda k: F.array_contains(names, k)),
                       F.array_except(names, shared))

    def entry(key: Column, value: Column) -> Column:
        return F.struct(key.alias("key"), value.alias("value"))

    found = F.transform(ordered, lambda k: entry(k, F.element_at(alt, k)))
    own = F.when(F.col("external_id") != "",
                 F.array(entry(F.lit("external_id"), F.col("external_id"))))
    keys = F.concat(found, F.coalesce(own, F.slice(found, 1, 0)))
    if name_price:
        last = entry(F.lit(NAME_PRICE), name_price_key(F.col("name"), F.col("price")))
        keys = F.concat(keys, F.array(last))
    return (items.select(*PAIR, "pos", F.posexplode(keys).alias("rank", "_key"))
            .select(*PAIR, "pos", "rank", "_key.key", "_key.value"))


def layered_match(prev: DataFrame, cur: DataFrame,
                  cross: tuple[str, ...] = fixed.CROSS_SOURCE_KEYS,
                  serial_limit: int = SERIAL_LIMIT, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """``(source_id, week, cur_pos, prev_pos, matched_by)``, one row per matched pair.

    Both sides carry the current week in ``week``. Runs jobs: one for the pairs that are final
    at once, and more only when rows are contested. ``serial_limit`` bounds the key rows that one
    task settles, and the rows of a block where rounds do not suffice.
    """
    cur_keys = match_keys(cur, cross, name_price=True)
    prev_keys = match_keys(prev, cross, name_price=True)

    both = (cur_keys.withColumn("is_cur", F.lit(True))
            .unionByName(prev_keys.withColumn("is_cur", F.lit(False))))
    # nearly every key is the only one of its side, so counting before the shuffle would only fill memory
    both = both.repartition(*POOL)
    is_cur = F.col("is_cur")
    lone = (F.col("n_cur") == 1) & (F.col("n_prev") == 1)
    pools = cut_lineage(
        both.groupBy(*POOL).agg(
            F.count_if(is_cur).alias("n_cur"), F.count_if(~is_cur).alias("n_prev"),
            F.min(F.when(is_cur, F.col("pos"))).alias("cur_pos"),
            F.min(F.when(~is_cur, F.col("pos"))).alias("prev_pos"),
            F.min(F.when(is_cur, F.col("rank"))).alias("rank"))
        .filter("n_cur > 0 AND n_prev > 0")
        .select(*PAIR, "key", F.when(~lone, F.col("value")).alias("value"), "rank",
                lone.alias("lone"), F.when(lone, F.col("cur_pos")).alias("cur_pos"),
                F.when(lone, F.col("prev_pos")).alias("prev_pos")))

    edges = pools.filter("lone").select(*PAIR, "cur_pos", "prev_pos", "rank", "key")
    seen_by_cur = edges.groupBy(*PAIR, "cur_pos").agg(
        F.min("prev_pos").alias("prev_pos"), F.max("prev_pos").alias("prev_last"),
        F.min_by("key", "rank").alias("matched_by"))
    seen_by_prev = edges.groupBy(*PAIR, "prev_pos").agg(
        F.min("cur_pos").alias("cur_first"), F.max("cur_pos").alias("cur_last"))
    judged = seen_by_cur.join(by_shuffle(seen_by_prev), [*PAIR, "prev_pos"]).withColumn(
        "final", (F.col("prev_pos") == F.col("prev_last"))
        & (F.col("cur_first") == F.col("cur_last")))

    crowded = pools.filter("NOT lone").select(*POOL)
    if not crowded.isEmpty():
        in_crowd = both.join(by_shuffle(crowded), POOL, "left_semi").select(*PAIR, "is_cur", "pos").distinct()
        judged = _unsettle(judged, in_crowd)
    verdict = cut_lineage(judged.select(*PAIR, "cur_pos", "prev_pos", "matched_by", "final"))

    settled = verdict.filter("final").drop("final")
    contested = verdict.filter("NOT final").select(*PAIR, F.col("cur_pos").alias("pos"))
    if contested.isEmpty():
        return settled

    wanted = cur_keys.join(by_shuffle(contested.distinct()), [*PAIR, "pos"], "left_semi")
    offered = cut_lineage(prev_keys.join(by_shuffle(wanted.select(*POOL).distinct()), POOL, "left_semi")
                          .select(*POOL, F.col("pos").alias("prev_pos")))
    wanted = cut_lineage(wanted.join(by_shuffle(offered.select(*POOL).distinct()), POOL, "left_semi")
                         .select(*POOL, "rank", F.col("pos").alias("cur_pos")))

    sizes = cut_lineage(wanted.select(*PAIR).unionByName(offered.select(*PAIR)).groupBy(*PAIR)
                        .agg(F.count(F.lit(1)).alias("n")))
    total, largest = sizes.agg(F.sum("n"), F.max("n")).first()
    if (largest or 0) <= serial_limit:
        contested_pairs = _settle_in_order(wanted, offered, F.xxhash64(*PAIR), total, serial_limit)
    else:
        contested_pairs = _settle_components(wanted, offered, total, max(serial_limit, 1), max_rounds)
    return settled.unionByName(cut_lineage(contested_pairs))


def _unsettle(judged: DataFrame, in_crowd: DataFrame) -> DataFrame:
    """Pairs with a row in a crowded pool are not final; rows only there join in without one."""
    def marked(is_cur: bool, name: str) -> DataFrame:
        return in_crowd.filter(F.col("is_cur") == is_cur).select(
            *PAIR, F.col("pos").alias(f"{name}_pos"), F.lit(True).alias(f"{name}_crowd"))

    return (judged.join(by_shuffle(marked(True, "cur")), [*PAIR, "cur_pos"], "full_outer")
            .join(by_shuffle(marked(False, "prev")), [*PAIR, "prev_pos"], "left")
            .withColumn("final", F.coalesce(
                F.col("final") & F.col("cur_crowd").isNull() & F.col("prev_crowd").isNull(),
                F.lit(False))))


def _serve(wanted: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
    """The contested rows of some components, each source-week in list order."""
    stock = {}
    offers = offered.sort_values("prev_pos", ascending=False)
    for *pool, p in zip(*[offers[c] for c in (*POOL, "prev_pos")]):
        stock.setdefault(tuple(pool), []).append(p)
    gone, served, out = set(), set(), []
    calls = wanted.sort_values(["cur_pos", "rank"])
    for source, week, key, value, c in zip(*[calls[c] for c in (*POOL, "cur_pos")]):
        seats = stock.get((source, week, key, value), [])
        while seats and (source, week, seats[-1]) in gone:
            seats.pop()
        if seats and (source, week, c) not in served:
            served.add((source, week, c))
            gone.add((source, week, seats[-1]))
            out.append((source, week, c, seats.pop(), key))
    return pd.DataFrame(out, columns=[*PAIR, "cur_pos", "prev_pos", "matched_by"])


def _settle_in_order(wanted: DataFrame, offered: DataFrame, key: Column, total: int, limit: int) -> DataFrame:
    """What belongs together by ``key`` is settled by one task, with as much else as fits about ``limit`` key rows."""
    packs = max(PACKS, -(-4 * (total or 0) // max(limit, 1)))
    pack = F.pmod(key, F.lit(packs)).alias("_pack")
    # both snapshots may come from one table; new names tell the columns of the two sides apart
    wanted = wanted.select(*[F.col(c).alias(c) for c in (*POOL, "rank", "cur_pos")], pack)
    offered = offered.select(*[F.col(c).alias(c) for c in (*POOL, "prev_pos")], pack)
    return (wanted.groupBy("_pack").cogroup(offered.groupBy("_pack"))
            .applyInPandas(_serve, "source_id string, week string, cur_pos bigint, prev_pos bigint, matched_by string"))


def _settle_components(wanted: DataFrame, offered: DataFrame, total: int, limit: int, max_rounds: int) -> DataFrame:
    """Source-weeks of any size by the connected components of rows and key pools.

    Rows that share no key with each other, not even through others, cannot take anything from each other. Pools are
    nodes themselves, so a pool of n rows has n links and not n squared. Components of at most ``limit`` key rows are
    packed into tasks; only a component beyond that goes in rounds.
    """
    pool = F.xxhash64(*POOL)
    links = (wanted.select(pool.alias("a"), F.xxhash64(*PAIR, F.lit("cur"), "cur_pos").alias("b"))
             .unionByName(offered.select(pool.alias("a"), F.xxhash64(*PAIR, F.lit("prev"), "prev_pos").alias("b"))))
    roots = cut_lineage(connected_components(links))

    def rooted(rows: DataFrame) -> DataFrame:
        return cut_lineage(rows.withColumn("node", pool).join(by_shuffle(roots), "node").drop("node"))
    wanted, offered = rooted(wanted), rooted(offered)
    sizes = wanted.select("root").unionByName(offered.select("root")).groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    giant = cut_lineage(sizes.filter(F.col("n") > limit).select(F.col("root").alias("_giant")))
    in_giant = F.col("root") == F.col("_giant")
    pairs = _settle_in_order(wanted.join(giant, in_giant, "left_anti"), offered.join(giant, in_giant, "left_anti"),
                             F.col("root"), total, limit)
    if giant.isEmpty():
        return pairs
    return pairs.unionByName(_settle_in_rounds(
        wanted.join(giant, in_giant, "left_semi").drop("root"), offered.join(giant, in_giant, "left_semi").drop("root"),
        max_rounds, limit))


def _settle_in_rounds(wanted: DataFrame, offered: DataFrame, max_rounds: int,
                      block: int) -> DataFrame:
    """Source-weeks of any size; the layer is the best key both rows of a pair share."""
    held, waiting = _propose_in_rounds(wanted, offered, max_rounds)
    if waiting is not None:
        held = _finish_in_blocks(wanted, offered, held, waiting, block)
    return (wanted.join(by_shuffle(held), [*PAIR, "cur_pos"])
            .join(by_shuffle(offered), [*POOL, "prev_pos"], "left_semi")
            .groupBy(*PAIR, "cur_pos", "prev_pos")
            .agg(F.min_by("key", "rank").alias("matched_by")))


def _finish_in_blocks(wanted: DataFrame, offered: DataFrame, held: DataFrame,
                      waiting: DataFrame, block: int) -> DataFrame:
    """Settle the rows from the first waiting one on, a block of rows at a time.

    Only an earlier row can take a previous row away, so pairs before the first waiting row are
    final. Of each pool a block needs no more open rows than it has rows itself, so a task holds
    a block and what it can reach. Blocks follow each other, source-weeks run side by side.
    """
    first = waiting.groupBy(*PAIR).agg(F.min("cur_pos").alias("first"))
    final = cut_lineage(held.join(first, PAIR, "left")
                        .filter("first IS NULL OR cur_pos < first").drop("first"))
    rest = wanted.join(first, PAIR).filter("cur_pos >= first").drop("first")
    numbered = number_in_group(rest.select(*PAIR, "cur_pos").distinct(), PAIR, "cur_pos")
    rest = cut_lineage(rest.join(by_shuffle(numbered), [*PAIR, "cur_pos"])
                       .withColumn("block", F.floor((F.col("rn") - 1) / block)).drop("rn"))
    for i in range(rest.agg(F.max("block")).first()[0] + 1):
        calls = rest.filter(F.col("block") == i).drop("block")
        open_seats = (offered.join(by_shuffle(calls.select(*POOL).distinct()), POOL, "left_semi")
                      .join(by_shuffle(final.select(*PAIR, "prev_pos")), [*PAIR, "prev_pos"], "left_anti"))
        near = number_in_group(open_seats, POOL, "prev_pos").filter(F.col("rn") <= block)
        served = cut_lineage(_settle_in_order(calls, near.drop("rn"), F.xxhash64(*PAIR), 0, block))
        final = final.unionByName(served.select(*PAIR, "prev_pos", "cur_pos"))
    return final


def _propose_in_rounds(wanted: DataFrame, offered: DataFrame,
                       max_rounds: int) -> tuple[DataFrame, DataFrame | None]:
    """Deferred acceptance over key pools: ``(source_id, week, prev_pos, cur_pos)``.

    A previous row only ever trades its holder for an earlier one, so being turned away is
    final and the holders are all the state there is. A round looks at each current row
    without a partner, finds its best pool that could still take it, and lines up the rows of
    a pool with its open previous rows. The line holds up to the first row whose opposite is
    already taken by someone before it; the rows behind wait for the next round. After
    ``max_rounds`` the rows that still wait are returned as well.
    """
    free = F.lit(_FREE)
    held = wanted.select(*PAIR, F.col("cur_pos").alias("prev_pos"), "cur_pos").limit(0)
    rounds = 0
    while True:
        seats = (offered.join(by_shuffle(held.withColumnRenamed("cur_pos", "holder")),
                              [*PAIR, "prev_pos"], "left")
                 .withColumn("holder", F.coalesce("holder", free)))
        latest = seats.groupBy(*POOL).agg(F.max("holder").alias("latest"))
        partnerless = wanted.join(by_shuffle(held.select(*PAIR, "cur_pos")), [*PAIR, "cur_pos"], "left_anti")
        callers = cut_lineage(
            partnerless.join(by_shuffle(latest), POOL).filter("latest > cur_pos")
            .groupBy(*PAIR, "cur_pos")
            .agg(F.min(F.struct("rank", "key", "value")).alias("best"))
            .select(*PAIR, "best.key", "best.value", "cur_pos"))
        if callers.isEmpty():
            return held, None
        if rounds == max_rounds:
            return held, callers
        rounds += 1

        first = callers.groupBy(*POOL).agg(F.min("cur_pos").alias("first"))
        open_seats = seats.join(by_shuffle(first), POOL).filter("holder > first")
        line = (number_in_group(callers, POOL, "cur_pos")
                .join(by_shuffle(number_in_group(open_seats.select(*POOL, "prev_pos", "holder"), POOL,
                                                 "prev_pos")), [*POOL, "rn"]))
        broken = (line.filter("holder < cur_pos").groupBy(*POOL)
                  .agg(F.min("rn").alias("broken")))
        calls = (line.join(by_shuffle(broken), POOL, "left")
                 .filter("broken IS NULL OR rn < broken").select(*PAIR, "prev_pos", "cur_pos"))
        held = cut_lineage(held.unionByName(calls).groupBy(*PAIR, "prev_pos")
                           .agg(F.min("cur_pos").alias("cur_pos")))
