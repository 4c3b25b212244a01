"""Mixing sources to target weights: Sainte-Laguë quotas of equal-token blocks, then seeded block selection."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfdiff.llm.parts import WORD, running_total, word_count
from shelfdiff.session import cut_lineage

#: Words of a block, copies of a source at most, shards that get quotas, seed of order and selection.
BLOCK_WORDS = 64
MOST_COPIES = 3
SHARDS = 24
SEED = 11

_PLAN = ("plan_source string, source_size bigint, target double, whole bigint, extra bigint, blocks bigint, "
         "phase bigint, quotas array<bigint>")


@dataclass(frozen=True)
class Source:
    name: str | None
    size: int
    weight: float


def targets(sources: list[Source], total: float | None = None, most: int = MOST_COPIES) -> list[float]:
    """Shares of ``total`` (default: all sizes) by weight, none above ``most`` times its source's size.

    What a capped source cannot take is shared again by weight among the rest. If every source is at its cap the
    targets add up to less than ``total``.
    """
    total = float(sum(s.size for s in sources)) if total is None else float(total)
    caps = [float(most * s.size) for s in sources]
    out = [0.0] * len(sources)
    free, left = [i for i, s in enumerate(sources) if s.weight > 0], total
    while free:
        weights = sum(sources[i].weight for i in free)
        share = {i: left * sources[i].weight / weights for i in free}
        over = [i for i in free if share[i] > caps[i]]
        if not over:
            for i in free:
                out[i] = share[i]
            break
        for i in over:
            out[i] = caps[i]
        left = total - sum(out)
        free = [i for i in free if i not in set(over)]
    return out


def sainte_lague(votes: list[float], limits: list[int], houses: list[int]) -> np.ndarray:
    """Seats of every party for each house size: seats go one by one to the highest vote / (2 seats + 1).

    A party with ``limits[i]`` seats gets no more. Ties go to the earlier party. A house is started from a divisor
    that gives out too few seats by at most one a party, so the seats dealt one by one do not grow with the house.
    """
    v, cap = np.array(votes, np.float64), np.array(limits, np.int64)
    out = np.zeros((len(houses), len(v)), np.int64)
    for k, house in enumerate(houses):
        house = min(int(house), int(cap[v > 0].sum()))
        seats = np.zeros(len(v), np.int64)
        if house and v.sum() > 0:
            low, high = 0.0, float(house) / v[v > 0].min() + 1.0
            given = lambda scale: np.where(v > 0, np.minimum(cap, np.floor(v * scale + 0.5).astype(np.int64)), 0)
            for _ in range(200):
                mid = (low + high) / 2
                low, high = (mid, high) if given(mid).sum() <= house else (low, mid)
            seats = given(low)
            while seats.sum() < house:
                quotient = np.where(seats < cap, v / (2 * seats + 1), -1.0)
                seats[int(np.argmax(quotient))] += 1
        out[k] = seats
    return out


def plan_mix(sources: list[Source], block: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED,
             most: int = MOST_COPIES) -> list[tuple]:
    """One row a source: its target, whole passes over its blocks, blocks drawn once more, quotas per shard.

    A seat is worth ``block`` words. A source's seats buy whole passes, and blocks for what is left of them. Its last
    block holds the words that fill no block; a source shorter than a block is one, and is passed over as often as its
    target asks for, since a seat would be worth several of it.
    """
    wanted = targets(sources, most=most)
    seats_all = int(round(sum(wanted) / block))
    houses = [seats_all * (k + 1) // shards for k in range(shards)]
    seats = sainte_lague(wanted, [-(-most * s.size // block) for s in sources], houses)
    quotas = np.diff(seats, axis=0, prepend=np.zeros((1, len(sources)), np.int64))
    rows = []
    for i, s in enumerate(sources):
        words = min(int(seats[-1, i]) * block if s.size >= block else round(wanted[i]), most * s.size)
        n = max(1, s.size // block)
        whole, rest = divmod(words, s.size) if s.size else (0, 0)
        extra = min(n, int(rest / (block if n > 1 else max(1, s.size)) + 0.5))
        mark = hashlib.sha256(f"{seed}\x00{s.name!r}".encode()).digest()
        rows.append((s.name, s.size, wanted[i], whole, extra, n,
                     int.from_bytes(mark[:7], "big") % n, [int(x) for x in quotas[:, i]]))
    return rows


def cyclic_weights(names: list[str | None], cycle: tuple[float, ...] = (1.0, 2.0, 3.0)) -> dict:
    """Weights that repeat over the sources by code point, null last."""
    order = sorted(names, key=lambda n: (n is None, n or ""))
    return {n: cycle[i % len(cycle)] for i, n in enumerate(order)}


def mix(docs: DataFrame, weights=cyclic_weights, block: int = BLOCK_WORDS, shards: int = SHARDS,
        seed: int = SEED, most: int = MOST_COPIES) -> DataFrame:
    """How much of each document a mix takes.

    Returns doc_id, source, size, source_size, target, taken, and what ``mixed_texts`` cuts texts by (before, whole,
    extra, blocks, phase, quotas). The documents of a source stand in a seeded order, end to end; every ``block``
    words are a block. Sainte-Laguë apportions as many draws as the targets hold blocks, for each shard of the
    output; a source's draws are whole passes over its blocks, and the rest picks blocks at even steps from a
    seeded phase. The words taken from a source differ from its target by two blocks or so. A document's words count as often as their blocks are drawn, at most ``most`` times.

    ``weights`` maps the list of source names to their weights. Only the table of sources (name and size, one row
    each) comes to the driver; its length is that of the registry of sources, not of the documents. Null texts and
    texts without words have size 0 and give nothing; null is a source; repeated rows each count; an empty table
    gives an empty result. The same input gives the same result.
    """
    spark = docs.sparkSession
    sized = cut_lineage(docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"),
        F.xxhash64(F.col("doc_id"), F.lit(seed)).alias("_spread"), F.xxhash64("text").alias("_text")))
    found = sized.groupBy("source").agg(F.sum("size").alias("size")).collect()
    given = weights([r.source for r in found])
    sources = [Source(r.source, int(r.size), float(given.get(r.source, 0.0)))
               for r in sorted(found, key=lambda r: (r.source is None, r.source or ""))]
    plan = _plan_table(spark, plan_mix(sources, block, shards, seed, most))
    placed = running_total(sized, ["source"], "_spread", F.col("size"), ties=["doc_id", "_text", "size"])
    return (placed.join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
            .withColumn("taken", _taken(block))
            .select("doc_id", "source", "size", "source_size", "target", "taken", "before", "whole", "extra",
                    "blocks", "phase", "quotas", "_text"))


def _plan_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, _PLAN)


def _drawn(block_no: str) -> str:
    """Blocks before ``block_no`` that are drawn once more: even steps through the source."""
    return f"((({block_no}) * extra + phase) div greatest(blocks, 1))"


def _taken(block: int):
    first = f"least(before div {block}, blocks - 1)"
    last = f"least((before + size - 1) div {block}, blocks - 1)"
    once = lambda b: f"({_drawn(b + ' + 1')} - {_drawn(b)})"
    return F.expr(
        f"CASE WHEN size = 0 THEN 0L "
        f"WHEN {first} = {last} THEN size * (whole + {once(first)}) "
        f"ELSE size * whole + {once(first)} * (({first} + 1) * {block} - before)"
        f" + {once(last)} * (before + size - {last} * {block})"
        f" + {block} * ({_drawn(last)} - {_drawn(first + ' + 1')}) END")


def mixed_texts(docs: DataFrame, mixed: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """The documents the mix holds: ``whole`` copies of the text, then the words of blocks drawn once more.

    Returns the columns of ``docs``, a row for each copy; n_chars, where it is a column, follows the text. Runs of
    drawn blocks keep their own white space and are joined by a line feed. Documents without a word in the mix are
    left out. ``mixed`` is the result of ``mix`` over the same documents.
    """
    word = re.compile(WORD)

    @F.pandas_udf("string")
    def part(text: pd.Series, before: pd.Series, extra: pd.Series, blocks: pd.Series,
             phase: pd.Series) -> pd.Series:
        return pd.Series([_cut(word, t, int(b), int(e), int(n), int(p), block)
                          for t, b, e, n, p in zip(text, before, extra, blocks, phase)])

    columns = docs.columns
    keyed = docs.select(F.struct(*columns).alias("_doc"), F.col("doc_id").alias("_id"),
                        F.xxhash64("text").alias("_hash"), F.col("source").cast("string").alias("_source"))
    # rows that agree in id, source and text are interchangeable: number them on both sides, meet by number
    keyed = keyed.withColumn("_copy", F.row_number().over(
        Window.partitionBy("_id", "_source", "_hash").orderBy("_hash")))
    mixed = mixed.withColumn("_copy", F.row_number().over(
        Window.partitionBy("doc_id", "source", "_text").orderBy("before")))
    m = mixed.filter("taken > 0").select(
        F.col("doc_id").alias("_m_id"), F.col("source").alias("_m_source"), F.col("_text").alias("_m_hash"),
        F.col("_copy").alias("_m_copy"), "size", "taken", "before", "whole", "extra", "blocks", "phase")
    met = keyed.join(m, F.col("_id").eqNullSafe(F.col("_m_id")) & (F.col("_hash") == F.col("_m_hash"))
                     & F.col("_source").eqNullSafe(F.col("_m_source")) & (F.col("_copy") == F.col("_m_copy")))
    copies = F.expr("CAST(whole + CASE WHEN taken > size * whole THEN 1 ELSE 0 END AS int)")
    rows = met.withColumn("_turn", F.explode(F.sequence(F.lit(1), copies)))
    rows = rows.withColumn("_new", F.when(F.col("_turn") <= F.col("whole"), F.col("_doc.text")).otherwise(
        part(F.when(F.col("_turn") > F.col("whole"), F.col("_doc.text")), "before", "extra", "blocks", "phase")))
    changed = {"text": F.col("_new")}
    if "n_chars" in columns:
        changed["n_chars"] = F.char_length("_new").cast(docs.schema["n_chars"].dataType)
    return rows.select(*[changed.get(c, F.col("_doc")[c]).alias(c) for c in columns])


def _cut(word, text: str | None, before: int, extra: int, blocks: int, phase: int, block: int) -> str | None:
    if text is None:
        return None
    spans, run, place = [], None, before
    for m in word.finditer(text):
        b = min(place // block, blocks - 1)
        drawn = ((b + 1) * extra + phase) // blocks - (b * extra + phase) // blocks
        if drawn:
            run = [m.start(), m.end()] if run is None else [run[0], m.end()]
        elif run:
            spans.append(run)
            run = None
        place += 1
    if run:
        spans.append(run)
    return "\n".join(text[a:b] for a, b in spans)
