"""SimHash document fingerprints and a search by permuted block tables. DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfdiff.session import cut_lineage

#: Bits of a fingerprint (two 64-bit halves), radius of the search, blocks of the tables, heaviest term.
BITS = 128
RADIUS = 7
BLOCKS = 8
TOP_WEIGHT = 24

_LANES = 0x0000000100000001
_LOW = 0xFFFFFFFF
_NO_ID = -(2 ** 63)


def _terms(text: Column) -> Column:
    """Neighbouring words as pairs, the last word with nothing; null and empty texts have no term."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "")
    return F.arrays_zip(words.alias("a"), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))).alias("b"))


def fingerprints(texts: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """``key`` columns, copies, high, low: the fingerprint of each text as two 64-bit halves.

    Terms are neighbouring word pairs in lower case. A term weighs as many characters as it has, at most
    ``TOP_WEIGHT``; for each bit of its hash the weight is a vote for or against. Votes are added in lanes, two to a
    number, so that one aggregation holds all bits. Equal texts have equal fingerprints; null texts and texts
    without words have zero. Rows that agree in ``key`` must agree in their text and become one row, ``copies`` says
    how many they were. Texts of up to 80 million terms fit the lanes.
    """
    rows = texts.select(*key, _terms(F.col(text)).alias("_terms"))
    rows = rows.select(*key, F.greatest(F.size("_terms"), F.lit(1)).alias("_n"), F.inline_outer("_terms").alias("a", "b"))
    weight = F.least(F.coalesce(F.char_length("a"), F.lit(0)) + F.coalesce(F.char_length("b"), F.lit(0)),
                     F.lit(TOP_WEIGHT)).cast("bigint")
    rows = rows.select(*key, "_n", weight.alias("_w"), F.xxhash64("a", "b").alias("_h0"))
    rows = rows.withColumn("_h1", F.xxhash64("_h0"))
    votes = [F.sum(F.shiftrightunsigned(f"_h{half}", i).bitwiseAND(F.lit(_LANES)) * F.col("_w")).alias(f"_v{half}_{i}")
             for half in (0, 1) for i in range(32)]
    voted = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"), F.first("_n").alias("_n"),
                                   F.sum("_w").alias("_all"), *votes)

    def half(k: int) -> Column:
        bits = []
        for i in range(32):
            low = F.col(f"_v{k}_{i}").bitwiseAND(F.lit(_LOW))
            high = F.shiftrightunsigned(F.col(f"_v{k}_{i}"), 32)
            bits.append(F.when(low * 2 > F.col("_all"), F.lit(1 << i)).otherwise(F.lit(0)))
            top = (1 << (i + 32)) if i < 31 else -(1 << 63)
            bits.append(F.when(high * 2 > F.col("_all"), F.lit(top)).otherwise(F.lit(0)))
        return reduce(lambda a, b: a.bitwiseOR(b), [b.cast("bigint") for b in bits])
    return voted.select(*key, F.expr("_rows div _n").alias("copies"), half(0).alias("high"), half(1).alias("low"))


def as_text(high: Column, low: Column) -> Column:
    """32 hexadecimal digits."""
    return F.lower(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in (high, low)]))


def likeness(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """Share of equal bits."""
    return F.lit(1.0) - distance(a, b) / F.lit(float(BITS))


def distance(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    return F.bit_count(a[0].bitwiseXOR(b[0])) + F.bit_count(a[1].bitwiseXOR(b[1]))


def next_ids(ids: DataFrame, id_col: str = "k") -> DataFrame:
    """``id_col`` and next_id: the next larger one, after the largest the smallest. ``ids`` holds each id once.

    Ids are sorted in ranges; only the first id of each range is compared across ranges.
    """
    ranged = cut_lineage(ids.select(id_col).repartitionByRange(id_col).withColumn("_p", F.spark_partition_id()))
    firsts = ranged.groupBy("_p").agg(F.min(id_col).alias("_first"))
    everything = Window.partitionBy(F.lit(0)).orderBy("_p")  # one row a range
    firsts = firsts.select(F.col("_p").alias("_q"), F.coalesce(
        F.lead("_first").over(everything),
        F.min("_first").over(everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .alias("_after"))
    return (ranged.withColumn("_lead", F.lead(id_col).over(Window.partitionBy("_p").orderBy(id_col)))
            .join(firsts, F.col("_p") == F.col("_q"))
            .select(id_col, F.coalesce("_lead", "_after").alias("next_id")))


def edited_texts(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with its text's second half overwritten by the start of the next document.

    Returns k (the id, null as the smallest), doc_id, text, edited, next_id. The last floor(n / 2) characters give
    way to as many from the document with the next larger id, or to all it has; the last document meets the first.
    Rows that repeat an id count as one place in the order, its text is the smallest of theirs.
    """
    d = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID)).alias("k"),
                    F.coalesce("text", F.lit("")).alias("text"))
    cut = F.expr("char_length(text) div 2")
    ids = d.groupBy("k").agg(F.max(cut).cast("int").alias("need"))
    after = cut_lineage(next_ids(ids).join(ids, "k"))
    heads = (d.join(after.select(F.col("next_id").alias("k"), F.col("k").alias("to"), "need"), "k")
             .groupBy(F.col("to").alias("k")).agg(F.min(F.expr("left(text, need)")).alias("head")))
    ahead = after.select("k", "next_id")
    return (d.join(heads, "k").join(ahead, "k")
            .withColumn("edited", F.concat(F.expr("left(text, char_length(text) - char_length(text) div 2)"),
                                           F.expr("left(head, CAST(char_length(text) div 2 AS int))")))
            .select("k", F.when(F.col("k") != _NO_ID, F.col("k")).alias("doc_id"), "text", "edited", "next_id"))


def block_keys(high: Column, low: Column, blocks: int = BLOCKS) -> Column:
    """Array of (table, value): table t holds fingerprints with block t in front."""
    width = BITS // blocks
    if 64 % width:
        raise ValueError("blocks must divide a half")
    per, mask = 64 // width, (1 << width) - 1
    return F.array(*[F.struct(F.lit(t).alias("table"), F.shiftrightunsigned(
        high if t < per else low, 64 - width * (t % per + 1)).bitwiseAND(F.lit(mask)).alias("value"))
        for t in range(blocks)])


def within_radius(queries: DataFrame, index: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Pairs (q_high, q_low, high, low, distance) of distinct fingerprints at most ``radius`` bits apart.

    With more blocks than the radius, two such fingerprints agree in a whole block, so they meet in the table that
    has it in front. A pair is kept in the first such table only. Both sides hold each fingerprint once.
    """
    if blocks <= radius:
        raise ValueError("more blocks than the radius are needed")
    q = (queries.select(F.col("high").alias("q_high"), F.col("low").alias("q_low"))
         .withColumn("_keys", block_keys(F.col("q_high"), F.col("q_low"), blocks))
         .select("*", F.inline("_keys")).withColumnRenamed("_keys", "_q_keys"))
    i = index.select("high", "low").withColumn("_keys", block_keys(F.col("high"), F.col("low"), blocks))
    i = i.select("high", "low", F.inline("_keys"))
    far = distance((F.col("q_high"), F.col("q_low")), (F.col("high"), F.col("low")))
    own = block_keys(F.col("high"), F.col("low"), blocks)
    first = reduce(lambda rest, t: F.when(F.col("_q_keys")[t] == own[t], F.lit(t)).otherwise(rest),
                   reversed(range(blocks)), F.lit(blocks))
    return (q.join(i, ["table", "value"]).withColumn("distance", far)
            .filter((F.col("distance") <= radius) & (F.col("table") == first))
            .select("q_high", "q_low", "high", "low", "distance"))
