"""Conversation logs: blocks, user turns, which conversations to keep, transcripts."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfdiff import fixed_values as fixed
from shelfdiff.functions.text import clip_text, strip
from shelfdiff.operators.ordering import number_in_group


@F.pandas_udf(T.StringType())
def _spaced_json(texts: pd.Series) -> pd.Series:
    """JSON with a blank after colons and commas."""
    return texts.map(lambda s: json.dumps(json.loads(s), ensure_ascii=False), na_action="ignore")


def _get(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, path, kind)


def _kind_of(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v), F.lit(""))


def flatten_blocks(records: DataFrame, content: str = "content") -> DataFrame:
    """``content`` is a JSON string or an array of typed blocks; one row per known block.

    Adds ``block`` (its place), ``kind`` (text, thinking, tool_use, tool_result) and ``text``.
    """
    keep = [c for c in records.columns if c != content]
    parsed = records.withColumn("_v", F.try_parse_json(F.col(content)))
    kind = _kind_of(F.col("_v"))
    whole = parsed.filter(kind == "STRING").select(
        *keep, F.lit(0).alias("block"), F.lit("text").alias("kind"),
        _get(F.col("_v"), "$").alias("text"))

    blocks = (parsed.filter(kind.startswith("ARRAY"))
              .select(*keep, content, F.posexplode(_get(F.col("_v"), "$", "array<variant>"))
                      .alias("block", "_b"))
              .withColumn("kind", _get(F.col("_b"), "$.type")))
    # tool arguments are taken from the raw text, which keeps the order of their keys
    place = F.concat(F.lit("$["), F.col("block").cast("string"), F.lit("].input"))
    raw = F.call_function("get_json_object", F.col(content), place)
    block = F.col("_b")
    call = F.when(F.col("kind") == "tool_use", F.coalesce(raw, F.lit("{}")))
    result = _get(block, "$.content", "variant")
    inner = F.filter(_get(block, "$.content", "array<variant>"),
                     lambda b: _get(b, "$.type") == "text")
    joined = F.array_join(F.transform(inner, lambda b: F.coalesce(_get(b, "$.text"), F.lit(""))), "")
    text = (F.when(F.col("kind") == "text", F.coalesce(_get(block, "$.text"), F.lit("")))
            .when(F.col("kind") == "thinking", F.coalesce(_get(block, "$.thinking"), F.lit("")))
            .when(F.col("kind") == "tool_use", F.concat(
                F.coalesce(_get(block, "$.name"), F.lit("None")), F.lit("("), F.col("_call"),
                F.lit(")")))
            .when(F.col("kind") == "tool_result", F.when(
                _kind_of(result).startswith("ARRAY"), joined).otherwise(
                    F.coalesce(_get(block, "$.content"), F.lit("")))))
    typed = (blocks.filter(F.col("kind").isin("text", "thinking", "tool_use", "tool_result"))
             .withColumn("_call", _spaced_json(call))
             .select(*keep, "block", "kind", text.alias("text")))
    return whole.unionByName(typed)


def user_turns(blocks: DataFrame) -> DataFrame:
    """Per conversation the user records with any non-blank text block."""
    said = (F.col("role") == "user") & (F.col("kind") == "text") & (strip(F.col("text")) != "")
    per_turn = blocks.groupBy("conv_id", "turn").agg(
        F.max(F.coalesce(said, F.lit(False))).alias("said"))
    return per_turn.groupBy("conv_id").agg(F.count_if("said").alias("user_turns"))


def keep_conversations(turns: DataFrame,
                       minimum: int = fixed.MIN_USER_TURNS) -> tuple[DataFrame, DataFrame]:
    """``(kept conversations with their number, how many were kept and skipped)``."""
    enough = F.col("user_turns") >= minimum
    kept = turns.filter(enough).withColumn("_all", F.lit(0))
    numbered = number_in_group(kept, ["_all"], "conv_id", "number").drop("_all")
    totals = turns.agg(F.count_if(enough).alias("kept"), F.count_if(~enough).alias("skipped"))
    return numbered, totals


def render_blocks(blocks: DataFrame) -> DataFrame:
    """Adds ``line``: the block as it stands in a transcript, clipped by kind."""
    body, kind = F.col("text"), F.col("kind")
    speaker = F.coalesce(*[F.when(F.col("role") == role, F.lit(name))
                           for role, name in fixed.SPEAKERS.items()])
    thought = F.replace(clip_text(body, fixed.THINKING_CHARS), F.lit("\n"), F.lit("\n> "))
    line = (F.when(kind == "text", F.concat(F.lit("## "), speaker, F.lit("\n\n"), strip(body),
                                            F.lit("\n")))
            .when(kind == "thinking", F.concat(F.lit(fixed.THINKING_TITLE), thought, F.lit("\n")))
            .when(kind == "tool_use", F.concat(
                F.lit("```\n" + fixed.TOOL_CALL_MARK), clip_text(body, fixed.TOOL_USE_CHARS), F.lit("\n```\n")))
            .when(kind == "tool_result", F.concat(
                F.lit("```\n"), clip_text(body, fixed.TOOL_RESULT_CHARS), F.lit("\n```\n"))))
    return (blocks.filter(F.col("role").isin(list(fixed.SPEAKERS)) & (strip(body) != ""))
            .withColumn("line", line))


def transcript_lines(blocks: DataFrame) -> DataFrame:
    """``(conv_id, turn, block, line)``: the transcripts as lines; the first line of a conversation has its title.

    Joined by a newline in order of turn and block they are the transcript. No row holds more than a block, so a
    conversation may have any length.
    """
    lines = render_blocks(blocks).select("conv_id", "turn", "block", "line")
    first = lines.groupBy("conv_id").agg(F.min(F.struct("turn", "block")).alias("_first"))
    title = F.concat(F.lit(fixed.TRANSCRIPT_TITLE), F.substring(F.col("conv_id").cast("string"), 1, 8), F.lit("\n\n"))
    opens = F.struct("turn", "block") == F.col("_first")
    return (lines.join(first, "conv_id")
            .withColumn("line", F.when(opens, F.concat(title, "line")).otherwise(F.col("line"))).drop("_first"))


def write_transcripts(blocks: DataFrame, path: str) -> None:
    """Transcripts as files of sorted lines, written by ranges of (conv_id, turn, block).

    A conversation of any length is shared out over as many files as it fills, and files read in order of their names
    hold all conversations in order.
    """
    order = ["conv_id", "turn", "block"]
    (transcript_lines(blocks).repartitionByRange(*order).sortWithinPartitions(*order)
     .write.mode("overwrite").parquet(path))


def read_transcripts(spark: SparkSession, path: str, conv_id=None) -> DataFrame:
    """The lines of all conversations or of one; the files' ranges prune the others."""
    lines = spark.read.parquet(path)
    return lines if conv_id is None else lines.filter(F.col("conv_id") == conv_id)


def render_transcript(blocks: DataFrame) -> DataFrame:
    """``(conv_id, transcript)``: each conversation as one text, for conversations that fit a row.

    ``write_transcripts`` has no such bound.
    """
    in_order = F.sort_array(F.collect_list(F.struct("turn", "block", "line")))
    return (transcript_lines(blocks).groupBy("conv_id").agg(in_order.alias("_l"))
            .select("conv_id", F.array_join("_l.line", "\n").alias("transcript")))
