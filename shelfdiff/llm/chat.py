"""Chat formatting in budgeted windows, and reading the formatted text back. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfdiff.llm.parts import word_count

#: Tokens (words and one for the marker) of a window's new turns, and of earlier turns repeated before them.
STEP_TOKENS = 384
HISTORY_TOKENS = 96

#: The template. ``<`` stands nowhere but in markers; texts and roles are escaped.
OPEN, MIDDLE, CLOSE = "<turn ", ">", "</turn>\n"
ESCAPES = (("\\", "\\e"), ("<", "\\l"), (">", "\\g"))


def escape(text: Column) -> Column:
    """Backslash, ``<`` and ``>`` as backslash and a letter: no marker can be spelled inside a text."""
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    """The inverse of ``escape``: the backslash comes last, so a doubled one is not read twice."""
    for plain, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def format_windows(turns: DataFrame, step: int = STEP_TOKENS, history: int = HISTORY_TOKENS) -> DataFrame:
    """Windows of whole turns: conv_id, window, text, n_repeated, loss (array of start, length in code points).

    Prefix sums of turn tokens place turns: a turn is new in window ``floor(tokens before it / step)``, so a window
    holds turns that begin within ``step`` tokens and none is cut. A first turn with role ``system`` costs nothing
    and is repeated in every window. Turns that begin at most ``history`` tokens before a window (``history`` <=
    ``step``) are repeated in it. The loss mask covers the texts of new assistant turns alone, so a repeated target
    is masked. Numbers of windows may have gaps where one turn is longer than ``step``.

    Turns stand by turn number (null first), then role and text; repeated rows are turns of their own. Null roles and
    texts are empty, a null conv_id is a conversation. A conversation is one text in the end and the unit of work;
    its turns are sorted by Spark, not gathered. An empty table gives no windows.
    """
    if history > step:
        raise ValueError("history must not exceed the step")
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("place", F.row_number().over(order) - 1)
    system = (F.col("place") == 0) & (F.col("role") == "system")
    rows = rows.withColumns({
        "tokens": F.when(system, F.lit(0).cast("bigint")).otherwise(word_count(F.col("text")) + 1),
        "system": F.when(system, F.col("text"))})
    seat = Window.partitionBy("conv_id").orderBy("place")
    rows = rows.withColumn("before", F.sum("tokens").over(seat) - F.col("tokens"))
    rows = rows.withColumn("window", F.expr(f"before div {step}"))
    rows = rows.withColumns({
        "opens": F.lag("window").over(seat).isNull() | (F.lag("window").over(seat) != F.col("window")),
        "system": F.first("system").over(seat.rowsBetween(Window.unboundedPreceding, 0)),
        "is_system": system})
    behind = (Window.partitionBy("conv_id").orderBy(F.desc("place"))
              .rowsBetween(Window.unboundedPreceding, -1))
    ahead = F.last(F.when(F.col("opens"), F.struct("window", "before")), ignorenulls=True).over(behind)
    rows = rows.withColumn("ahead", ahead)

    def piece(window: Column, place: Column, new: bool, role: Column, text: Column) -> Column:
        return F.struct(window.alias("window"), place.alias("place"), F.lit(new).alias("new"),
                        F.concat(F.lit(OPEN), escape(role), F.lit(MIDDLE)).alias("head"),
                        escape(text).alias("body"),
                        (F.lit(new) & (role == "assistant")).alias("target"))
    repeated = ~F.col("is_system") & (F.col("ahead.before") - F.col("before") <= history)
    pieces = F.array_compact(F.array(
        piece(F.col("window"), F.col("place"), True, F.col("role"), F.col("text")),
        F.when(repeated, piece(F.col("ahead.window"), F.col("place"), False, F.col("role"), F.col("text"))),
        F.when(F.col("opens") & (F.col("window") > 0) & F.col("system").isNotNull(),
               piece(F.col("window"), F.lit(0), False, F.lit("system"), F.col("system")))))
    out = rows.select("conv_id", F.inline(pieces))
    inside = Window.partitionBy("conv_id", "window").orderBy("place")
    length = F.char_length("head") + F.char_length("body") + len(CLOSE)
    out = out.withColumn("start", F.sum(length).over(inside) - length + F.char_length("head"))
    return (out.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(F.struct(
            "place", F.concat("head", "body", F.lit(CLOSE)).alias("piece"),
            F.when(F.col("target"), F.struct(F.col("start").cast("int").alias("start"),
                                             F.char_length("body").alias("length"))).alias("loss")))).alias("parts"),
        F.count_if(~F.col("new")).cast("int").alias("n_repeated"))
        .select("conv_id", "window", F.array_join(F.col("parts.piece"), "").alias("text"), "n_repeated",
                F.array_compact(F.col("parts.loss")).alias("loss")))


def read_turns(windows: DataFrame) -> DataFrame:
    """The turns a formatted table holds, each once: conv_id, window, place, role, text."""
    pieces = windows.select("conv_id", "window", "n_repeated",
                            F.posexplode(F.split("text", CLOSE)).alias("place", "piece"))
    halves = F.split(F.substring(F.col("piece"), len(OPEN) + 1, 2 ** 31 - 1), MIDDLE, 2)
    return (pieces.filter((F.col("piece") != "") & (F.col("place") >= F.col("n_repeated")))
            .select("conv_id", "window", "place", unescape(halves[0]).alias("role"),
                    unescape(halves[1]).alias("text")))


def read_loss(windows: DataFrame) -> DataFrame:
    """The text under the loss mask of each window, unescaped: conv_id, window, loss_text, chars of the window."""
    spans = F.transform("loss", lambda s: unescape(F.substr(F.col("text"), s["start"] + 1, s["length"])))
    return windows.select("conv_id", "window", F.array_join(spans, "").alias("loss_text"),
                          F.char_length("text").cast("bigint").alias("chars"))


def digests(windows: DataFrame) -> DataFrame:
    """One row a conversation, read back from the formatted text: counts and hashes of turns and loss."""
    def joined(rows: Column) -> Column:
        return F.array_join(F.transform(F.sort_array(F.collect_list(rows)), lambda r: r["said"]), "")
    turns = read_turns(windows).groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.sha2(joined(F.struct("window", "place",
                               F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("said"))), 256)
        .alias("turns_sha256"))
    loss = read_loss(windows).groupBy("conv_id").agg(
        joined(F.struct("window", F.col("loss_text").alias("said"))).alias("loss_text"),
        F.sum("chars").alias("formatted_chars")).withColumnRenamed("conv_id", "c")
    return (turns.join(loss, F.col("conv_id").eqNullSafe(F.col("c")))
            .select("conv_id", "n_turns", "turns_sha256",
                    F.char_length("loss_text").cast("bigint").alias("loss_chars"),
                    F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars"))
