"""Prefix trie of conversations by burst containers: which conversations begin alike, and what sharing would save."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfdiff.llm.parts import word_count
from shelfdiff.session import cut_lineage

#: Sequences of a container before it bursts, and rounds of bursting; conversations of a chunk of ids.
CONTAINER = 64
ROUNDS = 12
CHUNK_IDS = 4096

#: Bytes of a turn id (SHA-256) and of a word count in packed sequences.
ID, COUNT = 32, 4

#: Fixed values of the rebuilding: conversations of a family, and turns that may come from its first.
FAMILY, INHERITED = 20, 4

_NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, " \
        "saved_tokens bigint, ends_sha256 string"
_EMPTY = hashlib.sha256(b"").hexdigest()


def sequences(turns: DataFrame) -> DataFrame:
    """conv_id, ids, words (binary): every conversation as packed turn ids and word counts.

    A turn id is the SHA-256 of role and text. Turns stand by turn (null first), rows of one turn by their ids. Null
    roles and texts are empty; a null conv_id is a conversation. A conversation is one row, 36 bytes a turn.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = turns.select("conv_id", "turn", word_count(text).alias("words"), F.unhex(F.sha2(
        F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("id"))
    packed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id", "words"))).alias("t"))
    return packed.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.unhex(F.array_join(F.transform("t", lambda t: F.hex(t["id"])), "")).alias("ids"),
        F.unhex(F.array_join(F.transform("t", lambda t: F.lpad(F.hex(t["words"]), 2 * COUNT, "0")), "")).alias("words"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """``sequences`` in which the first turns come from the family's first conversation.

    Conversation c takes the first h turns of conversation c - c % 20 (all if fewer, none if absent) and then its own
    behind its first h; h is crc32 of c in decimal modulo 4. A null c takes none.
    """
    own = sequences(turns)
    heads = own.filter(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("family"),
        F.substr("ids", F.lit(1), F.lit(ID * (INHERITED - 1))).alias("head_ids"),
        F.substr("words", F.lit(1), F.lit(COUNT * (INHERITED - 1))).alias("head_words"))
    h = F.coalesce(F.crc32(F.col("conv_id").cast("string")) % INHERITED, F.lit(0)).cast("int")
    met = own.withColumns({"h": h, "family": F.expr(f"conv_id - conv_id % {FAMILY}")}).join(heads, "family", "left")
    none = F.lit(b"")
    return met.select("conv_id", *[
        F.concat(F.substr(F.coalesce(f"head_{c}", none), F.lit(1), F.col("h") * width),
                 F.substr(c, F.col("h") * width + 1, F.lit(2 ** 31 - 1))).alias(c)
        for c, width in (("ids", ID), ("words", COUNT))])


def classes(conversations: DataFrame) -> DataFrame:
    """ids, words, n, low, ends: conversations with equal sequences as one row.

    ``n`` counts them, ``low`` is their smallest id, ``ends`` the SHA-256 of all ids, ascending and comma-joined. Ids
    are put together in chunks of at most ``CHUNK_IDS`` by value first, so the task that hashes a class of any size
    reads a row a chunk, one after the other. A null id is counted and has no decimal.
    """
    chunk = F.floor(F.col("conv_id") / CHUNK_IDS)
    parts = conversations.groupBy("ids", chunk.alias("chunk")).agg(
        F.first("words").alias("words"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"),
        F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("said"))
    rows = parts.repartition("ids").sortWithinPartitions("ids", "chunk")
    schema = pa.schema([("ids", pa.binary()), ("words", pa.binary()), ("n", pa.int64()), ("low", pa.int64()),
                        ("ends", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, digest = None, None
        for batch in batches:
            out = []
            for ids, words, n, low, said in zip(*[batch.column(c).to_pylist() for c in ("ids", "words", "n", "low", "said")]):
                if held is None or held[0] != ids:
                    if held:
                        out.append((*held, digest.hexdigest()))
                    held, digest, first = [ids, words, 0, None], hashlib.sha256(), True
                held[2] += n
                held[3] = low if held[3] is None else held[3]
                if said:
                    digest.update(said.encode() if first else b"," + said.encode())
                    first = False
            yield _rows(out, schema)
        yield _rows([(*held, digest.hexdigest())] if held else [], schema)
    return rows.mapInArrow(run, "ids binary, words binary, n bigint, low bigint, ends string")


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)],
                                      schema=schema)


def _shared(a: bytes, b: bytes) -> int:
    """Turns that two packed sequences begin with in common."""
    low, high = 0, min(len(a), len(b)) // ID
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid * ID] == b[:mid * ID] else (low, mid - 1)
    return low


def burst(found: DataFrame, container: int = CONTAINER, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame | None]:
    """(sequences in their containers, burst heads) of ``classes``.

    All sequences begin in the container of the root. A container with more than ``container`` sequences bursts: its
    head runs on as far as all of them agree (the smallest and the largest sequence tell), and each next turn id
    behind that becomes the head of a container of its own. Copies are one sequence, so a container always parts.
    Sequences know the heads above them (``path``) and the smallest conversation of the last one (``parent_low``).
    Bursting ends when no container is too large, or after ``rounds``; what is then large is only swept by fewer tasks.
    """
    @F.pandas_udf("int")
    def agree(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([_shared(x, y) for x, y in zip(a, b)], dtype="int32")
    state = found.withColumns({
        "head": F.unhex(F.sha2(F.lit(b""), 256)), "depth": F.lit(0), "parent_low": F.lit(None).cast("bigint"),
        "path": F.array().cast("array<binary>")})
    state = cut_lineage(state)
    settled, heads = [], []
    for _ in range(rounds):
        large = (state.groupBy("head").agg(
            F.count(F.lit(1)).alias("sequences"), F.first("depth").alias("depth"), F.first("path").alias("path"),
            F.first("parent_low").alias("parent_low"), F.sum("n").alias("n"), F.min("low").alias("low"),
            F.min(F.struct("ids", "words")).alias("least"), F.max("ids").alias("most"))
            .filter(F.col("sequences") > container).withColumn("upto", agree("least.ids", "most")))
        large = cut_lineage(large)
        if large.isEmpty():
            break
        mark = large.select("head", "upto", F.col("low").alias("head_low"))
        state = cut_lineage(state.join(mark, "head", "left"))
        columns = [c for c in state.columns if c not in ("upto", "head_low")]
        settled.append(state.filter("upto IS NULL").select(*columns))
        ended = state.filter(F.octet_length("ids") == F.col("upto") * ID).select("head", "ends")
        heads.append(cut_lineage(large.select("head", "depth", "upto", "path", "parent_low", "n", "low",
                                              F.col("least.words").alias("words")).join(ended, "head", "left")))
        state = (state.filter(F.octet_length("ids") > F.col("upto") * ID)
                 .withColumns({"path": F.concat("path", F.array("head")), "parent_low": F.col("head_low"),
                               "depth": F.col("upto") + 1,
                               "head": F.unhex(F.sha2(F.substr("ids", F.lit(1), (F.col("upto") + 1) * ID), 256))})
                 .select(*columns))
    return reduce(DataFrame.unionByName, [*settled, state]), reduce(DataFrame.unionByName, heads) if heads else None


def sweep(contained: DataFrame) -> DataFrame:
    """Nodes of all containers (``path`` null) and a row for each container (``path``, n_leaves, saved_tokens).

    Containers are sorted by Spark and read once: the open nodes of the present sequence stand on a stack, with their
    closed children waiting for the parent's smallest conversation. Memory is that of one path and its children.
    """
    rows = contained.repartition("head").sortWithinPartitions("head", "ids")
    names = ["head", "depth", "ids", "words", "n", "low", "ends", "parent_low", "path"]
    schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
                        ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
                        ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("path", pa.list_(pa.binary()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        stack: list[list] = []  # low, n, children, leaves, saved, ends, words, waiting rows
        head, before, top, above, path = None, b"", 0, None, None

        def close(down_to: int) -> None:
            while len(stack) > down_to:
                low, n, children, leaves, saved, ends, words, waiting = stack.pop()
                leaves, saved = leaves if children else 1, saved + (n - 1) * words
                out.extend((*r[:2], low, *r[2:], None) for r in waiting)
                row = (low, top + len(stack), n, children, leaves, saved, ends)
                if not stack:
                    out.append((*row[:2], above, *row[2:], None))
                    out.append((None, None, None, None, None, leaves, saved, None, path))
                    continue
                parent = stack[-1]
                parent[0] = low if parent[0] is None or (low is not None and low < parent[0]) else parent[0]
                parent[1] += n
                parent[2] += 1
                parent[3] += leaves
                parent[4] += saved
                parent[7].append(row)
        for batch in batches:
            for h, depth, ids, words, n, low, ends, parent_low, up in zip(*[batch.column(c).to_pylist() for c in names]):
                if h != head:
                    close(0)
                    head, top, above, path, before = h, depth, parent_low, up, b""
                else:
                    close(_shared(before, ids) - top + 1)
                for k in range(top + len(stack), len(ids) // ID + 1):
                    said = int.from_bytes(words[COUNT * (k - 1):COUNT * k], "big") if k else 0
                    stack.append([None, 0, 0, 0, 0, _EMPTY, said, []])
                stack[-1][0], stack[-1][1], stack[-1][5] = low, n, ends
                before = ids
            if len(out) > 5_000:
                yield _rows(out, schema)
                out.clear()
        close(0)
        yield _rows(out, schema)
    return rows.select(*names).mapInArrow(run, _NODE + ", path array<binary>")


def prefix_nodes(conversations: DataFrame, container: int = CONTAINER, rounds: int = ROUNDS) -> DataFrame:
    """The nodes of the trie of ``sequences``: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    A node is a different beginning of d turns; its conv_id is the smallest conversation that begins so (null if all
    have a null id, as has the parent of the root). saved_tokens sums, over the node and all below it, the words of
    its last turn for every conversation but one. An empty table has no node. Heads that burst get leaves and savings
    from a table of (head, container), summed.
    """
    contained, heads = burst(classes(conversations), container, rounds)
    swept = sweep(contained)
    columns = [c.split()[0] for c in _NODE.split(", ")]
    if heads is None:
        return swept.filter("path IS NULL").select(*columns)
    swept, heads = cut_lineage(swept), cut_lineage(heads)
    schema = pa.schema([("head", pa.binary()), ("path", pa.list_(pa.binary())), ("saved", pa.int64())])

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _rows([(r["head"], r["path"], sum((r["n"] - 1) * w for w in _words(r))) for r in batch.to_pylist()],
                        schema)
    saved = heads.mapInArrow(own, "head binary, path array<binary>, saved bigint")
    zero = F.lit(0).cast("bigint")
    facts = (swept.filter("path IS NOT NULL").select("path", F.col("n_leaves").alias("leaves"),
                                                     F.col("saved_tokens").alias("saved"))
             .unionByName(saved.select("path", zero.alias("leaves"), "saved")))
    below = (facts.select(F.posexplode("path").alias("at", "head"), (F.size("path") - 1).alias("last"), "leaves", "saved")
             .groupBy("head").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
                                  F.count_if(F.col("at") == F.col("last")).alias("children")))

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([(c, pa.string() if c == "ends_sha256" else pa.int64()) for c in columns])
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                total = r["saved"]
                for depth, words in zip(range(r["upto"], r["depth"] - 1, -1), reversed(_words(r))):
                    total += (r["n"] - 1) * words
                    last = depth == r["upto"]
                    out.append((r["low"], depth, r["parent_low"] if depth == r["depth"] else r["low"], r["n"],
                                r["children"] if last else 1, r["leaves"], total,
                                (r["ends"] if last else None) or _EMPTY))
            yield _rows(out, kinds)
    return swept.filter("path IS NULL").select(*columns).unionByName(
        heads.join(below, "head").mapInArrow(chain, _NODE))


def _words(head: dict) -> list[int]:
    """Words of the turns of a head's nodes, from its first depth to its last; the root has none."""
    words = head["words"]
    return [int.from_bytes(words[COUNT * (k - 1):COUNT * k], "big") if k else 0
            for k in range(head["depth"], head["upto"] + 1)]
