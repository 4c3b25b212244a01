"""Harmonic packing of tokenized documents into sequences."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfdiff.llm.parts import running_total
from shelfdiff.session import cut_lineage

#: Tokens of a sequence; lengths below ``SMALL`` are not cut further.
CAPACITY = 1024
SMALL = 64

#: Fixed value: where the byte-level tokenizer splits texts.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Bytes in a row without a change of kind (letters, digits, marks, white space) that the fast encoder is given at
#: most; its pattern matcher runs out of stack on longer ones.
LONGEST_RUN = 1 << 16
_LONG_RUN = re.compile(r"\s{%d}|[^\W\d_]{%d}|\d{%d}|[^\w\s]{%d}" % ((LONGEST_RUN,) * 4))

_END = np.zeros(1, "<u4").tobytes()


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers, by the byte-level BPE tokenizer in a JSON file.

    Gives the ids of the ``tokenizers`` library without special tokens added. The vocabulary and merges are read from
    the same file, but encoded by ``tiktoken``, which is four times as fast; texts that spell one of the tokenizer's
    added tokens, or have more than ``LONGEST_RUN`` letters, digits, marks or blanks in a row, go through
    ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        byte_of = _bytes_of_characters()
        ranks = {bytes(byte_of[c] for c in token): rank for token, rank in vocabulary.items()
                 if token not in self.added}
        self.fast = tiktoken.Encoding("from_file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        if any(a in text for a in self.added) or (len(text) >= LONGEST_RUN and _LONG_RUN.search(text)):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()


def _bytes_of_characters() -> dict[str, int]:
    """Byte-level vocabularies spell printable bytes as themselves and the others, in order, from code point 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def cut(n: int, capacity: int = CAPACITY, small: int = SMALL) -> list[int]:
    """Lengths a document of ``n`` tokens is cut into: whole sequences, then halves of halves, then a rest.

    Every length but the rest is the capacity divided by a power of two; the rest is shorter than ``small``.
    """
    out = [capacity] * (n // capacity)
    n %= capacity
    part = capacity // 2
    while part >= small:
        if n >= part:
            out.append(part)
            n -= part
        part //= 2
    return out + [n] if n else out


def tokenized_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, small: int = SMALL) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids (binary): the pieces documents are cut into.

    A document is its text's ids, then id 0; a null text is empty. Each row of ``docs`` gives its own pieces.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = Encoder(tokenizer).encode
        for b in batches:
            rows = []
            for doc, text in zip(b["doc_id"], b["text"]):
                ids = encode(text or "") + _END
                n, start = len(ids) // 4, 0
                for length in cut(n, capacity, small):
                    rows.append((doc, start, length, n, ids[4 * start:4 * (start + length)]))
                    start += length
                if len(rows) > 20_000:
                    yield _pieces(rows)
                    rows = []
            yield _pieces(rows)
    return docs.select("doc_id", "text").mapInPandas(
        run, "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary")


def _pieces(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "doc_tokens", "ids"])
    return out.astype({"doc_id": "Int64"})


def size_class(length: Column, capacity: int = CAPACITY) -> Column:
    """Class k holds lengths over capacity / (k + 1) and up to capacity / k: k of them always fit a bin."""
    return F.floor(F.lit(capacity) / length).cast("int")


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset.

    Pieces of class k (see ``size_class``) are numbered, k in a row share a sequence, wherever they are: a piece's
    sequence and place follow from its number, so workers fill bins independently, and a class of any size is
    numbered by many tasks. At most k - 1 pieces of a class are left over; those of all classes, a number that
    depends on the capacity alone, are packed together in one task by first fit, largest first.

    Sequence ids have gaps between the classes; the order of pieces depends on their hashes alone. An empty table
    gives an empty result.
    """
    rows = cut_lineage(pieces.withColumn("_class", size_class(F.col("length"), capacity))
                       .withColumn("_spread", F.xxhash64("doc_id", "start", "length")))
    extra = [c for c in pieces.columns if c not in ("doc_id", "start", "length")]
    ties = [c for c, kind in pieces.select("doc_id", "start", *extra).dtypes if not kind.startswith(("map", "variant"))]
    rows = cut_lineage(running_total(rows, ["_class"], "_spread", ties=ties, before="_number", total="_all"))
    whole = F.col("_number") < F.expr("(_all div _class) * _class")
    # class k owns ids from k * 2^40 upwards; the left-over pieces those of class 0
    bins = rows.filter(whole).withColumn(
        "sequence_id", F.col("_class").cast("bigint") * (1 << 40) + F.expr("_number div _class"))
    inside = Window.partitionBy("sequence_id").orderBy("_number")
    bins = bins.withColumn("offset", F.sum("length").over(inside) - F.col("length"))
    rest = rows.filter(~whole)

    def first_fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "_spread", "_number"], ascending=[False, True, True], kind="stable")
        filled, seats = [], []
        for n in pdf["length"]:
            k = next((i for i, used in enumerate(filled) if used + n <= capacity), len(filled))
            if k == len(filled):
                filled.append(0)
            seats.append((k, filled[k]))
            filled[k] += int(n)
        return pd.DataFrame({"_class": pdf["_class"], "_number": pdf["_number"],
                             "sequence_id": [s[0] for s in seats], "offset": [s[1] for s in seats]})
    seats = rest.select("_class", "_number", "length", "_spread", F.lit(0).alias("_one")).groupBy("_one").applyInPandas(
        first_fit, "_class int, _number bigint, sequence_id bigint, offset bigint")
    left = rest.join(seats, ["_class", "_number"])
    columns = [*pieces.columns, "sequence_id", "offset"]
    return bins.select(*columns).unionByName(left.select(*columns))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, small: int = SMALL) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: where every piece lies.

    Only numbers are shuffled; ``sequences`` joins the ids to them where they are wanted.
    """
    pieces = tokenized_pieces(docs, tokenizer, capacity, small)
    return place(pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"), capacity)


def sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, small: int = SMALL) -> DataFrame:
    """sequence_id, length, ids, pieces: the packed sequences themselves.

    ids is an array padded with id 0 to the capacity, or not at all where the length is a power of two. pieces tells
    the document, start, length and offset of each.
    """
    placed = place(tokenized_pieces(docs, tokenizer, capacity, small), capacity)
    bins = placed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids"))).alias("pieces"))

    @F.pandas_udf("array<bigint>")
    def joined(parts: pd.Series) -> pd.Series:
        out = []
        for p in parts:
            ids = np.frombuffer(b"".join(x["ids"] for x in p), "<u4").astype(np.int64)
            n = len(ids)
            out.append(ids if n & (n - 1) == 0 else np.pad(ids, (0, capacity - n)))
        return pd.Series(out)
    return bins.select("sequence_id", "length", joined(F.transform("pieces", lambda p: F.struct(p["ids"].alias("ids"))))
                       .alias("ids"), F.transform("pieces", lambda p: F.struct(
                           p["doc_id"].alias("doc_id"), p["start"].alias("start"), p["length"].alias("length"),
                           p["offset"].alias("offset"))).alias("pieces"))
