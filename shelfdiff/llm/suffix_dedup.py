"""Removing byte strings that an earlier document has, by sorted suffixes in range-partitioned buckets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfdiff.llm import suffixes as S
from shelfdiff.llm.parts import give_back, tidied, tidied_pair

#: Text bytes of a block of documents and of a bucket of suffixes, and what a large corpus may raise them to.
BLOCK_BYTES = 4 << 20
LARGEST_BLOCK = 256 << 20
MOST_BUCKETS = 1 << 18

#: Documents (about) whose tokens are sampled for the splitters, and tokens taken from each.
SPLITTER_DOCS = 1024
SPLITTER_TOKENS = 64

#: Documents packed at a time.
PACKED_ROWS = 1000

#: Regions with one token, in all blocks, from which its windows are dealt one by one.
HOT_REGIONS = 1 << 13

_LAST = 2 ** 63 - 1


def _pack(**arrays: np.ndarray) -> bytes:
    head = ",".join(f"{k}:{a.dtype.str}:{'x'.join(map(str, a.shape))}" for k, a in arrays.items()).encode()
    body = b"".join(np.ascontiguousarray(a).tobytes() for a in arrays.values())
    return zstandard.ZstdCompressor(level=3).compress(len(head).to_bytes(4, "little") + head + body)


def _unpack(data: bytes) -> dict[str, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    size = int.from_bytes(raw[:4], "little")
    out, at = {}, 4 + size
    for item in raw[4:at].decode().split(","):
        name, kind, shape = item.split(":")
        shape = tuple(int(x) for x in shape.split("x"))
        n = int(np.prod(shape)) * np.dtype(kind).itemsize
        out[name] = np.frombuffer(raw, kind, count=int(np.prod(shape)), offset=at).reshape(shape)
        at += n
    return out


def _join(rows: list[dict[str, np.ndarray]], name: str) -> np.ndarray:
    return np.concatenate([r[name] for r in rows])


def _packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that go to one block as one compressed row, a few hundred documents at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, PACKED_ROWS):
            part = batch.slice(start, PACKED_ROWS)
            name, ids, hashes = (part.column(c).to_numpy(zero_copy_only=False) for c in ("block", "doc_id", "text_hash"))
            texts = part.column("text").to_pylist()
            rows = []
            for block in np.unique(name):
                at = np.flatnonzero(name == block)
                some = [(texts[i] or "").encode("utf-8", "surrogatepass") for i in at]
                rows.append(_pack(ids=ids[at].astype(np.int64), hashes=hashes[at].astype(np.int64),
                                  sizes=np.array([len(t) for t in some], np.int64),
                                  bytes=np.frombuffer(b"".join(some), np.uint8)))
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(name), pa.int32()), pa.array(rows, pa.binary())],
                                             ["block", "data"])
    give_back()


def _block_of(pdf: pd.DataFrame) -> tuple[S.Block, np.ndarray]:
    """The block, and the text hashes in its order."""
    ids, hashes, texts = [], [], []
    for data in pdf["data"]:
        row = _unpack(data)
        ends = np.cumsum(row["sizes"])
        whole = row["bytes"].tobytes()
        texts += [whole[e - n:e] for e, n in zip(ends, row["sizes"])]
        ids.append(row["ids"])
        hashes.append(row["hashes"])
    block = S.Block(np.concatenate(ids), texts)
    return block, np.concatenate(hashes)[block.order]


def _short(tokens: np.ndarray) -> np.ndarray:
    """Sorted tokens as the bytes of their steps, lowest bytes first, so that equal high bytes stand together."""
    steps = np.diff(tokens.astype("<u8"), prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :6].T)


def _long(short: np.ndarray) -> np.ndarray:
    out = np.zeros((short.shape[1], 8), np.uint8)
    out[:, :6] = short.T
    return np.cumsum(out.view("<u8").ravel().astype(np.uint64), dtype=np.uint64)


def _deal(tokens: np.ndarray, splitters: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of sorted tokens."""
    cuts = np.concatenate(([0], np.searchsorted(tokens, splitters), [len(tokens)]))
    return [(k, int(a), int(b)) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]


def _splitters(docs: DataFrame, buckets: int, n_docs: int) -> np.ndarray:
    """``buckets`` - 1 tokens that cut the tokens of a sample of documents into equal parts.

    The sample is the share of the hash range that holds about ``SPLITTER_DOCS`` documents; a few tokens of each come
    to the driver.
    """
    @F.pandas_udf("array<bigint>")
    def sample(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            token = S.Block(np.zeros(1), [(t or "").encode("utf-8", "surrogatepass")]).regions()[4]
            out.append(token[::max(1, len(token) // SPLITTER_TOKENS)][:SPLITTER_TOKENS].astype(np.int64))
        return pd.Series(out)
    share = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(9)), 11) / F.lit(float(1 << 53))
    chosen = docs.filter(share * F.lit(n_docs) <= SPLITTER_DOCS).select(sample("text").alias("tokens"))
    tokens = [t for row in chosen.collect() for t in row.tokens or []]
    if not tokens:
        return np.zeros(0, np.uint64)
    tokens = np.sort(np.array(tokens, np.uint64))
    return np.unique(tokens[(np.arange(1, buckets) * len(tokens)) // buckets])


def repeated_strings(docs: DataFrame, keep_bytes: bool = True, keep_text: bool = False) -> DataFrame:
    """doc_id, text_hash, n_bytes, spans, kept: what each document keeps without strings an earlier one has.

    A byte goes if a string of ``suffixes.LENGTH`` bytes that covers it also starts in a document with a smaller id.
    Strings are judged on the input. ``spans`` are the removed runs as (start, end) bytes, ``kept`` the other bytes
    (null unless ``keep_bytes``; a cut may fall inside a character). With ``keep_text``, ``cut`` is what is left as text,
    without characters of which a byte goes (null where nothing is removed).

    Documents are dealt into blocks. 1. Blocks send their different tokens (48-bit codes of the 16 bytes at an
    anchor) to buckets between sampled splitters; a token seen in one document alone is dropped there. 2. Blocks
    send the regions of the remaining tokens, each different one once, with the smallest and largest document that
    has it. A bucket holds all suffixes whose leading token lies between two splitters; it sorts them by multikey
    quicksort on eight-byte characters, and equal neighbours share their smallest document. The splitters are
    tokens, so equal suffixes never lie on both sides of a boundary. 3. Blocks mark the bytes. The three passes read
    one shuffle of the texts. A string that very many documents have reaches its bucket once a block. Tokens with more
    than ``HOT_REGIONS`` regions in all blocks together are split: blocks send their different windows, each by a
    128-bit hash of its ``suffixes.LENGTH`` bytes, to buckets between equal steps of the hash, so a run of 16 bytes
    that stands in many different surroundings is shared out and equal windows still meet.

    Null texts are empty. Null ids stand behind all others and come back as null; they are dealt by their texts. Rows that repeat an id never remove
    from each other. An empty table gives an empty result.
    """
    docs = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)).alias("doc_id"), "text",
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    total, n_docs = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
    buckets = max(1, min(-(-total // BLOCK_BYTES), MOST_BUCKETS))
    block_bytes = min(max(BLOCK_BYTES, 16 * (S.SPAN + 1) // 2 * buckets), LARGEST_BLOCK)
    blocks = max(1, -(-total // block_bytes))
    splitters = _splitters(docs, buckets, n_docs)
    place = F.xxhash64(F.when(F.col("doc_id") == _LAST, F.col("text_hash")).otherwise(F.col("doc_id")))
    dealt = (docs.withColumn("block", F.pmod(place, F.lit(blocks)).cast("int"))
             .mapInArrow(_packed_texts, "block int, data binary"))

    hot_regions = HOT_REGIONS
    hash_steps = np.array([(k << 64) // buckets for k in range(1, buckets)], np.uint64)

    def tokens_of(pdf: pd.DataFrame) -> pd.DataFrame:
        block, _ = _block_of(pdf)
        doc, _, _, _, token = block.regions()
        order = np.argsort(token, kind="stable")  # regions stand by document, and by id through the block's order
        token, owner = token[order], block.ids[doc[order]]
        opens = np.r_[True, token[1:] != token[:-1]] if len(token) else np.zeros(0, bool)
        head = np.flatnonzero(opens)
        several = (np.maximum.reduceat(owner, head) != np.minimum.reduceat(owner, head)) if len(head) else opens
        times = np.minimum(np.diff(np.append(head, len(token))), hot_regions + 1).astype(np.int32)
        token = token[head]
        name = int(pdf["block"].iloc[0])
        return pd.DataFrame([(name, k, _pack(token=_short(token[a:b]), several=several[a:b], times=times[a:b]))
                             for k, a, b in _deal(token, splitters)], columns=["block", "bucket", "data"])

    def shared_tokens(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [_unpack(d) for d in pdf["data"]]
        token = np.concatenate([_long(r["token"]) for r in rows])
        order = np.argsort(token, kind="stable")
        opens = np.r_[True, token[order][1:] != token[order][:-1]]
        group = np.empty(len(token), np.int64)
        group[order] = np.cumsum(opens) - 1
        shared = (np.bincount(group) > 1) | (np.bincount(group, weights=_join(rows, "several")) > 0)
        keep = shared[group]
        hot = (np.bincount(group, weights=_join(rows, "times")) > hot_regions)[group]
        ends = np.cumsum([len(r["several"]) for r in rows])
        out = [(int(b), _pack(token=_short(token[a:e][keep[a:e]]), hot=hot[a:e][keep[a:e]]))
               for b, a, e in zip(pdf["block"], np.concatenate(([0], ends[:-1])), ends) if keep[a:e].any()]
        return pd.DataFrame(out, columns=["block", "data"])

    def kept_regions(block: S.Block, passed: pd.DataFrame):
        """Regions whose token passed: their occurrences, and the different ones in a fixed order, hot or not."""
        doc, first, count, anchor, token = block.regions()
        rows = [_unpack(d) for d in passed["data"]]
        allowed = np.concatenate([_long(r["token"]) for r in rows])
        order = np.argsort(allowed, kind="stable")
        allowed, is_hot = allowed[order], _join(rows, "hot")[order]
        at = np.minimum(np.searchsorted(allowed, token), len(allowed) - 1)
        use = allowed[at] == token
        doc, first, count, anchor, token, hot = (x[use] for x in (doc, first, count, anchor, token, is_hot[at]))
        content, offset = block.bytes_of(first, count), anchor - first
        pick, number = S.distinct_regions(token, offset, count, content)
        return doc, first, count, token, offset, content, pick, number, hot[pick]

    def hot_windows(pick: np.ndarray, hot: np.ndarray, count: np.ndarray, content: np.ndarray):
        """The windows of different hot regions: number of the region, step, hashes, and their order and groups."""
        region = np.flatnonzero(hot)
        of, step, one, two = S.windows_of(region, count[pick[region]], content[pick[region]])
        return of, step, one, two, *S.groups_of(one, two)

    def regions_of(texts: pd.DataFrame, passed: pd.DataFrame) -> pd.DataFrame:
        columns = ["block", "bucket", "data"]
        if not len(texts) or not len(passed):
            return pd.DataFrame([], columns=columns)
        block, _ = _block_of(texts)
        doc, _, count, token, offset, content, pick, number, hot = kept_regions(block, passed)
        owner = block.ids[doc]
        low, high = np.full(len(pick), _LAST), np.full(len(pick), np.iinfo(np.int64).min)
        np.minimum.at(low, number, owner)
        np.maximum.at(high, number, owner)
        name, out = int(texts["block"].iloc[0]), []
        if hot.any():
            of, _, one, two, order, opens, _ = hot_windows(pick, hot, count, content)
            w_low, w_high = np.minimum.reduceat(low[of][order], opens), np.maximum.reduceat(high[of][order], opens)
            one, two = one[order][opens], two[order][opens]
            out = [(name, buckets + k, _pack(one=one[a:b], two=two[a:b], low=w_low[a:b], high=w_high[a:b],
                                             first=np.array([a])))
                   for k, a, b in _deal(one, hash_steps)]
        pick, low, high = pick[~hot], low[~hot], high[~hot]
        token, offset, count, content = token[pick], offset[pick].astype(np.uint8), count[pick].astype(np.uint8), content[pick]
        out += [(name, k, _pack(offset=offset[a:b], count=count[a:b], low=low[a:b], high=high[a:b],
                                first=np.array([a]), content=content[a:b])) for k, a, b in _deal(token, splitters)]
        return pd.DataFrame(out, columns=columns)

    def least_of_windows(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [_unpack(d) for d in pdf["data"]]
        low, high = _join(rows, "low"), _join(rows, "high")
        order, opens, number = S.groups_of(_join(rows, "one"), _join(rows, "two"))
        least = np.minimum.reduceat(low[order], opens)[number]
        use = least < high
        index = np.concatenate([r["first"][0] + np.arange(len(r["low"]), dtype=np.int32) for r in rows])
        ends = np.cumsum([len(r["low"]) for r in rows])
        out = [(int(n), 2, _pack(index=index[a:e][use[a:e]], least=least[a:e][use[a:e]]))
               for n, a, e in zip(pdf["block"], np.concatenate(([0], ends[:-1])), ends) if use[a:e].any()]
        return pd.DataFrame(out, columns=["block", "part", "data"])

    def least_of(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["bucket"].iloc[0] >= buckets:
            return least_of_windows(pdf)
        rows = [_unpack(d) for d in pdf["data"]]
        offset, count = (_join(rows, n).astype(np.int64) for n in ("offset", "count"))
        content, low, high = (_join(rows, n) for n in ("content", "low", "high"))
        token = S.tokens_in(content, offset)
        index = np.concatenate([r["first"][0] + np.arange(len(r["low"]), dtype=np.int32) for r in rows])
        source = np.repeat(np.arange(len(rows)), [len(r["low"]) for r in rows])
        row, start, stop, least = S.least_documents(token, offset, count, content, low)
        use = least < high[row]
        row, start, stop, least = row[use], start[use], stop[use], least[use]
        cuts = np.searchsorted(source[row], np.arange(len(rows) + 1))
        names = pdf["block"].to_numpy()
        return pd.DataFrame([(int(names[k]), 1, _pack(index=index[row[a:b]], start=start[a:b].astype(np.uint8),
                                                      stop=stop[a:b].astype(np.uint8), least=least[a:b]))
                             for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a], columns=["block", "part", "data"])

    def found_runs(found: pd.DataFrame, pick: np.ndarray, hot: np.ndarray, count: np.ndarray, content: np.ndarray):
        """Number of the region, first and last window and smallest document of all runs found."""
        out = []
        rows = [_unpack(d) for d in found.loc[found["part"] == 1, "data"]]
        if rows:
            index, start, stop, least = (_join(rows, n) for n in ("index", "start", "stop", "least"))
            out.append((np.flatnonzero(~hot)[index], start.astype(np.int64), stop.astype(np.int64), least))
        rows = [_unpack(d) for d in found.loc[found["part"] == 2, "data"]]
        if rows:
            of, step, _, _, _, opens, number = hot_windows(pick, hot, count, content)
            least = np.full(len(opens), _LAST)
            least[_join(rows, "index")] = _join(rows, "least")
            least = least[number]
            seen = np.flatnonzero(least < _LAST)
            of, step, least = of[seen], step[seen], least[seen]
            follows = (of[1:] == of[:-1]) & (step[1:] == step[:-1] + 1) & (least[1:] == least[:-1])
            head = np.flatnonzero(np.r_[True, ~follows])
            out.append((of[head], step[head], step[np.r_[head[1:], len(of)] - 1], least[head]))
        return (np.concatenate(x) for x in zip(*out))

    def marked(texts: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        columns = ["doc_id", "text_hash", "n_bytes", "spans", "kept", *["cut"] * keep_text]
        if not len(texts):
            return pd.DataFrame([], columns=columns)
        block, hashes = _block_of(texts)
        edges = np.zeros(block.size + 1, np.int32)
        passed, runs = found[found["part"] == 0], found[found["part"] > 0]
        if len(passed) and len(runs):
            doc, first, count, _, _, content, pick, number, hot = kept_regions(block, passed)
            index, start, stop, least = found_runs(runs, pick, hot, count, content)
            order = np.argsort(index, kind="stable")
            index, start, stop, least = index[order], start[order], stop[order], least[order]
            begin, end = np.searchsorted(index, number), np.searchsorted(index, number, side="right")
            n = end - begin
            seen = np.repeat(np.arange(len(number)), n)
            at = np.arange(len(seen)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin, n)
            later = block.ids[doc[seen]] > least[at]
            seen, at = seen[later], at[later]
            np.add.at(edges, first[seen] + start[at], 1)
            np.add.at(edges, first[seen] + stop[at] + S.LENGTH, -1)
        gone = np.cumsum(edges[:-1], dtype=np.int32) > 0
        out = []
        for i, h, a, b in zip(block.ids, hashes, block.starts, block.ends):
            part = gone[a:b]
            turns = np.flatnonzero(np.diff(np.concatenate(([0], part.view(np.int8), [0]))))
            spans = [{"start": int(x), "end": int(y)} for x, y in turns.reshape(-1, 2)]
            rest = block.data[a:b][~part].tobytes() if keep_bytes or keep_text and spans else None
            row = (i, h, b - a, spans, rest if keep_bytes else None)
            out.append((*row, rest.decode("utf-8", "ignore") if spans else None) if keep_text else row)
        return pd.DataFrame(out, columns=columns)

    tokens = dealt.groupBy("block").applyInPandas(tidied(tokens_of), "block int, bucket int, data binary")
    passed = tokens.groupBy("bucket").applyInPandas(tidied(shared_tokens), "block int, data binary")
    regions = (dealt.groupBy("block").cogroup(passed.groupBy("block"))
               .applyInPandas(tidied_pair(regions_of), "block int, bucket int, data binary"))
    runs = regions.groupBy("bucket").applyInPandas(tidied(least_of), "block int, part int, data binary")
    found = passed.withColumn("part", F.lit(0)).unionByName(runs)
    return (dealt.groupBy("block").cogroup(found.groupBy("block"))
            .applyInPandas(tidied_pair(marked), "doc_id bigint, text_hash bigint, n_bytes bigint, "
                           "spans array<struct<start:bigint,end:bigint>>, kept binary" + ", cut string" * keep_text)
            .withColumn("doc_id", F.when(F.col("doc_id") != _LAST, F.col("doc_id"))))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with texts cut by ``repeated_strings``; n_chars, where it is a column, follows the text.

    A character of which a byte goes, goes. Null texts stay null; texts of which nothing is left are empty. Rows that
    agree in id and text get the same text. All columns and rows are kept.
    """
    # the blocks decode what they cut: a function of its own would need a second Python process beside each task's first
    found = repeated_strings(docs.select("doc_id", "text"), keep_bytes=False, keep_text=True)
    cut = (found.filter(F.size("spans") > 0)
           .select(F.col("doc_id").alias("_cut_id"), "text_hash", F.col("cut").alias("_cut"))
           .dropDuplicates(["_cut_id", "text_hash"]))
    columns = docs.columns
    rows = docs.select(F.struct(*columns).alias("_doc"), F.col("doc_id").cast("bigint").alias("_id"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"))
    rows = rows.join(cut, F.col("_id").eqNullSafe(F.col("_cut_id")) & (F.col("_hash") == F.col("text_hash")), "left")
    rows = rows.withColumn("_new", F.coalesce("_cut", "_doc.text"))
    changed = {"text": F.col("_new")}
    if "n_chars" in columns:
        changed["n_chars"] = (F.when(F.col("_cut").isNull(), F.col("_doc.n_chars"))
                              .otherwise(F.char_length("_new")).cast(docs.schema["n_chars"].dataType))
    return rows.select(*[changed.get(c, F.col("_doc")[c]).alias(c) for c in columns])
