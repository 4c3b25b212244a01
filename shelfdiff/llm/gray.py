"""SimHash near-duplicates through a Gray-order hierarchical index; near-copies by exact similarity of shingles."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfdiff.llm import bits
from shelfdiff.llm.components import connected_components
from shelfdiff.llm.parts import give_back, tidied
from shelfdiff.session import cut_lineage, scratch_path

#: Shingle width and radius of the exact index; leading bits of a top node; rows of a node before it is cut.
WIDTH = 3
RADIUS = 3
LEAD = 16
SLICE = 100_000

#: For near-copies: words of a shingle, similarity, nodes of a token that are compared with all others of it first.
NEAR_WIDTH = 5
NEAR_SIMILARITY = 0.8
LEADERS = 4

#: Documents (about) whose shingles are counted to put common ones last, and how many common ones are told apart.
ORDER_DOCS = 8192
ORDER_SHINGLES = 1 << 16

#: Shingles (about) of a bucket of the sieve, documents packed at a time, and most bits of a parity map.
SIEVE_TOKENS = 500_000
PACKED_DOCS = 1000
PARITY_BITS = 1 << 16

#: So many texts are asked for by a broadcast of their hashes (16 bytes each); more of them by a shuffle of the texts.
ASKED_TEXTS = 1_000_000


def shingle_prints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, print (64 bits): a bit is set if over half of the shingle hashes have it. Null texts are empty."""
    @F.pandas_udf("bigint")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([bits.majority_bits(bits.shingle_hashes(t, width)) for t in texts],
                                  np.uint64).view(np.int64))
    return docs.select("doc_id", prints("text").alias("print"))


def _orders(tables: int) -> list[np.ndarray]:
    """Bit orders of the tables: four that bring each quarter in front, then seeded ones."""
    straight = np.arange(64)
    rng = np.random.default_rng(5)
    return [np.roll(straight, -LEAD * t) if t < 4 else rng.permutation(64) for t in range(tables)]


def _arrange(prints: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The prints with bit order[0] (counted from the highest) in front, then order[1], ..."""
    planes = np.unpackbits(prints.astype(">u8").view(np.uint8)).reshape(-1, 64)
    return np.ascontiguousarray(np.packbits(planes[:, order], axis=1)).view(">u8").ravel().astype(np.uint64)


def _in_tables(nodes: DataFrame, tables: int) -> DataFrame:
    """A row per table: node, table, lead (the first bits in the table's order), pattern (all of them)."""
    orders = _orders(tables)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            prints = b["print"].to_numpy(np.int64).view(np.uint64)
            for t, order in enumerate(orders):
                p = _arrange(prints, order)
                yield pd.DataFrame({"node": b["node"], "table": t,
                                    "lead": (p >> np.uint64(64 - LEAD)).astype(np.int32), "pattern": p.view(np.int64)})
    return nodes.select("node", "print").mapInPandas(deal, "node bigint, table int, lead int, pattern bigint")


def near_links(nodes: DataFrame, tables: int, radius: int, slice_rows: int = SLICE) -> DataFrame:
    """Links a, b that span the groups of near nodes: near ones reach each other, not every pair is a row.

    ``nodes`` has node and print (64 bits); each node is one row. In every table nodes
    with the same leading bits share a top node of the index; top nodes are dealt to tasks, searched in Gray order
    and joined up inside the task, so a group of n near nodes leaves n - 1 links a table and not n squared. With
    four tables and a radius of three the search is exact: one quarter of two such prints is equal.

    A top node with more than ``slice_rows`` rows is cut into slices and every two slices are searched in a task of
    their own, so no task holds more than two slices of one node.
    """
    rows = _in_tables(nodes, tables)
    rows = rows.withColumns({"lo": F.lit(0), "hi": F.lit(0)})
    hot = rows.groupBy("table", "lead").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > slice_rows)
    hot = cut_lineage(hot)
    if hot.limit(1).count():
        parts = F.ceil(F.coalesce("n", F.lit(1)) / slice_rows).cast("int")
        own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
        rows = (rows.drop("lo", "hi").join(hot, ["table", "lead"], "left").withColumn("parts", parts)
                .withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
                .withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}))
    cell = ["table", "lead", "lo", "hi"]
    rows = rows.select("node", "pattern", *cell)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _whole_cells(batches, cell, slice_rows):
            yield _search(group, radius)
    return rows.repartition(*cell).sortWithinPartitions(*cell).mapInPandas(search, "a bigint, b bigint")


def _whole_cells(batches: Iterator[pd.DataFrame], cell: list[str], rows: int) -> Iterator[pd.DataFrame]:
    """Sorted batches put together to about ``rows`` rows and cut where the table or slice changes or a cell ends."""
    held: list[pd.DataFrame] = []
    for b in batches:
        held.append(b)
        if sum(map(len, held)) < rows:
            continue
        pdf = pd.concat(held, ignore_index=True)
        keys = pdf[cell].to_numpy(np.int64)
        last = np.flatnonzero((keys != keys[-1]).any(axis=1))
        if len(last):
            yield from _by_table(pdf.iloc[:last[-1] + 1])
            pdf = pdf.iloc[last[-1] + 1:]
        held = [pdf]
    if held:
        yield from _by_table(pd.concat(held, ignore_index=True))


def _by_table(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    for _, part in pdf.groupby(["table", "lo", "hi"], sort=False):
        yield part


def _search(group: pd.DataFrame, radius: int) -> pd.DataFrame:
    patterns = group["pattern"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(bits.gray_rank(patterns), kind="stable")
    patterns, node = patterns[order], group["node"].to_numpy(np.int64)[order]
    forest = bits.Forest(len(node))
    for i, j in bits.close_pairs(patterns, radius, LEAD):
        forest.link(i, j)
    hung = np.flatnonzero(forest.label != np.arange(len(node)))
    return pd.DataFrame({"a": node[hung], "b": node[forest.label[hung]]})


def near_components(docs: DataFrame) -> DataFrame:
    """doc_id, print, component_id: documents whose prints are linked at ``RADIUS`` bits or fewer.

    component_id is the smallest id that links lead to, the document's own included. The nodes are the distinct
    prints, so copies of a text are one node. Null texts and texts without words have print zero and are linked like
    any other. A null doc_id is never the smallest; a component of null ids alone has component_id null. Repeated
    rows each get a row. An empty table gives an empty result.
    """
    prints = cut_lineage(shingle_prints(docs))
    nodes = prints.select(F.col("print").alias("node"), "print").distinct()
    roots = connected_components(near_links(nodes, 4, RADIUS))
    classes = prints.groupBy("print").agg(F.min("doc_id").alias("low"))
    rooted = (classes.join(roots, F.col("print") == F.col("node"), "left")
              .select("print", "low", F.coalesce("root", "print").alias("root")))
    least = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(least, "root").select("print", "component_id")
    return prints.join(named, "print").select("doc_id", "print", "component_id")


def as_text(column: str) -> Column:
    """16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def _texts(batch: pa.RecordBatch) -> Iterator[str | None]:
    """The texts of a batch, one at a time, so no second copy of all of them is held."""
    return (t.as_py() for t in batch.column("text"))


def _shingle_set(text: str | None) -> np.ndarray:
    """The different five-word shingles of a text as sorted 64-bit hashes."""
    runs = list(bits.shingle_hashes(text, NEAR_WIDTH))
    return np.unique(np.concatenate(runs)) if runs else np.zeros(0, np.uint64)


def _common_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several documents of a sample have, sorted, and how many have them; they only set an order."""
    @F.pandas_udf("array<bigint>")
    def shingles(texts: pd.Series) -> pd.Series:
        return pd.Series([_shingle_set(t).view(np.int64) for t in texts])
    share = F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(9)), 11) / F.lit(float(1 << 53))
    chosen = docs.filter(share * F.lit(docs.count()) <= ORDER_DOCS).select(F.explode(shingles("text")).alias("token"))
    found = (chosen.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n >= 3")
             .orderBy(F.desc("n"), "token").limit(ORDER_SHINGLES).collect())
    token = np.array([r.token for r in found], np.int64).view(np.uint64)
    order = np.argsort(token)
    return token[order], np.array([r.n for r in found], np.int64)[order]


def _prefix(found: np.ndarray, common: np.ndarray, often: np.ndarray, similarity: float) -> np.ndarray:
    """The shingles, rarest first, of which a set of that similarity must share one."""
    level = np.zeros(len(found), np.int64)
    if len(common) and len(found):
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        level = np.where(common[at] == found, often[at], 0)
    size = len(found) - math.ceil(similarity * len(found) - 1e-9) + 1 if len(found) else 0
    return found[np.lexsort((found, level))[:size]]


def _mixed(rows: DataFrame, name: str, more_than: int) -> DataFrame:
    """Tokens of more than so many rows that differ in ``name``."""
    return (rows.groupBy("token").agg(F.count(F.lit(1)).alias("_n"), F.min(name).alias("_low"), F.max(name).alias("_high"))
            .filter((F.col("_low") < F.col("_high")) & (F.col("_n") > more_than)).select("token"))


def _parity(found: np.ndarray) -> bytes:
    """A bit for each place that an odd number of the shingles hash to; about a place a shingle."""
    places = 64
    while places < min(len(found), PARITY_BITS):
        places *= 2
    odd = np.bincount((found & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _apart(a: bytes, b: bytes) -> int:
    """Bits in which two parity maps differ, at most the number of shingles that only one of the sets has.

    The longer map is folded to the length of the shorter, which gives the map that it would have at that length.
    """
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    short = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(v.reshape(-1, short), axis=0) for v in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def _possible(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sizes and parity maps do not rule the similarity out; no similar pair is lost.

    Two sets of that similarity differ in at most (1 - s) / (1 + s) of the sum of their sizes.
    """
    share = (1 - similarity) / (1 + similarity)

    @F.pandas_udf("boolean")
    def near(a: pd.Series, b: pd.Series, total: pd.Series) -> pd.Series:
        return pd.Series([_apart(x, y) <= t * share + 1e-6 for x, y, t in zip(a, b, total)], dtype=bool)
    maps = nodes.select("node", "size", "parity")
    met = (pairs.join(maps.select(F.col("node").alias("b"), F.col("size").alias("_n"), F.col("parity").alias("_b")), "b")
           .join(maps.select(F.col("node").alias("a"), F.col("size").alias("_m"), F.col("parity").alias("_a")), "a"))
    close = F.least("_m", "_n") >= F.greatest("_m", "_n") * similarity - 1e-6
    return met.filter(close).filter(near("_a", "_b", F.col("_m") + F.col("_n"))).select("a", "b")


def _similar(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose different shingles are similar: counted, not estimated.

    Parity maps rule out what they can. For the rest the texts travel, packed, as they take a third of the room of
    their shingles' hashes; a node's text is written once and met by joins, whose hot keys Spark splits.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            packed = [zlib.compress((t or "").encode("utf-8", "surrogatepass"), 6) for t in _texts(b)]
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(packed, pa.binary())], ["node", "packed"])
        give_back()

    def shingles(packed: bytes) -> np.ndarray:
        return _shingle_set(zlib.decompress(packed).decode("utf-8", "surrogatepass"))

    @F.pandas_udf("double")
    def alike(series: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        name, first = None, None
        for leader, a, b in series:
            out = []
            for k, x, y in zip(leader, a, b):
                if k != name:
                    name, first = k, shingles(x)
                second = shingles(y)
                both = len(np.intersect1d(first, second, assume_unique=True))
                out.append(both / (len(first) + len(second) - both) if len(first) + len(second) else 1.0)
            yield pd.Series(out, dtype=float)
        give_back()
    pairs = cut_lineage(_possible(pairs, nodes, similarity))
    asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = cut_lineage(nodes.join(asked, "node", "left_semi").select("node", "text_hash"))
    if texts.count() <= ASKED_TEXTS:
        texts = F.broadcast(texts)
    path = scratch_path(docs.sparkSession, "near-texts")
    (docs.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text").join(texts, "text_hash")
     .groupBy("node").agg(F.first("text").alias("text")).mapInArrow(pack, "node bigint, packed binary")
     .write.parquet(path))
    packed = docs.sparkSession.read.parquet(path)
    met = (pairs.join(packed.select(F.col("node").alias("b"), F.col("packed").alias("_b")), "b")
           .join(packed.select(F.col("node").alias("a"), F.col("packed").alias("_a")), "a"))
    return met.filter(alike("a", "_a", "_b") >= similarity).select("a", "b")


_PACKED = [("bucket", pa.int32())] + [(c, pa.binary()) for c in ("nodes", "sizes", "counts", "tokens")]


def _pack_tokens(texts: Iterator[str | None], common: np.ndarray, often: np.ndarray, hot: np.ndarray, similarity: float,
                 buckets: int) -> pd.DataFrame:
    """A row per bucket: nodes, sizes, numbers of tokens, then the tokens (32 bits of each), as packed arrays."""
    held: dict[int, tuple[int, np.ndarray]] = {}
    for t in texts:
        found = _shingle_set(t)
        name = bits.set_hash(found)
        if name not in held:
            tokens = _prefix(found, common, often, similarity)
            held[name] = len(found), tokens[~np.isin(tokens, hot)]
    nodes = np.fromiter(held, np.uint64, len(held))
    sizes = np.fromiter((n for n, _ in held.values()), np.int32, len(held))
    token = np.concatenate([t for _, t in held.values()]) if held else np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(held)), [len(t) for _, t in held.values()])
    bucket = ((token >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    token, doc, bucket = token[order].astype(np.uint32), doc[order], bucket[order]
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    out = []
    for low, high in zip(cuts, [*cuts[1:], len(bucket)]):
        own, counts = np.unique(doc[low:high], return_counts=True)
        out.append((int(bucket[low]), nodes[own].tobytes(), sizes[own].tobytes(), counts.astype(np.int32).tobytes(),
                    token[low:high].tobytes()))
    return pd.DataFrame(out, columns=["bucket", "nodes", "sizes", "counts", "tokens"])


def _meet(pdf: pd.DataFrame) -> pd.DataFrame:
    """token, node, size: the nodes of each set of nodes that have a token of the bucket in common, each set once."""
    node, size, count, token = (np.concatenate([np.frombuffer(v, kind) for v in pdf[name]]) for name, kind in
                                (("nodes", np.uint64), ("sizes", np.int32), ("counts", np.int32), ("tokens", np.uint32)))
    names, first, at = np.unique(node, return_index=True, return_inverse=True)
    keys = np.unique((token.astype(np.uint64) << np.uint64(32)) | np.repeat(at, count).astype(np.uint64))
    token, at = keys >> np.uint64(32), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    runs = np.diff(np.append(starts, len(token)))
    # a set of nodes is named by a sum of hashes; tokens of the same nodes say the same
    mixed = (names ^ (names >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    sets = np.add.reduceat(mixed[at], starts)
    several = np.flatnonzero(runs > 1)
    chosen = several[np.unique(sets[several], return_index=True)[1]]
    lengths = runs[chosen]
    place = np.repeat(starts[chosen] - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) + np.arange(lengths.sum())
    who = at[place.astype(np.int64)]
    return pd.DataFrame({"token": np.repeat(sets[chosen], lengths).view(np.int64), "node": names[who].view(np.int64),
                         "size": size[first][who]})


def _shared_tokens(docs: DataFrame, documents: int, shingles: int, similarity: float,
                   sieve_tokens: int = SIEVE_TOKENS) -> DataFrame:
    """token, node, size: tokens that several nodes have in their prefixes, as sets of nodes.

    The prefixes of all documents go to buckets as packed arrays, five bytes a token, and only what several nodes have
    comes out. The number of buckets follows the number of shingles. Tokens that the sample finds in so many documents
    that they would fill a bucket are rows of their own instead.
    """
    common, often = _common_shingles(docs)
    hot = common[often * max(1.0, documents / ORDER_DOCS) > sieve_tokens / 8]
    buckets = max(1, math.ceil((shingles * (1 - similarity) + documents) / sieve_tokens))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, PACKED_DOCS):
                rows = _pack_tokens(_texts(b.slice(at, PACKED_DOCS)), common, often, hot, similarity, buckets)
                yield pa.RecordBatch.from_pandas(rows, pa.schema(_PACKED), preserve_index=False)
        give_back()

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in _texts(b):
                found = _shingle_set(t)
                tokens = _prefix(found, common, often, similarity)
                tokens = tokens[np.isin(tokens, hot)].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens), pa.array(np.full(len(tokens), bits.set_hash(found), np.uint64).view(np.int64)),
                     pa.array(np.full(len(tokens), len(found), np.int32))], ["token", "node", "size"])
    packed = docs.select("text").mapInArrow(pack, "bucket int, nodes binary, sizes binary, counts binary, tokens binary")
    schema = "token bigint, node bigint, size int"
    met = packed.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(tidied(_meet), schema)
    if len(hot):
        met = met.unionByName(docs.select("text").mapInArrow(single, schema))
    return cut_lineage(met.distinct())


def _similar_roots(nodes: DataFrame, left: DataFrame, docs: DataFrame, similarity: float, leaders: int = LEADERS
                   ) -> DataFrame:
    """node, root for the nodes that links of similar nodes join to others.

    ``nodes`` has node, text_hash, size, print and parity; ``left`` has token, node and size. The Gray-order index
    finds nodes with prints up to ``RADIUS`` bits apart first; those that are similar are joined. What it leaves apart
    is compared by tokens: nodes with a token in common, the first ``leaders`` of each token with all others of it,
    then more and more of them, until all nodes of a token are in one component or all its pairs were compared. So the
    components are those of all similar pairs, and a group of n copies of each other asks for some n comparisons and
    not n squared.
    """
    links = cut_lineage(_similar(near_links(nodes, 4, RADIUS).distinct(), nodes, docs, similarity))
    done, upto = 0, leaders
    first = Window.partitionBy("token").orderBy("node")
    while True:
        roots = connected_components(links)
        named = (left.select("token", "node", "size").join(roots, "node", "left")
                 .withColumn("root", F.coalesce("root", "node")))
        left = cut_lineage(named.join(_mixed(named, "root", done or 1), "token", "left_semi"))
        if not left.limit(1).count():
            return roots
        lead = (left.withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") <= upto)
                .filter(F.col("_rank") > done)
                .select("token", F.col("node").alias("a"), F.col("root").alias("_root"), F.col("size").alias("_size")))
        pairs = (lead.join(left, "token").filter((F.col("a") < F.col("node")) & (F.col("_root") != F.col("root")))
                 .filter(F.least("size", "_size") >= F.greatest("size", "_size") * similarity - 1e-6)
                 .select("a", F.col("node").alias("b")).distinct())
        links = cut_lineage(links.unionByName(_similar(pairs, nodes, docs, similarity)))
        done, upto = upto, upto * 8


def near_groups(docs: DataFrame, similarity: float = NEAR_SIMILARITY) -> DataFrame:
    """doc_id, text_hash, root, low: the group of near-copies of each different document, and its smallest id.

    Two documents are near-copies if their different five-word shingles have a similarity (common ones by all) of at
    least ``similarity``; groups are joined by such pairs. Most are met through SimHash prints in the Gray-order index,
    and all of them are found: of two such sets each has a shingle of the other among its first
    ``n - ceil(similarity n) + 1`` in any common order, and the order puts shingles that a sample finds common last, so
    few documents meet there. Texts without words are copies of each other. Null ids come after all others.
    """
    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node, size, print_, parity = [], [], [], []
            for t in _texts(b):
                found = _shingle_set(t)
                node.append(bits.set_hash(found))
                size.append(len(found))
                print_.append(bits.majority_bits(iter([found])))
                parity.append(_parity(found))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_hash"), pa.array(np.array(node, np.uint64).view(np.int64)),
                 pa.array(size, pa.int32()), pa.array(np.array(print_, np.uint64).view(np.int64)),
                 pa.array(parity, pa.binary())], ["doc_id", "text_hash", "node", "size", "print", "parity"])
        give_back()
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(2 ** 63 - 1)).alias("doc_id"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    rows = cut_lineage(rows.mapInArrow(marks, "doc_id bigint, text_hash bigint, node bigint, size int, print bigint, "
                                              "parity binary"))
    nodes = cut_lineage(rows.groupBy("node").agg(*(F.min(c).alias(c) for c in ("text_hash", "size", "print", "parity"))))
    total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    roots = _similar_roots(nodes, _shared_tokens(docs, total[0], total[1], similarity), docs, similarity)
    classes = (rows.groupBy("node").agg(F.min("doc_id").alias("low")).join(roots, "node", "left")
               .withColumn("root", F.coalesce("root", "node")))
    least = classes.groupBy("root").agg(F.min("low").alias("low"))
    named = classes.select("node", "root").join(least, "root").select("node", "root", "low")
    return (rows.select("doc_id", "text_hash", "node").join(named, "node").select("doc_id", "text_hash", "root", "low")
            .distinct())


def near_copies(docs: DataFrame, similarity: float = NEAR_SIMILARITY) -> DataFrame:
    """doc_id, low: for documents in a group of near-copies that are not its smallest id, the smallest id."""
    return near_groups(docs, similarity).filter("doc_id <> low").select("doc_id", "low").distinct()


def one_of_each_group(docs: DataFrame, similarity: float = NEAR_SIMILARITY) -> DataFrame:
    """The rows of ``docs`` without near-copies: of each group the document with the smallest id stays.

    Rows that repeat an id are one document and one of them stands for it: one that is the smallest id of its group if
    there is any, of these that whose text hashes lowest. Only rows that stand for their id are the one that stays of a
    group, so a text goes only with its id or for a near-copy that stays. Rows without an id cannot be named in a group
    and stay. All columns are kept.
    """
    named = docs.filter("doc_id IS NOT NULL")
    groups = cut_lineage(near_groups(named, similarity))
    own = Window.partitionBy("doc_id").orderBy(F.col("doc_id") != F.col("low"), "text_hash")
    standing = groups.withColumn("_rank", F.row_number().over(own)).filter("_rank = 1")
    kept = (standing.groupBy("root").agg(F.min(F.struct("doc_id", "text_hash")).alias("_kept"))
            .select(F.col("_kept.doc_id").alias("_kept_id"), F.col("_kept.text_hash").alias("_kept_hash")))
    columns = docs.columns
    rows = named.select(F.struct(*columns).alias("_doc"), F.col("doc_id").cast("bigint").alias("_id"),
                        F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"))
    rows = rows.join(kept, (F.col("_id") == F.col("_kept_id")) & (F.col("_hash") == F.col("_kept_hash")))
    first = F.row_number().over(Window.partitionBy("_id", "_hash").orderBy("_hash"))
    rows = rows.withColumn("_rank", first).filter("_rank = 1").select("_doc.*")
    return rows.unionByName(docs.filter("doc_id IS NULL"))
