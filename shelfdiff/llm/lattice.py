"""Embedding near-duplicates by hashing projections to points of the lattice E8."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfdiff.llm.bits import Forest
from shelfdiff.llm.components import connected_components
from shelfdiff.session import cut_lineage

#: Cosine of a link, tables, neighbouring cells probed in each, length of a lattice step, rows of a cell cut up.
COSINE = 0.93
TABLES = 6
PROBES = 3
STEP = 1.2
SLICE = 4096
SEED = 3


def nearest_e8(points: np.ndarray) -> np.ndarray:
    """The nearest point of E8 to each row of 8 numbers, as doubled integers.

    E8 is D8 (integers with an even sum) together with D8 shifted by a half; the nearer of both nearest points wins.
    """
    def nearest_d8(x: np.ndarray) -> np.ndarray:
        whole = np.rint(x)
        off = x - whole
        worst = np.argmax(np.abs(off), axis=1)
        rows = np.arange(len(x))
        step = np.where(off[rows, worst] >= 0, 1.0, -1.0)
        odd = np.abs(whole.sum(axis=1)) % 2 == 1
        whole[rows[odd], worst[odd]] += step[odd]
        return whole
    a = nearest_d8(points)
    b = nearest_d8(points - 0.5) + 0.5
    nearer = (((points - b) ** 2).sum(axis=1) < ((points - a) ** 2).sum(axis=1))[:, None]
    return np.rint(2 * np.where(nearer, b, a)).astype(np.int64)


def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8, doubled."""
    out = []
    for i in range(8):
        for j in range(i):
            for a in (2, -2):
                for b in (2, -2):
                    v = [0] * 8
                    v[i], v[j] = a, b
                    out.append(v)
    for signs in range(256):
        v = [-1 if signs >> k & 1 else 1 for k in range(8)]
        if sum(v) % 4 == 0:
            out.append(v)
    return np.array(out, np.int64)


def _hash(label: np.ndarray, table: int, point: np.ndarray) -> np.ndarray:
    """64 bits of label, table and lattice point."""
    with np.errstate(over="ignore"):
        h = label.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(table + 1)
        for k in range(8):
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + point[:, k].astype(np.uint64)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(31))).view(np.int64)


class Tables:
    """Cells of unit vectors: their own in column 0, then probed neighbours, for each table."""

    def __init__(self, dims: int, tables: int = TABLES, probes: int = PROBES, step: float = STEP, seed: int = SEED):
        rng = np.random.default_rng([seed, dims])
        self.project = [(rng.standard_normal((dims, 8)), rng.uniform(0, 1, 8)) for _ in range(tables)]
        self.probes, self.step, self.around = probes, step, _shortest()

    def cells(self, unit: np.ndarray, label: np.ndarray) -> np.ndarray:
        """(rows, tables, 1 + probes) of 64-bit cells."""
        out = np.empty((len(unit), len(self.project), 1 + self.probes), np.int64)
        for t, (matrix, shift) in enumerate(self.project):
            place = unit @ matrix / self.step + shift
            own = nearest_e8(place)
            out[:, t, 0] = _hash(label, t, own)
            if self.probes:
                # the neighbour v away is nearer the more the residual points along v; all v have one length
                along = (place - own / 2) @ self.around.T
                best = np.argpartition(-along, self.probes - 1, axis=1)[:, :self.probes]
                for p in range(self.probes):
                    out[:, t, 1 + p] = _hash(label, t, own + self.around[best[:, p]])
        return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def distinct_vectors(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (vec_id, label, embedding) with their class, and the classes: equal vectors of one label.

    class_id is the smallest vec_id of the class; copies says how many rows it has. Rows that link with nothing (no
    label, null vector, zero vector, null or non-finite component) are not in the classes.
    """
    vector = F.col("embedding").cast("array<double>")
    sound = (F.col("label").isNotNull() & vector.isNotNull() & (F.size(vector) > 0)
             & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
             & F.exists(vector, lambda x: x != 0))
    tagged = rows.select("vec_id", F.col("label").cast("bigint").alias("label"), vector.alias("vector"),
                         F.coalesce(sound, F.lit(False)).alias("sound"))
    classes = (tagged.filter("sound").groupBy("label", "vector")
               .agg(F.min("vec_id").alias("class_id"), F.count(F.lit(1)).alias("copies")))
    return tagged, classes


def near_links(classes: DataFrame, cosine: float = COSINE, slice_rows: int = SLICE, **settings) -> DataFrame:
    """class_id, other, n: ``n`` is what the task found of the class's linked copies, ``other`` a class to join with.

    Every vector goes to its own cell and to the probed ones of each table, and meets there whoever has the cell as
    own or probed cell. All pairs of a cell are multiplied out in double precision, block by block. A pair that
    meets in several cells counts only in the first of them, which both vectors tell. Counts are added up inside the
    task and pairs joined to a spanning forest, so a cell of n vectors leaves n rows. A cell with more than
    ``slice_rows`` rows is cut into slices, and each two slices are met in a task of their own.
    """
    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for _, part in b.groupby(b["vector"].map(len)):
                v = np.array(part["vector"].tolist(), np.float64)
                label = part["label"].to_numpy(np.int64)
                cells = Tables(v.shape[1], **settings).cells(_unit(v), label)
                places = [x.tobytes() for x in cells.reshape(len(v), -1)]
                data = [_packed(x) for x in v]
                for t in range(cells.shape[1]):
                    for p in range(cells.shape[2]):
                        yield pd.DataFrame({"cell": cells[:, t, p], "class_id": part["class_id"].to_numpy(),
                                            "copies": part["copies"].to_numpy(), "label": label, "dims": v.shape[1],
                                            "data": data, "places": places})
    rows = classes.mapInPandas(deal, "cell bigint, class_id bigint, copies bigint, label bigint, dims int, "
                                     "data binary, places binary")
    rows = rows.withColumns({"own": F.lit(0), "lo": F.lit(0), "hi": F.lit(0)})
    hot = cut_lineage(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > slice_rows))
    if hot.limit(1).count():
        parts = F.ceil(F.coalesce("rows", F.lit(1)) / slice_rows).cast("int")
        rows = (rows.drop("own", "lo", "hi").join(hot, "cell", "left").withColumn("parts", parts)
                .withColumn("own", F.pmod(F.xxhash64("class_id"), F.col("parts")).cast("int"))
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
                .withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")})
                .drop("parts", "other", "rows"))

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, rows = [], 0
        for cell in _whole_cells(batches):
            for part in _links(cell, cosine, tables):
                out.append(part)
                rows += len(part[0])
            if rows > 50_000:
                yield _frame(out)
                out, rows = [], 0
        yield _frame(out)
    tables = settings.get("tables", TABLES)
    cell = ["cell", "lo", "hi"]
    return (rows.repartition(*cell).sortWithinPartitions(*cell)
            .mapInPandas(meet, "class_id bigint, other bigint, n bigint"))


def _whole_cells(batches: Iterator[pd.DataFrame]) -> Iterator[dict[str, np.ndarray]]:
    """The columns of each cell with two rows or more."""
    held = None
    for b in batches:
        new = {c: b[c].to_numpy() for c in b.columns}
        now = new if held is None else {c: np.concatenate((held[c], new[c])) for c in new}
        keys = np.stack([now[c] for c in ("cell", "lo", "hi")], axis=1).astype(np.int64)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        starts = np.concatenate(([0], cuts))
        for start, end in zip(starts[:-1], cuts):
            if end - start > 1:
                yield {c: v[start:end] for c, v in now.items()}
        held = {c: v[starts[-1]:] for c, v in now.items()}
    if held is not None and len(held["cell"]) > 1:
        yield held


def _packed(vector: np.ndarray) -> bytes:
    """The components in four bytes each where that loses nothing, else in eight."""
    short = vector.astype("<f4")
    return short.tobytes() if (short == vector).all() else vector.astype("<f8").tobytes()


def _unpacked(rows: np.ndarray, dims: int) -> np.ndarray:
    return np.stack([np.frombuffer(r, "<f4" if len(r) == 4 * dims else "<f8") for r in rows]).astype(np.float64)


def _frame(parts: list[tuple[np.ndarray, ...]]) -> pd.DataFrame:
    columns = [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 3
    return pd.DataFrame(dict(zip(("class_id", "other", "n"), columns)))


def _links(cell: dict[str, np.ndarray], cosine: float, tables: int) -> Iterator[tuple[np.ndarray, ...]]:
    """class_id, other and n of the rows of one cell that have a link."""
    key, lo, hi = (int(cell[c][0]) for c in ("cell", "lo", "hi"))
    own, ids, copies, labels = cell["own"], cell["class_id"], cell["copies"], cell["label"]
    forest, counts = Forest(len(ids)), np.zeros(len(ids), np.int64)
    for dims in np.unique(cell["dims"]):
        members = np.flatnonzero(cell["dims"] == dims)
        if len(members) < 2:
            continue
        unit = _unit(_unpacked(cell["data"][members], int(dims)))
        for start in range(0, len(members), 1024):
            block = unit[start:start + 1024]
            i, j = np.nonzero(block @ unit[start:].T >= cosine)
            keep = j > i
            i, j = members[i[keep] + start], members[j[keep] + start]
            keep = (labels[i] == labels[j]) & (ids[i] != ids[j])
            if lo != hi:  # rows of one slice meet in the task of that slice alone
                keep &= own[i] != own[j]
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            forest.link(i, j)
            for at in range(0, len(i), 16384):
                a, b = i[at:at + 16384], j[at:at + 16384]
                first = _first_meeting(*(np.frombuffer(b"".join(cell["places"][x]), np.int64)
                                         .reshape(len(x), tables, -1) for x in (a, b))) == key
                np.add.at(counts, a[first], copies[b[first]])
                np.add.at(counts, b[first], copies[a[first]])
    used = np.flatnonzero((counts > 0) | (forest.label != np.arange(len(ids))))
    if len(used):
        yield ids[used], ids[forest.label[used]], counts[used]


def _first_meeting(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cell two vectors share in the first table in which they share one; the smallest if there are several."""
    shared = (a[:, :, :, None] == b[:, :, None, :]).any(axis=3)
    lowest = np.where(shared, a, np.iinfo(np.int64).max).min(axis=2)
    table = shared.any(axis=2).argmax(axis=1)
    return lowest[np.arange(len(a)), table]


def near_duplicates(rows: DataFrame, cosine: float = COSINE, **settings) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``rows`` (vec_id, label, embedding).

    Links are pairs of equal, non-null label and cosine of at least ``cosine`` in double precision that the tables
    bring together; at a cosine of exactly 0.93 the six tables miss two pairs in a thousand, closer ones fewer. Equal vectors are one class
    with a number of copies, always linked, never expanded into pairs. Vectors that are null, empty, zero, or hold
    null or non-finite components link with nothing, nor do rows without vec_id; vectors of different lengths do
    not meet. vec_id is a key: classes with the same smallest vec_id are taken as one.
    """
    tagged, classes = distinct_vectors(rows.withColumn(
        "embedding", F.when(F.col("vec_id").isNotNull(), F.col("embedding"))))
    classes = cut_lineage(classes)
    links = cut_lineage(near_links(classes, cosine, **settings))
    counts = links.groupBy("class_id").agg(F.sum("n").alias("found"))
    roots = connected_components(links.filter("class_id <> other"), "class_id", "other")
    named = (classes.join(counts, "class_id", "left").join(roots, F.col("class_id") == F.col("node"), "left")
             .select(F.col("label").alias("c_label"), F.col("vector").alias("c_vector"),
                     (F.col("copies") - 1 + F.coalesce("found", F.lit(0))).alias("links"),
                     F.coalesce("root", "class_id").alias("root")))
    return (tagged.join(named, F.col("sound") & (F.col("label") == F.col("c_label"))
                        & (F.col("vector") == F.col("c_vector")), "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
                    F.coalesce("root", "vec_id").alias("component_id"),
                    F.coalesce(F.col("vec_id") == F.coalesce("root", "vec_id"), F.lit(False)).alias("kept")))
