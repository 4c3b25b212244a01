"""Toxicity by a factorization machine over hashed terms of short windows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of half a window; bytes of a word's stems; bytes of text looked at a time.
HALF = 128
STEMS = (4, 5)
PART = 1 << 20

#: The sample the machine is fitted on: labelled documents of each label (about) and the longest of them, in bytes.
TOXIC, CLEAN, LONGEST = 1200, 2400, 16_384

#: Terms that fewer documents of the sample have are not in the model; factors of a term; passes, documents a step,
#: rates of weights and factors, L1 and L2 penalties of weights, L2 penalty of factors.
LEAST_DOCS = 3
FACTORS = 8
EPOCHS, STEP_DOCS, RATE, RATE_FACTORS, L1, L2, L2_FACTORS = 6, 32, 0.3, 0.05, 4.0, 1.0, 0.1
SEED = 13
FOLDS = 5

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BACK = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LETTER = np.r_[np.zeros(97, bool), np.ones(26, bool), np.zeros(5, bool), np.ones(128, bool)]


@dataclass(frozen=True)
class Machine:
    """Sorted term keys, their weights and factors, and what turns a text's highest window into a probability."""
    keys: np.ndarray
    weight: np.ndarray
    factor: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0


def _powers(n: int, cache: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006 (one table a worker)
    if len(cache.get("up", ())) < n:
        size = 1 << max(16, int(n).bit_length())
        for name, base in (("up", _BASE), ("down", _BACK)):
            with np.errstate(over="ignore"):
                cache[name] = np.multiply.accumulate(np.r_[_U(1), np.full(size - 1, base)])
    return cache["up"][:n], cache["down"][:n]


def terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(half window, term key) of all different terms of half windows, and the half windows of every text.

    Texts are in small letters. A word is a run of a-z and of bytes beyond ASCII; its terms are the word and its first
    ``STEMS`` bytes where it is longer, as 64-bit hashes. A term that a half window has twice is one more term (its
    hash inverted). A half window is ``HALF`` words; a text has one at least.
    """
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    solid = _LETTER[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], solid)).astype(np.int8)))
    start, end = edge[0::2], edge[1::2]
    text = np.searchsorted(np.cumsum(sizes), start, side="right")
    words = np.bincount(text, minlength=len(texts))
    halves = np.maximum(1, -(-words // HALF))
    first_word, first_half = np.cumsum(words) - words, np.cumsum(halves) - halves
    half = first_half[text] + (np.arange(len(start)) - first_word[text]) // HALF
    up, down = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        upto = np.concatenate(([_U(0)], np.cumsum((data.astype(_U) + _U(1)) * up[:-1], dtype=_U)))

        def keyed(a, b, kind):
            code = (upto[b] - upto[a]) * down[a] + _U(kind)
            code = (code ^ (code >> _U(31))) * _U(0xD6E8FEB86659FD93)
            return code ^ (code >> _U(32))
        found, where = [keyed(start, end, 0)], [half]
        for kind, stem in enumerate(STEMS, 1):
            long_ = end - start > stem
            found.append(keyed(start[long_], start[long_] + stem, kind))
            where.append(half[long_])
    half, key = np.concatenate(where), np.concatenate(found)
    order = np.lexsort((key, half))
    half, key = half[order], key[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (half[1:] != half[:-1])
    again = np.flatnonzero(~fresh & np.r_[False, fresh[:-1]])
    return np.concatenate((half[fresh], half[again])), np.concatenate((key[fresh], ~key[again])), halves


def windows(half: np.ndarray, term: np.ndarray, halves: np.ndarray, width: int
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, term) of all different terms (numbers below ``width``) of windows, and the windows of every text.

    A window is two neighbouring half windows, so two words at most ``HALF`` apart share one.
    """
    n = np.maximum(1, halves - 1)
    first_half, first = np.cumsum(halves) - halves, np.cumsum(n) - n
    text = np.repeat(np.arange(len(halves)), halves)[half]
    place = half - first_half[text]
    code = np.concatenate([(first[text] + place)[place < n[text]] * width + term[place < n[text]],
                           (first[text] + place - 1)[place > 0] * width + term[place > 0]])
    code = np.unique(code)
    return code // width, code % width, n


def window_scores(machine: Machine, window: np.ndarray, term: np.ndarray, count: int) -> np.ndarray:
    """Bias, weights and all pairwise products of factors of the terms of each window."""
    out = machine.bias + np.bincount(window, machine.weight[term], count)
    for f in machine.factor.T:
        v = f[term]
        out += 0.5 * (np.bincount(window, v, count) ** 2 - np.bincount(window, v * v, count))
    return out


def text_scores(machine: Machine, texts: list[bytes]) -> np.ndarray:
    """The score of the highest window of every text."""
    half, key, halves = terms(texts)
    if len(machine.keys):
        at = np.minimum(np.searchsorted(machine.keys, key), len(machine.keys) - 1)
        known = machine.keys[at] == key
        half, at = half[known], at[known]
    else:
        half, at = half[:0], np.zeros(0, np.int64)
    window, term, n = windows(half, at, halves, max(1, len(machine.keys)))
    scores = window_scores(machine, window, term, int(n.sum()))
    return np.maximum.reduceat(scores, np.cumsum(n) - n)


def _segments(text: bytes, part: int) -> list[bytes]:
    """A text in runs of about ``part`` bytes that end at blanks or line feeds."""
    out, start = [], 0
    while len(text) - start > part:
        cut = max(text.rfind(b" ", start, start + part), text.rfind(b"\n", start, start + part))
        cut = start + part if cut <= start else cut
        out.append(text[start:cut])
        start = cut
    return [*out, text[start:]]


def document_scores(machine: Machine, texts: list[bytes], part: int = PART) -> np.ndarray:
    """Highest window scores of texts of any length, about ``part`` bytes at a time."""
    out = np.full(len(texts), -np.inf)
    held, owner, size = [], [], 0

    def settle():
        if held:
            np.maximum.at(out, owner, text_scores(machine, held))
    for i, text in enumerate(texts):
        for segment in _segments(text, part):
            if size + len(segment) > part:
                settle()
                held, owner, size = [], [], 0
            held.append(segment)
            owner.append(i)
            size += len(segment)
    settle()
    return out


def _bytes(texts: pd.Series) -> list[bytes]:
    return [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def gradient(machine: Machine, window: np.ndarray, term: np.ndarray, first: np.ndarray, toxic: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, float, float]:
    """Slopes of the log loss by weights, factors and bias, and the loss, summed over texts.

    A text is toxic if any of its windows is, each by itself (a noisy or): ``first`` are the first windows of texts.
    """
    count = int(first[-1])
    n = np.diff(first)
    score = window_scores(machine, window, term, count)
    p = sigmoid(score)
    text = np.repeat(np.arange(len(n)), n)
    clear = np.bincount(text, -np.log1p(np.exp(np.clip(score, -500, 500))), len(n))  # log of "no window is toxic"
    any_ = np.maximum(-np.expm1(clear), 1e-12)
    # clean: p; toxic: -p (1 - P) / P
    off = p * np.where(toxic == 1, -np.exp(clear) / any_, 1.0)[text]
    loss = float(-np.where(toxic == 1, np.log(any_), clear).sum())
    each = off[window]
    by_weight = np.bincount(term, each, len(machine.keys))
    by_factor = np.empty_like(machine.factor)
    for k, f in enumerate(machine.factor.T):
        v = f[term]
        whole = np.bincount(window, v, count)
        by_factor[:, k] = np.bincount(term, each * (whole[window] - v), len(machine.keys))
    return by_weight, by_factor, float(off.sum()), loss


def fit(found: list[tuple[np.ndarray, np.ndarray, int]], toxic: np.ndarray, epochs: int = EPOCHS) -> Machine:
    """A machine from texts as (half window, term key, half windows) and their labels.

    Weights follow the regularised leader: the L1 penalty keeps terms without a say at zero, however often they are
    met. Factors take steps of adapted length, and only terms with a weight have any, so a window of ordinary words
    has no noise of pairs. Terms without a weight are left out in the end.
    """
    docs = np.concatenate([np.unique(key) for _, key, _ in found]) if found else np.zeros(0, _U)
    keys, n = np.unique(docs, return_counts=True)
    keys = keys[n >= LEAST_DOCS]
    rng = np.random.default_rng(SEED)
    machine = Machine(keys, np.zeros(len(keys)), rng.normal(0, 0.05, (len(keys), FACTORS)), -3.0)
    if not len(keys) or len(set(toxic.tolist())) < 2:
        level = float(np.log((toxic.sum() + 0.5) / (len(toxic) - toxic.sum() + 0.5))) if len(toxic) else 0.0
        return Machine(keys, machine.weight, np.zeros_like(machine.factor), level)
    rows = []
    for half, key, halves in found:
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        known = keys[at] == key
        window, term, count = windows(half[known], at[known], np.array([halves]), len(keys))
        rows.append((window.astype(np.int32), term.astype(np.int32), int(count[0])))
    pulled, squares = np.zeros(len(keys)), np.zeros(len(keys))
    bias_squares, factor_squares = 1.0, np.ones(len(keys))
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for a in range(0, len(order), STEP_DOCS):
            some = order[a:a + STEP_DOCS]
            first = np.concatenate(([0], np.cumsum([rows[i][2] for i in some])))
            window = np.concatenate([rows[i][0] + f for i, f in zip(some, first)])
            term = np.concatenate([rows[i][1] for i in some])
            live = machine.weight != 0
            seen = Machine(keys, machine.weight, machine.factor * live[:, None], machine.bias)
            by_weight, by_factor, by_bias, _ = gradient(seen, window, term, first, toxic[some])
            rise = (np.sqrt(squares + by_weight ** 2) - np.sqrt(squares)) / RATE
            pulled += by_weight - rise * machine.weight
            squares += by_weight ** 2
            weight = np.where(np.abs(pulled) <= L1, 0.0, -(pulled - np.sign(pulled) * L1)
                              / ((1.0 + np.sqrt(squares)) / RATE + L2))
            by_factor = live[:, None] * (by_factor + L2_FACTORS * machine.factor)
            factor_squares += (by_factor ** 2).sum(axis=1)
            bias_squares += by_bias ** 2
            machine = Machine(keys, weight, machine.factor - RATE_FACTORS * by_factor / np.sqrt(factor_squares)[:, None],
                              machine.bias - RATE * by_bias / np.sqrt(bias_squares))
    live = machine.weight != 0
    return Machine(keys[live], machine.weight[live], machine.factor[live], machine.bias)


def calibrated(machine: Machine, scores: np.ndarray, toxic: np.ndarray, steps: int = 200) -> Machine:
    """Slope and shift that make the labels of held-back texts likeliest, with one doubtful text on either side."""
    if len(set(toxic.tolist())) < 2:
        return machine
    y = np.where(toxic == 1, 1 - 1 / (toxic.sum() + 2), 1 / (len(toxic) - toxic.sum() + 2))
    middle, scale = scores.mean(), scores.std() + 1e-9
    x = np.stack([(scores - middle) / scale, np.ones(len(scores))], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(steps):
        p = sigmoid(x @ beta)
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(curve, x.T @ (y - p) - 1e-3 * np.array([beta[0] - 1.0, beta[1]]))
        beta = beta + np.clip(move, -1, 1)
    slope = max(beta[0], 1e-3) / scale
    return Machine(machine.keys, machine.weight, machine.factor, machine.bias, float(slope),
                   float(beta[1] - slope * middle))


def train(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC, clean: int = CLEAN, longest: int = LONGEST) -> Machine:
    """A machine from documents (doc_id, text) and labels (doc_id, toxic 0 or 1).

    It is fitted on a sample: about ``toxic`` and ``clean`` labelled documents, those whose ids hash into the share of
    the hash range that holds so many, of at most ``longest`` bytes. One in ``FOLDS`` of them calibrates. Their
    terms, not their texts, come to the driver. Several labels of a document count as the highest; labels without id
    or of another value are left out. Without labels of both kinds every text has the same score.
    """
    one = (labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id")
           .agg(F.max("toxic").cast("int").alias("toxic")))
    # two rows
    counts = {r.toxic: r.n for r in one.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    spread = F.xxhash64("doc_id", F.lit(SEED))
    share = F.shiftrightunsigned(spread, 11) / F.lit(float(1 << 53))
    wanted = F.lit(0.0)
    for label, size in ((1, toxic), (0, clean)):
        wanted = F.when(F.col("toxic") == label, F.lit(size / max(counts.get(label, 0), 1))).otherwise(wanted)
    chosen = one.filter(share < wanted)

    @F.pandas_udf("halves int, half binary, key binary")
    def extracted(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in _bytes(texts):
            half, key, halves = terms([t])
            out.append((int(halves[0]), half.astype("<i4").tobytes(), key.astype("<u8").tobytes()))
        return pd.DataFrame(out, columns=["halves", "half", "key"])
    # about ``toxic`` + ``clean`` ids: the bound of what is broadcast
    rows = (docs.select("doc_id", "text").filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= longest)
            .join(F.broadcast(chosen), "doc_id")
            .select(spread.alias("spread"), "toxic", extracted("text").alias("f"))
            .select("spread", "toxic", "f.*").collect())
    rows.sort(key=lambda r: (r.spread, r.key, r.half))
    found = [(np.frombuffer(r.half, "<i4").astype(np.int64), np.frombuffer(r.key, "<u8").astype(_U), r.halves) for r in rows]
    label = np.array([r.toxic for r in rows], np.int64)
    hold = np.arange(len(rows)) % FOLDS == FOLDS - 1
    machine = fit([f for f, h in zip(found, hold) if not h], label[~hold])
    if not hold.any() or not len(machine.keys):
        return machine
    scores = []
    for (half, key, halves), h in zip(found, hold):
        if h:
            at = np.minimum(np.searchsorted(machine.keys, key), len(machine.keys) - 1)
            known = machine.keys[at] == key
            window, term, n = windows(half[known], at[known], np.array([halves]), len(machine.keys))
            scores.append(window_scores(machine, window, term, int(n[0])).max())
    return calibrated(machine, np.array(scores), label[hold])


def score_of(text: Column, machine: Machine) -> Column:
    """The score of a text column: the calibrated probability of its highest window. Null and empty texts have no term.

    Texts are looked at whole, about a megabyte at a time; the machine travels with the function, its size is bounded
    by the terms of the sample.
    """
    machine = Machine(machine.keys, machine.weight.astype(np.float32), machine.factor.astype(np.float32), machine.bias,
                      machine.slope, machine.shift)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(sigmoid(machine.slope * document_scores(machine, _bytes(texts)) + machine.shift))
    return scored(text)


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` with ``score`` (a column of that name is replaced); only the text is looked at."""
    return docs.withColumn("score", score_of(F.col("text"), machine))
