"""Document quality from lines that a linear-chain conditional random field labels good or bad."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfdiff.llm.parts import hashed_sample

#: Labelled documents of each label the field is fitted on, the bound of the sample; steps, step length, L2 penalty.
SAMPLE = 1500
STEPS = 150
RATE = 0.1
L2 = 0.02

#: Bytes whose features are computed at a time, about a hundred times that in memory; texts a task encodes at a time.
PART = 1 << 18
TEXTS = 512

#: Edges that the shares and numbers of a line are binned by.
SHARE_EDGES = (1e-9, 0.02, 0.06, 0.15, 0.35, 0.7)
SIZE_EDGES = (0.5, 3.5, 6.5, 12.5, 40.5, 120.5)

_SHARES = 8
_SIZES = 3
FEATURES = (_SHARES * len(SHARE_EDGES) + _SIZES * len(SIZE_EDGES)) + 1


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[np.frombuffer(chars.encode("latin-1"), np.uint8)] = 1
    return out


_UPPER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _table("abcdefghijklmnopqrstuvwxyz")
_DIGIT = _table("0123456789")
_STOPS = _table(".,;:?'\"()-")
_MARKS = _table("!#$%&*+/<=>@[\\]^_`{|}~")
_BLANK = _table(" \t\r\x0b\x0c\n")
_OTHER = np.r_[np.zeros(128, np.uint8), np.ones(128, np.uint8)]


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """0/1 features of every line, weight of every line (bytes and one), lines of every text.

    Lines end at line feeds; an empty text is one empty line. Shares of a line's bytes or words: upper case among
    letters, digits, sentence marks, other marks, bytes beyond ASCII, words with other marks, words equal to the word
    before, words equal to the word two before. Sizes: words, bytes a word, bytes in tens. Each is cut at fixed
    edges; the last feature is always 1.
    """
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.r_[0, ends[:-1] + 1]
    per_text = np.array([t.count(b"\n") + 1 for t in texts], np.int64)

    def total(mask: np.ndarray) -> np.ndarray:
        upto = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return (upto[ends] - upto[starts]).astype(np.float64)
    upper, lower, digit, stops, marks, other = (total(t[data]) for t in (_UPPER, _LOWER, _DIGIT, _STOPS, _MARKS, _OTHER))
    size = (ends - starts).astype(np.float64)

    solid = _BLANK[data] == 0
    opens = np.flatnonzero(solid & np.r_[True, ~solid[:-1]])
    closes = np.flatnonzero(solid & np.r_[~solid[1:], True]) + 1
    line = np.searchsorted(ends, opens)
    lines = len(ends)
    words = np.bincount(line, minlength=lines).astype(np.float64)
    marked = np.concatenate(([0], np.cumsum(_MARKS[data], dtype=np.int64)))
    with_marks = np.bincount(line, weights=(marked[closes] > marked[opens]), minlength=lines)
    code = _word_codes(data, opens, closes)

    def repeats(back: int) -> np.ndarray:
        same = (code[back:] == code[:-back]) & (line[back:] == line[:-back])
        return np.bincount(line[back:], weights=same, minlength=lines)
    letters = np.maximum(upper + lower, 1.0)
    bytes_, words_ = np.maximum(size, 1.0), np.maximum(words, 1.0)
    shares = np.stack([upper / letters, digit / bytes_, stops / bytes_, marks / bytes_, other / bytes_,
                       with_marks / words_, repeats(1) / words_, repeats(2) / words_], axis=1)
    sizes = np.stack([words, (size - np.maximum(words - 1, 0)) / words_, size / 10.0], axis=1)
    binned = [(shares[:, :, None] > np.array(SHARE_EDGES)).reshape(lines, -1),
              (sizes[:, :, None] > np.array(SIZE_EDGES)).reshape(lines, -1), np.ones((lines, 1), bool)]
    return np.concatenate(binned, axis=1).astype(np.uint8), size + 1.0, per_text


def _word_codes(data: np.ndarray, opens: np.ndarray, closes: np.ndarray) -> np.ndarray:
    """A number for every word that depends on its first 16 bytes, its last 8 and its length."""
    wide = np.concatenate((data, np.zeros(16, np.uint8)))
    length = closes - opens
    code = length.astype(np.uint64)
    with np.errstate(over="ignore"):
        for k in range(16):
            code = code * np.uint64(0x100000001B3) + np.where(k < length, wide[opens + k], 0).astype(np.uint64)
        for k in range(1, 9):
            code = code * np.uint64(0x100000001B3) + np.where(k <= length, wide[closes - k], 0).astype(np.uint64)
    return code


@dataclass
class Field:
    """Weights of a line's own, previous and next features for ``good``, and of the four steps between labels."""
    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    step: np.ndarray

    @staticmethod
    def zero() -> Field:
        return Field(np.zeros(FEATURES), np.zeros(FEATURES), np.zeros(FEATURES), np.zeros((2, 2)))


class Chains:
    """Texts as chains of lines, longest first, so that all chains take a step at once."""

    def __init__(self, per_text: np.ndarray):
        self.n = per_text
        self.order = np.argsort(-per_text, kind="stable")
        lengths = per_text[self.order]
        first = np.concatenate(([0], np.cumsum(per_text)[:-1]))[self.order] if len(per_text) else np.zeros(0, int)
        steps = int(lengths[0]) if len(lengths) else 0
        active = np.searchsorted(-lengths, -np.arange(steps), side="left")
        self.rows = [first[:k] + t for t, k in enumerate(active)]
        total = int(per_text.sum())
        self.first = np.zeros(total, bool)
        self.last = np.zeros(total, bool)
        self.first[first] = True
        self.last[first + lengths - 1] = True

    def neighbours(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The value of the line before and after, 0 at the ends of a chain."""
        before = np.concatenate(([0.0], values[:-1]))
        after = np.concatenate((values[1:], [0.0]))
        return np.where(self.first, 0.0, before), np.where(self.last, 0.0, after)


def _scores(field: Field, x: np.ndarray, chains: Chains) -> np.ndarray:
    weights = np.stack([field.own, field.before, field.after], axis=1)
    parts = [x[k:k + 16384] @ weights for k in range(0, len(x), 16384)]
    own, before, after = np.concatenate(parts).T if parts else np.zeros((3, 0))
    return own + chains.neighbours(before)[0] + chains.neighbours(after)[1]


def marginals(field: Field, x: np.ndarray, chains: Chains) -> tuple[np.ndarray, np.ndarray, float]:
    """Probability of ``good`` for each line, of each pair of labels of neighbours (summed), and log Z (summed)."""
    score = np.stack([np.zeros(len(x)), _scores(field, x, chains)], axis=1)
    ahead, back = np.zeros((len(x), 2)), np.zeros((len(x), 2))
    log_z = 0.0
    for t, rows in enumerate(chains.rows):
        if t == 0:
            ahead[rows] = score[rows]
        else:
            old = ahead[chains.rows[t - 1][:len(rows)]]
            ahead[rows] = score[rows] + np.logaddexp(old[:, :1] + field.step[0], old[:, 1:] + field.step[1])
    for t in range(len(chains.rows) - 1, 0, -1):
        rows = chains.rows[t]
        new = back[rows] + score[rows]
        back[chains.rows[t - 1][:len(rows)]] = np.logaddexp(new[:, :1] + field.step[:, 0], new[:, 1:] + field.step[:, 1])
    both = ahead + back
    line_z = np.logaddexp(both[:, 0], both[:, 1])
    pairs = np.zeros((2, 2))
    inner = np.flatnonzero(~chains.first)
    if len(inner):
        for a in (0, 1):
            for b in (0, 1):
                pairs[a, b] = np.exp(ahead[inner - 1, a] + field.step[a, b] + score[inner, b] + back[inner, b]
                                     - line_z[inner]).sum()
    if len(chains.rows):
        log_z = float(line_z[chains.rows[0]].sum())
    return np.exp(both[:, 1] - line_z), pairs, log_z


def fit(x: np.ndarray, per_text: np.ndarray, good: np.ndarray, steps: int = STEPS, rate: float = RATE,
        l2: float = L2) -> Field:
    """The field under which all lines of a text have its label, by gradient steps of adapted length (Adam)."""
    chains, field = Chains(per_text), Field.zero()
    x = x.astype(np.float64)
    truth = np.repeat(good, per_text).astype(np.float64)
    inner = ~chains.first
    counted = np.zeros((2, 2))
    for a in (0, 1):
        counted[a, a] = (inner & (truth == a)).sum()
    n = max(1, len(x))
    names = ("own", "before", "after", "step")
    m = {k: np.zeros_like(getattr(field, k)) for k in names}
    v = {k: np.zeros_like(getattr(field, k)) for k in names}
    for i in range(1, steps + 1):
        p, pairs, _ = marginals(field, x, chains)
        off = p - truth
        left, right = chains.neighbours(off)
        slope = {"own": x.T @ off, "before": x.T @ right, "after": x.T @ left, "step": pairs - counted}
        for k in names:
            g = slope[k] / n + l2 * getattr(field, k) / np.sqrt(n)
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            setattr(field, k, getattr(field, k) - rate * (m[k] / (1 - 0.9 ** i)) / (np.sqrt(v[k] / (1 - 0.999 ** i)) + 1e-8))
    return field


def _segments(text: bytes, part: int) -> list[bytes]:
    """A text in runs of whole lines of about ``part`` bytes."""
    out, start = [], 0
    while len(text) - start > part:
        cut = text.rfind(b"\n", start, start + part)
        cut = text.find(b"\n", start + part) if cut < 0 else cut
        if cut < 0:
            break
        out.append(text[start:cut])
        start = cut + 1
    return [*out, text[start:]]


def many_features(texts: list[bytes], part: int = PART) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``line_features`` of any amount of text, about ``part`` bytes at a time."""
    found, held, size = [], [], 0
    per_text = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
    for text in texts:
        for segment in _segments(text, part):
            if held and size + len(segment) > part:
                found.append(line_features(held)[:2])
                held, size = [], 0
            held.append(segment)
            size += len(segment)
    if held:
        found.append(line_features(held)[:2])
    return np.concatenate([x for x, _ in found]), np.concatenate([w for _, w in found]), per_text


def document_scores(field: Field, texts: list[bytes], part: int = PART) -> np.ndarray:
    """Mean probability of ``good`` over a text's lines, weighted by their length.

    Bytes are looked at about ``part`` at a time, and texts scored in groups of about 16 times that, so only a single
    longer text has more than that in memory: its line features.
    """
    out, start = [], 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and (stop == start or size + len(texts[stop]) <= 16 * part):
            size += len(texts[stop])
            stop += 1
        x, weight, per_text = many_features(texts[start:stop], part)
        p, _, _ = marginals(field, x, Chains(per_text))
        at = np.concatenate(([0], np.cumsum(per_text)[:-1]))
        out.append(np.add.reduceat(p * weight, at) / np.add.reduceat(weight, at))
        start = stop
    return np.clip(np.concatenate(out), 0.0, 1.0) if out else np.zeros(0)


def _bytes(texts: pd.Series) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in texts]


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field | None:
    """A field from documents (doc_id, text) and labels (doc_id, quality 0 or 1); None if nothing is labelled.

    At most ``sample`` labelled documents of each label are used, those whose ids hash lowest; several labels of a
    document count as the lowest. Their line features come to the driver. The table of chosen ids, two times
    ``sample`` rows, is broadcast to find their texts.
    """
    one = (labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id")
           .agg(F.min("quality").cast("int").alias("quality")))
    chosen = hashed_sample(one.withColumn("spread", F.xxhash64("doc_id", F.lit(5))), "quality", "spread",
                           sample).select("doc_id", "quality")

    @F.pandas_udf("lines int, x binary")
    def features(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in _bytes(texts):
            x, _, per_text = many_features([t])
            out.append((int(per_text[0]), np.packbits(x, axis=1).tobytes()))
        return pd.DataFrame(out, columns=["lines", "x"])
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .select("doc_id", "quality", features("text").alias("f")).select("doc_id", "quality", "f.lines", "f.x")
            .collect())
    if not rows:
        return None
    rows.sort(key=lambda r: (r.doc_id, r.x))
    wide = -(-FEATURES // 8)
    x = np.concatenate([np.unpackbits(np.frombuffer(r.x, np.uint8).reshape(-1, wide), axis=1)[:, :FEATURES]
                        for r in rows])
    return fit(x, np.array([r.lines for r in rows]), np.array([r.quality for r in rows]))


def score_of(text: Column, field: Field | None) -> Column:
    """The score of a text column. Null and empty texts are one empty line; without a field every score is 0.5."""
    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        if field is None:
            return pd.Series(np.full(len(texts), 0.5))
        parts = [document_scores(field, _bytes(texts.iloc[k:k + TEXTS])) for k in range(0, len(texts), TEXTS)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))
    return scored(text)


def score(docs: DataFrame, field: Field | None) -> DataFrame:
    """``docs`` with ``score`` (a column of that name is replaced); only the text is looked at."""
    return docs.withColumn("score", score_of(F.col("text"), field))
