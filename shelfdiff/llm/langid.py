"""Language identification: multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfdiff.llm.parts import hashed_sample

#: Longest n-gram, bits of the feature hash, characters of a text taken at a time.
GRAMS = 3
BITS = 14
CHUNK = 1 << 20

#: Documents of each language the model is fitted on, the bound of the sample; one in FOLDS of them calibrates.
SAMPLE = 1000
FOLDS = 5

#: FTRL: learning rate, smoothing, L1 and L2 penalty, passes over the sample.
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.02, 0.5, 3

UNKNOWN = "und"
_U = np.uint64


@dataclass(frozen=True)
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


def _letters() -> np.ndarray:
    """Which code points below 0x20000 are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x20000)), bool, 0x20000)


def gram_counts(text: str | None, letters: np.ndarray) -> np.ndarray | None:
    """Counts of hashed n-grams of the lower-case letters, words between blanks; None without a letter.

    Anything but a letter is a blank, runs of blanks are one. A text is taken in chunks, so the memory does not
    depend on its length.
    """
    counts, any_letter = np.zeros(1 << BITS), False
    for start in range(0, len(text or ""), CHUNK):
        code = np.frombuffer(text[start:start + CHUNK].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        known = letters[np.minimum(code, 0x1FFFF)]
        high = code > 0x1FFFF
        if high.any():
            known = np.where(high, [chr(c).isalpha() for c in code], known)
        if not known.any():
            continue
        any_letter = True
        code = np.where(known, code, 32).astype(_U)
        code = np.concatenate(([32], code, [32])).astype(_U)
        code = code[np.r_[True, (code[1:] != 32) | (code[:-1] != 32)]]
        with np.errstate(over="ignore"):
            gram = np.zeros(len(code), _U)
            for n in range(GRAMS):
                gram = gram[:len(code) - n] * _U(0x100000001B3) + code[n:] + _U(1)
                mixed = (gram ^ (gram >> _U(29))) * _U(0x9E3779B97F4A7C15)
                if n == 0:
                    mixed = mixed[code != 32]
                counts += np.bincount((mixed >> _U(64 - BITS)).astype(np.int64), minlength=1 << BITS)
    return counts if any_letter else None


def _tfidf(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's vector of length one; counts are damped by the logarithm."""
    at = np.flatnonzero(counts)
    value = (1.0 + np.log(counts[at])) * idf[at]
    return at, value / max(np.sqrt((value * value).sum()), 1e-12)


def softmax(scores: np.ndarray) -> np.ndarray:
    up = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return up / up.sum(axis=-1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, epochs: int = EPOCHS,
             alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2
             ) -> tuple[np.ndarray, np.ndarray]:
    """Weights (classes, features) and biases by follow-the-regularised-leader, one row at a time.

    z holds the gradients less what earlier weights were moved by, n the squares of the gradients. A weight is zero
    while its z stays within the L1 penalty, and else the minimum of the linear and quadratic terms seen so far.
    """
    width = 1 << BITS
    z, n = np.zeros((classes, width + 1)), np.zeros((classes, width + 1))

    def weights(at):
        zz, nn = z[:, at], n[:, at]
        return np.where(np.abs(zz) <= l1, 0.0, -(zz - np.sign(zz) * l1) / ((beta + np.sqrt(nn)) / alpha + l2))
    for _ in range(epochs):
        for (at, value), label in zip(rows, labels):
            at, value = np.append(at, width), np.append(value, 1.0)
            w = weights(at)
            p = softmax(w @ value)
            p[label] -= 1.0
            gradient = p[:, None] * value
            squares = gradient * gradient
            z[:, at] += gradient - (np.sqrt(n[:, at] + squares) - np.sqrt(n[:, at])) / alpha * w
            n[:, at] += squares
    final = weights(np.arange(width + 1))
    return final[:, :-1], final[:, -1]


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature in [1/64, 64] under which the labels are likeliest, by golden-section search.

    One wrong label among the rows and two more is reckoned with, so that rows without a fault leave a doubt.
    """
    if not len(labels) or scores.shape[1] < 2:
        return 1.0
    doubt = 1.0 / (len(labels) + 2)
    wanted = np.full(scores.shape, doubt / (scores.shape[1] - 1))
    wanted[np.arange(len(labels)), labels] = 1.0 - doubt

    def loss(log_t):
        return -(wanted * np.log(np.maximum(softmax(scores / np.exp(log_t)), 1e-300))).sum(axis=1).mean()
    low, high, ratio = -np.log(64), np.log(64), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from ``docs`` (doc_id, text, lang); rows without lang or without a letter teach nothing.

    Document frequencies are counted over all rows. Weights are fitted on at most ``sample`` rows of each language,
    those whose ids hash lowest (rows without id are not among them); their sparse vectors come to the driver, whole
    texts do not, and the table of their ids is broadcast to find them. Without any row to
    learn from the model has no language.
    """
    rows = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).filter("lang IS NOT NULL")

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters, seen, n = _letters(), np.zeros(1 << BITS, np.int64), 0
        for b in batches:
            for text in b["text"]:
                counts = gram_counts(text, letters)
                if counts is not None:
                    seen += counts > 0
                    n += 1
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"feature": np.append(at, -1), "n": np.append(seen[at], n)})
    found = (rows.select("text").mapInPandas(frequencies, "feature int, n bigint")
             .groupBy("feature").agg(F.sum("n").alias("n")).collect())
    n_docs = sum(r.n for r in found if r.feature == -1)
    seen = np.zeros(1 << BITS)
    for r in found:
        if r.feature >= 0:
            seen[r.feature] = r.n
    idf = np.log((1.0 + n_docs) / (1.0 + seen)) + 1.0
    empty = Model([], idf, np.zeros((0, 1 << BITS)), np.zeros(0), 1.0)
    if not n_docs:
        return empty

    @F.pandas_udf("binary")
    def counted(texts: pd.Series) -> pd.Series:
        letters = _letters()
        out = []
        for text in texts:
            counts = gram_counts(text, letters)
            if counts is None:
                out.append(None)
            else:
                at = np.flatnonzero(counts)
                out.append(at.astype("<u2").tobytes() + counts[at].astype("<f4").tobytes())
        return pd.Series(out)
    spread = F.xxhash64("doc_id", F.lit(3))
    some = (hashed_sample(rows.select("doc_id", "lang", spread.alias("spread")), "lang", "spread", sample)
            .filter("doc_id IS NOT NULL").select("doc_id", "lang").distinct())
    # ``sample`` ids of each language: a bound of the table that is broadcast
    chosen = (rows.join(F.broadcast(some), ["doc_id", "lang"])
              .select("lang", spread.alias("spread"), "doc_id", counted("text").alias("x")).collect())
    chosen = sorted((r for r in chosen if r.x is not None), key=lambda r: (r.spread, str(r.doc_id), r.lang))
    if not chosen:
        return empty
    langs = sorted({r.lang for r in chosen})
    vectors = []
    for r in chosen:
        size = len(r.x) // 6
        at = np.frombuffer(r.x, "<u2", count=size).astype(np.int64)
        counts = np.zeros(1 << BITS)
        counts[at] = np.frombuffer(r.x, "<f4", offset=2 * size)
        vectors.append(_tfidf(counts, idf))
    label = np.array([langs.index(r.lang) for r in chosen])
    hold = np.arange(len(chosen)) % FOLDS == FOLDS - 1
    weights, bias = fit_ftrl([v for v, h in zip(vectors, hold) if not h], label[~hold], len(langs))
    scores = np.array([weights[:, at] @ value + bias for (at, value), h in zip(vectors, hold) if h])
    return Model(langs, idf, weights.astype(np.float32), bias, fit_temperature(scores, label[hold]))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score (columns of these names are replaced); only the text is looked at.

    score is the calibrated probability of lang_pred. Null texts and texts without a letter are ``und`` with score 0,
    as is every text if the model has no language. The model travels with the function; its size is fixed by the
    feature hash and the number of languages.
    """
    @F.pandas_udf("lang_pred string, score double")
    def classify(texts: pd.Series) -> pd.DataFrame:
        letters, out = _letters(), []
        weights = model.weights.astype(np.float64)
        for text in texts:
            counts = gram_counts(text, letters) if model.langs else None
            if counts is None:
                out.append((UNKNOWN, 0.0))
                continue
            at, value = _tfidf(counts, model.idf)
            p = softmax((weights[:, at] @ value + model.bias) / model.temperature)
            best = int(np.argmax(p))
            out.append((model.langs[best], float(p[best])))
        return pd.DataFrame(out, columns=["lang_pred", "score"])
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.select(*kept, classify("text").alias("_said")).select(*kept, "_said.lang_pred", "_said.score")
