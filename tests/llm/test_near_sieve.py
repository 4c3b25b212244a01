"""The parts of the near-copy search: parity maps, the sieve of prefix tokens, hot tokens on their own."""

import random

import numpy as np
import pytest

from shelfdiff.llm import bits, gray
from tests.llm.test_near_exact import DOCS, found, planted, slow_lows


def test_parity_maps_never_differ_more_than_their_sets():
    rng = np.random.default_rng(3)
    for _ in range(300):
        size, more, less = (int(n) for n in rng.integers(0, 400, 3))
        base = np.unique(rng.integers(0, 2 ** 63, size, dtype=np.uint64))
        other = np.unique(np.concatenate([base[min(less, len(base)):], rng.integers(0, 2 ** 63, more, dtype=np.uint64)]))
        apart = len(np.setxor1d(base, other))
        assert gray._apart(gray._parity(base), gray._parity(other)) <= apart


def test_parity_maps_of_unlike_lengths_fold():
    rng = np.random.default_rng(4)
    short = np.unique(rng.integers(0, 2 ** 63, 60, dtype=np.uint64))
    long = np.unique(np.concatenate([short, rng.integers(0, 2 ** 63, 7, dtype=np.uint64)]))
    assert len(gray._parity(long)) > len(gray._parity(short))
    assert gray._apart(gray._parity(short), gray._parity(long)) <= 7


def plain_pairs(rows, common, often):
    """Pairs of different sets that share a prefix token, one pair of texts at a time."""
    held = {}
    for _, t in rows:
        found = gray._shingle_set(t)
        name = int(np.uint64(bits.set_hash(found)).view(np.int64))
        held[name] = set(gray._prefix(found, common, often, 0.8).tolist())
    return {(a, b) for a in held for b in held if a < b and held[a] & held[b]}


@pytest.mark.parametrize("sieve_tokens", [8, 300, gray.SIEVE_TOKENS])
def test_the_sieve_keeps_every_pair(spark, sieve_tokens):
    """Many buckets, one bucket, and common tokens as rows of their own (8: every token the sample counts is hot)."""
    rng = random.Random(6)
    line = " ".join(f"common{k}" for k in range(30))
    rows = planted("appended", 40, 40, 1) + [(100 + k, line) for k in range(6)]
    rows += [(200 + k, line + " " + " ".join(f"{k}w{rng.randrange(99)}" for _ in range(9))) for k in range(20)]
    rows += [(300, None), (301, ""), (302, " \t"), (303, "one"), (304, "one")]
    docs = spark.createDataFrame(rows, DOCS)
    shingles = sum(len(gray._shingle_set(t)) for _, t in rows)
    met = gray._shared_tokens(docs, len(rows), shingles, 0.8, sieve_tokens).collect()
    by_token = {}
    for r in met:
        by_token.setdefault(r.token, set()).add(r.node)
    got = {(a, b) for nodes in by_token.values() for a in nodes for b in nodes if a < b}
    assert got == plain_pairs(rows, *gray._common_shingles(docs))


def test_the_sieve_of_nothing(spark):
    docs = spark.createDataFrame([], DOCS)
    assert gray._shared_tokens(docs, 0, 0, 0.8).count() == 0


@pytest.mark.parametrize("asked", [0, gray.ASKED_TEXTS])
def test_few_and_many_texts_are_compared_alike(spark, asked, monkeypatch):
    monkeypatch.setattr(gray, "ASKED_TEXTS", asked)
    rows = planted("substituted", 30, 40, 2)
    assert found(spark, rows) == slow_lows(rows)
