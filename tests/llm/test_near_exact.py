"""Near-copies against a plain comparison of all pairs."""

import random

import pytest

from shelfdiff.llm import gray
from tests.llm.tables import HAS_TABLES, documents
from tests.llm.test_near import groups

DOCS = "doc_id bigint, text string"


def shingles(text, width=5):
    words = (text or "").lower().split()
    return {tuple(words[k:k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()


def similarity(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def slow_lows(rows):
    """The smallest id of each document's group, by all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    links = [(i, j) for k, (i, a) in enumerate(sets) for j, b in sets[:k]
             if min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and similarity(a, b) >= 0.8]
    return {i: low for i, low in groups({i for i, _ in rows}, links).items() if i != low}


def found(spark, rows):
    return {r.doc_id: r.low for r in gray.near_copies(spark.createDataFrame(rows, DOCS)).collect()}


def planted(kind, pairs, length, seed):
    """Texts and changed ones whose similarity lies around 0.8."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(3000)]
    rows = []
    for k in range(pairs):
        text = [rng.choice(words) for _ in range(length)]
        other, share = list(text), rng.uniform(0.0, 0.25)
        more = [rng.choice(words) for _ in range(max(1, int(share * length)))]
        if kind == "substituted":
            for at in rng.sample(range(length), max(1, int(share * length / 6))):
                other[at] = rng.choice(words)
        elif kind == "appended":
            other += more
        elif kind == "block":
            at = rng.randrange(length - len(more) + 1)
            other[at:at + len(more)] = more[:max(1, len(more) // 2)]
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(other))]
    return rows


def test_every_near_copy_is_found(spark):
    rows, at = [], 0
    for kind in ("substituted", "appended", "block"):
        for length in (12, 40, 200):
            part = planted(kind, 60, length, len(rows))
            rows += [(i + at, t) for i, t in part]
            at += len(part)
    want = slow_lows(rows)
    assert 200 < len(want) < 540
    got = found(spark, rows)
    assert not set(want) - set(got)


def test_nothing_else_is_linked(spark):
    """Pairs a little below 0.8, and lines that a text repeats."""
    rows = planted("appended", 80, 150, 3) + [(1000 + i, t) for i, t in planted("block", 80, 150, 4)]
    rng = random.Random(5)
    for k in range(40):
        line = " ".join(rng.choice("abcdefgh") + str(rng.randrange(10 ** 6)) for _ in range(30))
        own = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(12)) for _ in range(2)]
        rows += [(2000 + 2 * k + i, " ".join([line] * 20 + [o])) for i, o in enumerate(own)]
    sets = [shingles(t) for _, t in rows]
    below = sum(0.6 <= similarity(a, b) < 0.8 for a, b in zip(sets[::2], sets[1::2]))
    assert below > 20
    assert found(spark, rows) == slow_lows(rows)


@pytest.mark.parametrize("leaders", [1, 4])
def test_chains_and_shared_lines(spark, leaders, monkeypatch):
    """A line that all have, groups joined only by chains: more are compared than the first ones of a token."""
    monkeypatch.setattr(gray._similar_roots, "__defaults__", (leaders,))
    rng = random.Random(8)
    line, rows = " ".join(f"common{k}" for k in range(60)), []
    for g in range(12):
        text = [f"g{g}x{k}" for k in range(12)]
        for c in range(15):
            rows.append((100 * g + c, line + " " + " ".join(text)))
            text[rng.randrange(12)] = f"new{g}x{c}"
    rng.shuffle(rows)
    assert found(spark, rows) == slow_lows(rows)


@pytest.mark.skipif(not HAS_TABLES, reason="no test tables")
def test_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).select("doc_id", "text").collect()]
    assert found(spark, rows) == slow_lows(rows)


def test_repeated_ids_lose_no_text(spark):
    x, y, z = ("x%d y%d z%d " % (k, k, k) * 3 + " ".join(f"{k}t{j}" for j in range(20)) for k in range(3))

    def kept(rows):
        return sorted((r.doc_id, r.text) for r in gray.one_of_each_group(spark.createDataFrame(rows, DOCS)).collect())
    assert kept([(3, x), (7, x), (7, y)]) == [(3, x), (7, y)]
    assert kept([(3, x), (7, x), (7, y), (9, y), (9, z), (9, z)]) == [(3, x), (7, y), (9, z)]
    # of the texts of 7 one stands for it; the other is kept by 8 or 9
    both = kept([(7, x), (7, y), (8, x), (9, y)])
    assert [t for _, t in both if t == x] == [x] and [t for _, t in both if t == y] == [y] and both[0][0] == 7
