import hashlib

import pytest
from pyspark.sql import functions as F

from shelfdiff.llm import queries, simhash
from tests.llm.tables import HAS_TABLES, SF_DIR, awkward, awkward_rows, documents, empty


def edited(rows):
    """Brute force: the text with its second half overwritten by the start of the next id's smallest text."""
    low = -(2 ** 63)
    texts = [(low if i is None else i, t or "") for i, t in rows]
    first = {}
    for i, t in sorted(texts):
        first.setdefault(i, t)
    ids = sorted(first)
    after = {i: first[ids[(k + 1) % len(ids)]] for k, i in enumerate(ids)}
    return sorted((i, t, t[:len(t) - len(t) // 2] + after[i][:len(t) // 2]) for i, t in texts)


def test_edited_texts(spark):
    got = sorted((r.k, r.text, r.edited) for r in simhash.edited_texts(awkward(spark)).collect())
    assert got == edited([r[:2] for r in awkward_rows()])
    assert simhash.edited_texts(empty(spark)).count() == 0


def test_one_document_follows_itself(spark):
    one = awkward(spark).filter("doc_id = 11")
    assert simhash.edited_texts(one).first().edited == "zwei " + "zwei "


def test_equal_texts_have_equal_prints_and_empty_ones_zero(spark):
    prints = simhash.fingerprints(awkward(spark), ["doc_id", "text"]).collect()
    by_text = {}
    for r in prints:
        by_text.setdefault(r.text, set()).add((r.high, r.low))
    assert all(len(v) == 1 for v in by_text.values())
    assert by_text[None] == by_text[""] == by_text[" \t\n "] == {(0, 0)}
    assert {r.doc_id: r.copies for r in prints}[3] == 2


def test_votes_by_hand(spark):
    """Bits by brute force, from the term hashes Spark gives."""
    text = "one two two three one two"
    words = text.split()
    terms = [(a, b) for a, b in zip(words, words[1:] + [None])]
    df = spark.createDataFrame(terms, "a string, b string").select(
        "a", "b", F.xxhash64("a", "b").alias("h"), F.xxhash64(F.xxhash64("a", "b")).alias("g"))
    rows = df.collect()
    want = []
    for name in ("h", "g"):
        bits = 0
        for k in range(64):
            vote = sum((1 if r[name] >> k & 1 else -1) * min(24, len(r.a) + len(r.b or "")) for r in rows)
            bits |= (vote > 0) << k
        want.append(bits - (1 << 64) if bits >> 63 else bits)
    got = simhash.fingerprints(spark.createDataFrame([(1, text)], "k int, text string"), ["k"]).first()
    assert [got.high, got.low] == want


def test_tables_find_everything_in_the_radius(spark):
    import random
    rng = random.Random(4)
    base = [(rng.getrandbits(64), rng.getrandbits(64)) for _ in range(20)]
    prints = set()
    for h, g in base:
        for _ in range(12):
            a, b = h, g
            for k in rng.sample(range(128), rng.randint(0, 11)):
                a, b = (a ^ 1 << k, b) if k < 64 else (a, b ^ 1 << k - 64)
            prints.add((a, b))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    index = spark.createDataFrame([(signed(a), signed(b)) for a, b in prints], "high bigint, low bigint")
    queries_ = spark.createDataFrame([(signed(a), signed(b)) for a, b in base], "high bigint, low bigint")
    got = sorted((r.q_high, r.q_low, r.high, r.low) for r in simhash.within_radius(queries_, index).collect())
    want = sorted((signed(a), signed(b), signed(c), signed(d)) for a, b in base for c, d in prints
                  if (a ^ c).bit_count() + (b ^ d).bit_count() <= simhash.RADIUS)
    assert got == want
    with pytest.raises(ValueError):
        simhash.within_radius(queries_, index, radius=8)


@pytest.mark.skipif(not HAS_TABLES, reason="no test tables")
def test_query(spark):
    rows = {r.doc_id: r for r in queries.QUERIES["op1_simhash"](spark, SF_DIR).collect()}
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    want = {i: (len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e in edited(list(texts.items()))}
    assert {i: (r.n_chars, r.edited_sha256) for i, r in rows.items()} == want
    assert sum(r.near_edited > r.near_next for r in rows.values()) >= 0.95 * len(rows)
    assert all((r.n_near is not None) == (i % 100 == 0) for i, r in rows.items())
    plan = queries.QUERIES["op1_simhash"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
