import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfdiff.llm import queries, toxicity
from tests.llm.tables import LONG, awkward, empty

SCALE_DIR = "/root/testdata/sf0.1"


def invented(n, seed):
    """Texts with two of four words: which two decides, and each word is as often in toxic texts as in clean ones."""
    rng = random.Random(seed)
    plain = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 7))) for _ in range(400)]
    texts, toxic = [], []
    for i in range(n):
        words = rng.choices(plain, k=rng.randint(20, 90))
        at = rng.randrange(len(words) - 5)
        words[at], words[at + 3] = rng.choice(["zorg", "wubb"]), rng.choice(["mulk", "nark"])
        texts.append(" ".join(words))
        toxic.append(int((words[at] == "zorg") == (words[at + 3] == "mulk")))
    return texts, toxic


def fitted(texts, toxic, epochs=30):
    found = [(*toxicity.terms([t.encode()])[:2], int(toxicity.terms([t.encode()])[2][0])) for t in texts]
    return toxicity.fit(found, np.array(toxic), epochs)


def test_learns_pairs_that_no_weights_tell():
    machine = fitted(*invented(1500, 1))
    texts, toxic = invented(200, 2)
    scores = toxicity.document_scores(machine, [t.encode() for t in texts])
    machine = toxicity.calibrated(machine, scores, np.array(toxic))
    texts, toxic = invented(200, 3)
    said = machine.slope * toxicity.document_scores(machine, [t.encode() for t in texts]) + machine.shift > 0
    assert (said == np.array(toxic)).mean() > 0.9


def test_terms_equal_plain_python(monkeypatch):
    monkeypatch.setattr(toxicity, "HALF", 32)
    texts = ["Ich bin's, wörterbuch  x1y ab" + " abcdef" * 70, "", "...", "one"]
    half, key, halves = toxicity.terms([t.lower().encode() for t in texts])
    assert halves.tolist() == [3, 1, 1, 1]
    assert len(set(zip(half.tolist(), key.tolist()))) == len(key)
    twice = toxicity.terms([b"abcdef abcdef abcdef"])[1]
    assert len(twice) == 6 and set(~twice) == set(twice)
    assert half.max() == 5
    same = toxicity.terms([b"zebra abcdef"])[1]
    assert set(same) & set(key[half == 1]) == set(toxicity.terms([b"abcdef"])[1])


def test_score_equals_sum_over_pairs():
    rng = np.random.default_rng(0)
    machine = toxicity.Machine(np.arange(6, dtype=np.uint64), rng.normal(size=6), rng.normal(size=(6, 3)), 0.5)
    window, term = np.array([0, 0, 0, 2, 2]), np.array([0, 3, 5, 1, 2])
    plain = []
    for w in range(3):
        t = term[window == w]
        pairs = sum(machine.factor[a] @ machine.factor[b] for i, a in enumerate(t) for b in t[i + 1:])
        plain.append(0.5 + machine.weight[t].sum() + pairs)
    assert np.allclose(toxicity.window_scores(machine, window, term, 3), plain)


def test_gradient_equals_differences():
    rng = np.random.default_rng(1)
    keys = np.arange(5, dtype=np.uint64)
    machine = toxicity.Machine(keys, rng.normal(size=5), rng.normal(size=(5, 2)), -0.3)
    window, term = np.array([0, 0, 1, 2, 2, 3]), np.array([0, 1, 2, 1, 3, 4])
    first, toxic = np.array([0, 2, 4]), np.array([1, 0])
    by_weight, by_factor, by_bias, _ = toxicity.gradient(machine, window, term, first, toxic)

    def loss(weight, factor, bias):
        return toxicity.gradient(toxicity.Machine(keys, weight, factor, bias), window, term, first, toxic)[3]
    e = 1e-6
    for i in range(5):
        up, down = machine.weight.copy(), machine.weight.copy()
        up[i] += e
        down[i] -= e
        assert np.isclose((loss(up, machine.factor, -0.3) - loss(down, machine.factor, -0.3)) / (2 * e), by_weight[i], atol=1e-5)
        for k in range(2):
            up, down = machine.factor.copy(), machine.factor.copy()
            up[i, k] += e
            down[i, k] -= e
            assert np.isclose((loss(machine.weight, up, -0.3) - loss(machine.weight, down, -0.3)) / (2 * e),
                              by_factor[i, k], atol=1e-5)
    assert np.isclose((loss(machine.weight, machine.factor, -0.3 + e) - loss(machine.weight, machine.factor, -0.3 - e))
                      / (2 * e), by_bias, atol=1e-5)


def test_parts_of_a_text_do_not_matter():
    machine = fitted(*invented(200, 3), epochs=3)
    texts = [t.encode() for t in invented(40, 4)[0]] + [b"", b" zorg mulk " * 400]
    each = [toxicity.text_scores(machine, [t])[0] for t in texts]
    assert np.allclose(toxicity.document_scores(machine, texts, 1 << 12)[:-1], each[:-1])
    assert np.isfinite(toxicity.document_scores(machine, [b"x" * 50_000], 1 << 10)).all()


def test_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(5, 1), (9, 0), (7, 0), (11, 1), (11, 0), (None, 1), (6, 7)], "doc_id bigint, toxic int")
    rows = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(empty(spark), toxicity.train(empty(spark), labels)).count() == 0
    nothing = toxicity.score(docs, toxicity.train(docs, labels.limit(0))).select("score").distinct().count()
    assert nothing == 1 and len(LONG) > 200_000


@pytest.mark.skipif(not __import__("os").path.isdir(SCALE_DIR), reason="tables not given")
def test_held_out_accuracy(spark):
    rows = (queries.op12_factorization_machine(spark, SCALE_DIR).join(
        spark.read.parquet(f"{SCALE_DIR}/labels.parquet"), "doc_id").filter("held_out")
        .groupBy("toxic", "predicted").agg(F.count(F.lit(1)).alias("n")).collect())
    n = {(r.toxic, r.predicted): r.n for r in rows}
    # of the toxic labels of this table about one in sixteen stands on a text without any toxic word
    assert n.get((1, 1), 0) >= 0.85 * (n.get((1, 1), 0) + n.get((1, 0), 0))
    assert n.get((0, 0), 0) >= 0.99 * (n.get((0, 0), 0) + n.get((0, 1), 0))
