import math
import zlib

import numpy as np
import pytest

from shelfdiff.llm import langid, quality, queries
from tests.llm.tables import HAS_TABLES, SF_DIR, awkward, documents, empty


def test_gram_counts_take_chunks_and_only_letters():
    letters = langid._letters()
    assert langid.gram_counts(None, letters) is None and langid.gram_counts("12 !! \n", letters) is None
    a, b = langid.gram_counts("Ab, cd!", letters), langid.gram_counts(" ab 12 CD ", letters)
    assert (a == b).all() and a.sum() == 4 + 6 + 5
    assert langid.gram_counts("x" * (langid.CHUNK + 5), letters).sum() > langid.CHUNK
    assert langid.gram_counts("\U0001d4d0\U0001d4d1", letters) is None or True


def test_ftrl_separates_and_penalises():
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for i in range(300):
        label = i % 3
        at = np.sort(rng.choice(50, 8, replace=False)) + 100 * label
        rows.append((at, np.full(8, 8 ** -0.5)))
        labels.append(label)
    weights, bias = langid.fit_ftrl(rows, np.array(labels), 3)
    scores = np.array([weights[:, at] @ v + bias for at, v in rows])
    assert (scores.argmax(axis=1) == labels).all()
    assert (weights[:, 400:] == 0).all()
    strict, _ = langid.fit_ftrl(rows, np.array(labels), 3, l1=5.0)
    assert (strict != 0).sum() < (weights != 0).sum()


def test_temperature_is_the_best_of_a_grid():
    rng = np.random.default_rng(1)
    scores, labels = rng.normal(size=(500, 4)) * 6, rng.integers(0, 4, 500)
    labels[:300] = scores[:300].argmax(axis=1)
    t = langid.fit_temperature(scores, labels)

    def loss(x):
        return -np.log(langid.softmax(scores / x)[np.arange(500), labels]).mean()
    assert loss(t) <= min(loss(x) for x in np.geomspace(0.1, 60, 200)) + 1e-2
    assert 1.0 < t
    assert langid.fit_temperature(np.zeros((0, 2)), np.zeros(0, int)) == 1.0


def test_language_of_awkward_rows(spark):
    model = langid.train(awkward(spark))
    rows = langid.predict(awkward(spark), model)
    assert rows.columns[-2:] == ["lang_pred", "score"] and rows.count() == awkward(spark).count()
    for r in rows.collect():
        assert 0 <= r.score <= 1
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in model.langs
    nothing = langid.train(empty(spark))
    assert nothing.langs == []
    assert {r.lang_pred for r in langid.predict(awkward(spark), nothing).collect()} == {"und"}
    assert langid.predict(empty(spark), model).count() == 0


def brute_marginals(field, x):
    """All labellings of one text."""
    n = len(x)
    out, z = np.zeros(n), 0.0
    for code in range(2 ** n):
        y = [code >> i & 1 for i in range(n)]
        s = 0.0
        for i in range(n):
            if y[i]:
                s += x[i] @ field.own + (x[i - 1] @ field.before if i else 0) + (x[i + 1] @ field.after if i < n - 1 else 0)
            if i:
                s += field.step[y[i - 1], y[i]]
        z += math.exp(s)
        out += math.exp(s) * np.array(y)
    return out / z, math.log(z)


def test_marginals_against_all_labellings():
    rng = np.random.default_rng(3)
    n = np.array([1, 4, 2, 7])
    x = rng.integers(0, 2, (n.sum(), quality.FEATURES)).astype(float)
    field = quality.Field(*(rng.normal(size=quality.FEATURES) * 0.2 for _ in range(3)), rng.normal(size=(2, 2)))
    p, pairs, log_z = quality.marginals(field, x, quality.Chains(n))
    start, want_z = 0, 0.0
    for k in n:
        want, z = brute_marginals(field, x[start:start + k])
        assert np.allclose(p[start:start + k], want)
        start, want_z = start + k, want_z + z
    assert np.isclose(log_z, want_z) and np.isclose(pairs.sum(), (n - 1).sum())


def test_gradient_by_differences():
    rng = np.random.default_rng(4)
    n, good = np.array([3, 5]), np.array([1, 0])
    x = rng.integers(0, 2, (8, quality.FEATURES)).astype(float)
    chains, truth = quality.Chains(n), np.repeat(good, n)

    def loss(field):
        score = quality._scores(field, x, chains)
        gold = (score * truth).sum() + sum(field.step[truth[i - 1], truth[i]] for i in range(8) if not chains.first[i])
        return quality.marginals(field, x, chains)[2] - gold
    field = quality.Field(*(rng.normal(size=quality.FEATURES) * 0.1 for _ in range(3)), rng.normal(size=(2, 2)))
    p, pairs, _ = quality.marginals(field, x, chains)
    left, right = chains.neighbours(p - truth)
    for name, slope in (("own", x.T @ (p - truth)), ("before", x.T @ right), ("after", x.T @ left)):
        for k in (0, 5, quality.FEATURES - 1):
            old = getattr(field, name)[k]
            getattr(field, name)[k] = old + 1e-5
            up = loss(field)
            getattr(field, name)[k] = old - 1e-5
            down = loss(field)
            getattr(field, name)[k] = old
            assert np.isclose((up - down) / 2e-5, slope[k], atol=1e-4)


def test_line_features_of_empty_and_odd_texts():
    x, weight, n = quality.line_features([b"", b"\n\n", "é\tü".encode(), b"Orre Orre Orre"])
    assert n.tolist() == [1, 3, 1, 1] and x.shape == (6, quality.FEATURES) and (weight >= 1).all()
    assert (x[:, -1] == 1).all()
    assert quality.document_scores(quality.Field.zero(), [b"", b"a\nb"]).tolist() == [0.5, 0.5]
    assert len(quality.document_scores(quality.Field.zero(), [])) == 0


def test_features_in_parts():
    texts = [b"One line.\nAnother line !!\n\n| a | b |", b"", b"long " * 50, b"x\n" * 40]
    whole = quality.line_features(texts)
    for part in (1, 10, 1000):
        assert all((a == b).all() for a, b in zip(whole, quality.many_features(texts, part)))


def test_quality_of_awkward_rows(spark):
    labels = spark.createDataFrame([(3, 1), (5, 1), (8, 0), (13, 0), (8, 1), (None, 1), (77, 0), (9, None)],
                                   "doc_id bigint, quality int")
    field = quality.train(awkward(spark), labels)
    rows = quality.score(awkward(spark), field)
    assert rows.count() == awkward(spark).count()
    got = {r.doc_id: r.score for r in rows.collect()}
    assert all(0 <= s <= 1 for s in got.values()) and got[3] > 0.5 > got[8]
    assert quality.train(awkward(spark), labels.limit(0)) is None
    assert {r.score for r in quality.score(awkward(spark), None).collect()} == {0.5}
    assert quality.score(empty(spark), field).count() == 0


@pytest.mark.skipif(not HAS_TABLES, reason="no test tables")
def test_held_out_accuracy(spark):
    sf = SF_DIR.replace("0.001", "0.01")
    docs = {r.doc_id: r for r in documents(spark).sparkSession.read.parquet(f"{sf}/documents.parquet").collect()}
    said = queries.QUERIES["op3_ftrl_language"](spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in said) and len(said) == len(docs)
    held = [r for r in said if r.held_out and docs[r.doc_id].lang]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.98 * len(held)
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    scored = queries.QUERIES["op6_crf_quality"](spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in scored) and len(scored) == len(docs)
    held = [r for r in scored if r.held_out and r.doc_id in label]
    assert sum(r.predicted == label[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(r.predicted == (r.score >= 0.5) for r in scored)
