import hashlib
import random
import re
from pathlib import Path

import numpy as np
import pytest

from shelfdiff.llm import parts, queries, suffix_dedup, suffixes
from tests.llm.tables import HAS_TABLES, SF_DIR, awkward, awkward_rows, documents, empty


def brute(rows, length=suffixes.LENGTH):
    """(id, bytes, spans, kept) of every row."""
    last = 2 ** 63 - 1
    rows = [(last if i is None else i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, b in sorted(rows):
        for k in range(len(b) - length + 1):
            least.setdefault(b[k:k + length], i)
    out = []
    for i, b in rows:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if least[b[k:k + length]] < i:
                gone[k:k + length] = b"\1" * length
        edges = [k for k in range(len(b) + 1) if (k < len(b) and gone[k]) != (k > 0 and gone[k - 1])]
        out.append((i, len(b), list(zip(edges[::2], edges[1::2])), bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out)


def got(df):
    return sorted((2 ** 63 - 1 if r.doc_id is None else r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans],
                   bytes(r.kept)) for r in df.collect())


def test_awkward_rows(spark):
    assert got(suffix_dedup.repeated_strings(awkward(spark))) == brute([r[:2] for r in awkward_rows()])
    assert suffix_dedup.repeated_strings(empty(spark)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_random_copies(spark, seed, monkeypatch):
    """Pieces of a few passages, of letters that repeat, at many places; several blocks and buckets."""
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 4000)
    rng = random.Random(seed)
    passages = ["".join(rng.choice("ab é" if k % 2 else "abcdefgh \n") for _ in range(400)) for k in range(5)]
    rows = []
    for i in rng.sample(range(1000), 150):
        text = ""
        for _ in range(rng.randint(0, 5)):
            p, a = rng.choice(passages), rng.randint(0, 350)
            text += p[a:a + rng.randint(0, 120)] + "".join(rng.choice("xyz") for _ in range(rng.randint(0, 20)))
        rows.append((i, text))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(suffix_dedup.repeated_strings(df)) == brute(rows)


def test_multikey_sort():
    rng = np.random.default_rng(0)
    columns = [rng.integers(0, 3, 500).astype(np.uint64) for _ in range(6)]
    order, group = suffixes.multikey_sort(columns)
    rows = list(zip(*(c[order].tolist() for c in columns)))
    assert rows == sorted(rows)
    assert group.tolist() == np.cumsum([k > 0 and rows[k] != rows[k - 1] for k in range(500)]).tolist()


def test_every_window_is_in_one_region_with_its_anchor():
    rng = random.Random(1)
    texts = [("".join(rng.choice("ab") for _ in range(rng.randint(0, 300)))).encode() for _ in range(20)]
    block = suffixes.Block(np.arange(20), texts)
    doc, first, count, anchor, token = block.regions()
    seen = np.concatenate([np.arange(f, f + c) for f, c in zip(first, count)])
    want = np.concatenate([np.arange(s, e - suffixes.LENGTH + 1) for s, e in zip(block.starts, block.ends)])
    assert sorted(seen) == sorted(want)
    assert ((anchor >= first + count - 1) & (anchor - first < suffixes.SPAN)).all()
    content = block.bytes_of(first, count)
    assert (suffixes.tokens_in(content, anchor - first) == token).all()


def test_tokens_travel_unchanged():
    token = np.sort(np.random.default_rng(0).integers(0, 1 << 48, 1000).astype(np.uint64))
    assert (suffix_dedup._long(suffix_dedup._short(token)) == token).all()
    assert len(suffix_dedup._long(suffix_dedup._short(token[:0]))) == 0


def test_texts_without_repeats(spark):
    out = suffix_dedup.without_repeats(awkward(spark))
    assert out.columns == awkward(spark).columns
    want = {}
    for i, _, spans, kept in brute([r[:2] for r in awkward_rows()]):
        want[None if i == 2 ** 63 - 1 else i] = kept.decode("utf-8", "ignore")
    rows = out.collect()
    assert len(rows) == len(awkward_rows())
    for r in rows:
        assert (r.text or "") == want[r.doc_id] and (r.score, r.block, r._doc) == ("s", "b", "d")
        assert r.n_chars == (None if r.text is None else len(r.text))
    assert suffix_dedup.without_repeats(empty(spark)).count() == 0


def test_cut_texts_need_no_second_python_process(spark):
    plan = suffix_dedup.without_repeats(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroups" in plan and "ArrowEvalPython" not in plan


def test_groups_give_their_memory_back():
    def held():
        return int(re.search(r"Pss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) >> 10

    def work(pdf):
        pieces = [b"x" * (50_000 + k % 7) for k in range(2000)]
        kept.append(pieces[-1])
        return pdf
    kept, before = [], held()
    assert parts.tidied(work)(3) == 3 and parts.tidied_pair(lambda a, b: a + b)(1, 2) == 3
    assert held() < before + 30


@pytest.mark.skipif(not HAS_TABLES, reason="no test tables")
def test_query(spark):
    rows = queries.QUERIES["op7_suffix_array"](spark, SF_DIR).collect()
    texts = [(r.doc_id, r.text) for r in documents(spark).select("doc_id", "text").collect()]
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == [
        (i, n, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest())
        for i, n, spans, kept in brute(texts)]
