import hashlib
import random
import re
import zlib

import pytest

from shelfdiff.llm import queries, trie
from tests.llm.tables import HAS_TABLES, SF_DIR

SCHEMA = "conv_id bigint, turn bigint, role string, text string, head string, path string, depth int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, rows):
    return spark.createDataFrame([(*r, "h", "p", 1) for r in rows], SCHEMA)


def brute_nodes(rows):
    def name(role, text):
        return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
    own = {}
    for conv, turn, role, text in rows:
        own.setdefault(conv, []).append(((turn is not None, turn or 0), name(role or "", text or ""), role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 4
        first = [] if c is None else own.get(c - c % 20, [])
        built[c] = tuple(first[:h] + turns[h:])
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    low = {p: min((c for c in m if c is not None), default=None) for p, m in nodes.items()}
    children = {p: 0 for p in nodes}
    for p in nodes:
        if p:
            children[p[:-1]] += 1
    leaves, saved = {p: 0 for p in nodes}, {p: 0 for p in nodes}
    for p, m in nodes.items():
        own_saved = (len(m) - 1) * len(WORD.findall(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += own_saved
    out = []
    for p, m in nodes.items():
        ends = ",".join(map(str, sorted(c for c in m if c is not None and built[c] == p)))
        out.append((low[p], len(p), low[p[:-1]] if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def random_rows(conversations=300, seed=1):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        for t in range(rng.randint(1, 7)):
            role = rng.choice(["user", "assistant", None])
            text = rng.choice(["a b", "a b", "c", "", None, f"x{rng.randrange(3)}", "é  f\n"])
            rows.append((None if c == 7 else c, None if rng.random() < 0.05 else t, role, text))
    copy = [("user", "hello there"), ("assistant", "hi"), ("user", "so long text " * 5)]
    rows += [(1000 + 20 * c, t, r, x) for c in range(60) for t, (r, x) in enumerate(copy)]
    rows += [(9000 + 20 * c, t, *copy[t % 3]) for c in range(40) for t in range(c)]  # each the beginning of the next
    return rows + rows[:4]


def told(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


@pytest.mark.parametrize("container,rounds", [(1, 2), (30, 12), (512, 12)])
def test_nodes_equal_brute_force(spark, container, rounds):
    rows = random_rows()
    assert told(trie.prefix_nodes(trie.rebuilt(table(spark, rows)), container, rounds)) == brute_nodes(rows)


def test_ids_of_a_class_in_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_IDS", 3)
    rows = [(c, 0, "user", "same") for c in range(0, 4000, 20)] + [(-40, 0, "user", "same"), (-60, 0, "user", "same")]
    assert told(trie.prefix_nodes(trie.rebuilt(table(spark, rows)))) == brute_nodes(rows)


def test_very_long_text_and_conversation(spark):
    rows = [(20, 0, "user", "word " * 200_000), (21, 0, "user", "word " * 200_000)]
    rows += [(40, t, "user", str(t)) for t in range(3000)] + [(60, t, "user", str(t)) for t in range(3000)]
    assert told(trie.prefix_nodes(trie.rebuilt(table(spark, rows)), 1)) == brute_nodes(rows)


def test_empty_table(spark):
    assert trie.prefix_nodes(trie.rebuilt(table(spark, []))).count() == 0


@pytest.mark.skipif(not HAS_TABLES, reason="tables not given")
def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert told(queries.op13_burst_trie(spark, SF_DIR)) == brute_nodes(rows)
