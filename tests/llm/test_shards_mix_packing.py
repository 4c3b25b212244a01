import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfdiff.llm import mixing, packing, parts, queries, sharding
from tests.llm.tables import HAS_TABLES, SF_DIR, awkward, awkward_rows, documents, empty

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def slow_jump(key, shards):
    """One key at a time, in exact integers but for the division."""
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * sharding.JUMP_MULTIPLIER + 1) % 2 ** 64
        j = int((b + 1) * (2.0 ** 31 / ((key >> 33) + 1)))
    return b


def test_jump_hash_against_one_key_at_a_time():
    rng = random.Random(1)
    keys = [0, 1, 2 ** 64 - 1] + [rng.getrandbits(64) for _ in range(500)]
    for shards in (1, 2, 24, 25, 1000):
        assert sharding.jump_buckets(np.array(keys, np.uint64), shards).tolist() == [slow_jump(k, shards) for k in keys]
    with pytest.raises(ValueError):
        sharding.jump_buckets(np.zeros(1, np.uint64), 0)


def check_shards(rows, shards=24):
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < shards and r.grown_shard in (r.shard, shards)
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards_of_awkward_rows(spark):
    placed = sharding.assign_shards(awkward(spark), ["doc_id"], 24)
    rows = placed.collect()
    check_shards(rows)
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in awkward_rows())
    by_id = defaultdict(set)
    for r in rows:
        by_id[r.doc_id].add(r.shard)
    assert all(len(v) == 1 for v in by_id.values())
    assert sharding.assign_shards(empty(spark), ["doc_id"], 24).count() == 0


def test_written_shards(spark, tmp_path):
    sharding.write_shards(sharding.assign_shards(awkward(spark), ["doc_id"], 3), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == len(awkward_rows())


def test_running_total_in_a_hot_group(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("g"),
                                  F.xxhash64("id").alias("h"), (F.col("id") % 7).alias("v"))
    rows = parts.running_total(df, ["g"], "h", F.col("v"), ranges=16).collect()
    seen = defaultdict(int)
    for r in sorted(rows, key=lambda r: (str(r.g), r.h % 2 ** 64)):
        assert r.before == seen[r.g]
        seen[r.g] += r.v
    assert all(r.total == seen[r.g] for r in rows) and len(rows) == 5000


def slow_seats(votes, limits, house):
    seats = [0] * len(votes)
    for _ in range(house):
        best = max((v / (2 * s + 1), -i) for i, (v, s, c) in enumerate(zip(votes, seats, limits)) if s < c and v > 0)
        seats[-best[1]] += 1
    return seats


def test_seats_against_one_by_one():
    rng = random.Random(3)
    for _ in range(60):
        n = rng.randint(1, 8)
        votes = [rng.choice([0.0, rng.random() * 100, float(rng.randint(1, 4))]) for _ in range(n)]
        votes[0] = 1.0
        limits = [rng.randint(1, 60) for _ in range(n)]
        room = sum(c for v, c in zip(votes, limits) if v > 0)
        houses = sorted(rng.randint(0, room) for _ in range(4))
        got = mixing.sainte_lague(votes, limits, houses)
        assert [list(g) for g in got] == [slow_seats(votes, limits, h) for h in houses]


def test_targets_stop_at_three_times_the_size():
    s = [mixing.Source("a", 10, 1), mixing.Source("b", 100, 2), mixing.Source("c", 1000, 3), mixing.Source(None, 0, 1)]
    got = mixing.targets(s)
    assert np.isclose(sum(got), 1110) and got[0] == 30 and got[1] == 300 and np.isclose(got[2], 780) and got[3] == 0
    assert mixing.targets([]) == []


def replay(rows, plan, block):
    """Taken words of each document by drawing block after block."""
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    taken = {}
    for p in plan:
        place = 0
        for r in sorted(by[p[0]], key=lambda r: r.before):
            assert r.before == place
            n = 0
            for w in range(r.size):
                b = min((place + w) // block, p[5] - 1)
                n += p[3] + (((b + 1) * p[4] + p[6]) // p[5] - (b * p[4] + p[6]) // p[5])
            taken[r.doc_id, r.before, r.size] = n
            place += r.size
    return taken


@pytest.mark.parametrize("block", [1, 4, 64])
def test_mix_against_drawing_word_by_word(spark, block):
    mixed = mixing.mix(awkward(spark), block=block)
    rows = mixed.collect()
    sizes = Counter()
    for r in awkward_rows():
        sizes[r[3]] += len(WORDS.findall(r[1] or ""))
    given = mixing.cyclic_weights(list(sizes))
    sources = [mixing.Source(s, sizes[s], given[s]) for s in sorted(sizes, key=lambda s: (s is None, s or ""))]
    plan = mixing.plan_mix(sources, block)
    want = replay(rows, plan, block)
    assert len(rows) == len(awkward_rows())
    for r in rows:
        assert r.taken == want[r.doc_id, r.before, r.size] and 0 <= r.taken <= 3 * r.size
        assert r.source_size == sizes[r.source]
    for p in plan:
        got = sum(r.taken for r in rows if r.source == p[0])
        assert abs(got - p[2]) <= 2.5 * block and abs(sum(p[7]) * block - p[2]) <= 1.5 * block
    again = sorted((str(r.doc_id), r.before, r.taken) for r in mixing.mix(awkward(spark).repartition(3), block=block).collect())
    assert again == sorted((str(r.doc_id), r.before, r.taken) for r in rows)
    words = Counter()
    for r in mixing.mixed_texts(awkward(spark), mixed, block).collect():
        words[r.doc_id] += len(WORDS.findall(r.text))
        assert r.n_chars == len(r.text) and (r.score, r._doc) == ("s", "d")
    total = Counter()
    for r in rows:
        total[r.doc_id] += r.taken
    assert +words == +total


def test_mix_of_nothing(spark):
    assert mixing.mix(empty(spark)).count() == 0
    assert mixing.mixed_texts(empty(spark), mixing.mix(empty(spark))).count() == 0


@pytest.mark.skipif(not HAS_TABLES, reason="no test tables")
def test_shard_and_mix_queries(spark):
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    rows = queries.QUERIES["op4_jump_shards"](spark, SF_DIR).collect()
    check_shards(rows)
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {
        i: (len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in texts.items()}
    rows = queries.QUERIES["op5_sainte_lague"](spark, SF_DIR).collect()
    assert {r.doc_id: r.size for r in rows} == {i: len(WORDS.findall(t)) for i, t in texts.items()}
    near = defaultdict(lambda: [0, 0.0])
    for r in rows:
        near[r.source][0] += r.taken
        near[r.source][1] = r.target
    assert all(abs(a - t) <= 2.5 * mixing.BLOCK_WORDS for a, t in near.values())
    assert np.isclose(sum(t for _, t in near.values()), sum(r.size for r in rows))


# ---------------------------------------------------------------- packing


def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(queries.tokenizer_path())


def test_encoder_equals_the_tokenizer():
    rng, slow, fast = random.Random(5), tokenizer(), packing.Encoder(queries.tokenizer_path())
    bits = [" ", "  ", "\n", "\t", "'s", "'", "'ll", "a", "B", "é", "1", "23", "#", "　", "日", "<|endoftext|>", ".", "\r\n",
            "\u0085", "​", "\U0001f600", "é", "word"]
    for _ in range(1500):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert fast.encode(t) == np.array(slow.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_cut():
    for n in range(1, 5000, 7):
        lengths = packing.cut(n)
        assert sum(lengths) == n and all(x > 0 for x in lengths)
        assert all(1024 % x == 0 and x >= 64 for x in lengths[:-1])
    assert packing.cut(1024) == [1024] and packing.cut(1087) == [1024, 63]


def check_packed(rows, texts, capacity=1024):
    slow = tokenizer()
    pieces, bins, padding, tokens = Counter(), defaultdict(list), 0, 0
    encoded = {t: np.array(slow.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for t in texts.values()}
    for r in rows:
        ids = encoded[texts[r.doc_id]]
        assert r.doc_tokens == len(ids)
        assert zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32
        pieces[r.doc_id] += r.length
        bins[r.sequence_id].append(r)
    for v in bins.values():
        place = 0
        for r in sorted(v, key=lambda r: r.offset):
            assert r.offset == place
            place += r.length
        assert place <= capacity
        tokens += place
        padding += 0 if place & (place - 1) == 0 else capacity - place
    return pieces, {i: len(encoded[t]) for i, t in texts.items()}, padding / tokens


def test_packing_of_awkward_rows(spark):
    rows = packing.pack(awkward(spark), queries.tokenizer_path()).collect()
    texts = {r[0]: r[1] for r in awkward_rows()}
    got, want, _ = check_packed(rows, texts)
    want[3] *= 2
    assert got == want
    assert packing.pack(empty(spark), queries.tokenizer_path()).count() == 0


def test_sequences_are_padded_but_at_powers_of_two(spark):
    docs = awkward(spark).filter("doc_id <> 3")
    rows = packing.sequences(docs, queries.tokenizer_path()).collect()
    slow, texts = tokenizer(), {r[0]: r[1] for r in awkward_rows()}
    back = defaultdict(dict)
    for r in rows:
        assert len(r.ids) == 1024 or len(r.ids) == r.length and r.length & (r.length - 1) == 0
        for p in r.pieces:
            back[p.doc_id][p.start] = r.ids[p.offset:p.offset + p.length]
    for i, found in back.items():
        ids = [x for s in sorted(found) for x in found[s]]
        assert ids == slow.encode(texts[i] or "", add_special_tokens=False).ids + [0]


@pytest.mark.skipif(not HAS_TABLES, reason="no test tables")
def test_packing_query(spark):
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    got, want, padding = check_packed(queries.QUERIES["op9_harmonic"](spark, SF_DIR).collect(), texts)
    assert got == want and padding < 0.02


def test_hashed_sample_takes_the_lowest_hashes_of_each_value(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 50 == 0, "rare").when(F.col("id") % 7 > 0, "hot")
                                    .alias("g"), F.xxhash64("id").alias("h"))
    rows = df.collect()
    got = parts.hashed_sample(df, "g", "h", 100).collect()
    for g in ("rare", "hot"):
        want = sorted((r.h % 2 ** 64) >> 1 for r in rows if r.g == g)[:100]
        assert sorted((r.h % 2 ** 64) >> 1 for r in got if r.g == g) == want
    assert {r.g for r in got} == {"rare", "hot"}
    assert parts.hashed_sample(df.limit(0), "g", "h", 100).count() == 0


@pytest.mark.parametrize("text", [" " * 2_000_000, "\n" * 2_000_000, "w" * 2_000_000, "a" + "\t \n" * 700_000 + "b",
                                  "!" * 300_000 + "7" * 300_000])
def test_long_runs_are_encoded_without_a_crash(text):
    from tokenizers import Tokenizer
    path = queries.tokenizer_path()
    ids = np.array(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert packing.Encoder(path).encode(text) == ids


def test_a_null_key_leaves_the_others_alone(spark):
    keys = [(k * 7919 ** 4 + 12345678901234567 * k % (1 << 62),) for k in range(1000)]
    def shards(rows):
        df = spark.createDataFrame(rows, "k bigint").coalesce(1)
        return {r.k: r.s for r in df.select("k", sharding.jump_shard(F.col("k"), 24).alias("s")).collect()}
    alone, beside = shards(keys), shards([(None,), *keys])
    assert beside.pop(None) == shards([(0,)])[0] and alone == beside


def test_columns_with_the_names_used_inside_are_kept(spark):
    names = ["_key", "_value", "_range", "_spread", "_total", "key", "row", "spread", "total", "before", "a.b"]
    rows = [tuple([i, *[f"{n}{i}" for n in names]]) for i in range(20)]
    df = spark.createDataFrame(rows, ["doc_id", *names])
    out = sharding.assign_shards(df, ["doc_id"], 4)
    assert out.columns == ["doc_id", *names, "shard", "slot", "grown_shard"]
    assert sorted(tuple(r)[:len(names) + 1] for r in out.collect()) == rows


def test_sources_below_a_block_come_near_their_targets():
    sources = [mixing.Source("big", 5000, 1.0), mixing.Source("five", 5, 2.0), mixing.Source("two", 2, 3.0),
               mixing.Source("forty", 40, 1.0), mixing.Source("none", 0, 2.0)]
    for (name, size, target, whole, extra, blocks, *_rest), source in zip(mixing.plan_mix(sources), sources):
        if 0 < size < mixing.BLOCK_WORDS:
            assert blocks == 1 and abs(size * (whole + extra) - target) <= size / 2
            assert whole + extra <= mixing.MOST_COPIES
    tiny = mixing.plan_mix(sources)[1]
    assert tiny[2] == 15 and tiny[3] + tiny[4] == 3
