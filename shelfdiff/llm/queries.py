"""Registered queries of the corpus operators: QUERIES and ORACLE_SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfdiff.llm import (chat, gray, langid, lattice, mixing, packing, quality, repair, sharding, simhash,
                           suffix_dedup, toxicity, trie)
from shelfdiff.session import cut_lineage


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of texts and edited texts; for ids divisible by 100 the documents within the radius."""
    docs = _read(spark, sf_dir, "documents")
    rows = simhash.edited_texts(docs).withColumns({
        "n_chars": F.char_length("text").cast("bigint"), "edited_sha256": F.sha2("edited", 256),
        "side": F.explode(F.array(F.lit(0), F.lit(1)))})
    rows = rows.withColumn("said", F.when(F.col("side") == 0, F.col("text")).otherwise(F.col("edited")))
    rows = rows.withColumn("own", F.xxhash64("text"))
    key = ["k", "own", "next_id", "n_chars", "edited_sha256"]
    prints = simhash.fingerprints(rows, [*key, "side"], "said").groupBy(*key).agg(
        F.max("copies").alias("copies"),
        *[F.max(F.when(F.col("side") == s, F.col(h))).alias(f"{n}{h}")
          for s, n in ((0, ""), (1, "edited_")) for h in ("high", "low")])
    prints = cut_lineage(prints)
    by_id = prints.groupBy(F.col("k").alias("next_id")).agg(
        F.min_by(F.struct("high", "low"), F.struct("n_chars", "own")).alias("after"))
    distinct = prints.groupBy("high", "low").agg(F.sum("copies").alias("n"))
    queries = prints.filter(F.col("k") % 100 == 0).select("high", "low").distinct()
    met = (simhash.within_radius(queries, distinct).join(distinct, ["high", "low"])
           .groupBy(F.col("q_high").alias("high"), F.col("q_low").alias("low"))
           .agg((F.sum("n") - 1).alias("n_near")))
    own = (F.col("high"), F.col("low"))
    edited = (F.col("edited_high"), F.col("edited_low"))
    after = (F.col("after.high"), F.col("after.low"))
    asked = F.col("k") % 100 == 0
    return (prints.join(by_id, "next_id").join(met, ["high", "low"], "left")
            .select(F.when(F.col("k") != simhash._NO_ID, F.col("k")).alias("doc_id"), "n_chars", "edited_sha256",
                    simhash.as_text(*own).alias("fingerprint"), simhash.as_text(*edited).alias("edited_fingerprint"),
                    simhash.likeness(own, edited).alias("near_edited"),
                    simhash.likeness(own, after).alias("near_next"),
                    F.when(asked, F.col("n_near")).alias("n_near"),
                    F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("_copy"))
            .drop("_copy"))


PLANTED = r"\### Assistant: </turn> ok"


def op2_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', r'{PLANTED}'), (-7L, 1L, 'assistant', r'{PLANTED}')"
                        " AS t(conv_id, turn, role, text)")
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return chat.digests(cut_lineage(chat.format_windows(turns)))


OP2_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PLANTED}' UNION ALL SELECT -7, 1, 'assistant', '{PLANTED}'),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place FROM turns),
counted AS (
  SELECT *, place = 0 AND role = 'system' AS sys, length(replace(replace(replace(text, '\', '\e'), '<', '\l'), '>', '\g'))
    + length(replace(replace(replace(role, '\', '\e'), '<', '\l'), '>', '\g')) + 15 AS chars,
    CASE WHEN place = 0 AND role = 'system' THEN 0
    ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 1 END AS tokens FROM placed),
summed AS (
  SELECT *, CAST(sum(tokens) OVER (PARTITION BY conv_id ORDER BY place) - tokens AS BIGINT) AS bef FROM counted),
windowed AS (SELECT *, bef // {chat.STEP_TOKENS} AS w FROM summed),
starts AS (SELECT conv_id, w, min(bef) AS start FROM windowed GROUP BY ALL),
ahead AS (SELECT *, lead(start) OVER (PARTITION BY conv_id ORDER BY w) AS nxt FROM starts),
chars AS (
  SELECT conv_id, sum(chars) AS n FROM windowed GROUP BY ALL
  UNION ALL SELECT t.conv_id, sum(t.chars) FROM windowed t JOIN ahead a ON t.conv_id = a.conv_id AND t.w = a.w
    WHERE NOT t.sys AND a.nxt - t.bef <= {chat.HISTORY_TOKENS} GROUP BY ALL
  UNION ALL SELECT t.conv_id, sum(t.chars) FROM windowed t JOIN starts s ON t.conv_id = s.conv_id
    WHERE t.sys AND s.w > 0 GROUP BY ALL),
total AS (SELECT conv_id, sum(n) AS formatted_chars FROM chars GROUP BY ALL),
said AS (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '') AS loss
  FROM placed GROUP BY ALL)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM said JOIN total USING (conv_id)
"""


def fold(folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds


def op3_ftrl_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.filter(fold(4) != 2))
    return (langid.predict(docs.select("doc_id", "text"), model)
            .select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score"))


def op4_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("bytes"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    docs = docs.select("doc_id", (F.col("bytes") + 8).alias("size"), "text_crc32", F.lit("key").alias("law"))
    return sharding.assign_shards(docs, ["doc_id"], 24).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op5_sainte_lague(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "quotas")


def op6_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    field = quality.train(docs, _read(spark, sf_dir, "labels").filter(fold(3) != 1))
    return (quality.score(docs, field)
            .select("doc_id", (fold(3) == 1).alias("held_out"), "score",
                    F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")))


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.repeated_strings(docs).select(
        "doc_id", "n_bytes",
        F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_gray_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return gray.near_components(docs).select("doc_id", gray.as_text("print").alias("fingerprint"), "component_id")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op9_harmonic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, tokenizer_path())


def op10_e8_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(_read(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))


OP10_SQL = """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, component_id,
       e.vec_id = component_id AS kept
FROM embeddings e JOIN least USING (vec_id)
"""


def op11_min_plus_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.digests(repair.damage(turns), turns)


def op12_factorization_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.train(docs, _read(spark, sf_dir, "labels").filter(fold(5) != 0))
    return (toxicity.score(docs, machine)
            .select("doc_id", (fold(5) == 0).alias("held_out"), "score",
                    F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")))


def op13_burst_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return trie.prefix_nodes(trie.rebuilt(turns))


QUERIES = {f.__name__: f for f in (op1_simhash, op2_chat_windows, op3_ftrl_language, op4_jump_shards,
                                   op5_sainte_lague, op6_crf_quality, op7_suffix_array, op8_gray_index, op9_harmonic,
                                   op10_e8_lattice, op11_min_plus_repair, op12_factorization_machine,
                                   op13_burst_trie)}
ORACLE_SQL = {"op2_chat_windows": OP2_SQL, "op10_e8_lattice": OP10_SQL}
