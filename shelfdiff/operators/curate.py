"""Requests to an editor, its answers, and their cautious application to items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfdiff import fixed_values as fixed
from shelfdiff.functions.text import strip_fence
from shelfdiff.operators.ordering import number_in_group
from shelfdiff.session import by_shuffle

PAIR = ["source_id", "week"]
KEY = [*PAIR, "external_id"]
BATCH = [*PAIR, "batch"]

_ENTRY = T.StructType([T.StructField(n, T.StringType()) for n in
                       ("ref", "name", "category", "blurb", "out_of_scope")])


def request_batches(added: DataFrame, enriched: DataFrame,
                    size: int = fixed.BATCH_SIZE) -> tuple[DataFrame, DataFrame]:
    """``(ref_map, payload)``: batches of ``size`` items in list order.

    Items are named by a reference that only holds inside the batch (``r0``, ``r1``, ...), so
    product keys stay at home and cannot come back mangled.
    """
    numbered = number_in_group(added, PAIR, "pos")
    refs = (numbered.withColumn("batch", F.floor((F.col("rn") - 1) / size).cast("bigint"))
            .withColumn("slot", ((F.col("rn") - 1) % size).cast("int"))
            .withColumn("ref", F.concat(F.lit("r"), F.col("slot").cast("string"))))
    ref_map = refs.select(*BATCH, "slot", "ref", "external_id", "name")
    described = enriched.select(*KEY, F.col("description").alias("_description"))
    entry = F.struct("slot", F.struct(
        "ref", "name", "category_raw", "price",
        F.col("_description").alias("description")).alias("item"))
    payload = (refs.join(by_shuffle(described), KEY, "left").groupBy(*BATCH)
               .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
               .select(*BATCH, F.to_json(F.col("entries.item"),
                                         {"ignoreNullFields": "false"}).alias("payload")))
    return ref_map, payload


def parse_responses(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(entries, failed batches)`` from the text each batch got back.

    ``{"items": [...]}`` or a bare array, fenced or not. Entries need a textual ref, the last
    one of a ref wins, and an answer without any usable entry failed. One batch answers at most
    a batch size of items, so its entries fit a row.
    """
    # each step is a column, so that a text is parsed once however often the next step uses it
    parsed = responses.select(*BATCH, F.try_parse_json(strip_fence(F.col("response"))).alias("_json"))
    entry = "struct<ref: variant, name: string, category: string, blurb: string, out_of_scope: boolean>"
    read = parsed.withColumn("_entries", F.coalesce(F.try_variant_get("_json", "$", f"array<{entry}>"),
                                                    F.try_variant_get("_json", "$.items", f"array<{entry}>")))

    def textual(value):
        return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))

    usable = F.filter(
        F.transform("_entries", lambda e: F.struct(
            textual(e["ref"]).alias("ref"), e["name"].alias("name"), e["category"].alias("category"),
            e["blurb"].alias("blurb"), F.coalesce(e["out_of_scope"], F.lit(False)).alias("out_of_scope"))),
        lambda e: e["ref"].isNotNull())
    # made by a generator, entries stay where they are; filters on a plain column would compute them again
    answers = read.select(*BATCH, F.inline(F.array(F.struct(usable.alias("_usable")))))
    failed = answers.filter(F.coalesce(F.size("_usable") <= 0, F.lit(True))).select(*BATCH)
    last = (answers.select(*BATCH, F.posexplode("_usable").alias("_at", "_e"))
            .groupBy(*BATCH, F.col("_e.ref").alias("ref"))
            .agg(F.max_by("_e", "_at").alias("_e")))
    return last.select(*BATCH, "ref", "_e.name", "_e.category", "_e.blurb",
                       "_e.out_of_scope"), failed


def rekey(entries: DataFrame, ref_map: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(edits by product key, items the answers left out)``; invented refs are dropped."""
    edits = (entries.join(by_shuffle(ref_map.select(*BATCH, "ref", "external_id")), [*BATCH, "ref"])
             .select(*KEY, "name", "category", "blurb", "out_of_scope"))
    answered = entries.select(*BATCH).distinct()
    missing = (ref_map.join(by_shuffle(answered), BATCH, "left_semi")
               .join(by_shuffle(entries), [*BATCH, "ref"], "left_anti"))
    return edits, missing


def apply_edits(added: DataFrame, edits: DataFrame, enriched: DataFrame,
                max_blurb: int = fixed.MAX_BLURB_CHARS) -> DataFrame:
    """What each item is published with: category, tags, blurb, out_of_scope.

    An edit that renamed its item is ignored whole. Without an edit the item keeps its own
    category and stays in scope. A blurb needs a description behind it.
    """
    edit = edits.select(*KEY, F.struct("name", "category", "blurb", "out_of_scope").alias("_e"))
    facts = enriched.select(*KEY, F.col("description").alias("_description"),
                            F.col("tags").alias("_tags"))
    honest = F.coalesce(F.col("_e.name") == F.col("name"), F.lit(False))
    blurb = F.when(honest & (F.col("_e.blurb") != "") & (F.col("_description") != ""),
                   F.substring("_e.blurb", 1, max_blurb))
    category = F.coalesce(F.when(honest & (F.col("_e.category") != ""), F.col("_e.category")),
                          F.col("category_raw"))
    return (added.join(by_shuffle(edit), KEY, "left").join(by_shuffle(facts), KEY, "left")
            .select(*KEY, category.alias("category"),
                    F.coalesce("_tags", F.array().cast("array<string>")).alias("tags"),
                    blurb.alias("blurb"),
                    (honest & F.coalesce("_e.out_of_scope", F.lit(False))).alias("out_of_scope")))


def with_taxonomy(rows: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Adds the channel's category list; null for a channel without one.

    Items of such a channel go out with their own category and without an edit.
    """
    lists = (taxonomy.groupBy("channel")
             .agg(F.sort_array(F.collect_list(F.struct("ord", "category"))).alias("_l"))
             .select("channel", F.col("_l.category").alias("categories")))
    return rows.join(lists, "channel", "left")


def editable(added: DataFrame, dim: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Items of channels that have a category list: only these are sent to an editor.

    An editor without the right list would sort items into a wrong one, so items of other channels, and of sources
    without a channel, go out as their source has them.
    """
    listed = dim.join(taxonomy.select("channel").distinct(), "channel", "left_semi").select("source_id")
    return added.join(listed, "source_id", "left_semi")


def check_taxonomy(sources: DataFrame, taxonomy: DataFrame, labels: DataFrame) -> DataFrame:
    """Problems of the dimension tables: ``(channel, problem)``."""
    used = sources.select("channel").distinct()

    def problem(df: DataFrame, text: str) -> DataFrame:
        return df.select("channel", F.lit(text).alias("problem"))

    other = taxonomy.filter(F.col("category") == fixed.OTHER_CATEGORY)
    repeated = taxonomy.groupBy("channel", "category").count().filter("count > 1")
    return (problem(used.join(taxonomy, "channel", "left_anti"), "no categories")
            .unionByName(problem(taxonomy.select("channel").distinct()
                                 .join(other, "channel", "left_anti"), "no other category"))
            .unionByName(problem(repeated.select("channel").distinct(), "repeated category"))
            .unionByName(problem(used.join(labels, "channel", "left_anti"), "no label")))
