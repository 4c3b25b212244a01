"""Archived responses to rows: JSON envelopes, embedded JSON, HTML lists and detail pages.

A response with a wrong envelope is rejected as a whole; it never turns into zero rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfdiff.functions import text, values


def json_rows(responses: DataFrame, item_schema: str, list_path: str = "$",
              ok_path: str | None = None, ok_value: str | None = None,
              allow_empty: bool = True, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """``(rows, rejected)`` of responses that carry a JSON list at ``list_path``.

    Rejected are bodies that are no JSON, whose success field at ``ok_path`` is not
    ``ok_value``, that have no list there, an empty one unless ``allow_empty``, or one with a
    ``bad element``: one that is no object, or whose field has a value that does not fit its type.
    Rows keep the response's other columns, their place as ``index``, and the item as ``row``;
    rows and rejected together account for every response but empty lists that are allowed.
    """
    columns = responses.columns
    item = item_schema if item_schema.lstrip().lower().startswith("struct<") else f"struct<{item_schema}>"
    # a body is parsed once, and its list read once: each step is a column that the next ones use several times
    parsed = responses.withColumn("_json", F.try_parse_json(F.col(body)))
    read = parsed.withColumn("_list", F.try_variant_get("_json", list_path, f"array<{item}>"))
    reason = F.when(F.col("_json").isNull(), "not json")
    if ok_path is not None:
        read = read.withColumn("_flag", F.try_variant_get("_json", ok_path, "string"))
        reason = reason.when(~F.col("_flag").eqNullSafe(F.lit(ok_value)), "failure flag")
    reason = reason.when(F.col("_list").isNull(), "no list")
    if not allow_empty:
        reason = reason.when(F.size("_list") == 0, "empty list")
    fields = T.DataType.fromDDL(item_schema).fields

    def misfit(e: Column) -> Column:
        row = F.try_variant_get(e, "$", item)
        given = [F.try_variant_get(e, f"$['{f.name}']", "variant") for f in fields]
        lost = [row[f.name].isNull() & (F.coalesce(F.schema_of_variant(v), F.lit("VOID")) != "VOID")
                for f, v in zip(fields, given)]
        return row.isNull() | reduce(lambda a, b: a | b, lost, F.lit(False))
    # only a list with a null in it can hold something that did not fit
    lacking = F.exists("_list", lambda r: reduce(lambda a, b: a | b, [r[f.name].isNull() for f in fields], r.isNull()))
    elements = F.try_variant_get("_json", list_path, "array<variant>")
    reason = reason.when(lacking & F.exists(elements, misfit), "bad element")
    # made by a generator, the reason stays where it is; a filter on a plain column would compute it all over again
    judged = read.select(*columns, F.inline(F.array(F.struct(F.col("_list"), reason.alias("reason")))))
    rejected = judged.filter("reason IS NOT NULL").drop("_list", body)
    kept = judged.filter("reason IS NULL").drop("reason", body)
    return kept.select(*[c for c in columns if c != body], F.posexplode("_list").alias("index", "row")), rejected


def double_json(c: Column) -> Column:
    """A body that is a JSON string holding JSON gives the inner JSON; others pass."""
    inner = F.from_json(F.concat(F.lit("["), c, F.lit("]")), "array<string>")[0]
    return F.when(F.ltrim(c).startswith('"'), inner).otherwise(c)


def explode_nested(rows: DataFrame, outer: str, inner: str) -> DataFrame:
    """Flatten ``outer`` (an array of structs) and the array ``inner`` inside it.

    The outer struct is carried down without its inner array; list order is kept in
    ``outer_index`` and ``inner_index``.
    """
    keep = [c for c in rows.columns if c != outer.split(".")[0]]
    once = rows.select(*keep, F.posexplode(outer).alias("outer_index", "group"))
    return once.select(*keep, "outer_index", F.col("group").dropFields(inner).alias("group"),
                       F.posexplode(F.col("group")[inner]).alias("inner_index", "row"))


def embedded_json(c: Column, attribute: str) -> Column:
    """JSON held, with its entities escaped, in the first group of ``attribute``."""
    return text.unescape(values.key_from_text(c, attribute))


def first_payload(c: Column, choices: list[tuple[str, str]]) -> Column:
    """The first of several JSON paths that is there, as struct(payload, prefix)."""
    options = []
    for path, prefix in choices:
        payload = F.get_json_object(c, path)
        options.append(F.when(payload.isNotNull(), F.struct(
            payload.alias("payload"), F.lit(prefix).alias("prefix"))))
    return F.coalesce(*options)


def extract_records(pages: DataFrame, block: str, fields: dict[str, str], body: str = "html",
                    keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """One row per match of ``block``, each field by the first group of its pattern.

    Native regular expressions only; a field that is not found is null.
    """
    blocks = pages.select(*keep, F.posexplode(
        F.regexp_extract_all(body, F.lit(block), 0)).alias("index", "_block"))
    return blocks.select(*keep, "index", *[
        values.key_from_text(F.col("_block"), pattern).alias(name)
        for name, pattern in fields.items()])


def extract_detail(pages: DataFrame, fields: dict[str, str], body: str = "html",
                   keep: tuple[str, ...] = ("page_id",), closed: bool = False) -> DataFrame:
    """One record per page, each field without markup; ``closed`` as in ``text.unescape``."""
    return pages.select(*keep, *[
        text.strip_markup(values.key_from_text(F.col(body), pattern), closed).alias(name)
        for name, pattern in fields.items()])


def to_items(rows: DataFrame, source_id: str, mapping: dict[str, Column],
             category_dim: DataFrame, code: str = "code") -> tuple[DataFrame, DataFrame]:
    """``(items, rows with an unknown code)``: source rows in the common item schema.

    ``mapping`` gives the columns that differ per source; the category name comes from the
    request's code.
    """
    dim = (category_dim.filter(F.col("source_id") == source_id)
           .select(F.col("code").alias("_code"), F.col("name").alias("category_raw"),
                   F.col("priority").alias("_priority")))
    joined = rows.join(dim, F.col(code) == F.col("_code"), "left")
    unknown = joined.filter(F.col("_code").isNull()).select(*rows.columns)
    items = joined.filter(F.col("_code").isNotNull()).select(
        F.lit(source_id).alias("source_id"), "category_raw",
        F.col("_priority").alias("priority"),
        *[column.alias(name) for name, column in mapping.items()])
    return items, unknown
