"""Table schemas. Snapshot tables are stored as Parquet, partitioned by (week, source_id)."""

from pyspark.sql import types as T

S, L, B = T.StringType(), T.LongType(), T.BooleanType()


def _fields(*pairs) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


TAGS = T.ArrayType(S)
ALT_IDS = T.MapType(S, S)

RAW_RESPONSE = _fields(("week", S), ("source_id", S), ("request_id", S), ("ext", S), ("body", S))

SNAPSHOT_ITEM = _fields(
    ("source_id", S), ("week", S), ("pos", L), ("external_id", S), ("alt_ids", ALT_IDS),
    ("name", S), ("price", L), ("category_raw", S), ("description", S), ("tags", TAGS),
    ("image_url", S), ("source_url", S), ("scraped_at", T.TimestampType()))

SNAPSHOT_META = _fields(
    ("week", S), ("source_id", S), ("scraped_at", T.TimestampType()), ("count", L),
    ("held_from", S))

SNAPSHOT_MANIFEST = _fields(
    ("week", S), ("source_id", S), ("run", S), ("data_week", S), ("scraped_at", T.TimestampType()),
    ("count", L), ("held_from", S))

PROBLEM = _fields(("week", S), ("source_id", S), ("problem", S), ("id", S), ("name", S), ("detail", S))

CATEGORY_COUNT = _fields(("week", S), ("source_id", S), ("category_raw", S), ("n", L))

LABELS = _fields(("new", B), ("best", B), ("limited", B), ("sold_out", B), ("badges", TAGS),
                 ("new_start_date", S))

DIFF_COUNTS = _fields(
    ("source_id", S), ("week", S), ("previous", L), ("current", L), ("matched", L), ("added", L),
    ("removed", L), ("changed", L), ("review", L), ("conflicts", L), ("baseline", B),
    ("previous_week", S), ("gap_weeks", T.IntegerType()))

CONTROL = _fields(("week", S), ("source_id", S), ("external_id", S), ("labels", LABELS))

ENRICHED = _fields(("week", S), ("source_id", S), ("external_id", S), ("description", S),
                   ("tags", TAGS))

EDIT = _fields(("week", S), ("source_id", S), ("external_id", S), ("name", S), ("category", S),
               ("blurb", S), ("out_of_scope", B))

PUBLISHED_ITEM = _fields(
    ("id", S), ("week", S), ("brand", S), ("channel", S), ("name", S), ("price", L),
    ("category", S), ("tags", TAGS), ("blurb", S), ("image_url", S), ("source_url", S),
    ("source_id", S), ("external_id", S), ("alt_ids", ALT_IDS), ("first_seen", S),
    ("last_seen", S))

SOURCE_DIM = _fields(("source_id", S), ("brand", S), ("channel", S), ("detail", B),
                     ("monotonic_key", S))

CATEGORY_DIM = _fields(("source_id", S), ("code", S), ("name", S), ("priority", L),
                       ("bootstrap_count", L))

TAXONOMY_DIM = _fields(("channel", S), ("category", S), ("ord", L))

CHANNEL_DIM = _fields(("channel", S), ("label", S))
