"""Table schemas and vocabularies."""

from pyspark.sql import types as T

# Column names, order and types of the exchanged tables.
FILTER_INPUT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("data", T.BinaryType()),
    ]
)

_RECORD_FIELDS = [
    T.StructField("id", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("image_bytes", T.BinaryType()),
    T.StructField("image_format", T.StringType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("filter_result", T.StringType()),
]

_RUN_FIELDS = [
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("error", T.StringType()),
]

LABEL_TEXT_FIELDS = ("category", "subcategory", "description", "landmark", "city", "mood")
LABEL_FLAG_FIELDS = ("is_professional", "has_text_overlay")

FILTER_OUTPUT = T.StructType(_RECORD_FIELDS + _RUN_FIELDS)

LABEL_OUTPUT = T.StructType(
    _RECORD_FIELDS
    + [T.StructField("label_json", T.StringType())]
    + [T.StructField(name, T.StringType()) for name in LABEL_TEXT_FIELDS]
    + [T.StructField(name, T.BooleanType()) for name in LABEL_FLAG_FIELDS]
    + _RUN_FIELDS
)

# The advisory vocabularies of two label fields.
CATEGORIES = (
    "scenic",
    "food",
    "hotel",
    "people",
    "itinerary",
    "template",
    "pricing",
    "lifestyle",
    "shopping",
    "transport",
)
MOODS = (
    "warm",
    "cool",
    "vibrant",
    "serene",
    "adventurous",
    "luxurious",
    "casual",
    "romantic",
)

LEDGER = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("run_seq", T.IntegerType()),
        T.StructField("stage", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("total", T.LongType()),
        T.StructField("kept", T.LongType()),
        T.StructField("skipped", T.LongType()),
        T.StructField("errors", T.LongType()),
        T.StructField("first_shard", T.LongType()),
    ]
)

ATTEMPTS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("src_file", T.StringType()),
        T.StructField("src_row", T.LongType()),
        T.StructField("batch", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("run_id", T.StringType()),
    ]
)

QUARANTINE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("run_id", T.StringType()),
    ]
)
