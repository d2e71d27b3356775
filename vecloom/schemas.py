"""Schemas of the stored tables and of the fixed external formats."""

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

VECTOR = ArrayType(FloatType())
METADATA = MapType(StringType(), StringType(), valueContainsNull=True)


def _struct(*fields) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# One row per vector. Vector and metadata live in one table, so a metadata filter before scoring is a plain
# scan filter and not a join of two large tables; column pruning keeps the scoring scan at (vec_id, embedding).
ITEMS = _struct(
    ("vec_id", LongType()),
    ("embedding", VECTOR),
    ("external_id", StringType()),
    ("text", StringType()),
    ("metadata", METADATA),
    ("source_file", StringType()),
    ("source_row", LongType()),
    ("chunk_index", IntegerType()),
    # Filter keys that are also columns of their own, so that filters on them reach the scan.
    ("doc_type", StringType()),
    ("url", StringType()),
    ("doc_ref", StringType()),
)
PROMOTED = ("doc_type", "url", "doc_ref")

# Which document hashes there may be: a bit per value of the first ``bits`` bits, in buckets of Spark's bitmap functions.
KNOWN = _struct(("bits", IntegerType()), ("bucket", LongType()), ("bitmap", BinaryType()))

DOCUMENTS = _struct(
    ("doc_id", StringType()),
    ("url", StringType()),
    ("full_text_sha1", StringType()),
    ("total_chunks", IntegerType()),
    ("created_at", TimestampType()),
    ("title", StringType()),
    ("doc_type", StringType()),
    ("full_text", StringType()),
)

PROCESSED = _struct(
    ("path", StringType()),
    ("status", StringType()),
    ("rows_sent", LongType()),
    ("rows_skipped", LongType()),
    ("last_row", LongType()),  # of a file that a row limit cut
)

INFO = _struct(
    ("model_name", StringType()),
    ("dim", IntegerType()),
    ("next_id", LongType()),
    ("created_or_updated_at", TimestampType()),
    ("run", StringType()),
    ("compacted", BooleanType()),  # the batch holds all rows, earlier batches count no more
    ("layout", IntegerType()),  # null where a batch has no promoted columns and no bitmaps
)

METADATA_LINE = _struct(("id", LongType()), ("url", StringType()), ("created_at", StringType()))

BINARY_FILE = _struct(
    ("path", StringType()),
    ("modificationTime", TimestampType()),
    ("length", LongType()),
    ("content", BinaryType()),
)

CENSUS = _struct(
    ("path", StringType()),
    ("file_uri", StringType()),
    ("length", LongType()),
    ("from_row", LongType()),
    ("status", StringType()),
    ("n_rows", LongType()),
    ("text_col", StringType()),
    ("text_type", StringType()),
    ("url_col", StringType()),
    ("url_type", StringType()),
)
