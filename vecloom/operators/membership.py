"""Which content hashes a store may have: bitmaps that say for sure that a hash is new.

The first ``bits`` bits of a hash are a position in a bitmap, which is kept in buckets of 32,768 positions, as Spark's bitmap
functions have them. A commit adds the bitmaps of its own documents; what a store has is their union. A position that is not set
belongs to no known document, so such rows need not be compared with the known hashes. One that is set may be another
document's, so those rows are compared, and the result is exact whatever the bitmaps hold.
"""

from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_DOCUMENT = 16
LEAST_BITS = 15  # one bucket
MOST_BITS = 48
BUCKET_BYTES = 4096
MAX_BITMAP_BYTES = 64 << 20


def bits_for(documents: int) -> int:
    """Bits of a position in a store of so many documents: of 16 positions, one is set."""
    return min(MOST_BITS, max(LEAST_BITS, ceil(log2(max(1, documents) * BITS_PER_DOCUMENT))))


def position(sha1: Column, bits: Column | int) -> Column:
    """The first ``bits`` bits of a hexadecimal hash."""
    head = F.conv(F.left(sha1, F.lit(12)), 16, 10).cast("bigint")
    return F.call_function("shiftright", head, F.lit(MOST_BITS) - bits)


def bitmaps(hashes: DataFrame, documents: int) -> DataFrame:
    """``bits, bucket, bitmap`` of ``full_text_sha1``, for a store of at most ``documents`` documents."""
    bits = F.lit(bits_for(documents))
    placed = hashes.where(F.col("full_text_sha1").isNotNull()).select(bits.alias("bits"), position(F.col("full_text_sha1"), bits).alias("p"))
    return placed.groupBy("bits", F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bitmap"))


def combined(parts: DataFrame) -> DataFrame:
    return parts.groupBy("bits", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(1) == 1, F.lit(False))


def with_maybe_known(rows: DataFrame, known: DataFrame) -> DataFrame | None:
    """``rows`` with ``maybe_known``, false where the hash is surely new. The bitmaps are broadcast if they are small enough
    together; else there is no answer, and all rows have to be compared."""
    levels = {row.bits: row["count"] for row in known.groupBy("bits").count().collect()}  # grows with the logarithm of the store
    if sum(levels.values()) * BUCKET_BYTES > MAX_BITMAP_BYTES:
        return None
    flagged = rows.withColumn("maybe_known", F.lit(False))
    for bits in sorted(levels):
        level = known.where(F.col("bits") == bits).select(F.col("bucket").alias("_bucket"), F.col("bitmap").alias("_bitmap"))
        placed = flagged.withColumn("_p", position(F.col("full_text_sha1"), bits))
        joined = placed.join(F.broadcast(level), F.bitmap_bucket_number("_p") == F.col("_bucket"), "left")
        found = F.col("maybe_known") | is_set(F.col("_bitmap"), F.bitmap_bit_position("_p"))
        flagged = joined.withColumn("maybe_known", found).drop("_p", "_bucket", "_bitmap")
    return flagged
