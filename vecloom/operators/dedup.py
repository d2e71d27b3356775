"""First row per content hash.

Only hashes and row numbers are aggregated and compared with what is known; texts are brought in afterwards, for the
rows that turned out to be first and new. Keys are whole hashes: a prefix of one would merge different texts at scale.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.functions import text as T
from vecloom.operators import membership, numbering

KEY = "full_text_sha1"
MAX_BROADCAST_ROWS = 1_000_000


def with_content_key(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``full_text_sha1`` of the text as it is, and ``doc_ref`` made from it."""
    return df.withColumn(KEY, F.sha1(text)).withColumn("doc_ref", T.doc_ref(F.col(KEY)))


def first_seq(df: DataFrame, order_by: str, known: DataFrame | None = None, bitmaps: DataFrame | None = None) -> DataFrame:
    """The smallest ``order_by`` of each content key that is not in ``known``. The aggregate is partial on the map side,
    so a key that holds a third of all rows leaves each map task as a single row.

    Few known keys are sent to the rows, which are dropped before the shuffle. Of many, only those rows are compared that the
    ``bitmaps`` of :mod:`membership` do not say to be new.
    """
    if known is None:
        return df.groupBy(KEY).agg(F.min(order_by).alias(order_by))
    known = known.select(KEY)
    if known.count() <= MAX_BROADCAST_ROWS:  # from the footers
        return df.join(F.broadcast(known), KEY, "left_anti").groupBy(KEY).agg(F.min(order_by).alias(order_by))
    flagged = None if bitmaps is None else membership.with_maybe_known(df.select(KEY, order_by), bitmaps)
    if flagged is None:
        return df.groupBy(KEY).agg(F.min(order_by).alias(order_by)).join(known, KEY, "left_anti")
    first = flagged.groupBy(KEY).agg(F.min(order_by).alias(order_by), F.max("maybe_known").alias("maybe_known"))
    compared = first.where("maybe_known").join(known, KEY, "left_anti")
    return first.where("NOT maybe_known").union(compared).drop("maybe_known")


def first_rows(df: DataFrame, order_by: str, known: DataFrame | None = None) -> DataFrame:
    """The rows of :func:`first_seq`; ``order_by`` is unique per row."""
    return rows_of(df, numbering.stage(first_seq(df, order_by, known).select(order_by), "first-rows").read(), order_by)


def rows_of(df: DataFrame, winners: DataFrame, order_by: str) -> DataFrame:
    """The rows of ``df`` named by the staged ``winners``, which are broadcast below a checked count, so texts are not
    shuffled; above it Spark joins on them."""
    few = winners.count() <= MAX_BROADCAST_ROWS
    return df.join(F.broadcast(winners) if few else winners, order_by, "left_semi")
