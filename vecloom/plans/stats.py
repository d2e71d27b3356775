"""Counts and sizes: of a corpus before ingest, and of a store."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom import constants as C
from vecloom.functions import text as T
from vecloom.store import VectorStore


def skip_stats(df: DataFrame, by: str, text: Column, low: int = C.MIN_CHARS, high: int = C.MAX_CHARS) -> DataFrame:
    """Rows sent and skipped by the length band per group; groups are summed on the map side first."""
    sent = T.in_length_band(T.strip(text), low, high)
    return df.groupBy(by).agg(F.count_if(sent).alias("sent"), F.count_if(~sent).alias("skipped"))


def stored_bytes(store: VectorStore) -> dict[str, int]:
    """Bytes of the vector table and of the other tables, from the file listing."""
    reader = store.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    files = reader.option("recursiveFileLookup", "true").load(store.root)
    is_index = F.col("path").contains("/items/batch=")
    row = files.agg(
        F.coalesce(F.sum(F.when(is_index, F.col("length"))), F.lit(0)).alias("index_size_bytes"),
        F.coalesce(F.sum(F.when(~is_index, F.col("length"))), F.lit(0)).alias("meta_size_bytes"),
    )
    return row.first().asDict()


def store_counts(store: VectorStore) -> DataFrame:
    """``ntotal, dim, documents, next_id, model_name``. Counts come from parquet footers, the rest from the head."""
    totals = store.items().agg(F.count(F.lit(1)).alias("ntotal"))
    documents = store.documents().agg(F.count(F.lit(1)).alias("documents"))
    head = store.head
    return totals.select(
        "ntotal",
        F.lit(head.dim).cast("int").alias("dim"),
        F.lit(documents.first()[0]).cast("bigint").alias("documents"),
        F.lit(head.next_id).cast("bigint").alias("next_id"),
        F.lit(head.model_name).cast("string").alias("model_name"),
    )


def store_stats(store: VectorStore) -> DataFrame:
    """One row of counts plus sizes in bytes and in readable form. The vectors and their metadata share a table."""
    sizes = [F.lit(size).cast("bigint").alias(name) for name, size in stored_bytes(store).items()]
    sized = store_counts(store).select("*", *sizes)
    return sized.select(
        "*",
        T.human_bytes(F.col("index_size_bytes")).alias("index_size"),
        T.human_bytes(F.col("meta_size_bytes")).alias("meta_size"),
    )
