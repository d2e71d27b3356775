"""Tables written to the shared folder, which cut lineage and survive lost executors."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.session import discard, new_folder

BROADCAST_ROWS = 500_000
BATCH_BYTES = "8m"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below spark.checkpoint.dir and read it back."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_in = path
    return out


def release(*tables: DataFrame) -> None:
    """Remove staged tables that nothing reads any more; others, which were not staged, are left alone."""
    for df in tables:
        path = getattr(df, "_staged_in", None)
        if path:
            discard(df.sparkSession, path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores behind it, as no column of ``df`` is called, in lower or upper case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a staged narrow table for broadcasting if it has at most ``limit`` rows; else let Spark shuffle it."""
    return F.broadcast(df) if df.count() <= limit else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_small_batches(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Let the session hand texts to Python in batches of at most ``BATCH_BYTES``: with Spark's 64 MB, which JVM and
    worker hold several times over, a batch of long texts is the largest thing in an executor's memory."""

    @wraps(query)
    def run(spark: SparkSession, *args) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return query(spark, *args)

    return run
