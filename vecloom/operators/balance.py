"""Spreading inputs that arrive in fewer splits than the cluster has cores.

A parquet file with one large row group is one task. In front of per-row work that outweighs a shuffle of such a
small input - regular expressions, chunking, encoding - the rows are dealt out over all cores. Inputs that already
have a split per core are left alone, so at scale this adds no shuffle.
"""

from pyspark.sql import DataFrame, SparkSession

SPLIT_BYTES = 128 * 1024 * 1024


def cores(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def spread(scan: DataFrame) -> DataFrame:
    """Deal rows out evenly. Only for plans that hold no shuffle yet: their split count is known before they run."""
    n = cores(scan.sparkSession)
    return scan.repartition(n) if scan.rdd.getNumPartitions() < n else scan


def spread_small(df: DataFrame, input_bytes: int) -> DataFrame:
    """Like :func:`spread` for an input of known size, whatever its plan holds."""
    n = cores(df.sparkSession)
    return df.repartition(n) if input_bytes < n * SPLIT_BYTES else df


def spread_in_order(df: DataFrame, input_bytes: int, *keys: str) -> DataFrame:
    """Like :func:`spread` for an input of known size, keeping ranges of ``keys`` together."""
    n = cores(df.sparkSession)
    return df.repartitionByRange(n, *keys) if input_bytes < n * SPLIT_BYTES else df
