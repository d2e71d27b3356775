"""Contiguous ids without a global sort and without shuffling wide rows.

Rows are staged once as a parquet table in the shared folder. A written file has a fixed row order, so
``_metadata.row_index`` numbers its rows densely; a row's id is the start of its segment plus its place in it.
A segment is the part of one staged file that belongs to one group (for example one source file). Only the
segment summary - one row per staged file and group - is aggregated, ordered and summed up.
"""

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vecloom.session import discard, new_folder

# Above this many segments their offsets are computed and joined without the driver and without a broadcast.
MAX_LOCAL_SEGMENTS = 200_000
ROWS_PER_STAGED_FILE = 25_000


@dataclass
class Numbered:
    rows: DataFrame
    total: int
    sums: dict[str, int]


@dataclass(frozen=True)
class Staged:
    """A table written to the shared folder. Keeping its schema saves a job per read."""

    spark: SparkSession
    folder: str
    schema: StructType

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.folder)

    def positioned(self) -> DataFrame:
        """The rows with ``_part`` (the staged file) and ``_pos`` (the row's place in it)."""
        file, place = F.col("_metadata.file_name").alias("_part"), F.col("_metadata.row_index").alias("_pos")
        return self.read().select("*", file, place)

    def discard(self) -> None:
        discard(self.spark, self.folder)


def stage(df: DataFrame, label: str, rows_per_file: int = ROWS_PER_STAGED_FILE) -> Staged:
    """Write ``df`` to a fresh shared folder, keeping partition order inside the files."""
    folder = new_folder(df.sparkSession, label)
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(folder)
    return Staged(df.sparkSession, folder, df.schema)


def _offsets_local(spark: SparkSession, summary: pa.Table, start: int) -> DataFrame:
    counts = summary["_n"].to_numpy().astype(np.int64)
    base = start + np.cumsum(counts) - counts - summary["_first_pos"].to_numpy()
    table = summary.drop_columns(["_n", "_first_pos"]).append_column("_base", pa.array(base, type=pa.int64()))
    return F.broadcast(spark.createDataFrame(table))


def _offsets_distributed(summary: DataFrame, within: Sequence[str], start: int) -> DataFrame:
    """The same running sum in two levels: within range slots, and over the slots."""
    slotted = summary.repartitionByRange("_key").withColumn("_slot", F.spark_partition_id())
    slots = stage(slotted, "segments").read()  # freezes the sampled range bounds
    before = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)  # one row per range slot
    slot_start = slots.groupBy("_slot").agg(F.sum("_n").alias("_total"))
    slot_start = slot_start.select("_slot", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_slot_start"))
    inside = Window.partitionBy("_slot").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    base = F.lit(start) + F.col("_slot_start") + F.coalesce(F.sum("_n").over(inside), F.lit(0)) - F.col("_first_pos")
    return slots.join(F.broadcast(slot_start), "_slot").select("_part", *within, base.alias("_base"))


def number_staged(
    rows: DataFrame,
    start: int,
    *,
    id_column: str = "vec_id",
    within: Sequence[str] = (),
    order_by: Column | None = None,
    sums: dict[str, Column] | None = None,
) -> Numbered:
    """Give the rows of :meth:`Staged.positioned` the ids start, start+1, ... in ``order_by`` order of their segments.

    ``sums`` are integer expressions summed over all rows in the same pass.
    """
    spark = rows.sparkSession
    if order_by is None:
        order_by = F.struct(F.length("_part"), F.col("_part"))
    names = list(sums or {})
    summary = rows.groupBy("_part", *within).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("_pos").alias("_first_pos"),
        F.min(order_by).alias("_key"),
        *[F.sum(expression).cast("bigint").alias(name) for name, expression in (sums or {}).items()],
    )
    ordered = summary.orderBy("_key").select("_part", *within, "_first_pos", "_n", *names)
    local = ordered.limit(MAX_LOCAL_SEGMENTS + 1).toArrow()
    if local.num_rows <= MAX_LOCAL_SEGMENTS:
        totals = {name: sum(local[name].to_pylist()) for name in ["_n", *names]}
        offsets = _offsets_local(spark, local.drop_columns(names), start)
    else:
        totals = summary.agg(*[F.sum(name).alias(name) for name in ["_n", *names]]).first().asDict()
        offsets = _offsets_distributed(summary.drop(*names), within, start)
    return Numbered(with_ids(rows, offsets, within, id_column), totals.pop("_n"), totals)


def with_ids(rows: DataFrame, offsets: DataFrame, within: Sequence[str], id_column: str = "vec_id") -> DataFrame:
    numbered = rows.join(offsets, ["_part", *within]).withColumn(id_column, F.col("_base") + F.col("_pos"))
    return numbered.drop("_part", "_pos", "_base")


def assign_ids(
    df: DataFrame, start: int = 1, *, id_column: str = "vec_id", order_by: Sequence[str] = (), partitions: int | None = None
) -> DataFrame:
    """Rows of ``df`` with contiguous ids.

    Without ``order_by`` the rows are numbered as they come, with no shuffle. With it the rows are range
    partitioned and sorted first, so ids follow that order.
    """
    if order_by:
        ranged = df.repartitionByRange(partitions, *order_by) if partitions else df.repartitionByRange(*order_by)
        df = ranged.sortWithinPartitions(*order_by)
    return number_staged(stage(df, "numbered").positioned(), start, id_column=id_column).rows


def next_id(df: DataFrame, id_column: str = "vec_id") -> DataFrame:
    return df.agg((F.coalesce(F.max(id_column), F.lit(0)) + 1).cast("bigint").alias("next_id"))
