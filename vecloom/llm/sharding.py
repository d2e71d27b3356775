"""Sharding by a two-pass external shuffle.

Pass one scatters the records by a seeded hash into buckets that fit into a task's memory; Spark's shuffle files are the
external buckets. Pass two loads one bucket after the other, shuffles it by Fisher-Yates with a generator seeded by the
bucket, and writes its rows at their global places. Shards are equal ranges of those places, so their row counts differ
by one at most (law ``rows``).

The places need the bucket counts, which come from a histogram of fixed size over the hash range (2^20 cells, whatever
the input), so a bucket's content and place depend on the rows alone and a retried task writes the same.

Defined results: a null text has 0 bytes; empty input gives an empty table; rows that are equal in all columns share a
hash and thus a bucket; groups of equal texts are not kept together (the law is about rows); columns named shard or slot
are replaced, all others are passed through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.llm.staging import free_name
from vecloom.session import new_folder

SHARDS = 24
CELL_BITS = 20
BUCKET_BYTES = 32 << 20
ROW_BYTES = 8


def text_size():
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + ROW_BYTES


def _hashed(docs: DataFrame, seed: int, h: str, cell: str) -> DataFrame:
    keys = [F.col(f"`{f.name}`") for f in docs.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return docs.withColumn(h, F.xxhash64(F.lit(seed), *keys)).withColumn(cell, F.shiftrightunsigned(h, 64 - CELL_BITS).cast("int"))


def _buckets(hashed: DataFrame, cell: str, bucket_bytes: int) -> tuple[int, np.ndarray]:
    """Number of buckets and the place of the first row of each, the number of rows at the end."""
    cells = hashed.groupBy(F.col(cell).alias("cell")).agg(F.count("*").alias("n"), F.sum(text_size()).alias("b")).toArrow()
    where = cells.column("cell").to_numpy().astype(np.int64)
    n = int(min(max(1, -(-int(np.sum(cells.column("b").to_numpy())) // bucket_bytes)), 1 << CELL_BITS))
    counts = np.bincount(where * n >> CELL_BITS, weights=cells.column("n").to_numpy(), minlength=n).astype(np.int64)
    return n, np.concatenate([[0], np.cumsum(counts)])


def _placed(bucket: list[pa.RecordBatch], number: int, places: np.ndarray, starts: np.ndarray, seed: int) -> Iterator[pa.RecordBatch]:
    rows = pa.Table.from_batches(bucket)
    if len(rows) != places[number + 1] - places[number]:
        raise RuntimeError(f"bucket {number} holds {len(rows)} rows, not those counted; did the input change?")
    order = np.arange(len(rows))
    np.random.Generator(np.random.PCG64([seed, number])).shuffle(order)  # Fisher-Yates
    place = places[number] + np.arange(len(rows))
    shard = np.searchsorted(starts, place, side="right") - 1
    done = rows.select(range(rows.num_columns - 2)).take(pa.array(order))  # without hash and bucket
    done = done.append_column("shard", pa.array(shard.astype(np.int32))).append_column("slot", pa.array(place - starts[shard]))
    yield from done.to_batches(max_chunksize=2000)


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = 4, bucket_bytes: int = BUCKET_BYTES, path: str | None = None) -> DataFrame:
    """Write ``docs`` in random order to ``path``/shard=s and read them back, with the columns shard and slot."""
    spark = docs.sparkSession
    path = path or new_folder(spark, "shards")
    docs = docs.drop("shard", "slot")
    h, cell, number = (free_name(docs, name) for name in ("__h", "__cell", "__bucket"))
    hashed = _hashed(docs, seed, h, cell)
    n, places = _buckets(hashed, cell, bucket_bytes)
    total = int(places[-1])
    starts = spark.sparkContext.broadcast((places, np.arange(shards + 1) * total // shards))
    bucket = F.shiftright(F.col(cell).cast("bigint") * n, CELL_BITS).cast("int").alias(number)
    scattered = hashed.select(*(F.col(f"`{c}`") for c in docs.columns), h, bucket).repartitionById(n, number)
    schema = T.StructType([*docs.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None
        for batch in batches:
            numbers = batch.column(batch.num_columns - 1).to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(np.diff(numbers)) + 1, [len(numbers)]])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if a == b:
                    continue
                if current is not None and numbers[a] != current:
                    yield from _placed(held, current, *starts.value, seed)
                    held = []
                current = int(numbers[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield from _placed(held, current, *starts.value, seed)

    others = [F.col(f"`{f.name}`") for f in docs.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    ordered = scattered.sortWithinPartitions(number, h, *others) if docs.columns else scattered
    placed = ordered.mapInArrow(run, schema)
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    back = T.StructType([*docs.schema.fields, T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])
    return spark.read.schema(back).parquet(path).select(*(f"`{c}`" for c in schema.names))


def op4_external_shuffle(spark, sf_dir):
    kept = shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select(
        "doc_id", text_size().alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
