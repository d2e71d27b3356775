"""Exact top-k search by term-at-a-time accumulation.

Vectors are sparse rows of whole numbers, floor(256 x) per component; a component is a term. Each task turns its
candidates into posting lists per term. For every query it adds weight times posting to a dense array of scores, term
after term, selects the k best by partitioning that array, and merges them over its blocks of candidates; the tasks' k
hits per query are merged at the end. Queries are a stated set and are sent to the tasks in blocks of bounded size.

Defined results: vectors that are null or hold null or non-finite components, and rows without vec_id, take no part;
missing components of shorter vectors are 0; rows with the query's vec_id are its own; of queries
with one vec_id the least vector is asked; ties go to the smaller vec_id;
components beyond 2^62 / 256 are clipped and sums wrap as 64-bit numbers do; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.llm import words as W

K = 5
SCALE = 256
QUERY_BYTES = 16 << 20
CANDIDATES = 8192
_LOWEST = np.iinfo(np.int64).min


def whole_rows(ids: pa.Array, vectors: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """Ids and weights [row, term] of the rows that take part, in ascending order of ids."""
    lengths = np.array(vectors.value_lengths().fill_null(0), np.int64)
    valid = ~np.array(vectors.is_null()) & ~np.array(ids.is_null())
    values = vectors.flatten()
    given = np.array(values.is_valid(), bool)
    x = np.array(values.fill_null(0.0).cast(pa.float64()), np.float64)
    owner, inside = W.spans(lengths)
    good = given & np.isfinite(x)
    valid &= np.bincount(owner[~good], minlength=len(lengths))[: len(lengths)] == 0
    dense = np.zeros((len(lengths), int(lengths.max(initial=0))), np.int64)
    with np.errstate(over="ignore", invalid="ignore"):
        whole = np.clip(np.floor(x * scale), -(2.0**62), 2.0**62)
    dense[owner[good], inside[good]] = whole[good].astype(np.int64)
    kept = np.flatnonzero(valid)
    numbers = np.array(ids.take(pa.array(kept)), np.int64)
    order = np.argsort(numbers, kind="stable")
    return numbers[order], dense[kept[order]]


def postings(weights: np.ndarray) -> list[tuple[np.ndarray | slice, np.ndarray]]:
    """Per term the rows that have it and their weights; a slice where all rows have it."""
    out = []
    for column in weights.T:
        rows = np.flatnonzero(column)
        out.append((slice(None), column.copy()) if len(rows) == len(column) else (rows, column[rows]))
    return out


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best scores and their ids; ``ids`` ascends, so the first of equal scores win."""
    if len(scores) > k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > floor)
        chosen = np.concatenate([above, np.flatnonzero(scores == floor)[: k - len(above)]])
    else:
        chosen = np.arange(len(scores))
    chosen = chosen[np.lexsort((ids[chosen], -scores[chosen]))]
    return scores[chosen], ids[chosen]


def _accumulate(query_ids, query_weights, ids, weights, k, best) -> None:
    lists = postings(weights)
    scores = np.empty(len(ids), np.int64)
    for q, (query_id, row) in enumerate(zip(query_ids.tolist(), query_weights, strict=True)):
        scores[:] = 0
        for term in np.flatnonzero(row[: len(lists)]).tolist():
            rows, weight = lists[term]
            scores[rows] += weight * row[term]
        a, b = np.searchsorted(ids, [query_id, query_id + 1])
        others = (np.concatenate([scores[:a], scores[b:]]), np.concatenate([ids[:a], ids[b:]])) if b > a else (scores, ids)
        top = best_of(*others, k)
        if q in best:
            top = best_of(*_by_id(np.concatenate([best[q][0], top[0]]), np.concatenate([best[q][1], top[1]])), k)
        best[q] = top


def _by_id(scores: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(ids, kind="stable")
    return scores[order], ids[order]


def top_k_search(vectors: DataFrame, queries: DataFrame, k: int = K, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of ``vectors`` for each of ``queries`` (both vec_id, embedding)."""
    spark = vectors.sparkSession
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    stated = queries.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").where(F.col("vec_id").isNotNull() & finite)
    stated = stated.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    count, longest = stated.agg(F.count("*"), F.max(F.size("embedding"))).first()
    blocks = max(1, -(-count * (longest or 1) * 8 // query_bytes))
    narrow = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("query_id", "vec_id", "score")])
    hits = None
    for block in range(blocks):
        part = stated.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).toArrow()
        sent = spark.sparkContext.broadcast(whole_rows(part.column(0).combine_chunks(), part.column(1).combine_chunks()))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            query_ids, query_weights = sent.value
            for batch in batches:
                for a in range(0, batch.num_rows, CANDIDATES):
                    piece = batch.slice(a, CANDIDATES)
                    ids, weights = whole_rows(piece.column(0), piece.column(1))
                    if len(ids):
                        _accumulate(query_ids, query_weights, ids, weights, k, best)
            for q, (scores, ids) in best.items():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), query_ids[q])), pa.array(ids), pa.array(scores)], names=schema.names)

        found = narrow.mapInArrow(run, schema)
        hits = found if hits is None else hits.union(found)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_term_at_a_time(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k_search(rows, rows.where("vec_id % 50 = 0"))


ORACLE_SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS w FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
  r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
