"""Exact top-k by inner product.

Queries travel, the corpus stays: a block of queries of bounded size is broadcast, each task multiplies its
vectors with the block and keeps a local top k, and only those few rows are shuffled to be ranked. More queries
than one block can hold are answered block by block; each block is complete in itself.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from vecloom.constants import SCORE_DIGITS
from vecloom.functions.vectors import to_matrix, unit_rows
from vecloom.operators.numbering import assign_ids
from vecloom.operators.regions import Pruner
from vecloom.session import new_folder

QUERY_BLOCK_BYTES = 64 * 1024 * 1024
LOCAL_HIT_BYTES = 128 * 1024 * 1024
SCORE_CELLS = 2_000_000
MERGE_SALTS = 16
_NO_ID = np.iinfo(np.int64).max
_RANKED = StructType(
    [StructField("rank", IntegerType()), StructField("vec_id", LongType()), StructField("score", DoubleType())]
)


@dataclass
class Hits:
    rows: DataFrame
    bounded_bytes: int | None  # proven size of ``rows`` when all queries fitted in one block


class LocalTopK:
    """Running top k of one partition for all queries of a block.

    All pairs are scored in single precision, whose error on unit vectors is bounded by the dimension; pairs that
    may still belong to the top k are scored again in double precision, and only those scores are compared.
    """

    def __init__(self, queries: np.ndarray, k: int, floors: np.ndarray | None = None):
        self.queries, self.k = queries, k
        self.floors = np.full(len(queries), -np.inf) if floors is None else floors
        self.narrow = queries.astype(np.float32)
        self.scores = np.full((len(queries), k), -np.inf)
        self.ids = np.full((len(queries), k), _NO_ID)
        # Twice the rounding error of a float32 product of unit vectors.
        self.rounding = 2 * (queries.shape[1] + 2) * np.finfo(np.float32).eps

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Vectors with an element that is not finite have no score and are left out."""
        finite = np.isfinite(vectors).all(axis=1)
        if not finite.all():
            ids, vectors = ids[finite], vectors[finite]
        tile = max(1, SCORE_CELLS // len(self.queries))
        for low in range(0, len(ids), tile):
            self._add_tile(ids[low : low + tile], vectors[low : low + tile])

    def _add_tile(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        cells = self.narrow @ vectors.T
        floor = np.maximum(self.scores[:, -1], self.floors)
        if len(ids) > self.k and np.isneginf(floor).any():
            cut = len(ids) - self.k
            floor = np.maximum(floor, np.partition(cells, cut, axis=1)[:, cut])
        longest = np.sqrt(np.einsum("ij,ij->i", vectors, vectors).max())
        margin = self.rounding * max(1.0, longest) + 10.0**-SCORE_DIGITS
        owner, column = np.nonzero(cells >= (floor - margin).astype(np.float32)[:, None])
        fresh = np.round(self._exact(owner, column, vectors, cells.size), SCORE_DIGITS)
        last, last_id = self.scores[owner, -1], self.ids[owner, -1]
        better = (fresh > last) | ((fresh == last) & (ids[column] < last_id))
        better &= fresh >= self.floors[owner]
        self._merge(owner[better], fresh[better], ids[column[better]])

    def _merge(self, owner: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Replace the lists of the queries that gained a candidate by the best k of old and new."""
        touched, owner = np.unique(owner, return_inverse=True)
        places = np.arange(len(touched))
        owner = np.concatenate((np.repeat(places, self.k), owner))
        scores = np.concatenate((self.scores[touched].ravel(), scores))
        ids = np.concatenate((self.ids[touched].ravel(), ids))
        order = np.lexsort((ids, -scores, owner))
        starts = np.searchsorted(owner[order], places)
        best = order[starts[:, None] + np.arange(self.k)]
        self.scores[touched], self.ids[touched] = scores[best], ids[best]

    def _exact(self, owner: np.ndarray, column: np.ndarray, vectors: np.ndarray, n_cells: int) -> np.ndarray:
        """Double precision scores of some pairs. When many pairs are close, as copies of one text are, one full
        product is cheaper than many dots."""
        if len(owner) * 100 > n_cells:
            return (self.queries @ vectors.astype(np.float64).T)[owner, column]
        out = np.empty(len(owner))
        step = max(1, SCORE_CELLS // vectors.shape[1])
        for low in range(0, len(owner), step):
            part = slice(low, low + step)
            out[part] = np.einsum("ij,ij->i", self.queries[owner[part]], vectors[column[part]].astype(np.float64))
        return out

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        owner, place = np.nonzero(self.ids != _NO_ID)
        return owner, self.ids[owner, place], self.scores[owner, place]


def _scan(
    vectors: DataFrame, queries: np.ndarray, query_ids: pa.Array, id_field: StructField, k: int, floors: np.ndarray | None = None
) -> DataFrame:
    """The k best of each task per query, but none below the query's floor."""
    shared = vectors.sparkSession.sparkContext.broadcast((query_ids, queries, floors))
    dim = queries.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix, least = shared.value
        best = LocalTopK(matrix, k, least)
        for batch in batches:
            best.add(batch.column(0).to_numpy(), to_matrix(batch.column(1), dim))
        owner, ids, scores = best.rows()
        yield pa.RecordBatch.from_arrays(
            [names.take(pa.array(owner)), pa.array(ids), pa.array(scores)], names=["query_id", "vec_id", "score"]
        )

    schema = StructType([id_field, StructField("vec_id", LongType()), StructField("score", DoubleType())])
    return vectors.mapInArrow(run, schema)


def _score(
    vectors: DataFrame, block: pa.Table, dim: int, k: int, id_field: StructField, pruner: Pruner | None = None
) -> DataFrame:
    queries = unit_rows(to_matrix(block["_query"].combine_chunks(), dim))
    floors = None
    if pruner is not None:
        index, field = pa.array(np.arange(len(queries))), StructField("query_id", LongType())
        vectors, floors = pruner.narrow(queries, k, lambda rows: rank_hits(_scan(_typed(rows), queries, index, field, k), k))
        vectors = _typed(vectors)
    return _scan(vectors, queries, block["query_id"].combine_chunks(), id_field, k, floors)


def _typed(vectors: DataFrame) -> DataFrame:
    return vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<float>"))


def rank_hits(hits: DataFrame, k: int) -> DataFrame:
    """Rank scored rows inside each query. The salted first pass keeps a query's rows, which grow with the number
    of scan tasks, from meeting in one task before they are cut to k."""
    best_first = [F.col("score").desc(), F.col("vec_id").asc()]
    salted = Window.partitionBy("query_id", F.pmod(F.col("vec_id"), F.lit(MERGE_SALTS))).orderBy(*best_first)
    final = Window.partitionBy("query_id").orderBy(*best_first)
    survivors = hits.withColumn("_place", F.row_number().over(salted)).where(F.col("_place") <= k)
    ranked = survivors.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    dim: int | None = None,
    block_bytes: int = QUERY_BLOCK_BYTES,
    pruner: Pruner | None = None,
) -> Hits:
    """Top k of ``vectors(vec_id, embedding)`` for each of ``queries(query_id, vector)``.

    Stored vectors are taken as unit vectors, query vectors are normalised here. Scores are rounded to
    ``SCORE_DIGITS`` decimals; equal scores rank by smaller id. A ``pruner`` of the same rows leaves out those that
    cannot be hits; the result is the same.
    """
    spark = vectors.sparkSession
    vectors = _typed(vectors)
    queries = queries.select("query_id", F.col("vector").cast("array<float>").alias("_query"))
    id_field = StructField("query_id", queries.schema["query_id"].dataType)
    empty = Hits(spark.createDataFrame([], StructType([id_field, *_RANKED.fields])), 0)
    if dim is None:
        first = vectors.select(F.size("embedding")).first()
        if first is None:
            return empty
        dim = first[0]
    # A block is bounded by its matrix, which is broadcast, and by the k hits per query that each task keeps.
    block_rows = max(1, min(block_bytes // (8 * dim), LOCAL_HIT_BYTES // (16 * k)))
    block = queries.limit(block_rows + 1).toArrow()
    if block.num_rows == 0:
        return empty
    if block.num_rows <= block_rows:
        scored = _score(vectors, block, dim, k, id_field, pruner)
        return Hits(rank_hits(scored, k), block.num_rows * k * 64)
    return Hits(_by_blocks(spark, vectors, queries, k, dim, block_rows, id_field, pruner), None)


def _by_blocks(
    spark: SparkSession,
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    dim: int,
    block_rows: int,
    id_field: StructField,
    pruner: Pruner | None,
) -> DataFrame:
    """One corpus scan per block of queries. A block carries enough queries that arithmetic, not the scan, is
    the cost of a pass."""
    numbered = assign_ids(queries, 0, id_column="_q")
    n_queries = numbered.count()
    folder = new_folder(spark, "hits")
    for low in range(0, n_queries, block_rows):
        block = numbered.where(F.col("_q").between(low, low + block_rows - 1)).drop("_q").toArrow()
        scored = _score(vectors, block, dim, k, id_field, pruner)
        rank_hits(scored, k).write.parquet(f"{folder}/block={low // block_rows}")
    ranked = StructType([id_field, *_RANKED.fields])
    return spark.read.schema(ranked).parquet(f"{folder}/*")
