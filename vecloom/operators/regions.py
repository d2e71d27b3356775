"""Exact pruning of a top-k search by regions of the stored rows.

A region is a run of consecutive ids with its centroid, the widest angle of its vectors to it and their largest length.
The angle between a query and any vector of a region is at least the angle to the centroid less that widest angle, so a
region bounds the scores it can hold. The region of the highest bound is searched first for every query; its k-th score is
a floor, and regions that no query's bound lifts to its floor are not read. Nothing is lost: a bound never lies below a score.

Vectors that lie close together in id order, as those of one source or topic do, make narrow regions. Where all regions
are wide the search reads every row as it would without them, but tasks keep only hits that reach the floors.
"""

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, LongType, StructField, StructType

from vecloom.constants import SCORE_DIGITS
from vecloom.functions.vectors import to_lists, to_matrix

REGION_ROWS = 8_192
#: Ids further apart belong to different regions, as one range must cover a region's ids.
WIDEST_GAP = 1_024
#: Floors are sought only if the regions to search for them hold at most this share of the rows.
SEED_SHARE = 0.25
#: More regions than this are not listed; the scan then reads every row.
LISTED = 100_000
SCAN_RANGES = 64
BOUND_CELLS = 2_000_000
#: Covers the rounding of stored vectors, of centroids and of scores.
SLACK = 1e-5 + 10.0**-SCORE_DIGITS

_FIELDS = [
    StructField("low", LongType()),
    StructField("high", LongType()),
    StructField("n_rows", LongType()),
    StructField("angle", DoubleType()),
    StructField("length", DoubleType()),
    StructField("centroid", ArrayType(FloatType())),
]
REGIONS = StructType([StructField("batch", IntegerType()), *_FIELDS])


def _describe(batch: int, ids: np.ndarray, vectors: np.ndarray) -> tuple:
    """One region. Vectors with an element that is not finite have no score, but their ids count."""
    wide = vectors[np.isfinite(vectors).all(axis=1)].astype(np.float64)
    centroid = wide.sum(axis=0)
    centroid = (centroid / max(np.linalg.norm(centroid), 1e-300)).astype(np.float32)
    lengths = np.linalg.norm(wide, axis=1)
    centre = centroid.astype(np.float64)
    against = lengths * max(np.linalg.norm(centre), 1e-300)
    # a vector of no length has no angle; it is taken to point away from the centroid
    cosines = np.divide(wide @ centre, against, out=np.full(len(wide), -1.0), where=against > 1e-300)
    angle = float(np.arccos(np.clip(cosines.min(initial=1.0), -1.0, 1.0)))
    return batch, int(ids.min()), int(ids.max()), len(ids), angle, float(lengths.max(initial=0.0)), centroid


def describe(rows: DataFrame, dim: int, region_rows: int = REGION_ROWS) -> DataFrame:
    """The regions of ``rows(batch, vec_id, embedding)`` as the scan's tasks meet them: runs of at most ``region_rows``
    rows of one batch with ascending ids. A task holds the rows of one region at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, ids, vectors = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, dim), np.float32)

        def emit(regions: list) -> pa.RecordBatch:
            *plain, centroids = zip(*regions, strict=True)
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            columns = [pa.array(c, kind) for c, kind in zip(plain, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([*columns, to_lists(np.stack(centroids))], names=REGIONS.names)

        def cut(last: bool) -> list:
            """The regions that are complete; the rows behind them stay."""
            nonlocal of, ids, vectors
            step = np.diff(ids)
            breaks = np.flatnonzero((step < 1) | (step > WIDEST_GAP) | (np.diff(of) != 0)) + 1
            edges = [0]
            for stop in [*breaks.tolist(), len(ids)]:
                edges += range(edges[-1] + region_rows, stop, region_rows)
                edges.append(stop)
            if not last and edges[-1] - edges[-2] < region_rows:
                edges.pop()
            found = [_describe(int(of[a]), ids[a:b], vectors[a:b]) for a, b in zip(edges, edges[1:], strict=False) if b > a]
            of, ids, vectors = of[edges[-1] :], ids[edges[-1] :], vectors[edges[-1] :]
            return found

        for batch in batches:
            of = np.concatenate([of, batch.column(0).to_numpy()])
            ids = np.concatenate([ids, batch.column(1).to_numpy()])
            vectors = np.concatenate([vectors, to_matrix(batch.column(2), dim)])
            if len(ids) >= region_rows and (found := cut(False)):
                yield emit(found)
        if len(ids):
            yield emit(cut(True))

    narrow = rows.select(F.col("batch").cast("int"), F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<float>"))
    return narrow.mapInArrow(run, REGIONS)


def upper_bounds(queries: np.ndarray, centroids: np.ndarray, angle: np.ndarray, length: np.ndarray) -> np.ndarray:
    """[region, query]: a score that no vector of the region exceeds. Queries are unit vectors or zero."""
    centre = centroids.astype(np.float64)
    norms = np.linalg.norm(centre, axis=1, keepdims=True)
    cosines = np.clip((centre / np.where(norms > 0, norms, 1.0)) @ queries.T, -1.0, 1.0)
    best = np.cos(np.maximum(np.arccos(cosines) - angle[:, None], 0.0))
    return np.maximum(best, 0.0) * length[:, None] + SLACK


def _bounded(regions: DataFrame, queries: np.ndarray, judge: Callable, schema: StructType) -> tuple[DataFrame, object]:
    """``judge(low, high, n_rows, bounds)`` of every batch of regions, as rows; and the broadcast they use."""
    shared = regions.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = shared.value
        tile = max(1, BOUND_CELLS // max(1, len(matrix)))
        for batch in batches:
            for at in range(0, batch.num_rows, tile):
                part = batch.slice(at, tile)
                low, high, n_rows, angle, length = (part.column(i).to_numpy() for i in range(5))
                bounds = upper_bounds(matrix, to_matrix(part.column(5), matrix.shape[1]), angle, length)
                columns = [pa.array(c) for c in judge(low, high, n_rows, bounds)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return regions.select(*(f.name for f in _FIELDS)).mapInArrow(run, schema), shared


def best_regions(regions: DataFrame, queries: np.ndarray) -> np.ndarray:
    """low, high and n_rows of the regions that have the highest bound for some query."""

    def judge(low, high, n_rows, bounds):
        first = bounds.argmax(axis=0)
        return np.arange(bounds.shape[1]), bounds.max(axis=0), low[first], high[first], n_rows[first]

    schema = StructType(
        [StructField("q", LongType()), StructField("bound", DoubleType())]
        + [StructField(c, LongType()) for c in ("low", "high", "n_rows")]
    )
    found, shared = _bounded(regions, queries, judge, schema)
    best = F.max_by(F.struct("low", "high", "n_rows"), F.struct("bound", -F.col("low"))).alias("r")
    rows = found.groupBy("q").agg(best).select("r.*").distinct().toArrow()  # at most one row per query
    shared.destroy()
    return np.stack([rows[c].to_numpy() for c in ("low", "high", "n_rows")])


def regions_above(regions: DataFrame, queries: np.ndarray, floors: np.ndarray) -> np.ndarray | None:
    """low, high and n_rows of the regions whose bound reaches some query's floor; None if more than ``LISTED``."""

    def judge(low, high, n_rows, bounds):
        kept = (bounds >= floors).any(axis=1)
        return low[kept], high[kept], n_rows[kept]

    schema = StructType([StructField(c, LongType()) for c in ("low", "high", "n_rows")])
    found, shared = _bounded(regions, queries, judge, schema)
    rows = found.limit(LISTED + 1).toArrow()
    shared.destroy()
    return None if rows.num_rows > LISTED else np.stack([rows[c].to_numpy() for c in schema.names])


def covering(low: np.ndarray, high: np.ndarray, most: int = SCAN_RANGES) -> list[tuple[int, int]]:
    """At most ``most`` ranges of ids that cover the given ones, joined where the gaps are smallest."""
    order = np.argsort(low, kind="stable")
    low, reach = low[order], np.maximum.accumulate(high[order])
    gaps = low[1:] - reach[:-1]
    widest = np.argsort(gaps, kind="stable")[max(0, len(gaps) - most + 1) :]
    splits = np.sort(widest[gaps[widest] > 1]) + 1
    return [(int(a[0]), int(b[-1])) for a, b in zip(np.split(low, splits), np.split(reach, splits), strict=True) if len(a)]


class Pruner:
    """Chooses the rows of a store that a block of queries has to be compared with.

    ``rows(batch, vec_id, embedding, ..)`` may be filtered already: bounds then hold all the more, and floors are taken from
    rows that pass. Batches without regions are always read.
    """

    def __init__(self, rows: DataFrame, regions: DataFrame, covered: list[int]):
        self.rows, self.regions, self.covered = rows, regions, covered
        self.n_rows = regions.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n")).first()["n"]
        self.reads: list[int] = []  # of the regions' rows, per block of queries: for reports and tests

    def _within(self, spans: np.ndarray) -> Column:
        inside = [F.col("vec_id").between(low, high) for low, high in covering(spans[0], spans[1])]
        return reduce(Column.__or__, inside, F.lit(False))

    def floors(self, queries: np.ndarray, k: int, scan: Callable[[DataFrame], DataFrame]) -> np.ndarray:
        """The k-th score per query within the most promising regions, -inf where there are fewer hits."""
        floors = np.full(len(queries), -np.inf)
        seeds = best_regions(self.regions, queries)
        if seeds[2].sum() > SEED_SHARE * self.n_rows:
            return floors
        known = F.col("batch").isin(self.covered)
        hits = scan(self.rows.where(known & self._within(seeds)).select("vec_id", "embedding"))
        last = hits.groupBy("query_id").agg(F.min("score").alias("floor"), F.count("*").alias("n")).where(F.col("n") >= k).toArrow()
        floors[last["query_id"].to_numpy()] = last["floor"].to_numpy()
        return floors

    def narrow(self, queries: np.ndarray, k: int, scan: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, np.ndarray]:
        """The rows that can hold a hit, and the score per query below which no hit lies."""
        floors = self.floors(queries, k, scan)
        kept = regions_above(self.regions, queries, floors) if np.isfinite(floors).all() else None
        if kept is None:
            self.reads.append(self.n_rows)
            return self.rows.select("vec_id", "embedding"), floors
        self.reads.append(int(kept[2].sum()))
        # two scans: one condition on both the partition and the ids would not be pushed down
        known = F.col("batch").isin(self.covered)
        rows = self.rows.where(known).where(self._within(kept)).unionByName(self.rows.where(~known))
        return rows.select("vec_id", "embedding"), floors
