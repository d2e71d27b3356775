import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vecloom.functions.vectors import unit_rows
from vecloom.operators import regions as R
from vecloom.operators.topk import LocalTopK, top_k
from vecloom.plans.search import search
from vecloom.plans.vectors import add_vectors
from vecloom.store import compact, index_regions

DIM = 8


def clustered(seed=1, groups=8, each=250, spread=0.02):
    """Vectors near one centre each, group after group."""
    rng = np.random.default_rng(seed)
    centres = unit_rows(rng.normal(size=(groups, DIM)))
    return unit_rows(np.repeat(centres, each, axis=0) + spread * rng.normal(size=(groups * each, DIM))).astype(np.float32)


def frame(spark, vectors, first=0):
    rows = [(first + i, v.tolist(), {"label": str(i % 3)}) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "k int, embedding array<float>, metadata map<string,string>")


def asked(spark, vectors):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "query_id int, vector array<float>")


def hits(rows):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in rows.collect())


def pruner_of(store, rows=None):
    return R.Pruner(store.items_by_batch() if rows is None else rows, *store.regions())


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.floats(0.0, 3.0), st.integers(1, 60))
def test_no_score_exceeds_the_bound_of_its_region(seed, spread, n):
    rng = np.random.default_rng(seed)
    vectors = (unit_rows(rng.normal(size=DIM) + spread * rng.normal(size=(n, DIM))) * rng.uniform(0, 2, (n, 1))).astype(np.float32)
    vectors[rng.random(n) < 0.1] = 0
    queries = unit_rows(rng.normal(size=(20, DIM)))
    queries[0] = 0
    queries[1] = unit_rows(vectors.astype(np.float64))[0]
    _, low, high, rows, angle, length, centroid = R._describe(3, np.arange(n) + 7, vectors)
    assert (low, high, rows) == (7, 6 + n, n)
    bounds = R.upper_bounds(queries, centroid[None], np.array([angle]), np.array([length]))[0]
    assert (np.round(queries @ vectors.astype(np.float64).T, 6).max(axis=1) <= bounds).all()


def test_regions_cover_every_row_once_and_keep_their_size(spark, store):
    add_vectors(store, frame(spark, clustered()[:900]), order_by=["k"])
    add_vectors(store, frame(spark, clustered()[900:]), order_by=["k"])
    assert store.regions() is None
    assert index_regions(store, region_rows=100) == store.batch_starts()[1]
    table, covered = store.regions()
    rows = table.collect()
    assert sum(r.n_rows for r in rows) == 2000 and max(r.n_rows for r in rows) <= 100 and covered == store.batch_starts()[1]
    ids = [r.vec_id for r in store.items().select("vec_id").collect()]
    assert all(sum(r.low <= i <= r.high for r in rows) == 1 for i in ids)
    assert index_regions(store) == []


@pytest.mark.parametrize("near", [True, False])
def test_hits_are_those_of_the_full_scan(spark, store, near):
    vectors = clustered() if near else clustered(spread=5.0)
    add_vectors(store, frame(spark, vectors), order_by=["k"])
    index_regions(store, region_rows=125)
    queries = asked(spark, vectors[[3, 260, 262]])
    pruner = pruner_of(store)
    pruned = top_k(store.vectors(), queries, 7, DIM, pruner=pruner)
    assert hits(pruned.rows) == hits(top_k(store.vectors(), queries, 7, DIM).rows)
    if near:
        assert pruner.reads[0] <= 1000  # two of eight groups are near a query; others may fall into their angle
    assert hits(search(store, queries, 7)) == hits(search(store, queries, 7, prune=False))


def test_blocks_of_queries_are_pruned_one_by_one(spark, store):
    vectors = clustered()
    add_vectors(store, frame(spark, vectors), order_by=["k"])
    index_regions(store, region_rows=125)
    queries, pruner = asked(spark, vectors[::400]), pruner_of(store)
    pruned = top_k(store.vectors(), queries, 4, DIM, block_bytes=2 * 8 * DIM, pruner=pruner)
    assert hits(pruned.rows) == hits(top_k(store.vectors(), queries, 4, DIM).rows) and len(pruner.reads) == 3


def test_filters_later_batches_and_compaction(spark, store):
    vectors = clustered()
    add_vectors(store, frame(spark, vectors[:1500]), order_by=["k"])
    index_regions(store, region_rows=125)
    add_vectors(store, frame(spark, vectors[1500:]), order_by=["k"])  # not described, so read in full
    queries = asked(spark, vectors[[10, 1600]])
    for options in ({}, {"equal_to": {"metadata.label": "1"}, "filter_mode": "pre"}, {"equal_to": {"metadata.label": "9"}, "filter_mode": "pre"}):
        assert hits(search(store, queries, 6, **options)) == hits(search(store, queries, 6, prune=False, **options))
    compact(store)
    assert store.regions() is None  # those of batches that are visible no more do not count
    assert hits(search(store, queries, 6)) == hits(search(store, queries, 6, prune=False))
    assert index_regions(store) == store.batch_starts()[1]
    assert hits(search(store, queries, 6)) == hits(search(store, queries, 6, prune=False))


def test_ties_zero_vectors_and_empty_stores(spark, store):
    assert index_regions(store) == [] and store.regions() is None
    vectors = np.vstack([np.tile(clustered()[:1], (300, 1)), np.zeros((50, DIM), np.float32), clustered()[1000:1300]])
    add_vectors(store, frame(spark, vectors), order_by=["k"])
    index_regions(store, region_rows=60)
    queries = asked(spark, np.vstack([vectors[:1], np.zeros((1, DIM)), -vectors[:1]]))
    assert hits(search(store, queries, 5)) == hits(search(store, queries, 5, prune=False))


def test_tasks_emit_only_hits_that_reach_the_floor():
    vectors = clustered()
    queries = unit_rows(vectors[:2].astype(np.float64))
    plain, floored = LocalTopK(queries, 5), LocalTopK(queries, 5, np.array([0.999, 2.0]))
    for best in (plain, floored):
        best.add(np.arange(len(vectors)), vectors)
    kept = {(q, i, s) for q, i, s in zip(*plain.rows(), strict=True) if q == 0 and s >= 0.999}
    assert kept and set(zip(*floored.rows(), strict=True)) == kept


def test_covering_joins_at_the_smallest_gaps():
    low, high = np.array([50, 1, 8, 20]), np.array([60, 5, 12, 30])
    assert R.covering(low, high, 2) == [(1, 30), (50, 60)] and R.covering(low, high) == [(1, 5), (8, 12), (20, 30), (50, 60)]
    assert R.covering(low[:0], high[:0]) == []


def test_pushed_ranges_reach_the_scan(spark, store, capsys):
    vectors = clustered()
    add_vectors(store, frame(spark, vectors), order_by=["k"])
    index_regions(store, region_rows=125)
    pruner = pruner_of(store)
    queries = unit_rows(vectors[:1].astype(np.float64))
    rows, floors = pruner.narrow(queries, 5, lambda part: top_k(part, asked(spark, vectors[:1]), 5, DIM).rows)
    assert np.isfinite(floors).all() and rows.count() < 2000
    rows.explain("formatted")
    plan = capsys.readouterr().out
    assert "PushedFilters" in plan and "GreaterThanOrEqual(vec_id" in plan
    assert rows.agg(F.min("vec_id")).first()[0] >= 1
