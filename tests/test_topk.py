import numpy as np
import pytest
from pyspark.sql import functions as F

from vecloom.functions import vectors
from vecloom.operators import topk


def frame(spark, matrix, name, key):
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{key} bigint, {name} array<float>")


def brute(corpus, queries, k):
    q = queries.astype(np.float32).astype(np.float64)
    q = q / np.linalg.norm(q, axis=1, keepdims=True)
    scores = np.round(q @ corpus.astype(np.float32).astype(np.float64).T, 6)
    return {
        (i, place + 1): (int(j), scores[i, j])
        for i in range(len(queries))
        for place, j in enumerate(sorted(range(len(corpus)), key=lambda j: (-scores[i, j], j))[:k])
    }


def as_map(df):
    return {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in df.collect()}


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    corpus = rng.normal(size=(700, 12))
    corpus[200:450] = corpus[5]  # a third of the corpus are copies of one vector
    corpus /= np.linalg.norm(corpus, axis=1, keepdims=True)
    queries = rng.normal(size=(23, 12))
    queries[0] = corpus[5] * 4
    return corpus, queries


def test_matches_full_sort_with_heavy_ties(spark, data, monkeypatch):
    corpus, queries = data
    vectors = frame(spark, corpus, "embedding", "vec_id").repartition(5)
    found = topk.top_k(vectors, frame(spark, queries, "vector", "query_id"), 7)
    assert as_map(found.rows) == brute(corpus, queries, 7) and found.bounded_bytes
    monkeypatch.setattr(topk, "SCORE_CELLS", 23 * 40)  # many tiles per partition (driver side copy only)
    best = topk.LocalTopK(topk.unit_rows(queries.astype(np.float32)), 7)
    order = np.random.default_rng(1).permutation(700)
    best.add(order.astype(np.int64), corpus.astype(np.float32)[order])
    owner, ids, scores = best.rows()
    places = np.tile(np.arange(1, 8), 23)
    expected = brute(corpus, queries, 7)
    assert {(int(o), int(p)): (int(i), s) for o, p, i, s in zip(owner, places, ids, scores)} == expected


def test_query_blocks_give_the_same(spark, data):
    corpus, queries = data
    vectors, asked = frame(spark, corpus, "embedding", "vec_id"), frame(spark, queries, "vector", "query_id")
    found = topk.top_k(vectors, asked, 5, block_bytes=8 * 12 * 10)
    assert found.bounded_bytes is None
    assert as_map(found.rows) == brute(corpus, queries, 5)


def test_k_beyond_the_store_and_empty_sides(spark, data):
    corpus, queries = data
    few = frame(spark, corpus[:3], "embedding", "vec_id")
    asked = frame(spark, queries, "vector", "query_id")
    assert as_map(topk.top_k(few, asked, 10).rows) == brute(corpus[:3], queries, 10)
    assert topk.top_k(few, asked.limit(0), 5).rows.count() == 0
    assert topk.top_k(few.limit(0), asked, 5).rows.count() == 0


def test_string_query_ids(spark, data):
    corpus, queries = data
    asked = frame(spark, queries, "vector", "query_id").withColumn("query_id", F.concat(F.lit("q"), "query_id"))
    found = topk.top_k(frame(spark, corpus, "embedding", "vec_id"), asked, 2).rows
    expected = {(f"q{i}", r): v for (i, r), v in brute(corpus, queries, 2).items()}
    assert as_map(found) == expected


def test_wrong_dimensions_raise(spark, data):
    corpus, queries = data
    asked = frame(spark, queries[:, :5], "vector", "query_id")
    with pytest.raises(ValueError, match="dimension"):
        topk.top_k(frame(spark, corpus, "embedding", "vec_id"), asked, 2)
    ragged = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0])], "vec_id bigint, embedding array<float>")
    one = spark.createDataFrame([(0, [1.0, 0.0])], "query_id bigint, vector array<float>")
    with pytest.raises(Exception, match="dimension"):
        topk.top_k(ragged, one, 1, dim=2).rows.collect()


def test_plan_moves_only_hits(spark, data):
    corpus, queries = data
    found = topk.top_k(frame(spark, corpus, "embedding", "vec_id"), frame(spark, queries, "vector", "query_id"), 2)
    plan = found.rows._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "WindowGroupLimit" in plan


@pytest.mark.parametrize("n_bad", [1, 5, 40])
def test_rows_that_are_not_finite_hide_no_hit(spark, n_bad):
    rng = np.random.default_rng(n_bad)
    good = vectors.unit_rows(rng.normal(size=(300, 8))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(good)]
    rows += [(1000 + i, [[float("nan")] * 8, [float("inf")] * 8, [None] * 8][i % 3]) for i in range(n_bad)]
    corpus = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(2)
    queries = spark.createDataFrame([(i, good[i].tolist()) for i in range(6)] + [(9, [float("nan")] * 8)], "query_id int, vector array<float>")
    found = topk.top_k(corpus, queries, 5).rows.collect()
    scores = np.round(good[:6].astype(np.float64) @ good.astype(np.float64).T, 6)
    want = {(q, r + 1, int(i)) for q in range(6) for r, i in enumerate(np.lexsort((np.arange(300), -scores[q]))[:5])}
    assert {(r.query_id, r.rank, r.vec_id) for r in found} == want
