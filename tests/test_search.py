import numpy as np
import pytest
from pyspark.sql import functions as F

from vecloom.plans.documents import upsert_documents
from vecloom.plans.search import id_ranges, rendered, search, search_one
from vecloom.plans.vectors import add_vectors
from vecloom.store import compact


@pytest.fixture
def filled(spark, store):
    rows = [(i, [1.0, i / 10.0, 0.0], f"text {i} " + "y" * 250 * (i % 2), {"label": str(i % 3), "url": f"http://u/{i}"}) for i in range(12)]
    df = spark.createDataFrame(rows, "k int, embedding array<float>, text string, metadata map<string,string>")
    add_vectors(store, df, doc_type="fineweb2", order_by=["k"], keep_text=True)
    return store


def asked(spark, *vectors):
    return spark.createDataFrame(list(enumerate(vectors)), "query_id int, vector array<float>")


def test_post_filter_may_leave_fewer_and_keeps_ranks(spark, filled):
    queries = asked(spark, [2.0, 0.0, 0.0], [0.0, 5.0, 0.0])
    plain = search(filled, queries, 5).orderBy("query_id", "rank").collect()
    assert [r.vec_id for r in plain if r.query_id == 0] == [1, 2, 3, 4, 5]
    assert [r.vec_id for r in plain if r.query_id == 1] == [12, 11, 10, 9, 8]
    assert plain[0].score == 1.0 and plain[0].metadata["url"] == "http://u/0" and len(plain[0].external_id) == 16
    post = search(filled, queries, 5, equal_to={"metadata.label": 0}).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in post] == [(0, 1, 1), (0, 4, 4), (1, 3, 10)]
    pre = search(filled, queries, 3, equal_to={"metadata.label": 0}, filter_mode="pre").orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in pre] == [
        (0, 1, 1), (0, 2, 4), (0, 3, 7), (1, 1, 10), (1, 2, 7), (1, 3, 4),
    ]


def test_both_filter_modes_agree_when_k_covers_the_store(spark, filled):
    queries = asked(spark, [1.0, 0.4, 0.1])
    wanted = {"metadata.label": "1", "metadata.doc_type": "fineweb2", "metadata.missing": None}
    post = search(filled, queries, 50, equal_to=wanted).collect()
    pre = search(filled, queries, 50, equal_to=wanted, filter_mode="pre").collect()
    assert {r.vec_id for r in post} == {r.vec_id for r in pre} == {2, 5, 8, 11}
    assert search(filled, queries, 50, equal_to={"metadata.missing": "x"}).count() == 0


def test_text_only_on_request_and_rendering(spark, filled):
    queries = asked(spark, [1.0, 0.0, 0.0])
    assert "text" not in search(filled, queries, 2).columns
    shown = rendered(search(filled, queries, 2, return_text=True)).orderBy("rank").collect()
    assert shown[0].snippet == "text 0 " and shown[0].url == "http://u/0"
    assert shown[1].snippet.endswith("...") and len(shown[1].snippet) == 203 and shown[1].score == 0.995


def test_single_query_forms(spark, filled):
    rows = search_one(filled, vector=[1.0, 0.0, 0.0], k=3).collect()
    assert [r.vec_id for r in rows] == [1, 2, 3]
    with pytest.raises(ValueError, match="dimension"):
        search_one(filled, vector=[1.0, 0.0])
    with pytest.raises(ValueError, match="encoder"):
        search_one(filled, text="needs a model")


def test_text_and_vector_queries_agree(spark, store, encoder):
    from vecloom.functions.encoders import encode

    texts = ["apple banana cherry", "banana cherry date", "elephant fox goat", "apple apple apple", "zebra"]
    docs = spark.createDataFrame([(i, t, f"http://d/{i}") for i, t in enumerate(texts)], "seq int, text string, url string")
    upsert_documents(store, docs, encoder)
    queries = spark.createDataFrame([(1, "apple banana"), (2, "  "), (3, None), (4, "fox")], "query_id int, text string")
    by_text = search(store, queries, 3, encoder=encoder)
    vectors = queries.where("query_id IN (1, 4)").select("query_id", encode(encoder, F.col("text")).alias("vector"))
    by_vector = search(store, vectors, 3)
    pick = ["query_id", "rank", "vec_id", "score"]
    assert sorted(by_text.select(*pick).collect()) == sorted(by_vector.select(*pick).collect())
    assert {r.query_id for r in by_text.collect()} == {1, 4}
    mixed = queries.withColumn("vector", F.when(F.col("query_id") == 2, F.array(*[F.lit(1.0)] * 16)))
    assert {r.query_id for r in search(store, mixed, 3, encoder=encoder).collect()} == {1, 2, 4}
    linked = search(store, queries, 1, encoder=encoder, link_documents=True).where("query_id = 4").first()
    assert linked.document.url == "http://d/2" and "url" not in linked.metadata
    itself = search_one(store, text=texts[2], k=1, encoder=encoder).first()
    assert itself.score == 1.0 and itself.metadata["doc_ref"] == linked.document.doc_id


def test_empty_store_gives_nothing(spark, store, encoder):
    assert search_one(store, vector=[1.0, 2.0]).count() == 0
    assert search_one(store, text="x", encoder=encoder).count() == 0
    assert search_one(store, text=" ", encoder=encoder).count() == 0


def test_batches_without_hits_are_pruned(spark, filled):
    far = spark.createDataFrame([(i, [0.0, 0.0, 1.0]) for i in range(9)], "k int, embedding array<float>")
    for _ in range(3):
        add_vectors(filled, far)
    assert filled.batch_starts() == ([1, 13, 22, 31], [1, 2, 3, 4])
    hits = search(filled, asked(spark, [1.0, 0.0, 0.0]), 2)
    assert sorted(r.vec_id for r in hits.collect()) == [1, 2]
    last = search(filled, asked(spark, [0.0, 0.0, 1.0]), 40)
    assert {r.vec_id for r in last.collect()} >= set(range(13, 40))
    plan = hits._jdf.queryExecution().toString()
    assert "batch" in plan and "PartitionFilters" in plan
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "external_id" in line)
    assert "GreaterThanOrEqual(vec_id,1)" in scan and "LessThanOrEqual(vec_id,2)" in scan


def test_id_ranges_cover_all_ids():
    ids = np.array([5, 1, 2, 3, 100, 101, 5000, 7, 7])
    assert id_ranges(ids, 3) == [(1, 7), (100, 101), (5000, 5000)]
    assert id_ranges(ids, 1) == [(1, 5000)]
    assert id_ranges(ids, 100) == [(1, 3), (5, 5), (7, 7), (100, 101), (5000, 5000)]
    assert id_ranges(np.array([9])) == [(9, 9)]


def test_hits_are_broadcast_to_the_metadata(spark, filled):
    plan = search(filled, asked(spark, [1.0, 0.0, 0.0]), 2)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "NestedLoop" not in plan


def test_filters_on_promoted_keys_reach_the_scan(spark, store, encoder, monkeypatch):
    """doc_type, url and doc_ref are pushed down; batches from before the columns are still read by their metadata."""
    from vecloom import schemas
    from vecloom.functions import metadata
    from vecloom.plans.vectors import add_vectors

    def add(low, high):
        rows = [([float(i), 1.0], f"http://x/{i}" if i % 4 else None, {"lang": "en"}) for i in range(low, high)]
        add_vectors(store, spark.createDataFrame(rows, "embedding array<float>, url string, metadata map<string,string>"), doc_type=f"t{low}")

    def found(equal_to):
        hits = search(store.refresh(), spark.createDataFrame([(0, [1.0, 0.5])], "query_id int, vector array<float>"), 50, equal_to=equal_to, filter_mode="pre")
        return sorted(r.vec_id for r in hits.collect())

    add(0, 8)
    add(8, 16)
    items = store.items()
    assert {(r.doc_type, r.url) for r in items.collect()} == {(r.metadata["doc_type"], r.metadata.get("url")) for r in items.collect()}
    passed = metadata.matches({"metadata.doc_type": "t8", "metadata.url": None}, [], schemas.PROMOTED)
    plan = items.where(passed).select("vec_id", "embedding")._jdf.queryExecution().executedPlan().toString()
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "EqualNullSafe(doc_type,t8)" in pushed and "url" in pushed.split("PushedFilters")[1] and "metadata" not in pushed.split("ReadSchema")[1]
    wanted = ({"metadata.doc_type": "t8"}, {"metadata.url": "http://x/3"}, {"metadata.url": None}, {"metadata.doc_ref": None, "metadata.lang": "en"})
    expected = [list(range(9, 17)), [4], [1, 5, 9, 13], list(range(1, 17))]
    assert [found(x) for x in wanted] == expected
    monkeypatch.setattr("vecloom.store.LAYOUT", None)
    monkeypatch.setattr(schemas, "PROMOTED", ())
    add(16, 18)  # as an earlier release would write it
    monkeypatch.undo()
    assert not store.refresh().has_layout
    assert [found(x) for x in wanted] == [*expected[:2], [1, 5, 9, 13, 17], list(range(1, 19))]
    compact(store)
    assert store.has_layout and found(wanted[2]) == [1, 5, 9, 13, 17]
