import pytest
from pyspark.sql import functions as F

from vecloom.plans.stats import store_stats
from vecloom.plans.vectors import add_vectors
from vecloom.plans.search import search
from vecloom.store import compact, open_store, vacuum


def vectors(spark, n, dim=3, start=0):
    rows = [(i, [float(i + 1)] + [1.0] * (dim - 1), f"http://u/{i}") for i in range(start, start + n)]
    return spark.createDataFrame(rows, "k bigint, embedding array<float>, url string")


def test_new_store_is_empty_and_reopens(spark, store):
    assert (store.head.version, store.head.next_id, store.head.dim) == (0, 1, None)
    assert store.items().count() == store.documents().count() == store.processed().count() == 0
    again = open_store(spark, store.root)
    assert again.head == store.head and again.info().count() == 1


def test_bulk_add_normalises_numbers_and_describes(spark, store):
    own = F.when(F.col("k") == 1, F.create_map(F.lit("url"), F.lit("own"), F.lit("label"), F.lit("7")))
    result = add_vectors(store, vectors(spark, 5).withColumn("metadata", own), doc_type="t", order_by=["k"])
    assert result == {"added": 5, "rejected": 0, "skipped": 0, "first_id": 1, "dim": 3}
    rows = store.items().orderBy("vec_id").collect()
    assert [r.vec_id for r in rows] == [1, 2, 3, 4, 5]
    assert all(abs(sum(x * x for x in r.embedding) - 1) < 1e-6 for r in rows)
    assert rows[0].metadata["doc_type"] == "t" and rows[0].metadata["url"] == "http://u/0" and rows[0].metadata["created_at"]
    assert rows[1].metadata["url"] == "own" and rows[1].metadata["label"] == "7"
    assert len({r.external_id for r in rows}) == 5 and all(len(r.external_id) == 16 for r in rows)
    assert rows[0].text is None


def test_appends_continue_the_ids(spark, store):
    add_vectors(store, vectors(spark, 4), order_by=["k"])
    result = add_vectors(store, vectors(spark, 3, start=4), order_by=["k"])
    assert result["first_id"] == 5
    reopened = open_store(spark, store.root)
    assert [r.vec_id for r in reopened.items().orderBy("vec_id").collect()] == list(range(1, 8))
    assert reopened.head.next_id == 8 and reopened.head.dim == 3


def test_dimension_mismatch_raises_and_adds_nothing(spark, store):
    add_vectors(store, vectors(spark, 2))
    head = store.head
    with pytest.raises(ValueError, match="dimension"):
        add_vectors(store, vectors(spark, 2, dim=4))
    assert store.head == head and open_store(spark, store.root).items().count() == 2


def test_mismatched_rows_can_be_rejected(spark, store):
    add_vectors(store, vectors(spark, 2))
    mixed = vectors(spark, 30, start=2).unionByName(vectors(spark, 9, dim=4, start=40)).repartition(3)
    empty = spark.createDataFrame([(99, [], "u"), (98, None, "u")], "k bigint, embedding array<float>, url string")
    result = add_vectors(store, mixed.unionByName(empty), on_mismatch="reject", order_by=["k"])
    assert (result["added"], result["rejected"]) == (30, 9)
    rows = store.items().orderBy("vec_id").collect()
    assert [r.vec_id for r in rows] == list(range(1, 33))
    assert [r.metadata["url"] for r in rows[2:]] == [f"http://u/{i}" for i in range(2, 32)]


def test_text_is_kept_on_request(spark, store):
    add_vectors(store, vectors(spark, 1).withColumn("text", F.lit("t")), keep_text=True)
    add_vectors(store, vectors(spark, 1).withColumn("text", F.lit("t")))
    assert [r.text for r in store.items().orderBy("vec_id").collect()] == ["t", None]


def test_uncommitted_rows_stay_invisible_and_are_replaced(spark, store):
    add_vectors(store, vectors(spark, 2))
    left = store.items().limit(1).withColumn("vec_id", F.lit(77).cast("bigint"))
    store.write("items", left)  # a run that dies here ...
    store.write("processed", spark.createDataFrame([("f", "ok", 1, 0)], "path string, status string, rows_sent bigint, rows_skipped bigint"))
    survivor = open_store(spark, store.root)
    assert survivor.items().count() == 2 and survivor.processed().count() == 0
    add_vectors(survivor, vectors(spark, 1, start=5))  # ... is overwritten by the next one
    assert [r.vec_id for r in survivor.items().orderBy("vec_id").collect()] == [1, 2, 3]
    assert survivor.processed().count() == 0


def test_second_writer_is_refused(spark, store):
    other = open_store(spark, store.root)
    add_vectors(store, vectors(spark, 10), order_by=["k"])
    with pytest.raises(RuntimeError, match="another writer"):
        add_vectors(other, vectors(spark, 3, start=50))
    kept = open_store(spark, store.root)
    assert kept.head.next_id == 11
    assert [r.metadata["url"] for r in kept.items().orderBy("vec_id").collect()] == [f"http://u/{i}" for i in range(10)]
    assert add_vectors(other.refresh(), vectors(spark, 1))["first_id"] == 11
    assert open_store(spark, store.root).items().count() == 11


def test_of_two_writers_that_commit_at_once_one_is_refused(spark, store, monkeypatch):
    other = open_store(spark, store.root)
    store.write("items", spark.createDataFrame([(1, "a")], "vec_id bigint, text string"))
    other.write("items", spark.createDataFrame([(1, "b"), (2, "b")], "vec_id bigint, text string"))
    monkeypatch.setattr(other, "_committed", lambda version: False)  # both have seen no commit
    store.commit(added=1, dim=3)
    with pytest.raises(RuntimeError, match="another writer"):
        other.commit(added=2, dim=3)
    assert [r.text for r in open_store(spark, store.root).items().collect()] == ["a"]


def test_a_broken_store_raises(spark, store):
    with open(f"{store.root}/info/version=0/part-x.parquet", "w") as out:
        out.write("broken")
    with pytest.raises(Exception):
        open_store(spark, store.root)


def test_stats(spark, store):
    empty = store_stats(store).first()
    assert (empty.ntotal, empty.dim, empty.documents, empty.next_id) == (0, None, 0, 1)
    add_vectors(store, vectors(spark, 3))
    row = store_stats(store).first()
    assert (row.ntotal, row.dim, row.next_id) == (3, 3, 4)
    assert row.index_size_bytes > 0 and row.index_size.endswith("KB") and row.meta_size_bytes > 0


def test_vectors_that_are_not_finite_are_refused(spark, store):
    nan = float("nan")
    rows = [(0, [1.0, 2.0]), (1, [nan, 1.0]), (2, [1.0, None]), (3, [float("inf"), 0.0]), (4, None), (5, []), (6, [1.0]), (7, [3.0, 4.0])]
    given = spark.createDataFrame(rows, "k bigint, embedding array<float>")
    with pytest.raises(ValueError, match="do not fit"):
        add_vectors(store, given)
    assert open_store(spark, store.root).items().count() == 0
    result = add_vectors(store, given, on_mismatch="reject", order_by=["k"])
    assert result == {"added": 2, "rejected": 4, "skipped": 2, "first_id": 1, "dim": 2}


def test_the_commonest_length_is_the_dimension(spark, store):
    given = spark.createDataFrame([(0, [1.0])] + [(i, [1.0, float(i)]) for i in range(1, 4)], "k bigint, embedding array<float>")
    result = add_vectors(store, given, on_mismatch="reject", order_by=["k"])
    assert (result["added"], result["rejected"], result["dim"]) == (3, 1, 2)
    with pytest.raises(ValueError, match="dimension"):
        add_vectors(store, given, dim=5)


def test_nothing_stays_in_the_shared_folder(spark, store):
    import glob

    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(glob.glob(f"{folder}/vecloom/*"))
    add_vectors(store, vectors(spark, 3))
    with pytest.raises(ValueError):
        add_vectors(store, vectors(spark, 3, dim=4))
    assert set(glob.glob(f"{folder}/vecloom/*")) == before


def test_compaction_keeps_ids_and_hits(spark, store):
    for i in range(6):
        add_vectors(store, vectors(spark, 4, start=4 * i), order_by=["k"])
    queries = spark.createDataFrame([(0, [1.0, 1.0, 1.0]), (1, [9.0, 1.0, 1.0])], "query_id int, vector array<float>")
    look = lambda s: [tuple(r)[:4] for r in search(s, queries, k=7).orderBy("query_id", "rank").collect()]
    rows, hits = store.items().orderBy("vec_id").collect(), look(store)
    early = open_store(spark, store.root)
    compact(store)
    for other in (store, open_store(spark, store.root), early):
        assert other.items().orderBy("vec_id").collect() == rows and look(other) == hits
    assert vacuum(store) == 6 and vacuum(store) == 0
    again = open_store(spark, store.root)
    assert len(again.items_by_batch().select("batch").distinct().collect()) == 1 and again.batch_starts() == ([1], [7])
    assert add_vectors(again, vectors(spark, 2, start=50))["first_id"] == 25
    assert open_store(spark, store.root).items().count() == 26 and len(look(again)) == 14
