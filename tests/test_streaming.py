import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
from test_ingest import expected, names, put, stored, words

from vecloom.plans.ingest import IngestOptions, ingest_corpus
from vecloom.store import open_store
from vecloom.streaming.ingest import heartbeat, stop_after_batch, stream_corpus, stream_documents


def test_stream_equals_batch_and_resumes(spark, store, encoder, tmp_path):
    root, files = str(tmp_path / "in"), {}
    for n in range(3):
        files[f"f{n}.parquet"] = [words(n, 100 + 950 * i) for i in range(4)]
        put(f"{root}/f{n}.parquet", files[f"f{n}.parquet"], "content" if n == 1 else "text")
    with open(f"{root}/bad.parquet", "w") as out:
        out.write("bad")
    reports = []
    run = lambda: stream_corpus(
        store, root, encoder, str(tmp_path / "cp"), IngestOptions(), interval=None, files_per_trigger=2, reports=reports
    )
    run().awaitTermination()
    assert len(reports) == 2 and sum(r.files for r in reports) == 4
    assert sorted(names(stored(store.refresh()), root)) == sorted(w[:3] for w in expected(files))

    batch = open_store(spark, str(tmp_path / "batch"))
    ingest_corpus(batch, root, encoder)
    assert sorted(names(stored(batch), root)) == sorted(names(stored(store), root))

    files["g.parquet"] = [words(7, 300)]
    put(f"{root}/g.parquet", files["g.parquet"])
    run().awaitTermination()
    assert sorted(names(stored(store.refresh()), root)) == sorted(w[:3] for w in expected(files))

    # A lost checkpoint replays all files; the ledger keeps them from being added twice.
    before = store.items().count()
    stream_corpus(store, root, encoder, str(tmp_path / "cp2"), interval=None).awaitTermination()
    assert store.refresh().items().count() == before


def test_running_stream_heartbeat_and_stop(spark, store, encoder, tmp_path):
    root = str(tmp_path / "in")
    put(f"{root}/a.parquet", [words(1, 500)])
    query = stream_corpus(store, root, encoder, str(tmp_path / "cp"), interval="1 second")
    deadline = time.time() + 60
    while heartbeat(query, store)["added"] < 1 and time.time() < deadline:
        time.sleep(0.5)
    beat = heartbeat(query, store)
    assert beat["added"] == 1 and not beat["nothing_added"]
    stop_after_batch(query)
    assert not query.isActive
    put(f"{root}/b.parquet", [words(2, 500)])
    again = stream_corpus(store, root, encoder, str(tmp_path / "cp"), interval=None)
    again.awaitTermination()
    assert store.refresh().items().count() == 2


def test_an_error_stops_the_stream_and_commits_nothing(spark, store, tmp_path):
    class Broken:
        name, dim, batch_size = "broken", 4, 8

        def encode(self, texts):
            raise RuntimeError("model failed")

    put(f"{tmp_path}/in/a.parquet", [words(1, 500)])
    query = stream_corpus(store, f"{tmp_path}/in", Broken(), str(tmp_path / "cp"), interval=None)
    try:
        query.awaitTermination()
        failed = False
    except Exception as error:
        failed = "model failed" in str(error)
    assert failed and store.refresh().items().count() == 0 and store.processed().count() == 0


def test_documents_are_deduplicated_across_batches(spark, store, encoder, tmp_path):
    inbox = tmp_path / "docs"
    inbox.mkdir()
    for n, texts in enumerate((["one", "two", "one"], ["two", "three"])):
        table = pa.table({"seq": pa.array(range(len(texts)), pa.int64()), "text": texts})
        pq.write_table(table, str(inbox / f"{n}.parquet"))
        stream = spark.readStream.schema("seq bigint, text string").parquet(str(inbox))
        stream_documents(store, stream, encoder, str(tmp_path / "cp"), interval=None).awaitTermination()
    assert store.refresh().documents().count() == 3 and store.items().count() == 3


def test_old_files_are_taken(spark, store, encoder, tmp_path):
    root = str(tmp_path / "in")
    put(f"{root}/new.parquet", [words(1, 300)])
    run = lambda: stream_corpus(store, root, encoder, str(tmp_path / "cp"), interval=None).awaitTermination()
    run()
    put(f"{root}/old.parquet", [words(2, 300)])
    os.utime(f"{root}/old.parquet", (time.time() - 30 * 86400,) * 2)
    run()
    assert store.refresh().items().count() == 2


def test_failed_and_limited_files_are_offered_again(spark, store, encoder, tmp_path):
    root = str(tmp_path / "in")
    put(f"{root}/a.parquet", [words(1, 300), words(2, 300), words(3, 300)])
    ledger = [(f"file://{root}/a.parquet", "failed", 0, 0, None), (f"file://{root}/gone.parquet", "failed", 0, 0, None)]
    store.write("processed", spark.createDataFrame(ledger, "path string, status string, rows_sent bigint, rows_skipped bigint, last_row bigint"))
    store.commit()
    checkpoint = str(tmp_path / "cp")
    run = lambda: stream_corpus(store, root, encoder, checkpoint, IngestOptions(limit=2), interval=None).awaitTermination()
    run()
    assert store.refresh().items().count() == 2
    put(f"{root}/b.parquet", [words(4, 300)])
    run()
    assert sorted(r.source_row for r in store.refresh().items().collect() if r.source_file.endswith("a.parquet")) == [0, 1, 2]


def test_a_run_without_new_files_finishes_what_is_open(spark, store, encoder, tmp_path):
    """A limited file goes on behind its last row, files behind the limit and a failed one are read at all."""
    root, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    put(f"{root}/a.parquet", [words(n, 300) for n in range(3)])
    put(f"{root}/b.parquet", [words(n, 300) for n in range(5, 7)])
    run = lambda limit: stream_corpus(store, root, encoder, checkpoint, IngestOptions(limit=limit), interval=None).awaitTermination()
    counts = []
    for limit in (2, 2, 2, None):
        run(limit)
        counts.append(store.refresh().items().count())
    assert counts == [2, 4, 5, 5]
    assert sorted((r.source_file[-9:], r.source_row) for r in store.items().collect()) == [
        ("a.parquet", 0), ("a.parquet", 1), ("a.parquet", 2), ("b.parquet", 0), ("b.parquet", 1),
    ]
    ledger = [(f"file://{root}/c.parquet", "failed", 0, 0, None)]
    store.write("processed", spark.createDataFrame(ledger, "path string, status string, rows_sent bigint, rows_skipped bigint, last_row bigint"))
    store.commit()
    run(None)  # gone files are no obstacle
    put(f"{root}/c.parquet", [words(9, 300)])
    stream_corpus(store, root, encoder, checkpoint, interval=None).awaitTermination()
    assert store.refresh().items().count() == 6


def test_the_limit_counts_for_the_whole_run(spark, store, encoder, tmp_path):
    root = str(tmp_path / "in")
    for n in range(4):
        put(f"{root}/f{n}.parquet", [words(n, 300), words(n + 10, 300)])
    reports = []
    run = lambda limit: stream_corpus(
        store, root, encoder, str(tmp_path / "cp"), IngestOptions(limit=limit), interval=None, files_per_trigger=1, reports=reports
    ).awaitTermination()
    run(3)
    assert store.refresh().items().count() == 3 and sum(r.rows_sent for r in reports) == 3
    run(4)
    assert store.refresh().items().count() == 7
    run(None)
    rows = [(r.source_file, r.source_row) for r in store.refresh().items().collect()]
    assert len(rows) == len(set(rows)) == 8
    run(None)
    assert store.refresh().items().count() == 8


def test_a_stopped_or_failed_run_is_not_reconciled(spark, store, encoder, tmp_path):
    root = str(tmp_path / "in")
    put(f"{root}/a.parquet", [words(1, 300)])
    query = stream_corpus(store, root, encoder, str(tmp_path / "cp"), interval="1 hour")
    query.processAllAvailable()
    query.stop()
    put(f"{root}/b.parquet", [words(2, 300)])
    query.awaitTermination()
    assert store.refresh().items().count() == 1
