"""Live counters against the ledger."""

import time

from pyspark.sql import functions as F
from test_ingest import put, words

from vecloom.plans.ingest import IngestOptions, ingest_corpus
from vecloom.plans.progress import watched_streams
from vecloom.streaming.ingest import stream_corpus


def corpus(root):
    for n in range(5):
        put(f"{root}/f{n}.parquet", [words(n, 60 + 300 * i) for i in range(n + 2)] + [None] * n)
    put(f"{root}/nothing.parquet", [None, ""])
    put(f"{root}/zero.parquet", [])


def ledger(store):
    sums = store.processed().agg(F.sum("rows_sent").alias("sent"), F.sum("rows_skipped").alias("skipped"), F.count("*").alias("files"))
    return sums.first()


def test_counters_of_a_run_agree_with_the_ledger(store, encoder, tmp_path):
    root = str(tmp_path / "in")
    corpus(root)
    told = []
    report = ingest_corpus(store, root, encoder, IngestOptions(files_per_slice=2), progress=told.append)
    last, done = told[-1], ledger(store.refresh())
    assert (last.rows_sent, last.rows_skipped, last.files) == (done.sent, done.skipped, done.files)
    assert (last.rows_sent, last.rows_skipped, last.added) == (report.rows_sent, report.rows_skipped, report.added)
    assert last.added == store.items().count() and last.rows_per_second > 0 and last.vectors_per_second > 0
    assert {p.phase for p in told} == {"staged", "encoded"} and len(told) > 5
    for a, b in zip(told, told[1:], strict=False):
        assert a.rows_sent <= b.rows_sent and a.added <= b.added and a.seconds <= b.seconds
    assert told[0].rows_sent > 0 and told[0].added == 0  # known before the first vectors are


def test_counters_of_a_run_without_files(store, encoder, tmp_path):
    root = str(tmp_path / "in")
    put(f"{root}/no.parquet", ["x"], "html")
    told = []
    ingest_corpus(store, root, encoder, progress=told.append)
    assert told == []


def test_counters_of_a_stream(spark, store, encoder, tmp_path):
    root = str(tmp_path / "in")
    corpus(root)
    told, batches = [], []
    with watched_streams(spark, batches.append):
        run = stream_corpus(store, root, encoder, str(tmp_path / "cp"), interval=None, files_per_trigger=3, progress=told.append)
        run.awaitTermination()
        deadline = time.time() + 20
        while sum(b.files for b in batches) < 7 and time.time() < deadline:
            time.sleep(0.2)
    done = ledger(store.refresh())
    assert (told[-1].rows_sent, told[-1].rows_skipped, told[-1].added) == (done.sent, done.skipped, store.items().count())
    assert sum(b.files for b in batches) == 7 and len(batches) == 3
    assert all(b.seconds > 0 for b in batches) and batches[0].files_per_second > 0
