"""Incremental ingest as Structured Streaming.

The stream carries file paths, not rows: files of one folder may have different schemas, which a parquet stream
cannot have. Each micro-batch runs the batch ingest on its new files. The ledger is committed together with the
vectors, so a replayed micro-batch finds its files finished and adds nothing.

The stream offers a file once. What it offered and the ledger does not hold as finished - files that a row limit cut or kept
from being read, files whose read broke off, files of a micro-batch that died with its checkpoint - is found by comparing
the listing with the ledger, with which each run that takes what is there and ends is closed.
"""

import time
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from vecloom import constants as C
from vecloom.plans.documents import UpsertReport, upsert_documents
from vecloom.plans.ingest import IngestOptions, IngestReport, ingest_files
from vecloom.plans.progress import Meter, Progress, offered
from vecloom.plans.stats import stored_bytes
from vecloom.sources.files import list_files, stream_files, to_retry
from vecloom.store import VectorStore

FILES_PER_TRIGGER = 1_000


def _start(stream: DataFrame, handle, checkpoint: str, interval: str | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


class CorpusRun:
    """What one run of :func:`stream_corpus` has taken. ``options.limit`` counts for the run, over all of its micro-batches."""

    def __init__(
        self, store: VectorStore, encoder, options: IngestOptions, reports: list[IngestReport] | None, meter: Meter | None = None
    ):
        self.store, self.encoder, self.options, self.reports, self.meter = store, encoder, options, reports, meter
        self.sent = 0

    @property
    def full(self) -> bool:
        return self.options.limit is not None and self.sent >= self.options.limit

    def take(self, files: DataFrame) -> IngestReport:
        """Ingest those of ``files`` that the ledger does not hold as finished, as far as the run's limit reaches."""
        limit = None if self.options.limit is None else self.options.limit - self.sent
        report = ingest_files(self.store.refresh(), files, self.encoder, replace(self.options, limit=limit), self.meter)
        self.sent += report.rows_sent
        return report

    def micro_batch(self, files: DataFrame, _batch: int) -> None:
        if self.full:
            return
        again = to_retry(self.store.spark, self.store.refresh().processed())
        if again is not None:
            files = files.union(again).dropDuplicates(["file_uri"])
        self._report(self.take(files))

    def reconcile(self, root: str) -> None:
        """Take what is listed below ``root`` and the ledger does not hold as finished."""
        if not self.full:
            report = self.take(list_files(self.store.spark, root))
            if report.files:
                self._report(report)

    def _report(self, report: IngestReport) -> None:
        if self.reports is not None:
            self.reports.append(report)


class CorpusStream:
    """The streaming query of a run, which is closed by a reconciliation once it has ended by itself."""

    def __init__(self, query: StreamingQuery, run: CorpusRun, root: str, ends: bool):
        self._query, self._run, self._root, self._open = query, run, root, ends

    def __getattr__(self, name: str):
        return getattr(self._query, name)

    def awaitTermination(self, timeout: int | None = None) -> bool | None:
        ended = self._query.awaitTermination(timeout) if timeout is not None else self._query.awaitTermination()
        if self._open and ended is not False:
            self._open = False
            self._run.reconcile(self._root)
        return ended

    def stop(self) -> None:
        self._open = False
        self._query.stop()


def stream_corpus(
    store: VectorStore,
    root: str,
    encoder,
    checkpoint: str,
    options: IngestOptions = IngestOptions(),
    interval: str | None = C.CHECKPOINT_INTERVAL,
    files_per_trigger: int = FILES_PER_TRIGGER,
    bytes_per_trigger: str | None = None,
    reports: list[IngestReport] | None = None,
    progress: Callable[[Progress], None] | None = None,
) -> CorpusStream:
    """Ingest files as they arrive below ``root``, one commit per micro-batch. Without ``interval`` the query takes
    what is there and ends, and ``awaitTermination`` then finishes what the ledger still lacks, also where no new file has come.
    With one, open files of the ledger are taken up by the next micro-batch. A micro-batch takes at most ``files_per_trigger``
    files, or ``bytes_per_trigger`` when given; ``options.limit`` is the number of rows of the whole run. ``progress`` is told what the run has done so far."""
    run = CorpusRun(store, encoder, options, reports, Meter(progress) if progress else None)
    stream = offered(stream_files(store.spark, root, files_per_trigger, bytes_per_trigger))
    query = _start(stream, run.micro_batch, checkpoint, interval)
    return CorpusStream(query, run, root, ends=interval is None)


def stream_documents(
    store: VectorStore,
    documents: DataFrame,
    encoder,
    checkpoint: str,
    interval: str | None = C.CHECKPOINT_INTERVAL,
    reports: list[UpsertReport] | None = None,
    **options,
) -> StreamingQuery:
    """Insert-if-absent of a stream of documents (see :func:`upsert_documents`). Known documents are found in the
    registry, so the stream keeps no growing state."""

    def handle(rows: DataFrame, _batch: int) -> None:
        report = upsert_documents(store.refresh(), rows, encoder, with_status=False, **options)
        if reports is not None:
            reports.append(report)

    return _start(documents, handle, checkpoint, interval)


def stop_after_batch(query: StreamingQuery | CorpusStream, poll_seconds: float = 0.1) -> None:
    """Stop between two micro-batches; the next start resumes from the checkpoint."""
    while query.isActive and query.status["isTriggerActive"]:
        time.sleep(poll_seconds)
    query.stop()


def heartbeat(query: StreamingQuery | CorpusStream, store: VectorStore) -> dict:
    """Progress of a running ingest: vectors and bytes so far, rows of the last micro-batch, and whether nothing was
    added, which a caller may want to warn about."""
    last = query.lastProgress
    added = store.refresh().head.next_id - 1
    return {
        "added": added,
        "version": store.head.version,
        "batch_id": last["batchId"] if last else None,
        "rows_in_batch": last["numInputRows"] if last else 0,
        "nothing_added": added == 0,
        **stored_bytes(store),
    }
