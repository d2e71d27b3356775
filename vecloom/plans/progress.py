"""Live counters of an ingest: what a run has sent, skipped and added so far, counted by the writes that do the work.

The counts come from observed metrics, which a write gathers on its way, so nothing is scanned for them. They are told
after every staged and every encoded slice, before the slice is committed; rows of a file that turns out to be broken are
among them, which the ledger leaves out.
"""

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener


@dataclass(frozen=True)
class Progress:
    phase: str = ""
    files: int = 0
    rows_sent: int = 0
    rows_skipped: int = 0
    added: int = 0
    seconds: float = 0.0

    @property
    def rows_per_second(self) -> float:
        return (self.rows_sent + self.rows_skipped) / self.seconds if self.seconds else 0.0

    @property
    def vectors_per_second(self) -> float:
        return self.added / self.seconds if self.seconds else 0.0


class Meter:
    """Adds up the counts of one run, over all its slices and micro-batches, and hands each state to ``tell``."""

    def __init__(self, tell: Callable[[Progress], None]):
        self._tell, self._began, self.state = tell, time.monotonic(), Progress()

    def observe(self, df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
        seen = Observation()
        return df.observe(seen, *(column.alias(name) for name, column in counts.items())), seen

    def add(self, phase: str, **counts: int) -> None:
        sums = {name: getattr(self.state, name) + n for name, n in counts.items()}
        self.state = replace(self.state, phase=phase, seconds=time.monotonic() - self._began, **sums)
        self._tell(self.state)


@dataclass(frozen=True)
class BatchProgress:
    batch_id: int
    files: int  # that the stream offered
    files_per_second: float
    seconds: float


OFFERED = "offered"


def offered(files: DataFrame) -> DataFrame:
    """A stream of files whose progress events carry the number of files."""
    return files.observe(OFFERED, F.count(F.lit(1)).alias("files"))


class _Listener(StreamingQueryListener):
    def __init__(self, tell: Callable[[BatchProgress], None]):
        self._tell = tell

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(OFFERED)
        if seen is not None:
            p = event.progress
            self._tell(BatchProgress(p.batchId, seen["files"], p.processedRowsPerSecond, p.batchDuration / 1000))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


@contextmanager
def watched_streams(spark: SparkSession, tell: Callable[[BatchProgress], None]) -> Iterator[None]:
    """Tell of every micro-batch of the session's corpus streams, as Spark's listener hears of it."""
    listener = _Listener(tell)
    spark.streams.addListener(listener)
    try:
        yield
    finally:
        spark.streams.removeListener(listener)
