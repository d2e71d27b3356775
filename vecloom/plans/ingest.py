"""Corpus ingest: parquet files of web text -> chunks -> vectors in the store.

Per slice of files: scan, strip, filter and cut into chunks in one narrow stage that is written once to the shared
folder; number the staged chunks from their file positions; encode and append; record the files; commit. Nothing
wide is shuffled. A slice is bounded in files and bytes, so what the driver sees of it (file names, segment counts)
is bounded too, and a lost run repeats at most one slice.
"""

import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from vecloom import constants as C
from vecloom.functions import chunks, encoders, metadata
from vecloom.functions import text as T
from vecloom.operators import numbering
from vecloom.operators.balance import spread_in_order
from vecloom.plans.progress import Meter, Progress
from vecloom.session import hidden_files
from vecloom.sources import files as file_source
from vecloom.sources.census import census
from vecloom.sources.corpus import in_band, read_corpus
from vecloom.store import VectorStore

FILES_PER_SLICE = 20_000
BYTES_PER_SLICE = 1024**4


@dataclass(frozen=True)
class IngestOptions:
    chunk: bool = True
    keep_text: bool = False
    doc_type: str | None = None
    limit: int | None = None
    min_chars: int = C.MIN_CHARS
    max_chars: int = C.MAX_CHARS
    chunk_size: int = C.CORPUS_CHUNK_SIZE
    overlap: int = C.CORPUS_CHUNK_OVERLAP
    files_per_slice: int = FILES_PER_SLICE
    bytes_per_slice: int = BYTES_PER_SLICE

    def __post_init__(self):
        if self.chunk and self.chunk_size < self.min_chars:
            raise ValueError("chunk_size is below min_chars: no chunk could be kept")


@dataclass
class IngestReport:
    files: int = 0
    rows_sent: int = 0
    rows_skipped: int = 0
    added: int = 0
    seconds_staging: float = 0.0
    seconds_encoding: float = 0.0
    commits: list[int] = field(default_factory=list)
    hidden: list[str] = field(default_factory=list)  # files that Spark's sources pass over by their names

    @property
    def vectors_per_second(self) -> float:
        return self.added / self.seconds_encoding if self.seconds_encoding else 0.0

    def as_frame(self, spark: SparkSession) -> DataFrame:
        row = {**asdict(self), "vectors_per_second": self.vectors_per_second}
        return spark.createDataFrame([Row(**{k: v for k, v in row.items() if k not in ("commits", "hidden")})])


def ingest_corpus(
    store: VectorStore, root: str, encoder, options: IngestOptions = IngestOptions(), allow: list[str] | None = None,
    progress: Callable[[Progress], None] | None = None,
) -> IngestReport:
    """Ingest the files below ``root`` that the ledger does not name yet. The report names files that were passed over.
    ``progress`` is told what has been done so far, twice per slice."""
    meter = Meter(progress) if progress else None
    report = ingest_files(store, file_source.list_files(store.spark, root, allow), encoder, options, meter)
    report.hidden = hidden_files(store.spark, root, ".parquet")
    return report


def ingest_files(
    store: VectorStore, files: DataFrame, encoder, options: IngestOptions = IngestOptions(), meter: Meter | None = None
) -> IngestReport:
    store.check_dim(encoder.dim)
    facts = numbering.stage(census(file_source.unprocessed(files, store.processed())), "census")
    report = IngestReport()
    try:
        _ingest_slices(store, facts, encoder, options, report, meter)
    finally:
        facts.discard()
    return report


def _ingest_slices(
    store: VectorStore, facts: numbering.Staged, encoder, options: IngestOptions, report: IngestReport, meter: Meter | None
) -> None:
    last = ""
    # A limited run starts with few files and widens, as it may need only the first ones.
    width = options.files_per_slice if options.limit is None else min(8, options.files_per_slice)
    while options.limit is None or report.rows_sent < options.limit:
        slice_files, more = _next_slice(facts.read(), last, width, options.bytes_per_slice)
        if slice_files:
            last = slice_files[-1].file_uri
            width = min(options.files_per_slice, width * 4)
            _ingest_slice(store, slice_files, encoder, options, report, meter)
        if not more:
            break


def _next_slice(facts: DataFrame, after: str, width: int, max_bytes: int) -> tuple[list[Row], bool]:
    """The next files in path order, bounded in number and bytes, and whether more follow."""
    rows = facts.where(F.col("file_uri") > after).orderBy("file_uri").limit(width + 1).collect()
    total = 0
    for place, row in enumerate(rows[:width]):
        total += row.length
        if place and total > max_bytes:
            return rows[:place], True
    return rows[:width], len(rows) > width


def _ingest_slice(
    store: VectorStore, files: list[Row], encoder, options: IngestOptions, report: IngestReport, meter: Meter | None
) -> None:
    spark = store.spark
    began = time.monotonic()
    readable = [f for f in files if f.status == "ok"]
    touched, cut = readable, None
    if options.limit is not None:
        touched, cut = limit_cut(spark, readable, options.limit - report.rows_sent, options)
    corpus = read_corpus(spark, touched)
    corpus = spread_in_order(corpus, sum(f.length for f in touched), "file_uri", "row_index")
    pieces, seen = chunk_rows(corpus, cut, options), None
    if meter and touched:
        pieces, seen = meter.observe(pieces, **_row_counts())
    chunked = numbering.stage(pieces, "chunks")
    if seen:
        meter.add("staged", files=len(touched), **seen.get)
    try:
        _number_and_encode(store, files, touched, cut, chunked.positioned(), encoder, options, report, began, meter)
    finally:
        chunked.discard()


def _number_and_encode(
    store: VectorStore, files: list[Row], touched: list[Row], cut: tuple[str, int] | None, rows: DataFrame, encoder,
    options: IngestOptions, report: IngestReport, began: float, meter: Meter | None,
) -> None:
    spark = store.spark
    segments = _segments(rows)
    ledger = _file_ledger(files, segments, {f.file_uri for f in touched}, cut)
    staged = time.monotonic()

    good = set(ledger.loc[ledger["rows_sent"] > 0, "path"])
    offsets = _segment_offsets(segments[segments["file_uri"].isin(good)], store.head.next_id)
    added = int(offsets["n"].sum())
    if added:
        table = pa.Table.from_pandas(offsets[["_part", "file_uri", "_base"]], preserve_index=False)
        # At most one row per file and scan split of a bounded slice; beyond the checked count Spark joins by a shuffle.
        small = spark.createDataFrame(table)
        small = F.broadcast(small) if table.num_rows <= numbering.MAX_LOCAL_SEGMENTS else small
        kept = rows.where(F.col("chunk_index").isNotNull())
        numbered = numbering.with_ids(kept, small, ["file_uri"])
        items = encoded_items(numbered, encoder, options)
        if meter:
            items, seen = meter.observe(items, added=F.count("vec_id"))
        store.write("items", items)
        if meter:
            meter.add("encoded", **seen.get)
    store.write("processed", spark.createDataFrame(pa.Table.from_pandas(ledger, preserve_index=False)).coalesce(1))
    store.commit(added=added, dim=encoder.dim if added else None, model_name=encoder.name)

    report.files += len(files)
    report.rows_sent += int(ledger["rows_sent"].sum())
    report.rows_skipped += int(ledger["rows_skipped"].sum())
    report.added += added
    report.seconds_staging += staged - began
    report.seconds_encoding += time.monotonic() - staged
    report.commits.append(store.head.version)


def limit_cut(
    spark: SparkSession, files: list[Row], limit: int, options: IngestOptions
) -> tuple[list[Row], tuple[str, int] | None]:
    """The files that hold the first ``limit`` passing rows in (file, row) order, and the last row of the last file.

    The limit becomes a predicate on file and row, so no text is moved to apply it. Only row numbers of the one
    file in which the limit falls are ordered.
    """
    passing = in_band(read_corpus(spark, files), options.min_chars, options.max_chars)
    counts = {row.file_uri: row["count"] for row in passing.groupBy("file_uri").count().collect()}
    left = limit
    for place, file in enumerate(files):
        here = counts.get(file.file_uri, 0)
        if here >= left:
            inside = in_band(read_corpus(spark, [file]), options.min_chars, options.max_chars)
            first = inside.select("row_index").orderBy("row_index").limit(left)
            return files[: place + 1], (file.file_uri, first.agg(F.max("row_index")).first()[0])
        left -= here
    return files, None


def chunk_rows(corpus: DataFrame, cut: tuple[str, int] | None, options: IngestOptions) -> DataFrame:
    """One row per kept chunk, and one row with a null ``chunk_index`` per rejected text so that skips can be
    counted without a second scan. Rejected rows come last in a partition: kept rows are numbered by position."""
    if cut is not None:
        file_uri, last_row = cut
        corpus = corpus.where((F.col("file_uri") != file_uri) | (F.col("row_index") <= last_row))
    text = F.col("text")
    if options.chunk:
        parts = chunks.windows(text, options.chunk_size, options.overlap, max_length=options.max_chars)
    else:
        parts = F.array(text)
    judged = corpus.withColumn("sent", T.in_length_band(text, options.min_chars, options.max_chars))
    ordered = judged.sortWithinPartitions(F.col("sent").desc(), "file_uri", "row_index")
    pieces = F.when(F.col("sent"), parts).otherwise(F.array(F.lit(None).cast("string")))
    exploded = ordered.select("file_uri", "row_index", "url", "sent", F.posexplode(pieces).alias("pos", "chunk"))
    long_enough = exploded.where(~F.col("sent") | (F.length("chunk") >= options.min_chars))
    return long_enough.select(
        "file_uri",
        "row_index",
        F.when(F.col("sent"), F.col("pos")).alias("chunk_index"),
        "chunk",
        F.when(F.col("sent"), F.col("url")).alias("url"),
    )


def _row_counts() -> dict[str, Column]:
    return {"rows_sent": F.count_if(F.col("chunk_index") == 0), "rows_skipped": F.count_if(F.col("chunk_index").isNull())}


def _segments(rows: DataFrame) -> pd.DataFrame:
    kept = F.col("chunk_index").isNotNull()
    summary = rows.groupBy("_part", "file_uri").agg(
        F.count("chunk_index").alias("n"),
        F.min(F.when(kept, F.col("_pos"))).alias("first_pos"),
        F.min(F.when(kept, F.col("row_index"))).alias("first_row"),
        _row_counts()["rows_sent"].alias("sent"),
        _row_counts()["rows_skipped"].alias("skipped"),
    )
    return summary.toPandas()


def _segment_offsets(segments: pd.DataFrame, start: int) -> pd.DataFrame:
    kept = segments[segments["n"] > 0]
    ordered = kept.sort_values(["file_uri", "first_row", "_part"], kind="stable")
    before = np.cumsum(ordered["n"].to_numpy(dtype=np.int64)) - ordered["n"].to_numpy(dtype=np.int64)
    return ordered.assign(_base=start + before - ordered["first_pos"].to_numpy(dtype=np.int64))


def _file_ledger(
    files: list[Row], segments: pd.DataFrame, touched: set[str], cut: tuple[str, int] | None
) -> pd.DataFrame:
    """Status and counts per file. A file that gave fewer rows than its footer promises broke off while being read:
    it is ``failed``, none of its rows are added, and it is offered again by the next run, as is the ``limited`` file
    in which a row limit fell, from the row behind ``last_row``."""
    totals = segments.groupby("file_uri")[["sent", "skipped"]].sum()
    rows = []
    for file in files:
        sent, skipped = totals.loc[file.file_uri] if file.file_uri in totals.index else (0, 0)
        status, last_row = file.status, None
        if status == "ok" and file.file_uri not in touched:
            continue  # behind the limit: not read, so not finished
        if cut is not None and file.file_uri == cut[0]:
            status, last_row = "limited", cut[1]
        elif status == "ok" and sent + skipped < file.n_rows - file.from_row:
            status, sent, skipped = "failed", 0, 0
            if file.from_row:  # the rows taken before stay taken
                status, last_row = "limited", file.from_row - 1
        rows.append((file.file_uri, status, int(sent), int(skipped), last_row))
    ledger = pd.DataFrame(rows, columns=["path", "status", "rows_sent", "rows_skipped", "last_row"])
    return ledger.astype({"last_row": "Int64"})


def encoded_items(numbered: DataFrame, encoder, options: IngestOptions) -> DataFrame:
    entries = {"url": F.col("url")}
    if options.doc_type is not None:
        entries["doc_type"] = F.lit(options.doc_type)
    if options.chunk:
        entries["created_at"] = T.shown_time(F.current_timestamp())
    return numbered.select(
        "vec_id",
        encoders.encode(encoder, F.col("chunk")).alias("embedding"),
        T.external_id_16().alias("external_id"),
        (F.col("chunk") if options.keep_text else F.lit(None).cast("string")).alias("text"),
        metadata.metadata_map(entries).alias("metadata"),
        F.col("file_uri").alias("source_file"),
        F.col("row_index").alias("source_row"),
        "chunk_index",
    )


def whole_text_options(
    limit: int | None = C.WHOLE_TEXT_LIMIT, doc_type: str = C.WHOLE_TEXT_TYPE, **changes
) -> IngestOptions:
    """Small ingest: whole texts without chunking, text kept beside the vector, exact row limit."""
    return IngestOptions(chunk=False, keep_text=True, limit=limit, doc_type=doc_type, **changes)


def metadata_lines(store: VectorStore, from_id: int = 1) -> DataFrame:
    """``id, url, created_at`` of the store's vectors, ready for the JSON-lines sink. ``from_id`` leaves out those
    an earlier export has written."""
    field = F.col("metadata").getItem
    return store.items().where(F.col("vec_id") >= from_id).select(
        F.col("vec_id").alias("id"), field("url").alias("url"), field("created_at").alias("created_at")
    )


def export_metadata_lines(store: VectorStore, path: str) -> int:
    """Export the metadata lines of all vectors that no export below ``path`` has; how many ids were exported.

    The watermark is published with the lines, so every id is exported once, whatever run dies or is repeated.
    """
    first = file_source.export_watermark(store.spark, path) + 1
    last = store.head.next_id - 1
    if last < first:
        return 0
    lines = metadata_lines(store, first).where(F.col("id") <= last)
    if not file_source.publish_metadata_lines(lines, path, first, last):
        raise RuntimeError("another export has begun at the same id; try again")
    return last - first + 1
