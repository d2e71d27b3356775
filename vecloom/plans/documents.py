"""Document insert-if-absent and markdown ingest, over many documents at once.

A document is known by the hash of its text. The first document of a hash is added; later ones, in this call or
in earlier ones, report ``exists``. Nothing is ever updated.
"""

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from vecloom import constants as C
from vecloom.functions import chunks, encoders, metadata
from vecloom.functions import text as T
from vecloom.operators import membership, numbering
from vecloom.operators.balance import spread_small
from vecloom.operators.dedup import first_seq, rows_of, with_content_key
from vecloom.store import VectorStore

_OPTIONAL = ["url", "title", "doc_type", "external_id"]
_KEYS = ["full_text_sha1", "doc_ref"]


@dataclass
class UpsertReport:
    status: DataFrame | None  # seq, doc_ref, status, total_chunks, first_id - one row per input row
    documents: int
    added: int
    seconds: dict[str, float]


def document_rows(df: DataFrame, keyed: bool = False) -> DataFrame:
    """``seq, text``, the optional columns, absent ones as nulls, and the content hash, taken over when ``keyed``."""
    absent = [F.lit(None).cast("string").alias(name) for name in _OPTIONAL if name not in df.columns]
    given = [c for c in _OPTIONAL + (_KEYS if keyed else []) if c in df.columns]
    rows = df.select("seq", F.col("text").cast("string"), *given, *absent)
    return rows if keyed else with_content_key(rows)


def judged_rows(docs: DataFrame) -> DataFrame:
    """What decides about a document: ``seq``, its hash, its reference, whether its text is blank, and its size."""
    return docs.select("seq", *_KEYS, T.is_blank(F.col("text")).alias("blank"), F.octet_length("text").cast("bigint").alias("bytes"))


def document_chunks(docs: DataFrame, size: int, overlap: int, text: str = "text") -> DataFrame:
    """Adds one row per window: ``chunk_index, chunk, char_start, char_end, total_chunks``."""
    length = F.length(text)
    counted = docs.withColumn("total_chunks", chunks.window_count(F.col(text), size, overlap)).withColumn("_len", length)
    cut = counted.select("*", F.posexplode(chunks.windows(F.col(text), size, overlap)).alias("chunk_index", "chunk"))
    index = F.col("chunk_index")
    return (
        cut.withColumn("char_start", chunks.window_start(index, size, overlap))
        .withColumn("char_end", chunks.window_end(index, F.col("_len"), size, overlap))
        .drop("_len")
    )


def registry_rows(first_chunks: DataFrame) -> DataFrame:
    return first_chunks.select(
        F.col("doc_ref").alias("doc_id"), "url", "full_text_sha1", "total_chunks",
        F.current_timestamp().alias("created_at"), "title", "doc_type", "full_text",
    )


def document_items(numbered: DataFrame, encoder) -> DataFrame:
    entries = {
        "doc_ref": F.col("doc_ref"),
        "chunk_index": F.col("chunk_index"),
        "total_chunks": F.col("total_chunks"),
        "sha1": F.sha1("chunk"),
        "h_path": F.to_json(chunks.heading_path()),
        "char_start": F.col("char_start"),
        "char_end": F.col("char_end"),
    }
    return numbered.select(
        "vec_id",
        encoders.encode(encoder, F.col("chunk")).alias("embedding"),
        F.coalesce("external_id", F.uuid()).alias("external_id"),
        metadata.metadata_map(entries).alias("metadata"),
        "chunk_index",
    )


def upsert_documents(
    store: VectorStore,
    df: DataFrame,
    encoder,
    chunk_size: int = C.DOCUMENT_CHUNK_SIZE,
    overlap: int = C.DOCUMENT_CHUNK_OVERLAP,
    with_status: bool = True,
    keyed: bool = False,
) -> UpsertReport:
    """Add the documents of ``df`` that the store does not have.

    ``df`` needs ``seq``, an orderable column unique per row that decides which copy comes first, and ``text``;
    ``url, title, doc_type, external_id`` are optional. Ids are contiguous and the chunks of a document are
    consecutive. Registry and chunks become visible together. Without ``with_status`` no status rows are kept.
    ``keyed`` says that ``df`` already has the hash columns of :func:`with_content_key`.
    """
    store.check_dim(encoder.dim)
    began = time.monotonic()
    docs = document_rows(df, keyed)
    scratch = []

    def kept(rows: DataFrame, label: str) -> numbering.Staged:
        scratch.append(numbering.stage(rows, label))
        return scratch[-1]

    try:
        # One pass judges all rows, another reads the texts of those that turned out to be first and new.
        judged = kept(judged_rows(docs), "judged").read()
        first = first_seq(judged.where("NOT blank"), "seq", store.documents(), store.known_hashes())
        winners = kept(first.select("seq"), "first-rows").read()
        size = judged.agg(F.sum("bytes")).first()[0] or 0
        cut = document_chunks(spread_small(rows_of(docs, winners, "seq"), size), chunk_size, overlap)
        full_text = F.when((F.col("chunk_index") == 0) & F.lit(store.keep_full_text), F.col("text"))
        staged = kept(cut.withColumn("full_text", full_text).drop("text"), "documents")
        return _add_documents(store, judged, staged, encoder, with_status, began)
    finally:
        for table in scratch:
            table.discard()


def _add_documents(
    store: VectorStore, judged: DataFrame, staged: numbering.Staged, encoder, with_status: bool, began: float
) -> UpsertReport:
    is_first = F.col("chunk_index") == 0
    result = numbering.number_staged(
        staged.positioned(), store.head.next_id, sums={"documents": is_first.cast("int")}
    )
    numbered = result.rows
    chunked = time.monotonic()

    store.write("items", document_items(numbered, encoder))
    encoded = time.monotonic()
    first = numbered.where(is_first)
    store.write("documents", registry_rows(first))
    added = result.total
    store.write("known", membership.bitmaps(store.written("documents"), store.head.next_id + added))
    status = None
    if with_status:
        winners = first.select("seq", "total_chunks", F.col("vec_id").alias("first_id"))
        status = numbering.stage(upsert_status(judged, winners), "status").read()
    store.commit(added=added, dim=encoder.dim if added else None, model_name=encoder.name)
    ended = time.monotonic()
    seconds = {
        "chunk": chunked - began, "encode": encoded - chunked, "add": ended - encoded, "total": ended - began,
    }
    return UpsertReport(status, result.sums["documents"], added, seconds)


def upsert_status(judged: DataFrame, winners: DataFrame) -> DataFrame:
    """``added``, ``exists`` or ``rejected`` per input row. Joined on ``seq``, which is unique, so copies of one
    text do not pile up in one task."""
    status = F.when(F.col("blank"), "rejected").when(F.col("first_id").isNotNull(), "added").otherwise("exists")
    doc_ref = F.when(~F.col("blank"), F.col("doc_ref")).alias("doc_ref")
    return judged.join(winners, "seq", "left").select("seq", doc_ref, status.alias("status"), "total_chunks", "first_id")


def upsert_document(
    store: VectorStore,
    encoder,
    text: str | None,
    external_id: str | None = None,
    metadata: dict | None = None,
    chunk_size: int = C.DOCUMENT_CHUNK_SIZE,
    overlap: int = C.DOCUMENT_CHUNK_OVERLAP,
) -> dict:
    """One document; raises on blank text. For many documents use :func:`upsert_documents`."""
    given = metadata or {}
    row = (0, text, given.get("url"), given.get("title"), given.get("doc_type"), external_id)
    one = store.spark.createDataFrame([row], "seq int, text string, url string, title string, doc_type string, external_id string")
    if one.select(T.is_blank(F.col("text"))).first()[0]:
        raise ValueError("a document needs text")
    report = upsert_documents(store, one, encoder, chunk_size, overlap)
    row = report.status.first()
    if row.status == "exists":
        return {"doc_ref": row.doc_ref, "status": "exists"}
    ids = list(range(row.first_id, row.first_id + row.total_chunks))
    timings = {f"{name}_ms": value * 1000.0 for name, value in report.seconds.items()}
    return {"doc_ref": row.doc_ref, "total_chunks": row.total_chunks, "ids": ids, "timings": timings}


# ---- markdown ----
def markdown_documents(df: DataFrame) -> DataFrame:
    """``seq, url, raw_markdown, doc_type`` -> cleaned documents with ``reason``, null for acceptable pages."""
    doc_type = F.col("doc_type") if "doc_type" in df.columns else F.lit(C.DEFAULT_PAGE_TYPE)
    cleaned = df.select(
        "seq", "url", F.lower(doc_type).alias("doc_type"), T.clean_markdown(F.col("raw_markdown")).alias("text")
    )
    reason = F.when(~T.is_valid_url(F.col("url")), "invalid url").when(
        F.coalesce(F.col("text") == "", F.lit(True)), "empty markdown after cleaning"
    )
    return cleaned.withColumn("title", T.markdown_title(F.col("text"))).withColumn("reason", reason)


def ingest_markdown(
    store: VectorStore,
    df: DataFrame,
    encoder,
    chunk_size: int = C.DOCUMENT_CHUNK_SIZE,
    overlap: int = C.DOCUMENT_CHUNK_OVERLAP,
    language: str = C.DEFAULT_LANGUAGE,
) -> DataFrame:
    """Add markdown pages; one status row per page. ``success`` is also true for pages that exist already.

    Cleaning, the costly part, runs once: cleaned pages are staged, and what follows reads the columns it needs.
    """
    cleaned = numbering.stage(with_content_key(markdown_documents(df)), "pages")
    try:
        return _ingest_cleaned(store, cleaned.read(), encoder, chunk_size, overlap, language)
    finally:
        cleaned.discard()


def _ingest_cleaned(store: VectorStore, pages: DataFrame, encoder, chunk_size: int, overlap: int, language: str) -> DataFrame:
    report = upsert_documents(store, pages.where(F.col("reason").isNull()), encoder, chunk_size, overlap, keyed=True)
    narrow = pages.select("seq", "url", "title", "doc_type", "reason")
    rows = narrow.join(report.status, "seq", "left").select(
        "seq", "url", "title", "doc_type", F.lit(language).alias("language"), "doc_ref",
        F.coalesce("status", F.lit("rejected")).alias("status"), F.col("reason").isNull().alias("success"), "reason",
        "total_chunks", "first_id", F.lit(encoder.name).alias("model_name"), F.lit(encoder.dim).alias("dim"),
        F.current_date().cast("string").alias("emb_ver"),
    )
    return numbering.stage(rows, "status").read()


def ingest_markdown_page(
    store: VectorStore, encoder, url: str, raw_markdown: str, doc_type: str = C.DEFAULT_PAGE_TYPE, **options
) -> Row:
    """One page; raises on an invalid url or empty markdown."""
    page = store.spark.createDataFrame(
        [(0, url, raw_markdown, doc_type)], "seq int, url string, raw_markdown string, doc_type string"
    )
    reason = markdown_documents(page).first().reason
    if reason is not None:
        raise ValueError(reason)
    return ingest_markdown(store, page, encoder, **options).first()
