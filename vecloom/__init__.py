"""Text to searchable vectors as Spark jobs."""

from vecloom.functions.encoders import HashingEncoder, SentenceModelEncoder
from vecloom.plans.documents import ingest_markdown, ingest_markdown_page, upsert_document, upsert_documents
from vecloom.plans.ingest import IngestOptions, ingest_corpus, whole_text_options
from vecloom.plans.search import search, search_one
from vecloom.plans.stats import store_stats
from vecloom.plans.vectors import add_vectors
from vecloom.store import VectorStore, compact, index_regions, open_store, vacuum
from vecloom.streaming.ingest import stream_corpus, stream_documents

__all__ = [
    "HashingEncoder",
    "IngestOptions",
    "SentenceModelEncoder",
    "VectorStore",
    "add_vectors",
    "compact",
    "index_regions",
    "ingest_corpus",
    "ingest_markdown",
    "ingest_markdown_page",
    "open_store",
    "search",
    "search_one",
    "store_stats",
    "stream_corpus",
    "stream_documents",
    "upsert_document",
    "upsert_documents",
    "vacuum",
    "whole_text_options",
]
