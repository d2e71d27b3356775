"""Top-k cosine search over a store, by text or by vector, with metadata equality filters."""

from functools import reduce
from typing import Any, Literal

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom import constants as C
from vecloom import schemas
from vecloom.functions import encoders, metadata
from vecloom.functions import text as T
from vecloom.operators import numbering
from vecloom.operators.regions import Pruner
from vecloom.operators.topk import top_k
from vecloom.store import VectorStore

HIT_BROADCAST_BYTES = 128 * 1024 * 1024
PRUNING_IDS = 1_000_000
ID_RANGES = 32
LINKED_DOCUMENTS = 100_000
_TOP_LEVEL = ["external_id", "text"]


def query_vectors(queries: DataFrame, encoder=None) -> DataFrame:
    """``query_id, vector`` of queries given as ``vector`` or ``text``; a vector wins, blank queries give nothing."""
    has_text, has_vector = "text" in queries.columns, "vector" in queries.columns
    vector = F.col("vector").cast(schemas.VECTOR) if has_vector else F.lit(None).cast(schemas.VECTOR)
    given = queries.select("query_id", vector.alias("vector")).where(F.col("vector").isNotNull()) if has_vector else None
    if not has_text:
        return given
    texts = queries.where(vector.isNull() & ~T.is_blank(F.col("text")))
    if encoder is None:
        raise ValueError("text queries need an encoder")
    encoded = texts.select("query_id", encoders.encode(encoder, F.col("text")).alias("vector"))
    return encoded if given is None else given.unionByName(encoded)


def id_ranges(ids: np.ndarray, most: int = ID_RANGES) -> list[tuple[int, int]]:
    """At most ``most`` ranges that cover the ids, split at the widest gaps."""
    ids = np.unique(ids)
    gaps = np.diff(ids)
    widest = np.argsort(gaps, kind="stable")[max(0, len(gaps) - most + 1) :]
    splits = np.sort(widest[gaps[widest] > 1]) + 1
    return [(int(part[0]), int(part[-1])) for part in np.split(ids, splits) if len(part)]


def near_ids(store: VectorStore, ids: np.ndarray) -> Column:
    """A scan filter that every row of ``ids`` passes: its batch, a partition column, and its range of ids, which
    parquet row groups are skipped by, as rows are stored in id order."""
    if not len(ids):
        return F.lit(False)
    starts, versions = store.batch_starts()
    batches = np.unique(np.array(versions)[np.searchsorted(starts, ids, side="right") - 1])
    ranges = [F.col("vec_id").between(low, high) for low, high in id_ranges(ids)]
    return F.col("batch").isin([int(b) for b in batches]) & reduce(Column.__or__, ranges)


def search(
    store: VectorStore,
    queries: DataFrame,
    k: int = C.DEFAULT_TOP_K,
    encoder=None,
    equal_to: dict[str, Any] | None = None,
    filter_mode: Literal["post", "pre"] = "post",
    return_text: bool = False,
    link_documents: bool = False,
    prune: bool = True,
) -> DataFrame:
    """``query_id, rank, vec_id, score, external_id, metadata[, text][, document]``.

    ``post`` filters the k best, so fewer than k may be left; ``pre`` ranks only rows that pass. ``rank`` is the
    place among the k best before a post filter. ``link_documents`` adds the registry row of document chunks, whose
    ``full_text`` comes with ``return_text`` only. ``prune`` passes over regions of the store that cannot hold a hit,
    where :func:`~vecloom.store.index_regions` has described them; hits are the same.
    """
    prepared = query_vectors(queries, encoder)
    items = store.items()
    passed = metadata.matches(equal_to, _TOP_LEVEL)
    scanned = metadata.matches(equal_to, _TOP_LEVEL, schemas.PROMOTED if store.has_layout else ())
    corpus = items.where(scanned) if equal_to and filter_mode == "pre" else items
    if store.head.dim is None:
        corpus, dim = corpus.limit(0), encoder.dim if encoder else 1
        prepared = prepared.limit(0)
    else:
        dim = store.head.dim
    pruner = None
    if prune and store.head.dim is not None and (known := store.regions()):
        rows = store.items_by_batch()
        pruner = Pruner(rows.where(scanned) if equal_to and filter_mode == "pre" else rows, *known)
    hits = top_k(corpus.select("vec_id", "embedding"), prepared, k, dim, pruner=pruner)
    small = hits.bounded_bytes is not None and hits.bounded_bytes <= HIT_BROADCAST_BYTES
    # The hits are written once: reading the result again does not score the corpus again.
    found = numbering.stage(hits.rows, "hits").read()
    wide = store.items_by_batch()
    ids = found.select("vec_id").distinct().limit(PRUNING_IDS + 1).toArrow()["vec_id"].to_numpy()
    if len(ids) <= PRUNING_IDS:
        wide = wide.where(near_ids(store, ids))
    described = wide.select("vec_id", "external_id", "text", "metadata").join(F.broadcast(found) if small else found, "vec_id")
    if equal_to and filter_mode == "post":
        described = described.where(passed)
    columns = ["query_id", "rank", "vec_id", "score", "external_id", "metadata"] + (["text"] if return_text else [])
    result = described.select(*columns)
    if link_documents:
        result = numbering.stage(result, "described-hits").read()
        wanted = result.select(F.col("metadata")["doc_ref"].alias("doc_id")).where("doc_id IS NOT NULL").distinct()
        few = wanted.count() <= LINKED_DOCUMENTS
        registry = store.documents() if return_text else store.documents().drop("full_text")
        registry = registry.join(F.broadcast(wanted) if few else wanted, "doc_id", "left_semi")
        registry = registry.select(F.struct(*registry.columns).alias("document"))
        linked = F.col("metadata")["doc_ref"] == F.col("document.doc_id")
        result = result.join(F.broadcast(registry) if few and not return_text else registry, linked, "left")
    return result


def search_one(
    store: VectorStore, text: str | None = None, vector: list[float] | None = None, k: int = C.DEFAULT_TOP_K, **options
) -> DataFrame:
    """Hits of a single query, best first."""
    query = store.spark.createDataFrame([(0, text, vector)], "query_id int, text string, vector array<float>")
    query = query.drop("vector") if vector is None else query.drop("text")
    return search(store, query, k, **options).orderBy("rank").drop("query_id", "rank")


def rendered(hits: DataFrame) -> DataFrame:
    """Hits as a result list shows them: score with four decimals, url, first characters of the text."""
    return hits.select(
        *[c for c in ("query_id", "rank") if c in hits.columns],
        T.shown_score(F.col("score")).alias("score"),
        F.coalesce(F.col("metadata")["url"], F.lit("")).alias("url"),
        T.snippet(F.col("text")).alias("snippet"),
    )
