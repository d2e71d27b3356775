"""Benchmark decontamination with suffix arrays.

Documents are cut into shards of bounded size. Each shard's words are put into a suffix array and every suffix of every
benchmark item is binary-searched in it, which yields the longest verbatim match of the suffix and all places of the
window of 13 words that starts there. No row is shuffled: a document lies in one shard, so its hits are complete there.
Hits need no more than a window of each suffix, so texts and items of any length are judged in linear time;
:func:`longest_matches` follows every suffix to the end of its match.

The benchmark is a stated query set. It is sent to the tasks in blocks of at most ``BLOCK_BYTES`` of text, of which the
driver and each task hold one at a time, so it may grow beyond one task's memory.

Defined results: a null text has no words and no hits; an item without words is never found; a null item_id is named
``null``; rows that repeat are judged each on their own; further columns of either table are ignored or passed through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.llm import words as W
from vecloom.llm.suffixes import search, suffix_array

WINDOW = 13
SHARE = 20  # contaminated when SHARE * hit words >= words
SHARD_BYTES = 2 << 20
BLOCK_BYTES = 16 << 20


class Block:
    """Items of a benchmark block, equal word sequences kept once."""

    def __init__(self, rows: list, window: int):
        codes, offsets = W.word_codes(pa.array([r["text"] for r in rows], pa.string()), W.ALNUM, True)
        classes: dict[bytes, list[int]] = {}
        for i in range(len(rows)):
            if offsets[i + 1] > offsets[i]:
                classes.setdefault(codes[offsets[i] : offsets[i + 1]].tobytes(), []).append(i)
        names = ["null" if r["item_id"] is None else str(r["item_id"]) for r in rows]
        self.names = [sorted({names[i] for i in members}) for members in classes.values()]
        lengths = np.array([len(key) // 8 for key in classes], np.int64)
        self.codes = np.frombuffer(b"".join(classes), np.uint64)
        self.item, inside = W.spans(lengths)
        self.starts = np.arange(len(self.codes))
        self.left = lengths[self.item] - inside
        self.stop = np.minimum(window, lengths[self.item])
        self.depth = int(lengths.max(initial=1))


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> tuple[list, int]:
    """The broadcast blocks and the words of the longest item; the driver never reads a block back, which would keep it."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where(F.col("text").isNotNull())
    size = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = -(-size // block_bytes) or 1
    parts = (rows if n == 1 else rows.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k) for k in range(n))
    blocks, depth = [], 1
    for part in parts:
        block = Block(part.collect(), window)
        depth = max(depth, block.depth)
        blocks.append(spark.sparkContext.broadcast(block))
        del block
    return blocks, depth


def _held(blocks: list) -> Iterator[Block]:
    """One block after the other; only a single block stays in the worker's memory."""
    for b in blocks:
        yield b.value
        if len(blocks) > 1:
            b.__dict__.pop("_value", None)


class Shard:
    """Suffix array of consecutive documents, a code of 0 behind each of them."""

    def __init__(self, codes: np.ndarray, offsets: np.ndarray, depth: int):
        counts = np.diff(offsets)
        n = len(counts)
        self.doc = np.repeat(np.arange(n), counts + 1)
        self.begin = offsets[:-1] + np.arange(n)
        self.codes = np.zeros(len(codes) + n, np.uint64)
        self.codes[np.arange(len(codes)) + np.repeat(np.arange(n), counts)] = codes
        self.counts = counts
        self.order = suffix_array(self.codes, depth)

    def find(self, block: Block, whole: bool):
        """Every suffix of the block's items, to its end if ``whole``, else to the end of the window it begins with."""
        return search(self.order, self.codes, block.codes, block.starts, block.left if whole else np.minimum(block.left, block.stop), block.stop)


def _shards(column: pa.Array, depth: int, shard_bytes: int) -> Iterator[Shard]:
    data, offsets = W.text_bytes(column)
    for a, b in W.row_slices(offsets, shard_bytes):
        yield Shard(*W.word_codes(column.slice(a, b - a), W.ALNUM, True), depth)


def _judge(column: pa.Array, blocks: list, depth: int, shard_bytes: int) -> dict[str, list]:
    out: dict[str, list] = {"n_words": [], "n_hit": [], "items": []}
    for shard in _shards(column, depth, shard_bytes):
        edges = np.zeros(len(shard.codes) + 1, np.int64)
        items: dict[int, list[str]] = {}
        for block in _held(blocks):
            if not len(block.codes):
                continue
            _, _, _, (lo, hi) = shard.find(block, False)
            live = np.flatnonzero(hi > lo)
            windows, owner = np.unique(np.stack([lo[live], hi[live], block.stop[live]]), axis=1, return_inverse=True)
            owner = owner.reshape(-1)
            sizes = windows[1] - windows[0]
            places = shard.order[W.ranges(windows[0], sizes)]
            of, _ = W.spans(sizes)
            np.add.at(edges, places, 1)
            np.subtract.at(edges, places + windows[2][of], 1)
            pairs = np.unique(np.stack([of, shard.doc[places]]), axis=1)
            uses = np.unique(np.stack([owner, block.item[live]]), axis=1)  # window, item: ordered by window
            first = np.searchsorted(uses[0], pairs[0])
            many = np.searchsorted(uses[0], pairs[0], side="right") - first
            hit = np.unique(np.stack([np.repeat(pairs[1], many), uses[1][W.ranges(first, many)]]), axis=1)
            for doc, item in hit.T.tolist():
                items.setdefault(doc, []).extend(block.names[item])
        covered = np.cumsum(edges[:-1]) > 0
        n = len(shard.counts)
        out["n_hit"].append(np.bincount(shard.doc[covered], minlength=n)[:n])
        out["n_words"].append(shard.counts)
        out["items"].extend(sorted(set(items[i])) if i in items else [] for i in range(n))
    for key in ("n_words", "n_hit"):
        out[key] = np.concatenate(out[key]) if out[key] else np.zeros(0, np.int64)
    return out


def _contaminated(n_words: np.ndarray, n_hit: np.ndarray, share: int) -> np.ndarray:
    return (n_hit > 0) & (share * n_hit >= n_words)


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (ids of the items found, as strings), n_items, items_sha256, contaminated."""
    blocks, depth = _blocks(benchmark, window, block_bytes)
    depth = min(depth, window)
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [T.StructField("doc_id", kind)]
        + [T.StructField(name, T.LongType()) for name in ("n_words", "n_hit", "n_items")]
        + [T.StructField("items", T.ArrayType(T.StringType())), T.StructField("items_sha256", T.StringType())]
        + [T.StructField("contaminated", T.BooleanType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = _judge(batch.column(1), blocks, depth, shard_bytes)
            digests = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in got["items"]]
            bad = _contaminated(got["n_words"], got["n_hit"], share)
            lists = pa.array(got["items"], pa.list_(pa.string()))
            columns = [batch.column(0), pa.array(got["n_words"]), pa.array(got["n_hit"]), pa.array([len(x) for x in got["items"]], pa.int64()), lists, pa.array(digests, pa.string()), pa.array(bad)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(W.tidy(run), schema)


def remove_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    blocks, depth = _blocks(benchmark, window, block_bytes)
    depth = min(depth, window)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = _judge(batch.column(place), blocks, depth, shard_bytes)
            yield batch.filter(pa.array(~_contaminated(got["n_words"], got["n_hit"], share)))

    return docs.mapInArrow(W.tidy(run), docs.schema)


def longest_matches(docs: DataFrame, benchmark: DataFrame, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per item the longest verbatim match over all documents: item_id, n_matched, item_word, doc_id, doc_word.

    Items of equal words share a row per id. Items of which no word occurs are absent. Ties go to the smaller doc_id,
    then to the earlier place in the document.
    """
    blocks, depth = _blocks(benchmark, WINDOW, block_bytes)
    schema = "item_id string, n_matched bigint, item_word bigint, doc_id bigint, doc_word bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.array([np.iinfo(np.int64).max if x is None else x for x in batch.column(0).to_pylist()], np.int64)
            row = 0
            for shard in _shards(batch.column(1), depth, shard_bytes):
                rows = []
                for block in _held(blocks):
                    best, lo, hi, _ = shard.find(block, True) if len(block.codes) else (np.zeros(0, np.int64),) * 4
                    order = np.lexsort((block.starts, -best, block.item))
                    top = order[np.unique(block.item[order], return_index=True)[1]]
                    for s in top[best[top] > 0].tolist():
                        places = shard.order[lo[s] : hi[s]]
                        at = places[np.lexsort((places, ids[row + shard.doc[places]]))[0]]
                        doc = shard.doc[at]
                        inside = int(s - np.searchsorted(block.item, block.item[s]))
                        rows += [(name, int(best[s]), inside, int(ids[row + doc]), int(at - shard.begin[doc])) for name in block.names[block.item[s]]]
                row += len(shard.counts)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["item_id", "n_matched", "item_word", "doc_id", "doc_word"])

    found = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(W.tidy(run), schema)
    order = F.struct((-F.col("n_matched")).alias("a"), "doc_id", "doc_word", "item_word")
    best = found.groupBy("item_id").agg(F.min(order).alias("m"))
    return best.select("item_id", (-F.col("m.a")).alias("n_matched"), "m.item_word", "m.doc_id", "m.doc_word")


def op1_suffix_decontamination(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
  b AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
  bw AS (SELECT DISTINCT item, n, array_to_string(w[p:p + n - 1], ' ') AS win FROM
      (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM (SELECT item, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0))),
  lens AS (SELECT DISTINCT n FROM bw),
  dw AS (SELECT r, p, n, array_to_string(w[p:p + n - 1], ' ') AS win FROM
      (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, lens WHERE len(w) >= n)),
  hits AS (SELECT r, p, n, item FROM dw JOIN bw USING (n, win)),
  cov AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT r, p, n FROM hits)) GROUP BY r),
  its AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cov USING (r) LEFT JOIN its USING (r)
"""
