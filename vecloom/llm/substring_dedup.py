"""Substring deduplication with FM-indexes: words of long passages that a document with a smaller id has go.

A passage is a window of ``WINDOW`` words. Its owner is the smallest doc_id that has it. Owners' windows are indexed in
FM-indexes, one per shard, and other documents are streamed through the shards that hold owners of their windows:
backward search gives the intervals that occur there, which are the words to remove. What leads to the shards:

1. Documents of equal word sequences are one class; beyond its smallest id they need no search.
2. Anchors: the smallest fingerprint of the 10-word runs in a window. Windows that are equal have equal anchors, so only
   stretches whose anchors occur in two classes can hold a repeated window.
3. Fingerprints of the windows in these stretches give each repeated window its owner, summed up before the shuffle.
   Windows owned by a document are consecutive words of it: its index pieces, in the shard of its id. Windows owned by
   others are its query pieces, routed to the owners' shards; pieces with equal words are searched once.

Equal texts go by equality; of the others the fingerprints select the windows and a search confirms them. The number of shards follows
from the number of repeated windows; the queries of a shard with many are salted and its index is sent to each salt.

Defined results: a null text has no words; rows without doc_id neither lose words nor make others lose them; rows that
share a doc_id are judged each on its own and never by one another; further columns are ignored.
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
from vecloom.llm.fm_index import FMIndex
from vecloom.llm.staging import small, staged

WINDOW = 50
ANCHOR = 10
SHARD_WINDOWS = 400_000
QUERY_WORDS = 4_000_000
PIECE_WINDOWS = 512
SEARCH_WORDS = 400_000


def joined_words(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: np.ndarray, keep: np.ndarray | None = None) -> list[bytes]:
    """The words of each text (those to ``keep``), joined by one space."""
    row = np.repeat(np.arange(len(words) - 1), np.diff(words))
    if keep is not None:
        starts, ends, row = starts[keep], ends[keep], row[keep]
    first = np.ones(len(row), bool)
    first[1:] = row[1:] != row[:-1]
    lead = (~first).astype(np.int64)
    sizes = ends - starts + lead
    begin = np.cumsum(sizes) - sizes
    out = np.full(int(sizes.sum()), 0x20, np.uint8)
    out[W.ranges(begin + lead, ends - starts)] = data[W.ranges(starts, ends - starts)]
    raw = out.tobytes()
    bounds = np.concatenate([[0], np.cumsum(np.bincount(row, weights=sizes, minlength=len(words) - 1).astype(np.int64))]).tolist()
    return [raw[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def _anchors(codes: np.ndarray, window: int, anchor: int) -> np.ndarray:
    """The anchor of every window."""
    if len(codes) < window:
        return np.zeros(0, np.int64)
    return _sliding_min((W.window_codes(codes, anchor) >> np.uint64(1)).astype(np.int64), window - anchor + 1)


def _parts(column: pa.Array):
    """Per slice of a text column: bytes, row offsets, word starts, ends, word offsets of the rows, fingerprints."""
    data, offsets = W.text_bytes(column)
    for a, b in W.row_slices(offsets):
        raw, bounds = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        starts, ends, words = W.split_words(raw, bounds, W.NOT_SPACE)
        yield a, raw, bounds, starts, ends, words, W.fingerprints(raw, starts, ends)


def _part(sha: str) -> int:
    return int(sha[:8], 16)


def _surveyed(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """doc_id, n_words, sha (of the joined words), part (tells rows of one doc_id apart), anchors (runs of equal ones once)."""
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("sha", T.StringType()),
        T.StructField("part", T.LongType()), T.StructField("anchors", T.ArrayType(T.LongType())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, shas, lists = [], [], []
            for _, raw, bounds, starts, ends, words, codes in _parts(batch.column(1)):
                shas += [hashlib.sha256(x).hexdigest() for x in joined_words(raw, bounds, starts, ends, words)]
                counts += np.diff(words).tolist()
                anchors = _anchors(codes, window, anchor)
                for i, j in zip(words[:-1].tolist(), words[1:].tolist(), strict=True):
                    own = anchors[i : max(i, j - window + 1)]
                    lists.append(own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own)
            edges = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
            values = np.concatenate(lists) if lists else np.zeros(0, np.int64)
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array([_part(s) for s in shas], pa.int64()), pa.ListArray.from_arrays(pa.array(edges), pa.array(values))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, part and text of the documents in ``ids``."""
    wanted = docs.select("doc_id", "text").join(small(ids), "doc_id", "left_semi")
    schema = T.StructType([docs.schema["doc_id"], T.StructField("part", T.LongType()), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [_part(hashlib.sha256(x).hexdigest()) for _, *p, _ in _parts(batch.column(1)) for x in joined_words(*p)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(parts, pa.int64()), batch.column(1)], names=schema.names)

    return wanted.mapInArrow(run, schema)


def _window_rows(texts: DataFrame, window: int, anchor: int) -> DataFrame:
    """(fp, doc_id, part, pos) of the windows of ``texts`` (doc_id, part, text, keys) whose anchor is in keys."""
    schema = T.StructType([T.StructField("fp", T.LongType()), texts.schema["doc_id"], T.StructField("part", T.LongType()), T.StructField("pos", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, values = batch.column(3).offsets.to_numpy(), batch.column(3).values.to_numpy()
            for a, _, _, _, _, words, codes in _parts(batch.column(2)):
                anchors, prints = _anchors(codes, window, anchor), W.window_codes(codes, window).view(np.int64)
                rows, at, fps = [], [], []
                for k, (i, j) in enumerate(zip(words[:-1].tolist(), words[1:].tolist(), strict=True)):
                    pos = np.flatnonzero(np.isin(anchors[i : max(i, j - window + 1)], values[keys[a + k] : keys[a + k + 1]]))
                    rows.append(np.full(len(pos), a + k))
                    at.append(pos)
                    fps.append(prints[i + pos])
                rows = pa.array(np.concatenate(rows))
                whole = pa.RecordBatch.from_arrays([pa.array(np.concatenate(fps)), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(np.concatenate(at).astype(np.int64))], names=schema.names)
                for start in range(0, whole.num_rows, 100_000):
                    yield whole.slice(start, 100_000)

    return texts.select("doc_id", "part", "text", "keys").mapInArrow(run, schema)


_PIECES = "shard long, role int, digest binary, doc_id bigint, part bigint, start bigint, n bigint, words binary"


def _pieces(texts: DataFrame, window: int) -> DataFrame:
    """Index (role 0) and query (role 1) pieces of ``texts`` (doc_id, part, text, owned: array of pos, owner, shard)."""
    names = [x.split()[0] for x in _PIECES.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.binary(), *[pa.int64()] * 4, pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            bounds, owned = batch.column(3).offsets.to_numpy(), batch.column(3).values
            pos, owner, shard = (owned.field(i).to_numpy() for i in range(3))
            for a, _, _, _, _, words, codes in _parts(batch.column(2)):
                rows = []
                for k in range(len(words) - 1):
                    lo, hi = bounds[a + k], bounds[a + k + 1]
                    order = lo + np.argsort(pos[lo:hi], kind="stable")
                    p, s, query = pos[order], shard[order], owner[order] != ids[a + k]
                    edge = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1] + 1) | (s[1:] != s[:-1]) | (query[1:] != query[:-1]), [True]])).tolist()
                    for x, y in zip(edge[:-1], edge[1:], strict=True):
                        for z in range(x, y, PIECE_WINDOWS) if query[x] else (x,):
                            stop = min(z + PIECE_WINDOWS, y) if query[x] else y
                            begin = words[k] + p[z]
                            raw = codes[begin : begin + stop - z + window - 1].tobytes()
                            digest = hashlib.blake2b(raw, digest_size=16).digest()
                            rows.append((int(s[z]), int(query[x]), digest, ids[a + k], parts[a + k], int(p[z]), len(raw) // 8, raw))
                for start in range(0, len(rows), 5000):
                    columns = zip(*rows[start : start + 5000], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return texts.select("doc_id", "part", "text", "owned").mapInArrow(run, _PIECES)


_FOUND = "shard long, digest binary, first bigint, length bigint, owner bigint"


def _search(rows: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Streams (shard, salt, role, digest, doc_id, words), ordered by shard, salt and role, through the shards' indexes."""
    names = [x.split()[0] for x in _FOUND.split(", ")]
    group, pieces, owners, index = None, [], [], None
    for batch in rows:
        shards, salts, roles = (batch.column(i).to_pylist() for i in range(3))
        ids = batch.column(4).to_pylist()
        raw = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(5)]
        queries: list[int] = []
        for i in range(batch.num_rows + 1):
            ends = i == batch.num_rows or (shards[i], salts[i]) != group
            if queries and (ends or sum(len(raw[q]) for q in queries[-1:]) + pending > SEARCH_WORDS):
                index = index or FMIndex(pieces)
                yield from _answers(index, owners, group[0], [raw[q] for q in queries], batch.column(3).take(pa.array(queries)), window, names)
                queries = []
            if i == batch.num_rows:
                break
            if ends:
                group, pieces, owners, index = (shards[i], salts[i]), [], [], None
            if roles[i]:
                pending = len(raw[i]) + (pending if queries else 0)
                queries.append(i)
            else:
                pieces.append(raw[i].copy())
                owners.append(ids[i])


def _answers(index: FMIndex, owners: list, shard: int, queries: list, digests: pa.Array, window: int, names: list) -> Iterator[pa.RecordBatch]:
    offsets = np.concatenate([[0], np.cumsum([len(q) for q in queries])])
    query, first, length, row = index.intervals(np.concatenate(queries), offsets, window)
    if len(query):
        piece, _ = index.locate(row)
        owner = np.array(owners, np.int64)[piece]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(query), shard)), digests.take(pa.array(query)), pa.array(first), pa.array(length), pa.array(owner)], names=names)


def _removed(texts: DataFrame) -> DataFrame:
    """doc_id, part, n_removed, kept_sha256 of ``texts`` (doc_id, part, text, gone: array of first, length)."""
    schema = T.StructType([
        T.StructField("id", texts.schema["doc_id"].dataType), T.StructField("of", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, gone = batch.column(3).offsets.to_numpy(), batch.column(3).values
            first, length = gone.field(0).to_numpy(), gone.field(1).to_numpy()
            counts, shas = [], []
            for a, raw, edges, starts, ends, words, _ in _parts(batch.column(2)):
                change = np.zeros(len(starts) + 1, np.int64)
                lo, hi = bounds[a], bounds[a + len(words) - 1]
                base = words[np.searchsorted(bounds[a : a + len(words)], np.arange(lo, hi), side="right") - 1]
                np.add.at(change, base + first[lo:hi], 1)
                np.add.at(change, base + first[lo:hi] + length[lo:hi], -1)
                covered = np.cumsum(change[:-1]) > 0
                counts += np.diff(np.concatenate([[0], np.cumsum(covered)])[words]).tolist()
                shas += [hashlib.sha256(x).hexdigest() for x in joined_words(raw, edges, starts, ends, words, ~covered)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(shas, pa.string())], names=schema.names)

    return texts.select("doc_id", "part", "text", "gone").mapInArrow(run, schema)


def repeated_intervals(docs: DataFrame, survey: DataFrame, window: int = WINDOW, anchor: int = ANCHOR):
    """(texts, intervals): texts searched (doc_id, part, text) and the intervals (doc_id, part, first, length) found in smaller ids."""
    classes = survey.where(f"n_words >= {window} AND doc_id IS NOT NULL").groupBy("sha").agg(F.min("doc_id").alias("rep"))
    classes = staged(classes.select(F.col("sha").alias("class"), "rep"), "word-classes")
    firsts = survey.join(classes, (F.col("sha") == F.col("class")) & (F.col("doc_id") == F.col("rep"))).select("doc_id", "part", F.explode("anchors").alias("key"))
    firsts = staged(firsts, "anchors")
    shared = firsts.groupBy("key").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).where("x < y").select("key")
    keyed = firsts.join(staged(shared, "shared-anchors"), "key").groupBy("doc_id", "part").agg(F.collect_set("key").alias("keys"))
    keyed = staged(keyed, "keyed-documents")

    texts = staged(_texts(docs, keyed.select("doc_id").distinct()), "texts")
    rows = staged(_window_rows(texts.join(keyed, ["doc_id", "part"]), window, anchor), "windows")
    owners = rows.groupBy("fp").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("y")).where("owner < y").select("fp", "owner")
    owners = staged(owners, "owners")
    shards = max(1, -(-owners.count() // SHARD_WINDOWS))
    shard = F.pmod(F.xxhash64("owner"), F.lit(shards))
    owned = rows.join(owners, "fp").groupBy("doc_id", "part").agg(F.collect_list(F.struct("pos", "owner", shard.alias("shard"))).alias("owned"))
    pieces = staged(_pieces(texts.join(owned, ["doc_id", "part"]), window), "pieces")

    asked = staged(pieces.where("role = 1").dropDuplicates(["shard", "digest"]).select("shard", "role", "digest", "doc_id", "n", "words"), "queries")
    salts = asked.groupBy("shard").agg(F.ceil(F.sum("n") / QUERY_WORDS).cast("long").alias("salts"))
    salts = small(staged(salts, "salts"))
    index = pieces.where("role = 0").join(salts, "shard").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    query = asked.join(salts, "shard").withColumn("salt", F.pmod(F.xxhash64("digest"), F.col("salts")))
    columns = ["shard", "salt", "role", "digest", "doc_id", "words"]
    groups = int(salts.agg(F.sum("salts")).first()[0] or 1)
    routed = index.select(columns).union(query.select(columns)).repartition(2 * groups, "shard", "salt")
    found = staged(routed.sortWithinPartitions("shard", "salt", "role", "digest").mapInArrow(lambda it: _search(it, window), _FOUND), "matches")

    members = pieces.where("role = 1").select("shard", "digest", "doc_id", "part", "start")
    hits = members.join(found, ["shard", "digest"]).where("owner < doc_id")
    return texts, classes, hits.select("doc_id", "part", (F.col("start") + F.col("first")).alias("first"), "length")


def substring_dedup(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space)."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    survey = staged(_surveyed(docs, window, anchor), "survey")
    texts, classes, hits = repeated_intervals(docs, survey, window, anchor)
    gone = hits.groupBy("doc_id", "part").agg(F.collect_list(F.struct("first", "length")).alias("gone"))
    changed = staged(_removed(texts.join(gone, ["doc_id", "part"])), "changed").dropDuplicates(["id", "of"])
    nothing = hashlib.sha256(b"").hexdigest()
    out = survey.select("doc_id", "n_words", "sha", "part").join(classes, F.col("sha") == F.col("class"), "left")
    out = out.join(changed, (F.col("doc_id") == F.col("id")) & (F.col("part") == F.col("of")) & F.col("doc_id").isNotNull(), "left")
    copy = F.col("rep") < F.col("doc_id")
    return out.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )


def op10_fm_substring_dedup(spark, sf_dir):
    return substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
  s AS MATERIALIZED (SELECT r, doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS g FROM
      (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d WHERE len(w) >= 50)),
  o AS (SELECT g, min(doc_id) AS owner FROM s GROUP BY g HAVING min(doc_id) < max(doc_id)),
  c AS (SELECT DISTINCT r, unnest(range(p, p + 50)) AS q FROM s JOIN o USING (g) WHERE owner < doc_id),
  k AS (SELECT r, list(q) AS gone FROM c GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed, sha256(coalesce(array_to_string(
  CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""
