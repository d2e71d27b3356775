"""Token ids as length-delimited binary records with an offset index.

A record is: length of the body (8 bytes), masked CRC-32 of those bytes (4), the body, masked CRC-32 of the body (4) and
a line feed; all numbers little-endian. The body is one byte that says whether there is a doc_id, the doc_id (8), the
width of an id in bytes (1) and the ids. A checksum c is masked as rotate_right(c, 15) + 0xA282EAD8, so that a checksum
stored among checksummed data does no harm. The line feed is what Spark's text sink writes behind a row, so the files
come from a plain Spark write of ordered rows.

Documents are ordered by doc_id with a range partitioning; files are cut after a number of records that follows from
their mean size. The index, one Parquet row per record, holds file, record, offset, length, doc_id, start (tokens of all
documents before it), n_tokens and the CRC-32 of the ids; a shuffled reader needs a row of it and one ranged read.

With a tokenizer that cuts texts into words as ``WORDS`` says, no token holds white space or spans the end of a word and a
sign, so each distinct run is encoded once per worker and the ids of a text are those of its runs. Capitals are only lowered in runs
of pure ASCII, as others are composed before they are lowered. Runs of nothing but ``LETTERS`` are one word that composing
leaves as it is; they go to the tokenizer's model as such, without its normalizer and its patterns, which take longer than the model.
Where the memory of runs is full, those met in the fewest slices of text are forgotten. With any other tokenizer whole texts are encoded.
Tests compare both.

Defined results: a null text is the empty text (its record holds the end id only); rows without doc_id come first; rows
that share a doc_id are ordered by a hash of the text; further columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vecloom.llm import words as W
from vecloom.llm.staging import small, staged
from vecloom.session import new_folder

END_ID = 2
FILE_BYTES = 16 << 20
CACHE_RUNS = 200_000
CACHE_IDS = 4 << 20
#: What is left of both when one has become too large.
KEPT = 0.75
RUNS_AT_ONCE = 2000
OUT_BYTES = 1 << 20
SEPARATOR = "<|startoftext|>"
TEXTS_AT_ONCE = 64
#: Fixed value: the words of tokenizers whose texts may be cut into runs.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Latin and Cyrillic letters that are composed, and lowered to one letter of the same kind wherever they stand.
LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f\u0400-\u045f]+")
WORD_END = "</w>"
#: The characters that stand for the bytes of letters in the vocabularies of byte-level models, and the space.
_BYTE_LEVEL = np.arange(256, dtype="<u4")
_BYTE_LEVEL[0x80:0xA1] += 0x122 - 0x80
_BYTE_LEVEL[0xAD] = 0x143
_SIGN = np.zeros(256, bool)
_SIGN[0x21:0x30] = _SIGN[0x3A:0x41] = _SIGN[0x5B:0x61] = _SIGN[0x7B:0x7F] = True
_LETTER = W.ALNUM & (np.arange(256) < 0x80)
_HEAD = struct.Struct("<QI")
_BODY = struct.Struct("<?qB")
_INDEX = "file string, record bigint, offset bigint, length bigint, doc_id bigint, in_file bigint, n_tokens bigint, ids_crc32 bigint"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray) -> bytes:
    """The record without its line feed. ``ids``: uint16 or uint32."""
    body = _BODY.pack(doc_id is not None, doc_id or 0, ids.itemsize) + ids.astype(ids.dtype.newbyteorder("<")).tobytes()
    size = struct.pack("<Q", len(body))
    return size + struct.pack("<I", masked(size)) + body + struct.pack("<I", masked(body))


def frames(content: bytes) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """Offset, length, doc_id and ids of every record of a file; a damaged one is an error."""
    at = 0
    while at < len(content):
        size, check = _HEAD.unpack_from(content, at)
        body = content[at + _HEAD.size : at + _HEAD.size + size]
        end = at + _HEAD.size + size + 4
        if check != masked(content[at : at + 8]) or content[end - 4 : end + 1] != struct.pack("<I", masked(body)) + b"\n":
            raise ValueError(f"damaged record at byte {at}")
        named, doc_id, width = _BODY.unpack_from(body)
        yield at, end + 1 - at, doc_id if named else None, np.frombuffer(body, f"<u{width}", offset=_BODY.size)
        at = end + 1


def cuts_into_words(settings: dict) -> bool:
    """Whether a tokenizer composes characters, lowers them and takes the words of ``WORDS``, each on its own."""
    normal, split = settings.get("normalizer") or {}, settings.get("pre_tokenizer") or {}
    steps = normal.get("normalizers", [normal])
    spaces = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    words = {"type": "Split", "pattern": {"Regex": WORDS}, "behavior": "Removed", "invert": True}
    parts = split.get("pretokenizers", [])
    return (
        [x.get("type") for x in steps if x != spaces] == ["NFC", "Lowercase"]
        and len(parts) == 2 and parts[0] == words
        and parts[1].get("type") == "ByteLevel" and not parts[1].get("add_prefix_space") and not parts[1].get("use_regex")
        and not settings["model"].get("dropout") and not settings.get("truncation") and not settings.get("padding")
    )


def byte_level(data: bytes) -> str:
    return _BYTE_LEVEL[np.frombuffer(data, np.uint8)].tobytes().decode("utf-32-le")


def words_at_once(tokenizer, settings: dict):
    """A tokenizer with the model of the given one that takes words of ``LETTERS``, in lower case and as byte-level characters, with spaces
    between them, and which of its ids end a word; None if the model does not mark the ends of all such words, or a special token might
    stand in one."""
    from tokenizers import Tokenizer, pre_tokenizers

    vocabulary = settings["model"].get("vocab") or {}
    letters = byte_level(bytes([*range(0x61, 0x7B), *range(0x80, 0x100)]))
    if (
        settings["model"].get("type") != "BPE"
        or settings["model"].get("end_of_word_suffix") != WORD_END
        or not all(c in vocabulary and c + WORD_END in vocabulary for c in letters)
        or not all(x["content"].startswith("<|") for x in settings.get("added_tokens") or [])
    ):
        return None
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
    plain = Tokenizer(tokenizer.model)
    plain.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
    return plain, ends


class Encoder:
    """Encodes texts run by run, with a bounded memory of runs seen before, or whole where runs are not shown to be enough."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, "rb") as file:
            settings = json.load(file)
        self.by_runs = cuts_into_words(settings)
        self.plain = words_at_once(self.tokenizer, settings) if self.by_runs else None
        self.kind = np.uint16 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.uint32
        self.gap = SEPARATOR if self.tokenizer.token_to_id(SEPARATOR) is not None else None
        self._forget()

    def _forget(self) -> None:
        self.codes, self.lengths, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, self.kind)
        self.met = np.zeros(0, np.int32)

    def _encode_some(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and ids."""
        texts = [r.decode("utf-8", "replace") for r in runs]
        if self.plain is None:
            return self._encode_any(texts)
        plain = np.fromiter((LETTERS.fullmatch(t) is not None for t in texts), bool, len(texts))
        if plain.all():
            return self._encode_words(texts)
        words = self._encode_words([t for t, p in zip(texts, plain, strict=True) if p])
        others = self._encode_any([t for t, p in zip(texts, plain, strict=True) if not p])
        sizes = np.zeros(len(texts), np.int64)
        sizes[plain], sizes[~plain] = words[0], others[0]
        of_words = np.repeat(plain, sizes)
        ids = np.zeros(len(of_words), self.kind)
        ids[of_words], ids[~of_words] = words[1], others[1]
        return sizes, ids

    def _encode_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of words of ``LETTERS``. The model marks where each of them ends."""
        if not texts:
            return np.zeros(0, np.int64), np.zeros(0, self.kind)
        tokenizer, ends = self.plain
        line = byte_level(" ".join(texts).lower().encode())
        ids = np.array(tokenizer.encode_batch_fast([line], add_special_tokens=False)[0].ids, self.kind)
        sizes = np.diff(np.flatnonzero(ends[ids]), prepend=-1)
        if len(sizes) != len(texts):
            raise ValueError(f"{len(texts)} words, {len(sizes)} ends")
        return sizes, ids

    def _encode_any(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of any runs. They are joined by a special token, at which the tokenizer starts afresh."""
        if self.gap is None or any("<|" in t for t in texts):
            ids = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            return np.fromiter(map(len, ids), np.int64, len(ids)), np.fromiter((i for x in ids for i in x), self.kind)
        ids = np.array(self.tokenizer.encode_batch_fast([self.gap.join([*texts, ""])], add_special_tokens=False)[0].ids, np.int64)
        ends = np.flatnonzero(ids == self.tokenizer.token_to_id(self.gap))
        return np.diff(ends, prepend=-1) - 1, np.delete(ids, ends).astype(self.kind)

    def _known(self, codes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Length and place in the returned ids of the distinct runs with the given sorted fingerprints."""
        place = np.searchsorted(self.codes, codes)
        fresh = np.ones(len(codes), bool)
        within = place < len(self.codes)
        fresh[within] = self.codes[place[within]] != codes[within]
        self.met[place[~fresh]] += 1
        raw = data.tobytes()
        runs = [raw[a:b] for a, b in zip(starts[fresh].tolist(), ends[fresh].tolist(), strict=True)]
        parts = [self._encode_some(runs[i : i + RUNS_AT_ONCE]) for i in range(0, len(runs), RUNS_AT_ONCE)]
        merged = np.concatenate([self.codes, codes[fresh]])
        sizes = np.concatenate([self.lengths, *(p[0] for p in parts)])
        begin = np.cumsum(sizes) - sizes
        order = np.argsort(merged, kind="stable")
        every = np.concatenate([self.ids, *(p[1] for p in parts)])
        wanted = order[np.searchsorted(merged[order], codes)]
        met = np.concatenate([self.met, np.ones(len(runs), np.int32)])
        if len(order) > CACHE_RUNS or len(every) > CACHE_IDS:
            latest = np.zeros(len(order), np.int32)
            latest[wanted] = 1
            best = np.argsort(-(2 * met + latest)[order], kind="stable")[: int(KEPT * CACHE_RUNS)]
            best = best[np.cumsum(sizes[order][best]) <= KEPT * CACHE_IDS]
            order = order[np.sort(best)]
            met //= 2
        self.codes, self.lengths, self.met = merged[order], sizes[order], met[order]
        self.ids = every[W.ranges(begin[order], sizes[order])]
        return sizes[wanted], begin[wanted], every

    def __call__(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of every row."""
        if not self.by_runs:
            for at in range(0, len(column), TEXTS_AT_ONCE):
                texts = [x or "" for x in column.slice(at, TEXTS_AT_ONCE).to_pylist()]
                for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
                    yield np.array(x.ids, self.kind)
            return
        data, offsets = W.text_bytes(column)
        for a, b in W.row_slices(offsets):
            raw, bounds = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            low, starts, ends, words = runs_of(raw, bounds)
            codes, first, inverse = np.unique(W.fingerprints(low, starts, ends), return_index=True, return_inverse=True)
            lengths, begin, every = self._known(codes, low, starts[first], ends[first])
            sizes = lengths[inverse]
            flat = every[W.ranges(begin[inverse], sizes)]
            edges = np.concatenate([[0], np.cumsum(sizes)])[words].tolist()
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                yield flat[i:j]


@lru_cache(maxsize=1)
def worker_encoder(path: str) -> Encoder:
    """One tokenizer for all tasks of a worker; loading it leaves more behind than it holds."""
    return Encoder(path)


def runs_of(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with pure ASCII runs in lower case, and start, end and row offsets of the runs that are encoded on their own.

    A text is cut at white space, and before an ASCII sign that follows an ASCII letter or digit or a letter of
    Latin-1: there a token always ends, and no character is composed over the cut. Upper and lower case of ASCII letters have the same
    ids, unless a mark follows with which only one of them composes. Neither is done to runs with ``<|``, with which special tokens begin.
    """
    starts, ends, _ = W.split_words(raw, bounds, W.NOT_SPACE)
    low = W.LOWER[raw]
    if len(raw) > 1:
        before = raw[:-1]
        letter = _LETTER[before]
        letter[1:] |= (before[1:] >= 0x80) & (before[1:] != 0x97) & (before[1:] != 0xB7) & (raw[:-2] == 0xC3)
        cut = np.flatnonzero(_SIGN[raw[1:]] & letter) + 1
        special = np.flatnonzero((raw[:-1] == 0x3C) & (raw[1:] == 0x7C))
        if len(special):
            held = np.unique(np.searchsorted(starts, special, side="right") - 1)
            word = np.searchsorted(starts, cut, side="right") - 1
            cut = cut[~np.isin(word, held)]
            inside = W.ranges(starts[held], (ends - starts)[held])
            low[inside] = raw[inside]
        cut = cut[~np.isin(cut, starts)]
        starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
        beyond = np.flatnonzero(raw >= 0x80)
        mixed = np.unique(np.searchsorted(starts, beyond, side="right") - 1)
        inside = W.ranges(starts[mixed], (ends - starts)[mixed])
        low[inside] = raw[inside]
    return low, starts, ends, np.searchsorted(starts, bounds)


def write_records(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> None:
    """Write one record per document (doc_id, text) below ``path``, in ascending order of doc_id over the sorted files."""
    vocabulary = tokenizer or default_tokenizer()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    mean = docs.agg(F.avg(F.coalesce(F.octet_length("text"), F.lit(0)))).first()[0] or 0
    ordered = rows.repartitionByRange(F.asc_nulls_first("doc_id"), "h").sortWithinPartitions(F.asc_nulls_first("doc_id"), "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(vocabulary)
        last = np.array([end_id], encoder.kind)
        for batch in batches:
            records, size = [], 0
            for i, x in zip(batch.column(0).to_pylist(), encoder(batch.column(1)), strict=True):
                records.append(frame(i, np.concatenate([x, last])))
                size += len(records[-1])
                if size >= OUT_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], names=["record"])
                    records, size = [], 0
            if records:
                yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], names=["record"])

    records = ordered.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
    records.write.option("lineSep", "\n").option("maxRecordsPerFile", max(1, int(file_bytes // (mean + 32)))).text(path)


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in _INDEX.split(", ")]
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            rows, before = [], 0
            for k, (at, length, doc_id, ids) in enumerate(frames(content.as_py())):
                rows.append((path.rsplit("/", 1)[-1], k, at, length, doc_id, before, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                before += len(ids)
            if rows:
                columns = [pa.array(c, pa.string() if i == 0 else pa.int64()) for i, c in enumerate(zip(*rows, strict=True))]
                yield pa.RecordBatch.from_arrays(columns, names=names)


def build_index(spark: SparkSession, path: str, index_path: str) -> DataFrame:
    """Read all records back, check them, and write the index: see the module's text for its columns."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0")
    found = staged(files.select("path", "content").mapInArrow(_index_rows, _INDEX), "records")
    part, cut = (F.regexp_extract("file", r"^part-(\d+)-.*-c(\d+)", i).cast("bigint") for i in (1, 2))
    totals = found.groupBy("file").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy(part, cut).rowsBetween(Window.unboundedPreceding, -1)
    totals = staged(totals.select(F.col("file").alias("of"), F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("before")), "file-starts")
    index = found.join(small(totals), F.col("file") == F.col("of"))
    index.select(
        "file", "record", "offset", "length", "doc_id", (F.col("before") + F.col("in_file")).alias("start"), "n_tokens", "ids_crc32"
    ).write.parquet(index_path)
    return spark.read.parquet(index_path)


def op8_token_records(spark, sf_dir):
    path = new_folder(spark, "token-records")
    write_records(spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{path}/data")
    return build_index(spark, f"{path}/data", f"{path}/index").select("doc_id", "start", "n_tokens", "ids_crc32")
