"""Secret scan: fixed patterns, and a linear-chain conditional random field that adds what they miss.

Texts are cut into tokens (runs of letters, digits and ``+/_-``, and runs of other signs). The field tags each token as
secret begin, inside or outside. Its features are the token's shape (character classes, length, changes of class), its
own form and those of its neighbours, whether white space precedes, and file features (share of signs and of digits).
Tags are decoded by Viterbi. Most tokens are so clearly outside that no neighbourhood can change it; they cut the chain
exactly, and Viterbi runs over what lies between them.

The field is fitted by gradient steps on the likelihood of a bounded sample: the ``TRAIN_ROWS`` documents with a pattern
match that have the smallest hashes in the whole table, and as many without one from a slice by hash of about
``TRAIN_SLICE`` rows. Of texts over ``TRAIN_BYTES`` bytes a window of that size is used, around the first match or at a
place given by the hash; its file features are those of the window. The values of pattern matches are its secrets.
Scanning reads whole texts.

Spans are kind:start:end in code points, end exclusive; kinds are assign, access, hex (the patterns, whose spans always
stay) and crf (runs of secret tokens that overlap no pattern span). Defined results: a null text is the empty text and
has no span; without a match in the table there is no field and no crf span; columns other than doc_id and text are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.llm import words as W

KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
#: What every text with a match contains, for a fast test of whole columns.
_HINTS = (r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]", "AKIA[A-Z0-9]{12}", "[0-9a-f]{32}")

TRAIN_ROWS = 200
TRAIN_BYTES = 20_000
TRAIN_SLICE = 20_000
WINDOW = 128
STEPS, RATE, DECAY = 60, 0.15, 1e-4
FORMS = 4096
BEGIN, INSIDE, OUTSIDE = 0, 1, 2

_WORD = W.ALNUM.copy()
_WORD[list(b"+/_-")] = True
_KIND = np.where(W.SPACE, 0, np.where(_WORD, 1, 2)).astype(np.uint8)
_CLASS = np.zeros(256, np.uint8)  # lower, upper, digit, other ASCII, beyond ASCII
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[0x21:0x30] = 1, 2, 4, 8
_CLASS[0x3A:0x41] = _CLASS[0x5B:0x61] = _CLASS[0x7B:0x80] = 8
_CLASS[0x80:] = 16
_LENGTHS = np.array([2, 4, 8, 12, 16, 24, 32, 40])
_SHAPES = 32 * (len(_LENGTHS) + 1)
_CHANGES = np.array([1, 2, 4, 8])
_SHARES = np.array([0.02, 0.1, 0.25])
_FILES = (len(_SHARES) + 1) ** 2
_SIZES = (1, _SHAPES, _SHAPES, _SHAPES, FORMS, FORMS, FORMS, FORMS, 4 * (len(_CHANGES) + 1), 2 * _FILES, 2 * _SHAPES)
_STARTS = np.concatenate([[0], np.cumsum(_SIZES)])


def pattern_spans(raw: bytes) -> list[tuple[int, int, int, int]]:
    """(start, end, kind, start of the value) of all pattern matches, in bytes, by start and kind."""
    found = [(m.start(), m.end(), 0, m.start(2)) for m in ASSIGN.finditer(raw) if m.end(2) - m.start(2) >= LEAST_VALUE]
    found += [(m.start(), m.end(), 1, m.start()) for m in ACCESS.finditer(raw) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), m.end(), 2, m.start()) for m in HEX.finditer(raw) if m.end() - m.start() >= LEAST_HEX]
    return sorted(found, key=lambda s: (s[0], s[2]))


def may_match(column: pa.Array) -> np.ndarray:
    """Rows that may hold a pattern match; all that do are among them."""
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    found = np.zeros(len(column), bool)
    for hint in _HINTS:
        found |= np.array(pc.match_substring_regex(column, hint).fill_null(False), bool)
    return found


class Tokens:
    """Tokens of several texts and their features."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        kind = _KIND[data]
        first = np.zeros(len(data), bool)
        if len(data):
            first[0] = True
            first[1:] = kind[1:] != kind[:-1]
            first[offsets[:-1][np.diff(offsets) > 0]] = True
        edge = np.flatnonzero(first)
        stop = np.append(edge[1:], len(data))
        real = kind[edge] > 0
        self.starts, self.ends = edge[real], stop[real]
        self.rows = np.searchsorted(self.starts, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.rows))
        self.n = len(self.starts)
        if self.n:
            self._describe(data, offsets)
        else:
            self.features = np.zeros((len(_SIZES), 0), np.int64)

    def _describe(self, data: np.ndarray, offsets: np.ndarray) -> None:
        classes = _CLASS[data]
        length = self.ends - self.starts
        shape = np.bitwise_or.reduceat(classes, self.starts).astype(np.int64)
        change = np.zeros(len(data), np.int32)
        change[1:] = (classes[1:] != classes[:-1]) & (classes[1:] > 0) & (classes[:-1] > 0)
        change[self.starts] = 0
        changes = np.add.reduceat(change, self.starts)
        long = length >= 8
        shape = shape * (len(_LENGTHS) + 1) + np.searchsorted(_LENGTHS, length, side="right")
        form = (W.fingerprints(W.LOWER[data], self.starts, self.ends) % np.uint64(FORMS)).astype(np.int64)
        spaced = np.ones(self.n, np.int64)
        spaced[1:] = self.starts[1:] > self.ends[:-1]
        text_bytes = np.maximum(np.diff(offsets), 1)
        shares = []
        for flag in (8, 4):
            sums = np.concatenate([[0], np.cumsum(classes == flag)])[offsets]
            shares.append(np.searchsorted(_SHARES, np.diff(sums) / text_bytes, side="right"))
        file = (shares[0] * (len(_SHARES) + 1) + shares[1])[self.doc]

        def near(values: np.ndarray, step: int, none: int) -> np.ndarray:
            """The value ``step`` tokens on, or ``none`` beyond the text."""
            out = np.full(self.n, none)
            a, b = (slice(None, -step), slice(step, None)) if step > 0 else (slice(-step, None), slice(None, step))
            same = self.doc[a] == self.doc[b]
            out[a][same] = values[b][same]
            return out

        rows = (
            np.zeros(self.n, np.int64), shape, near(shape, -1, 0), near(shape, 1, 0), form, near(form, -1, 0), near(form, 1, 0),
            near(form, -2, 0), (long * 2 + spaced) * (len(_CHANGES) + 1) + np.searchsorted(_CHANGES, changes, side="right"),
            long * _FILES + file, spaced * _SHAPES + shape,
        )
        self.features = np.stack(rows) + _STARTS[:-1, None]


class Field:
    """Weights of the conditional random field: [feature, tag] and [tag, next tag]."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights = weights
        self.moves = moves.copy()
        self.moves[OUTSIDE, INSIDE] = -np.inf
        allowed = [(a, y, b) for a in range(3) for y in (BEGIN, INSIDE) for b in range(3) if (a, y) != (OUTSIDE, INSIDE)]
        again = max(self.moves[INSIDE] - self.moves[BEGIN])  # the token behind a new begin
        worth = [self.moves[a, y] + self.moves[y, b] - self.moves[a, OUTSIDE] - self.moves[OUTSIDE, BEGIN if b == INSIDE else b] + (max(again, 0) if b == INSIDE else 0) for a, y, b in allowed]
        self.worth = max(worth)

    def emissions(self, tokens: Tokens) -> np.ndarray:
        out = np.zeros((tokens.n, 3))
        for row in tokens.features:
            out += self.weights[row]
        return out

    def secret(self, tokens: Tokens) -> np.ndarray:
        """The Viterbi tag of every token; texts are chains of their own, outside before and after."""
        tags = np.full(tokens.n, OUTSIDE)
        if not tokens.n:
            return tags
        e = self.emissions(tokens)
        # making a token outside, and the next one a begin if it was inside, costs no more than this
        following = np.append(np.maximum(e[1:, INSIDE] - e[1:, BEGIN], 0), 0)
        open_ = e[:, OUTSIDE] - e[:, :2].max(axis=1) <= self.worth + following
        at = np.flatnonzero(open_)
        if not len(at):
            return tags
        begin = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (tokens.doc[at[1:]] != tokens.doc[at[:-1]])])
        runs = at[begin]
        lengths = np.diff(np.append(np.flatnonzero(begin), len(at)))
        order = np.argsort(-lengths, kind="stable")
        runs, lengths = runs[order], lengths[order]
        score = np.full((len(runs), 3), -np.inf)
        score[:, OUTSIDE] = 0
        back = []
        for t in range(int(lengths[0])):
            live = int(np.searchsorted(-lengths, -t, side="left"))
            options = score[:live, :, None] + self.moves[None]
            best = options.argmax(axis=1)
            back.append(best)
            score[:live] = np.take_along_axis(options, best[:, None], axis=1)[:, 0] + e[runs[:live] + t]
        tag = (score + self.moves[:, OUTSIDE]).argmax(axis=1)
        for t in range(int(lengths[0]) - 1, -1, -1):
            live = len(back[t])
            tags[runs[:live] + t] = tag[:live]
            tag[:live] = back[t][np.arange(live), tag[:live]]
        return tags


def fit_field(tokens: Tokens, tags: np.ndarray, steps: int = STEPS) -> Field:
    """Maximum likelihood by Adam over windows of ``WINDOW`` tokens, forward-backward over all windows at once."""
    size = np.diff(tokens.rows)
    parts = -(-size // WINDOW)
    owner, inside = W.spans(parts)
    starts = tokens.rows[:-1][owner] + inside * WINDOW
    lengths = np.minimum(size[owner] - inside * WINDOW, WINDOW)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    live = [int(np.searchsorted(-lengths, -t, side="left")) for t in range(int(lengths[0]))]
    gold = np.zeros((tokens.n, 3))
    gold[np.arange(tokens.n), tags] = 1
    width = int(_STARTS[-1])
    params = [np.zeros((width, 3)), np.zeros((3, 3))]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    m = len(starts)
    for step in range(1, steps + 1):
        field = Field(*params)
        e = field.emissions(tokens)
        e = np.exp(e - e.max(axis=1, keepdims=True))
        a = np.exp(field.moves)
        alpha = np.zeros((tokens.n, 3))
        now = np.tile(np.array([0.0, 0.0, 1.0]), (m, 1))
        scale = np.ones(tokens.n)
        for t, k in enumerate(live):
            value = (now[:k] @ a) * e[starts[:k] + t]
            total = value.sum(axis=1)
            now[:k] = value / total[:, None]
            alpha[starts[:k] + t], scale[starts[:k] + t] = now[:k], total
        beta = np.tile(a[:, OUTSIDE], (m, 1))
        share, moved = np.zeros((tokens.n, 3)), np.zeros((3, 3))
        wanted = np.zeros((3, 3))
        for t in range(len(live) - 1, -1, -1):
            k = live[t]
            at = starts[:k] + t
            both = alpha[at] * beta[:k]
            share[at] = both / both.sum(axis=1, keepdims=True)
            before = alpha[at - 1] if t else np.tile(np.array([0.0, 0.0, 1.0]), (k, 1))
            pair = before[:, :, None] * a[None] * (e[at] * beta[:k])[:, None, :]
            moved += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            previous = tags[at - 1] if t else np.full(k, OUTSIDE)
            np.add.at(wanted, (previous, tags[at]), 1)
            beta[:k] = (e[at] * beta[:k]) @ a.T / scale[at][:, None]
        difference = gold - share
        slope = np.stack([sum(np.bincount(row, weights=difference[:, y], minlength=width) for row in tokens.features) for y in range(3)], axis=1)
        for p, g, f, s in zip(params, (slope / m, (wanted - moved) / m), first, second, strict=True):
            g = g - DECAY * p
            f += 0.1 * (g - f)
            s += 0.01 * (g * g - s)
            p += RATE * (f / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return Field(*params)


def _gold(tokens: Tokens, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    tags = np.full(tokens.n, OUTSIDE)
    raw = data.tobytes()
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        for _, end, _, value in pattern_spans(raw[a:b]):
            i, j = np.searchsorted(tokens.starts, [a + value, a + end])
            if i < j and tags[i] == OUTSIDE:
                tags[i:j] = INSIDE
                tags[i] = BEGIN
    return tags


def _window(raw: bytes, match: tuple[int, int] | None, place: int, most_bytes: int) -> bytes:
    """At most ``most_bytes`` bytes, around the match (its start if it is longer) or anywhere."""
    if len(raw) <= most_bytes:
        return raw
    if match is None:
        start = place % (len(raw) - most_bytes + 1)
    else:
        start = match[0] - max(0, most_bytes - (match[1] - match[0])) // 2
    start = min(max(start, 0), len(raw) - most_bytes)
    return raw[start : start + most_bytes]


def _examples(known: DataFrame, matching: bool, most_bytes: int) -> DataFrame:
    """h, doc_id and window of the texts with a pattern match, or of those without one, of (h, doc_id, text)."""
    schema = T.StructType([*known.drop("text").schema.fields, T.StructField("text", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.text_bytes(batch.column(2))
            hinted = may_match(batch.column(2))
            rows, windows = [], []
            for i in (np.flatnonzero(hinted) if matching else np.arange(len(hinted))).tolist():
                raw = data[offsets[i] : offsets[i + 1]].tobytes()
                spans = pattern_spans(raw) if hinted[i] else []
                if bool(spans) == matching:
                    rows.append(i)
                    windows.append(_window(raw, spans[0][:2] if spans else None, batch.column(0)[i].as_py(), most_bytes))
            kept = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns[:2], pa.array(windows, pa.binary())], names=schema.names)

    return known.mapInArrow(run, schema)


def train(docs: DataFrame, rows: int = TRAIN_ROWS, most_bytes: int = TRAIN_BYTES, slice_rows: int = TRAIN_SLICE) -> Field | None:
    """Fit the field on a bounded sample of ``docs``; None if no text has a match."""
    share = min(1.0, slice_rows / max(1, docs.count()))
    h = F.xxhash64(F.lit("secrets"), "doc_id", F.length("text"))
    known = docs.where("text IS NOT NULL").select(h.alias("h"), "doc_id", "text")
    some = known.where(F.pmod(F.xxhash64("h"), F.lit(1 << 20)) < share * (1 << 20))
    parts = [_examples(few, wanted, most_bytes).orderBy("h", "doc_id", "text").limit(rows).select("text").toArrow() for few, wanted in ((known, True), (some, False))]
    windows = [x for p in parts for x in p.column(0).to_pylist()]
    data, offsets = np.array(bytearray(b"".join(windows)), np.uint8), np.cumsum([0, *map(len, windows)])
    tokens = Tokens(data, offsets)
    tags = _gold(tokens, data, offsets)
    return fit_field(tokens, tags) if (tags != OUTSIDE).any() else None


def _join(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, b, kind in spans)


def _scan_text(raw: bytes, base: list, extra: list[tuple[int, int]]) -> tuple[list, list]:
    """Base spans and all spans, in code points."""
    starts = sorted((a, b) for a, b, *_ in base)
    reach = [0, *accumulate((b for _, b in starts), max)]  # the furthest end of the first spans
    added = [(a, b, 3) for a, b in extra if reach[bisect_left(starts, (b,))] <= a]
    every = sorted([(a, b, kind) for a, b, kind, _ in base] + added, key=lambda s: (s[0], s[2]))
    code_point = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    every = [(int(code_point[a]), int(code_point[b]), kind) for a, b, kind in every]
    return [s for s in every if s[2] < 3], every


def scan(docs: DataFrame, field: Field | None) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, n_crf, base_sha256, spans."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    schema = T.StructType(
        [docs.schema["doc_id"]]
        + [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
        + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            data, offsets = W.text_bytes(column)
            hinted = may_match(column)
            counts = np.zeros((len(column), len(KINDS)), np.int64)
            base_text, span_text = [""] * len(column), [""] * len(column)
            for a, b in W.row_slices(offsets):
                raw, bounds = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                extra: dict[int, list[tuple[int, int]]] = {}
                if shared.value is not None:
                    tokens = Tokens(raw, bounds)
                    tags = shared.value.secret(tokens)
                    begin = np.flatnonzero(tags == BEGIN)
                    following = np.flatnonzero(np.append(tags, OUTSIDE) != INSIDE)
                    last = following[np.searchsorted(following, begin, side="right")] - 1
                    for i, j in zip(begin.tolist(), last.tolist(), strict=True):
                        doc = int(tokens.doc[i])
                        extra.setdefault(doc, []).append((int(tokens.starts[i] - bounds[doc]), int(tokens.ends[j] - bounds[doc])))
                for i in sorted(extra.keys() | set(np.flatnonzero(hinted[a:b]).tolist())):
                    text = raw[bounds[i] : bounds[i + 1]].tobytes()
                    base, every = _scan_text(text, pattern_spans(text) if hinted[a + i] else [], extra.get(i, []))
                    base_text[a + i], span_text[a + i] = _join(base), _join(every)
                    counts[a + i] = np.bincount([kind for *_, kind in every], minlength=len(KINDS))
            digests = [hashlib.sha256(s.encode()).hexdigest() for s in base_text]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, counts.T.copy()), pa.array(digests, pa.string()), pa.array(span_text, pa.string())], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op2_crf_secret_scan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scan(docs, train(docs)).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
