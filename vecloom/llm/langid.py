"""Language identification with unigram models over a fixed public piece vocabulary, all segmentations summed.

Each language has one probability per piece. The probability of a word is the sum, over every way to cut it into
pieces, of the product of their probabilities, computed by a forward recursion; pieces never cross white space, so a
text's log-probability is the sum over its words, and each distinct word of a batch is scored once. The probabilities
are fitted by expectation-maximisation, whose expected counts come from the same recursion run both ways.

The models are fitted on a sample of the labelled rows: ``TRAIN_ROWS`` in expectation, spread evenly over the languages
and drawn by a hash of doc_id, of texts of any length; the row with the smallest hash of a language is always drawn. Whole
texts are read, for fitting as for prediction. Spark reduces the sample to distinct words with their counts per language
and sums the expected counts of every round over them; the driver holds only the counts per piece and language. Expected
counts are rounded to a power of two that makes their sums exact, so that the model does not depend on their order.

Defined results: a null text, or one without any letter, is ``und`` with score 0, and so is every text where no row is
labelled; rows with null lang or doc_id, or without a word, are not learned from, and a language that has no other rows
is not among the answers; runs without white space are scored whole, however long they are: beyond ``WORD_BYTES`` bytes the
recursion goes on block by block on logarithms, and the longest piece bounds what it carries along; only fitting takes longer
runs in parts, which begin with a character; equal scores go to the lesser language code.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.llm import words as W
from vecloom.llm.staging import staged

TRAIN_ROWS = 3000
WORD_BYTES = 48
ROUNDS = 3
SMOOTHING = 0.02
REJECT_BELOW = 0.5
CHUNK = 4_000
LONG_CHUNK = 256
BLOCK_BYTES = 1_024
EMIT_WORDS = 50_000
CACHE_WORDS = 200_000
_MULTIPLY = np.uint64(0xD1342543DE82EF95)
_FILTER_BITS = 22


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load_pieces(path: str) -> list[bytes]:
    """Pieces as bytes, a space where a word begins; every single byte is a piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {bytes([b]) for b in range(256)}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or "▁" in piece[1:]):
            pieces.add(piece.replace("▁", " ").encode())
    return sorted(pieces)


class Pieces:
    """Finds all pieces inside words."""

    def __init__(self, pieces: list[bytes]):
        self.n = len(pieces)
        self.longest = max(map(len, pieces))
        codes = np.zeros(self.n, np.uint64)
        with np.errstate(over="ignore"):
            for i, piece in enumerate(pieces):
                h = np.uint64(0)
                for b in piece:
                    h = h * _MULTIPLY + np.uint64(b + 1)
                codes[i] = h
        order = np.argsort(codes)
        self.codes, self.ids = codes[order], order
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[self._slot(codes)] = True

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return W.scramble(codes) >> np.uint64(64 - _FILTER_BITS)

    def matches(self, cells: np.ndarray, lengths: np.ndarray):
        """Word, start, end and piece of every occurrence; ``cells`` holds byte + 1 as [position, word], 0 beyond the word."""
        size, m = cells.shape
        wide = cells.astype(np.uint64)
        h = np.zeros_like(wide)
        word, start, length, piece = [], [], [], []
        for n in range(1, min(self.longest, size) + 1):
            h = h[: size - n + 1] * _MULTIPLY + wide[n - 1 :]
            alive = cells[n - 1 :] > 0
            if not alive.any():
                break
            at = np.flatnonzero(alive & self.maybe[self._slot(h)])
            codes = h.reshape(-1)[at]
            where = np.minimum(np.searchsorted(self.codes, codes), self.n - 1)
            hit = self.codes[where] == codes
            at, where = at[hit], where[hit]
            word.append(at % m)
            start.append(at // m)
            length.append(np.full(len(at), n))
            piece.append(self.ids[where])
        word, start, piece = np.concatenate(word), np.concatenate(start), np.concatenate(piece)
        end = start + np.concatenate(length)
        order = np.argsort(end * m + word, kind="stable")
        return word[order], start[order], end[order], piece[order]


def _forward(word, start, end, weight, size, m):
    """alpha[position, word, language]: probability of the first ``position`` bytes, summed over segmentations."""
    alpha = np.zeros((size + 1, m, weight.shape[1]))
    alpha[0] = 1.0
    edges = np.searchsorted(end, np.arange(1, size + 2))
    for e in range(1, size + 1):
        a, b = edges[e - 1], edges[e]
        if a == b:
            break
        w = word[a:b]
        first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
        alpha[e, w[first]] = np.add.reduceat(alpha[start[a:b], w] * weight[a:b], first)
    return alpha


def _chunks(lengths: np.ndarray, most: int = CHUNK) -> Iterator[np.ndarray]:
    """Places by length, at most ``most`` at a time and not many of long ones."""
    order = np.argsort(lengths, kind="stable")
    a = 0
    while a < len(order):
        b = min(a + most, len(order))
        while b - a > 1 and lengths[order[b - 1]] * (b - a) > W.SLICE_BYTES:
            b = a + (b - a) // 2
        yield order[a:b]
        a = b


def _cells(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    size = int(lengths.max())
    cells = np.zeros((size, len(starts)), np.uint8)
    owner, inside = W.spans(lengths)
    # byte 255 occurs in no UTF-8 text, so byte + 1 fits
    cells[inside, owner] = data[starts[owner] + inside] + np.uint8(1)
    return cells


def _log_forward(pieces: Pieces, log_probability: np.ndarray, cells: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Logarithm of the sum over all segmentations [word, language] of words of any length, ``BLOCK_BYTES`` at a time."""
    (size, m), k, reach = cells.shape, log_probability.shape[1], pieces.longest
    out = np.zeros((m, k))
    carried = np.full((reach + 1, m, k), -np.inf)  # at the last positions, the current one in the end
    carried[-1] = 0.0
    for low in range(0, size, BLOCK_BYTES):
        high = min(low + BLOCK_BYTES, size)
        first = max(0, low - reach)
        word, start, end, piece = pieces.matches(cells[first:high], lengths)
        # rows stand for the positions from low - reach on
        start, end = start + first - (low - reach), end + first - (low - reach)
        new = end > reach
        word, start, end, weight = word[new], start[new], end[new], log_probability[piece[new]]
        alpha = np.concatenate([carried, np.full((high - low, m, k), -np.inf)])
        edges = np.searchsorted(end, np.arange(reach + 1, len(alpha) + 1))
        for e, (a, b) in enumerate(zip(edges, edges[1:], strict=False), reach + 1):
            if a < b:
                w = word[a:b]
                each = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
                alpha[e, w[each]] = np.logaddexp.reduceat(alpha[start[a:b], w] + weight[a:b], each)
        ended = np.flatnonzero((lengths > low) & (lengths <= high))
        out[ended] = alpha[lengths[ended] - low + reach, ended]
        carried = alpha[len(alpha) - reach - 1 :]
    return out


def word_scores(pieces: Pieces, probability: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """log-probability [word, language] of the byte ranges."""
    out = np.zeros((len(starts), probability.shape[1]))
    short = np.flatnonzero(lengths <= WORD_BYTES)
    rest = [np.flatnonzero(lengths > WORD_BYTES)]
    for part in _chunks(lengths[short]):
        part = short[part]
        cells = _cells(data, starts[part], lengths[part])
        word, start, end, piece = pieces.matches(cells, lengths[part])
        alpha = _forward(word, start, end, probability[piece], cells.shape[0], len(part))
        whole = alpha[lengths[part], np.arange(len(part))]
        tiny = (whole < 1e-290).any(axis=1)  # near the least number
        rest.append(part[tiny])
        out[part] = np.log(np.where(tiny[:, None], 1.0, whole))
    long = np.concatenate(rest)
    with np.errstate(divide="ignore"):
        logs = np.log(probability) if len(long) else None
    for part in _chunks(lengths[long], LONG_CHUNK):
        part = long[part]
        out[part] = _log_forward(pieces, logs, _cells(data, starts[part], lengths[part]), lengths[part])
    return out


def _expected(pieces: Pieces, probability: np.ndarray, data, starts, lengths, counts: np.ndarray, unit: float) -> np.ndarray:
    """Expected number of uses [piece, language], in multiples of ``unit``, over all segmentations of words that occur
    counts[word, language] times."""
    total = np.zeros_like(probability)
    for part in _chunks(lengths):
        cells = _cells(data, starts[part], lengths[part])
        m, size = len(part), cells.shape[0]
        word, start, end, piece = pieces.matches(cells, lengths[part])
        weight = probability[piece]
        alpha = _forward(word, start, end, weight, size, m)
        flipped = lengths[part][word] - start
        order = np.argsort(flipped * m + word, kind="stable")
        beta = _forward(word[order], (lengths[part][word] - end)[order], flipped[order], weight[order], size, m)
        whole = np.maximum(alpha[lengths[part], np.arange(m)], 1e-300)
        share = alpha[start, word] * weight * beta[lengths[part][word] - end, word] / whole[word] * counts[part][word]
        share = np.rint(share / unit) * unit
        for k in range(total.shape[1]):
            total[:, k] += np.bincount(piece, weights=share[:, k], minlength=pieces.n)
    return total


def _texts_as_words(data: np.ndarray, offsets: np.ndarray, whole: bool):
    """Bytes with a space before every word, and start, length and row offsets of the words (with their space).

    Unless they are to be ``whole``, words of ``WORD_BYTES`` and more are cut in parts that begin with a character.
    """
    starts, ends, words = W.split_words(data, offsets, W.NOT_SPACE)
    lengths = ends - starts
    lead = np.ones(len(starts), bool)
    if not whole and lengths.max(initial=0) >= WORD_BYTES:
        parts = -(-lengths // (WORD_BYTES - 1))
        owner, inside = W.spans(parts)
        at = starts[owner] + inside * (WORD_BYTES - 1)
        for _ in range(3):  # a character has at most three bytes behind its first one
            at -= (inside > 0) & ((data[at] & 0xC0) == 0x80)
        words = np.concatenate([[0], np.cumsum(parts)])[words]
        last = np.append(inside[1:] == 0, True)
        starts, lengths = at, np.where(last, ends[owner], np.append(at[1:], 0)) - at
        lead = inside == 0
    sizes = lengths + lead
    begin = np.cumsum(sizes) - sizes
    out = np.full(int(sizes.sum()), 0x20, np.uint8)
    out[W.ranges(begin + lead, lengths)] = data[W.ranges(starts, lengths)]
    return out, begin, sizes, words


def _distinct(data, offsets, whole: bool):
    """Distinct words of the texts: their bytes' starts and lengths, fingerprints, and the index of every word's own."""
    out, begin, sizes, words = _texts_as_words(data, offsets, whole)
    codes = W.fingerprints(out, begin, begin + sizes)
    unique, first, inverse = np.unique(codes, return_index=True, return_inverse=True)
    return out, begin[first], sizes[first], unique, inverse, words


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Model:
    def __init__(self, langs: list[str], pieces: list[bytes], probability: np.ndarray):
        self.langs, self.pieces, self.probability = langs, Pieces(pieces), probability


def _labelled_words(docs: DataFrame, langs: list[str]) -> DataFrame:
    """word (with its space), uses (index of the language and count) of the distinct words of (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = pc.index_in(batch.column(0), pa.array(langs, batch.column(0).type)).to_numpy(zero_copy_only=False)
            data, offsets = W.text_bytes(batch.column(1))
            for a, b in W.row_slices(offsets):
                raw, bounds = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                out, starts, lengths, _, inverse, words = _distinct(raw, bounds, False)
                pairs, n = np.unique(inverse * len(langs) + np.repeat(of[a:b], np.diff(words)), return_counts=True)
                for i in range(0, len(pairs), EMIT_WORDS):
                    at, lang = np.divmod(pairs[i : i + EMIT_WORDS], len(langs))
                    word = [out[x:y].tobytes() for x, y in zip(starts[at].tolist(), (starts + lengths)[at].tolist(), strict=True)]
                    columns = [pa.array(word, pa.binary()), pa.array(lang, pa.int64()), pa.array(n[i : i + EMIT_WORDS], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["word", "lang", "n"])

    found = docs.select("lang", "text").mapInArrow(W.tidy(run), "word binary, lang bigint, n bigint")
    found = found.groupBy("word", "lang").agg(F.sum("n").alias("n"))
    return found.groupBy("word").agg(F.collect_list(F.struct("lang", "n")).alias("uses"))


def _expected_of(words: DataFrame, model: Model, unit: float) -> np.ndarray:
    """Expected number of uses [piece, language] over all words, summed on Spark."""
    shared = words.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        total = np.zeros_like(held.probability)
        for batch in batches:
            raw = batch.column(0).to_pylist()
            lengths = np.array([len(x) for x in raw], np.int64)
            places, uses = batch.column(1).offsets.to_numpy(), batch.column(1).values
            counts = np.zeros((len(raw), len(held.langs)))
            counts[np.repeat(np.arange(len(raw)), np.diff(places)), uses.field(0).to_numpy()[places[0] : places[-1]]] = uses.field(1).to_numpy()[places[0] : places[-1]]
            if len(raw):
                data = np.frombuffer(b"".join(raw), np.uint8)
                total += _expected(held.pieces, held.probability, data, np.cumsum(lengths) - lengths, lengths, counts, unit)
        piece, lang = np.nonzero(total)
        for i in range(0, len(piece), EMIT_WORDS):
            p, k = piece[i : i + EMIT_WORDS], lang[i : i + EMIT_WORDS]
            yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(k), pa.array(total[p, k])], names=["piece", "lang", "uses"])

    sums = words.mapInArrow(W.tidy(run), "piece bigint, lang bigint, uses double").groupBy("piece", "lang").agg(F.sum("uses").alias("uses")).toArrow()
    shared.destroy()
    out = np.zeros_like(model.probability)
    out[sums.column("piece").to_numpy(), sums.column("lang").to_numpy()] = sums.column("uses").to_numpy()
    return out


def fit(docs: DataFrame, vocabulary: str | None = None, rows: int = TRAIN_ROWS) -> Model:
    """Fit on labelled rows that are not held out; see the sample above."""
    pieces = load_pieces(vocabulary or default_vocabulary())
    known = docs.select("doc_id", "lang", "text").where("doc_id IS NOT NULL AND lang IS NOT NULL").where(~held_out())
    known = known.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    known = known.withColumn("h", F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1 << 20)))
    facts = {r["lang"]: r for r in known.groupBy("lang").agg(F.count("*").alias("n"), F.min("h").alias("least")).collect()}
    langs = sorted(facts)
    if not langs:
        return Model([], pieces, np.zeros((len(pieces), 0)))
    each = rows / len(langs)
    limit = F.lit(0.0)
    for lang in langs:
        share = min(1.0, each / facts[lang]["n"])
        limit = F.when(F.col("lang") == lang, F.lit(max(share * (1 << 20), facts[lang]["least"] + 1.0))).otherwise(limit)
    words = staged(_labelled_words(known.where(F.col("h") < limit), langs), "labelled-words")
    used = F.aggregate("uses", F.lit(0).cast("bigint"), lambda s, x: s + x["n"])
    size = words.agg(F.sum(used * F.length("word")).alias("size")).first()["size"]
    # no sum of uses exceeds the bytes of all words: sums of multiples of the unit are exact
    unit = 2.0 ** (int(size).bit_length() - 52)
    model = Model(langs, pieces, np.full((len(pieces), len(langs)), 1.0 / len(pieces)))
    for _ in range(ROUNDS):
        got = _expected_of(words, model, unit) + SMOOTHING
        model.probability = got / got.sum(axis=0)
    return model


class Scorer:
    """Scores batches with a bounded memory of words seen before."""

    def __init__(self, model: Model):
        self.model = model
        self.codes = np.zeros(0, np.uint64)
        self.scores = np.zeros((0, len(model.langs)))

    def _lookup(self, codes, data, starts, lengths) -> np.ndarray:
        where = np.searchsorted(self.codes, codes)
        found = np.zeros(len(codes), bool)
        inside = where < len(self.codes)
        found[inside] = self.codes[where[inside]] == codes[inside]
        out = np.empty((len(codes), len(self.model.langs)))
        out[found] = self.scores[where[found]]
        new = ~found
        out[new] = word_scores(self.model.pieces, self.model.probability, data, starts[new], lengths[new])
        if len(self.codes) + new.sum() > CACHE_WORDS:
            self.codes, self.scores = codes[:CACHE_WORDS], out[:CACHE_WORDS]
        else:
            merged = np.concatenate([self.codes, codes[new]])
            order = np.argsort(merged, kind="stable")
            self.codes, self.scores = merged[order], np.concatenate([self.scores, out[new]])[order]
        return out

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Index of the best language (-1: und) and its probability given the text, per row."""
        data, offsets = W.text_bytes(column)
        n, k = len(offsets) - 1, len(self.model.langs)
        best, score = np.full(n, -1), np.zeros(n)
        for a, b in W.row_slices(offsets):
            if not k:
                break
            raw, bounds = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            out, starts, lengths, codes, inverse, words = _distinct(raw, bounds, True)
            scores = self._lookup(codes, out, starts, lengths)
            row = np.repeat(np.arange(b - a), np.diff(words))
            total = np.stack([np.bincount(row, weights=scores[inverse, j], minlength=b - a) for j in range(k)], axis=1)
            top = total.argmax(axis=1)
            total -= total.max(axis=1, keepdims=True)
            sure = 1.0 / np.exp(total).sum(axis=1)
            letters = np.concatenate([[0], np.cumsum(W.ALNUM[raw] & (raw > 0x39) & (raw < 0x80))])[bounds]
            plain = np.diff(letters) > 0
            for i in np.flatnonzero(~plain).tolist():
                plain[i] = any(map(str.isalpha, raw[bounds[i] : bounds[i + 1]].tobytes().decode("utf-8", "replace")))
            best[a:b] = np.where(plain, top, -1)
            score[a:b] = np.where(plain, sure, 0.0)
        return best, score


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    narrow = docs.select("doc_id", held_out().alias("held_out"), "text")
    schema = T.StructType([*narrow.drop("text").schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        names = pa.array([*shared.value.langs, "und"], pa.string())
        for batch in batches:
            best, score = scorer(batch.column(2))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], names.take(pa.array(best % len(names))), pa.array(score)], names=schema.names)

    return narrow.mapInArrow(W.tidy(run), schema)


def keep_identified(docs: DataFrame, model: Model, reject_below: float = REJECT_BELOW) -> DataFrame:
    """The documents whose language is identified with at least the given score, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            best, score = scorer(batch.column(place))
            yield batch.filter(pa.array((best >= 0) & (score >= reject_below)))

    return docs.mapInArrow(W.tidy(run), docs.schema)


def op6_marginal_language_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(docs, fit(docs))
