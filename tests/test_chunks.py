import hashlib
import time

import pytest
from pyspark.sql import functions as F

from vecloom.functions import chunks
from vecloom.plans.documents import document_chunks


def twin(text, size, overlap):
    step = max(1, size - overlap)
    return [text[i : i + size] for i in range(0, len(text), step)]


def cut(spark, texts, column):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r.v for r in rows.select("i", column.alias("v")).orderBy("i").collect()]


def test_kept_lengths_at_the_edges(spark):
    expected = {
        0: [], 79: [], 80: [80], 950: [950], 979: [979], 980: [980, 80], 1000: [1000, 100], 1001: [1000, 101],
        1800: [1000, 900], 8000: [1000] * 8 + [800],
    }
    kept = F.filter(chunks.windows(F.col("t"), max_length=8000), lambda c: F.length(c) >= 80)
    found = cut(spark, ["x" * n for n in expected], F.transform(kept, F.length))
    assert found == list(expected.values())


@pytest.mark.parametrize("size,overlap", [(1500, 200), (10, 3), (7, 7), (5, 9), (10, 8), (100, 0)])
def test_windows_match_python(spark, size, overlap):
    alphabet = "aé\U0001f600\n"
    texts = ["".join(alphabet[(i * i) % 4] for i in range(n)) for n in (0, 1, 6, 7, 10, 53, 400)] + [None]
    for limit in (10**9, 5):  # all by substring, then all longer ones by pieces
        old, chunks.LINEAR_BEYOND = chunks.LINEAR_BEYOND, limit
        try:
            found = cut(spark, texts, chunks.windows(F.col("t"), size, overlap))
        finally:
            chunks.LINEAR_BEYOND = old
        assert found == [twin(t or "", size, overlap) for t in texts]


def test_very_long_text_is_cut_in_linear_time(spark):
    text = "".join(chr(97 + i % 26) for i in range(1_000_003)) * 8
    began = time.monotonic()
    assert cut(spark, [text], chunks.windows(F.col("t"), 1500, 200)) == [twin(text, 1500, 200)]
    assert time.monotonic() - began < 30  # quadratic cutting of 8 million characters takes minutes


def test_document_chunks_carry_offsets(spark):
    text = "\U0001f600abc" * 1000
    docs = spark.createDataFrame([(1, text), (2, "short")], "seq int, text string")
    rows = document_chunks(docs, 1500, 200).orderBy("seq", "chunk_index").collect()
    for row in rows:
        whole = text if row.seq == 1 else "short"
        assert whole[row.char_start : row.char_end] == row.chunk
        assert row.total_chunks == len(twin(whole, 1500, 200))
    covered = set()
    for row in rows:
        if row.seq == 1:
            covered.update(range(row.char_start, row.char_end))
    assert covered == set(range(len(text)))
    digests = document_chunks(docs, 1500, 200).select(F.sha1("chunk").alias("s"), "chunk").collect()
    assert all(hashlib.sha1(r.chunk.encode()).hexdigest() == r.s for r in digests)
