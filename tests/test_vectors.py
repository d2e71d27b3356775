import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecloom.functions import encoders, metadata, vectors


def test_normalize_ragged_null_and_zero_rows(spark):
    rows = [(0, [3.0, 4.0]), (1, [0.0, 0.0]), (2, []), (3, None), (4, [1.0, 2.0, 2.0])]
    df = spark.createDataFrame(rows, "i int, v array<double>").coalesce(1)
    got = {r.i: r.u for r in df.select("i", vectors.normalize(F.col("v")).alias("u")).collect()}
    assert got[0] == pytest.approx([0.6, 0.8]) and got[1] == [0.0, 0.0] and got[2] == [] and got[3] is None
    assert got[4] == pytest.approx([1 / 3, 2 / 3, 2 / 3])


def test_norm(spark):
    assert spark.range(1).select(vectors.norm(F.array(F.lit(3.0), F.lit(4.0)))).first()[0] == 5.0


def test_faults(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0]), (2, None), (3, []), (4, [nan, 1.0]), (5, [1.0, inf]), (6, [None, 1.0]), (7, [-inf, nan])]
    df = spark.createDataFrame(rows, "i int, v array<float>")
    found = {r.i: r.f for r in df.select("i", vectors.fault(F.col("v"), 2).alias("f")).collect()}
    bad = dict.fromkeys((4, 5, 6, 7), "not finite")
    assert found == {0: None, 1: "length", 2: "missing", 3: "missing", **bad}


def test_wrong_dimension(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0]), (2, None), (3, [])], "i int, v array<float>")
    assert [r.i for r in df.where(vectors.wrong_dimension(F.col("v"), 2)).orderBy("i").collect()] == [0, 2, 3]


def test_to_matrix_rejects_other_lengths():
    lists = vectors.to_lists(np.ones((3, 4)))
    assert vectors.to_matrix(lists.slice(1), 4).shape == (2, 4)
    with pytest.raises(ValueError):
        vectors.to_matrix(lists, 5)


def hashing_twin(text, dim):
    counts = [0] * dim
    for token in re.findall("[a-z0-9]+", text.lower()):
        counts[int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % dim] += 1
    norm = math.sqrt(sum(c * c for c in counts)) or 1.0
    return [c / norm for c in counts]


def test_hashing_encoder_matches_twin(spark):
    texts = ["Hello hello world 42", "", None, "Ünïcode only é", "a b c d e f g"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = df.select("i", encoders.encode(encoders.HashingEncoder(16), F.col("t")).alias("v")).orderBy("i").collect()
    for row, text in zip(got, texts):
        assert row.v == pytest.approx(hashing_twin(text or "", 16), abs=1e-7)


def test_encoder_batches_and_shape_check():
    class Wrong:
        name, dim, batch_size = "wrong", 3, 2

        def encode(self, texts):
            return np.ones((len(texts), 2))

    with pytest.raises(ValueError, match="shape"):
        encoders.encode_texts(Wrong(), ["a", "b", "c"])
    small = encoders.HashingEncoder(8)
    small.batch_size = 2
    texts = ["a b", "c", "d e f", "a", "b"]
    assert np.array_equal(encoders.encode_texts(small, texts), encoders.encode_texts(encoders.HashingEncoder(8), texts))


def test_bucket_cache_is_bounded():
    cache = encoders._Buckets(8, room=3)
    first = [cache[t] for t in "abcdefgh"]
    assert len(cache) <= 3 and first == [cache[t] for t in "abcdefgh"]


def test_model_encoder_is_gated():
    with pytest.raises(RuntimeError, match="sentence-transformers"):
        encoders.SentenceModelEncoder("any", 3).encode(["a"])


def test_merge_right_wins(spark):
    df = spark.createDataFrame(
        [(0, {"a": "1", "b": "2"}, {"b": "3", "c": None}), (1, {"a": "1"}, None), (2, {}, {"x": "y"})],
        "i int, l map<string,string>, r map<string,string>",
    )
    got = [r.m for r in df.select("i", metadata.merge(F.col("l"), F.col("r")).alias("m")).orderBy("i").collect()]
    assert got == [{"a": "1", "b": "3", "c": None}, {"a": "1"}, {"x": "y"}]


def test_filter_rules(spark):
    df = spark.createDataFrame(
        [(0, "e0", None, {"k": "1", "a.b": "x", "flag": "true"}), (1, "e1", "t", {"k": None}), (2, "e2", "t", {})],
        "i int, external_id string, text string, metadata map<string,string>",
    )

    def passing(**equal_to):
        wanted = {k.replace("__", "."): v for k, v in equal_to.items()}
        kept = df.where(metadata.matches(wanted, ["external_id", "text"])).orderBy("i").collect()
        return [r.i for r in kept]

    assert passing(metadata__k=1) == passing(metadata__k=1.0) == passing(metadata__k="1") == [0]
    assert passing(metadata__k=None) == [1, 2]
    assert passing(metadata__a__b="x") == [0]
    assert passing(metadata__flag=True) == [0]
    assert passing(metadata__k=None, text="t", external_id="e2") == [2]
    assert passing(nothing=None) == [0, 1, 2] and passing(nothing="x") == [] and passing() == [0, 1, 2]
