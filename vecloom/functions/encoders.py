"""Text encoders and the UDF that runs them.

An encoder is a small picklable object with ``name``, ``dim``, ``batch_size`` and ``encode(texts) -> matrix``.
Spark partitions the texts; every Python worker keeps its own model. Vectors leave the UDF with length one.
"""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from vecloom import schemas
from vecloom.functions.vectors import to_lists, unit_rows

_TOKEN = re.compile(r"[a-z0-9]+")
_LOADED_MODELS: dict[str, object] = {}


class _Buckets(dict):
    """token -> hash bucket, filled on demand and emptied when a vocabulary outgrows it."""

    def __init__(self, dim: int, room: int = 1_000_000):
        super().__init__()
        self.dim, self.room = dim, room

    def __missing__(self, token: str) -> int:
        if len(self) >= self.room:
            self.clear()
        bucket = int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % self.dim
        self[token] = bucket
        return bucket


class HashingEncoder:
    """Bag of hashed ASCII word tokens. Deterministic and model-free: a stand-in for tests, with no semantics."""

    batch_size = 4096

    def __init__(self, dim: int = 64):
        self.dim = dim
        self.name = f"hashing-{dim}"
        self._buckets = _Buckets(dim)

    def __getstate__(self):
        return {"dim": self.dim}

    def __setstate__(self, state):
        self.__init__(state["dim"])

    def encode(self, texts: list[str]) -> np.ndarray:
        tokens = [_TOKEN.findall(text.lower()) for text in texts]
        counts = np.fromiter(map(len, tokens), dtype=np.int64, count=len(texts))
        bucket_of = self._buckets.__getitem__
        buckets = np.fromiter((bucket_of(t) for row in tokens for t in row), dtype=np.int64, count=counts.sum())
        cells = np.repeat(np.arange(len(texts)), counts) * self.dim + buckets
        return np.bincount(cells, minlength=len(texts) * self.dim).reshape(len(texts), self.dim)


class SentenceModelEncoder:
    """A sentence-transformers model, loaded once per Python worker and only when first used."""

    def __init__(self, name: str, dim: int, batch_size: int = 64, device: str = "cpu"):
        self.name, self.dim, self.batch_size, self.device = name, dim, batch_size, device

    def encode(self, texts: list[str]) -> np.ndarray:
        if self.name not in _LOADED_MODELS:
            try:
                from sentence_transformers import SentenceTransformer
            except ImportError as missing:
                raise RuntimeError("SentenceModelEncoder needs the sentence-transformers package") from missing
            _LOADED_MODELS[self.name] = SentenceTransformer(self.name, device=self.device)
        model = _LOADED_MODELS[self.name]
        return model.encode(texts, batch_size=self.batch_size, show_progress_bar=False, convert_to_numpy=True)


def encode_texts(encoder, texts: list[str]) -> np.ndarray:
    """Unit float32 vectors of a list of texts, encoded in batches of the encoder's size."""
    out = np.zeros((len(texts), encoder.dim), dtype=np.float32)
    for low in range(0, len(texts), encoder.batch_size):
        part = texts[low : low + encoder.batch_size]
        vectors = np.atleast_2d(encoder.encode(part))
        if vectors.shape != (len(part), encoder.dim):
            raise ValueError(f"encoder {encoder.name} gave shape {vectors.shape}, expected {(len(part), encoder.dim)}")
        if not np.isfinite(vectors).all():
            raise ValueError(f"encoder {encoder.name} gave elements that are not finite")
        out[low : low + len(part)] = unit_rows(vectors)
    return out


def encode(encoder, text: Column) -> Column:
    @F.arrow_udf(schemas.VECTOR)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield to_lists(encode_texts(encoder, batch.fill_null("").to_pylist()))

    return run(text)
