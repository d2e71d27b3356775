import random

import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words bigint, shard string, h string, v bigint"


def _sentence(rng, n, words=None):
    words = words or ["alpha", "beta", "Gamma", "delta", "e", "zeta9", "été", "ny", "x-y", "k_m", "the", "of"]
    return " ".join(rng.choice(words) + (str(rng.randrange(40)) if rng.random() < 0.6 else "") for _ in range(n))


@pytest.fixture(scope="session")
def raw_documents():
    """Plain, near and exact copies, shared passages, nulls in every column, empty, very long and repeated rows."""
    rng = random.Random(7)
    passage = _sentence(rng, 70)
    texts = [_sentence(rng, rng.randrange(3, 160)) for _ in range(40)]
    rows = [(i, t, "en" if i % 3 else "fr", f"src{i % 3}") for i, t in enumerate(texts)]
    base = _sentence(rng, 150)
    rows.append((40, base, "en", "src0"))
    for i in range(41, 75):  # near copies, one word changed
        words = base.split(" ")
        words[rng.randrange(len(words))] = f"new{i}"
        rows.append((i, " ".join(words), "en", "src1"))
    rows += [(i, base, "en", "src0") for i in range(75, 85)]
    rows += [(i, _sentence(rng, 20) + "\n" + passage + " " + _sentence(rng, 30), "de", "src2") for i in range(85, 95)]
    rows.append((95, " ".join(_sentence(rng, 4000).split(" ")) + " " + passage, None, None))
    rows.append((96, "x" * 300_000, "en", "src1"))
    rows += [(97, None, "en", "src1"), (98, "", None, "src1"), (99, " \t\n", "en", None), (100, "###  *** 12", "en", "src0")]
    rows += [(None, base, "en", "src0"), (None, None, None, None), (101, "Hello World", "en", "z"), (101, "Hello World", "en", "z")]
    rows += [(102, "one two three four", "en", "z"), (103, "ONE two\x0bthree four", "en", "z"), (104, "one two three", "en", "z")]
    return [(*r, None if i % 5 == 0 else 1, i, "s", None, i) for i, r in enumerate(rows)]


@pytest.fixture(scope="session")
def documents(spark, raw_documents):
    return spark.createDataFrame(raw_documents, COLUMNS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], COLUMNS)
