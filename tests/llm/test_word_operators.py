"""Operators on words against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from document_fixtures import documents, no_documents, raw_documents  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from vecloom.llm import decontaminate, mixing, near_dedup, sharding, substring_dedup
from vecloom.llm import words as W
from vecloom.llm.components import components
from vecloom.llm.fm_index import FMIndex
from vecloom.llm.suffixes import search, suffix_array

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def multiset(rows):
    return sorted(map(tuple, rows), key=repr)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB0 .\té漢\n", max_size=30), max_size=6))
def test_word_codes_follow_the_words(texts):
    column = pa.array(texts, pa.string())
    for keep, pattern in ((W.ALNUM, ALNUM), (W.NOT_SPACE, SPACED)):
        codes, offsets = W.word_codes(column, keep, True)
        found = [[w for w in pattern.findall(lower(t))] for t in texts]
        assert np.diff(offsets).tolist() == [len(x) for x in found]
        flat = [w for x in found for w in x]
        assert len({(w, c) for w, c in zip(flat, codes.tolist(), strict=True)}) == len(set(flat)) == len(set(codes.tolist()))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=40), st.lists(st.integers(1, 5), min_size=1, max_size=12))
def test_binary_search_finds_longest_prefix(text, query):
    codes, q = np.array(text, np.uint64), np.array(query, np.uint64)
    order = suffix_array(codes, len(text) + 1)
    assert [tuple(text[i:]) for i in order] == sorted(tuple(text[i:]) for i in range(len(text)))
    best, lo, hi, _ = search(order, codes, q, np.arange(len(q)), len(q) - np.arange(len(q)), np.full(len(q), 3))
    for s in range(len(q)):
        occurs = [n for n in range(len(q) - s + 1) if any(text[i : i + n] == query[s : s + n] for i in range(len(text) - n + 1))]
        assert best[s] == max(occurs, default=0)
        n = best[s]
        if n:
            assert sorted(order[lo[s] : hi[s]].tolist()) == [i for i in range(len(text) - n + 1) if text[i : i + n] == query[s : s + n]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=25), min_size=1, max_size=5), st.lists(st.integers(0, 4), min_size=1, max_size=50))
def test_fm_index_intervals(pieces, query):
    index = FMIndex([np.array(p, np.uint64) for p in pieces])
    found = index.intervals(np.array(query, np.uint64), np.array([0, len(query)]), 4)
    want = {i for i in range(len(query) - 3) if any(p[j : j + 4] == query[i : i + 4] for p in pieces for j in range(len(p) - 3))}
    assert want == {i for _, a, n, _ in found.T for i in range(a, a + n - 3)}
    piece, at = index.locate(found[3])
    for (_, a, n, _), p, j in zip(found.T, piece, at, strict=True):
        assert pieces[p][j : j + n] == query[a : a + n]


def brute_contamination(docs, items):
    windows = []
    for item_id, text in items:
        w = ALNUM.findall(lower(text))
        n = min(13, len(w))
        windows += [(tuple(w[i : i + n]), "null" if item_id is None else str(item_id)) for i in range(len(w) - n + 1) if n]
    out = []
    for doc_id, text, *_ in docs:
        w = ALNUM.findall(lower(text))
        hit, names = set(), set()
        for win, name in windows:
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    names.add(name)
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(names), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_decontamination(spark, documents, raw_documents, block_bytes):
    long = raw_documents[10][1]
    items = [(1, " ".join(raw_documents[85][1].split()[22:60])), (2, "hello world"), (10, "HELLO, world!"), (None, long), (3, None), (4, " .. "),
             (5, " ".join(raw_documents[40][1].split()[5:30]))]
    benchmark = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id bigint, text string, doc_id int")
    found = decontaminate.contamination(documents, benchmark, shard_bytes=5000, block_bytes=block_bytes)
    rows = found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    want = brute_contamination(raw_documents, items)
    assert multiset(rows) == multiset(want) and any(r[5] for r in want)
    kept = decontaminate.remove_contaminated(documents, benchmark, shard_bytes=5000, block_bytes=block_bytes)
    assert kept.columns == documents.columns
    assert multiset([(r.doc_id, r.text) for r in kept.collect()]) == multiset(
        [(d[0], d[1]) for d, w in zip(raw_documents, want, strict=True) if not w[5]]
    )


def test_driver_keeps_no_block(spark, no_documents, monkeypatch):
    sent = []
    broadcast = type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(broadcast(self, value)) or sent[-1])
    benchmark = spark.createDataFrame([(i, f"item {i} of many words") for i in range(30)], "item_id bigint, text string")
    for use in (decontaminate.contamination, decontaminate.remove_contaminated, decontaminate.longest_matches):
        use(no_documents, benchmark, block_bytes=200)
    assert len(sent) > 6 and not any("_value" in b.__dict__ for b in sent)


def test_items_and_texts_of_equal_words_take_linear_time(spark):
    """A suffix is followed for a window, not to its end."""
    import time

    import pyarrow as pa

    text = "same " * 16_000
    began = time.monotonic()
    block = decontaminate.Block([{"item_id": 1, "text": text}], 13)

    class Sent:
        value = block

    got = decontaminate._judge(pa.array([text, "same " * 12, None]), [Sent()], 13, decontaminate.SHARD_BYTES)
    assert time.monotonic() - began < 5
    assert got["n_hit"].tolist() == [16_000, 0, 0] and got["items"] == [["1"], [], []]


def test_longest_matches(spark, documents, raw_documents):
    part = raw_documents[40][1].split()[5:30]
    benchmark = spark.createDataFrame([(1, "nowhere " + " ".join(part)), (2, "qqq www")], "item_id bigint, text string")
    (row,) = decontaminate.longest_matches(documents.where("doc_id IS NOT NULL"), benchmark).collect()
    words = ALNUM.findall(lower(" ".join(part)))
    assert (row.item_id, row.n_matched, row.item_word, row.doc_id) == ("1", len(words), 1, 40)


def test_decontamination_of_nothing(spark, documents, no_documents):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.contamination(documents, none).where("contaminated OR n_hit > 0 OR n_items > 0").isEmpty()
    assert decontaminate.contamination(no_documents, none).isEmpty()


def shingles(text):
    w = SPACED.findall(lower(text))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(docs):
    nodes = defaultdict(list)
    for i, (doc_id, text, *_) in enumerate(docs):
        nodes[("null", i) if doc_id is None else doc_id].append(shingles(text))
    label = {n: n for n in nodes}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(x for x in nodes if isinstance(x, int))
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in nodes[a] for y in nodes[b]):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {x: root(x) for x in ids}


@pytest.mark.parametrize("long_list", [50, 4])
def test_near_duplicates(documents, raw_documents, long_list):
    label = brute_components(raw_documents)
    want = [(d[0], len(shingles(d[1])), None if d[0] is None else label[d[0]], d[0] is None or label[d[0]] == d[0]) for d in raw_documents]
    found = near_dedup.near_duplicates(documents, long_list=long_list)
    assert multiset(found.collect()) == multiset(want)
    assert sum(not w[3] for w in want) > 40


def family(rng, members, first_id):
    """Texts that share half or more of a common original; copies cut short; a branch of copies with words of its own."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(160)]
    rows = [(first_id, " ".join(base))]
    branch = [f"b{rng.randrange(10**6)}" for _ in range(40)]
    for i in range(1, members):
        words = list(base)
        if i % 7 == 0:
            words = words[: rng.randrange(90, 160)]
        elif i % 7 == 1:
            words = words[:60] + branch[: rng.randrange(25, 40)] + words[100:]
        for _ in range(rng.choice([1, 3, 5, 8, 12])):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**9)}"
        rows.append((first_id + i, " ".join(words)))
    return rows


def test_large_families(spark):
    rng = random.Random(5)
    rows = [r for f in range(3) for r in family(rng, 120, 1000 * f)]
    rows += [(5000 + i, " ".join(f"o{rng.randrange(10**6)}" for _ in range(50))) for i in range(20)]
    label = brute_components(rows)
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
    assert {r.doc_id: r.component_id for r in found.collect()} == label
    sizes = sorted(np.unique(list(label.values()), return_counts=True)[1])
    assert sizes[-1] > 20 and sizes.count(1) > 60


def test_families_meet_without_their_square(spark):
    """Texts of one family that are linked to nothing, each half its original, meet nobody."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(200)]
    rows = [(0, " ".join(base))]
    for i in range(1, 1500):
        words = list(base)
        for at in rng.sample(range(200), 12):
            words[at] = f"n{i}-{at}"
        rows.append((i, " ".join(words)))
    met = []
    kept, near_dedup._confirmed = near_dedup._confirmed, lambda pairs, *a: (met.append(pairs.count()), kept(pairs, *a))[1]
    try:
        found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
    finally:
        near_dedup._confirmed = kept
    assert found.where("kept").count() == 1500
    assert met[0] <= 1500 and met[1] == 0


def test_one_of_each_stays(documents, raw_documents, no_documents):
    label = brute_components(raw_documents)
    kept = near_dedup.keep_one_of_each(documents)
    assert kept.columns == documents.columns
    assert multiset([(r.doc_id, r.text) for r in kept.collect()]) == multiset([(d[0], d[1]) for d in raw_documents if d[0] is None or label[d[0]] == d[0]])
    assert near_dedup.near_duplicates(no_documents).isEmpty()


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    edges = [tuple(sorted(map(int, e))) for e in rng.integers(0, 60, (45, 2))] + [(i, i + 1) for i in range(100, 130)]
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert dict(map(tuple, got.collect())) == label


def test_estimate_keeps_pairs_far_below_the_threshold():
    """44 of 96 common values of the union's sketch keep a pair at 0.75, 43 do not."""
    for common in (44, 43):
        only = list(range(common, 96))
        u = list(range(common)) + only[::2] + list(range(200, 200 + len(only) - len(only[::2])))
        v = list(range(common)) + only[1::2] + list(range(400, 400 + len(only) - len(only[1::2])))
        kind = pa.list_(pa.int64())
        batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([u], kind), pa.array([v], kind)], names=["a", "b", "x", "y"])
        (kept,) = near_dedup._may_reach(iter([batch]), 96, 0.75)
        assert kept.num_rows == (common == 44)


def brute_removed(docs):
    first = {}
    words = [SPACED.findall(d[1] or "") for d in docs]
    for d, w in zip(docs, words, strict=True):
        if d[0] is not None:
            for i in range(len(w) - 49):
                key = tuple(w[i : i + 50])
                first[key] = min(first.get(key, d[0]), d[0])
    out = []
    for d, w in zip(docs, words, strict=True):
        gone = set()
        if d[0] is not None:
            for i in range(len(w) - 49):
                if first[tuple(w[i : i + 50])] < d[0]:
                    gone.update(range(i, i + 50))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("sizes", [{}, {"SHARD_WINDOWS": 40, "QUERY_WORDS": 100, "PIECE_WINDOWS": 7, "SEARCH_WORDS": 90}])
def test_substring_dedup(documents, raw_documents, no_documents, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(substring_dedup, name, value)
    want = brute_removed(raw_documents)
    assert multiset(substring_dedup.substring_dedup(documents).collect()) == multiset(want)
    assert sum(w[2] > 0 for w in want) > 20
    if sizes:
        assert substring_dedup.substring_dedup(no_documents).isEmpty()


def test_mixing(documents, raw_documents, no_documents):
    rows = mixing.mix_report(documents).collect()
    again = mixing.mix_report(documents.repartition(5)).collect()
    assert multiset(rows) == multiset(again)
    sizes = defaultdict(int)
    for d in raw_documents:
        sizes[d[3]] += len(SPACED.findall(d[1] or ""))
    names = sorted(x for x in sizes if x is not None) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, rest, open_ = {}, sum(sizes.values()), set(names)
    while True:  # cap what is above its cap, share the rest by weight
        rate = rest / sum(weight[s] for s in open_)
        above = {s for s in open_ if rate * weight[s] > 3 * sizes[s]}
        if not above:
            break
        target.update({s: 3 * sizes[s] for s in above})
        rest -= sum(target[s] for s in above)
        open_ -= above
    target.update({s: rate * weight[s] for s in open_})
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert 0 <= r.taken == r.copies * r.size <= 3 * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6 for s in names)
    mixed = mixing.mix(documents)
    assert mixed.columns == documents.columns and mixed.count() == sum(r.copies for r in rows)
    assert mixing.mix_report(no_documents).isEmpty() and mixing.mix(no_documents).isEmpty()


@pytest.mark.parametrize("bucket_bytes", [32 << 20, 3000])
def test_sharding(documents, raw_documents, bucket_bytes):
    placed = sharding.shard_documents(documents, shards=7, bucket_bytes=bucket_bytes)
    rows = placed.collect()
    assert placed.columns == [*[c for c in documents.columns if c != "shard"], "shard", "slot"]
    assert multiset([(r.doc_id, r.text, r.v) for r in rows]) == multiset([(d[0], d[1], d[8]) for d in raw_documents])
    counts = defaultdict(list)
    for r in rows:
        counts[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in counts.values())
    assert sorted(counts) == list(range(7)) and max(map(len, counts.values())) - min(map(len, counts.values())) <= 1
    again = sharding.shard_documents(documents.repartition(5), shards=7, bucket_bytes=bucket_bytes)
    assert multiset([(r.v, r.shard, r.slot) for r in again.collect()]) == multiset([(r.v, r.shard, r.slot) for r in rows])
    order = [r.v for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert order != sorted(order)


def test_sharding_of_nothing(no_documents):
    assert sharding.shard_documents(no_documents).isEmpty()


def test_names_of_the_stages_are_no_obstacle(spark):
    """Columns that are called like internal ones are passed through as they are."""
    names = ["__h", "__cell", "__bucket", "__gone", "__source", "__copies", "__copy", "__source_of", "__target_of", "__full_of", "row", "copy", "h", "cell"]
    rows = [(i, f"word{i % 20} " * (30 + i % 5), f"s{i % 3}", *(f"{n}:{i}" for n in names)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, " + ", ".join(f"{n} string" for n in names))
    known = {r[0]: tuple(r) for r in rows}
    kept = near_dedup.keep_one_of_each(docs)
    mixed = mixing.mix(docs)
    sharded = sharding.shard_documents(docs, shards=3)
    assert kept.columns == mixed.columns == docs.columns and sharded.columns == [*docs.columns, "shard", "slot"]
    assert all(tuple(r) == known[r.doc_id] for df in (kept, mixed) for r in df.collect())
    placed = sharded.collect()
    assert len(placed) == 60 and all(tuple(r)[:-2] == known[r.doc_id] for r in placed)
    assert mixed.count() >= 1 and kept.count() <= 60
