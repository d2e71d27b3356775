"""Licence scans, conversation tries and Merkle manifests against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import TESTDATA
from document_fixtures import documents, no_documents, raw_documents  # noqa: F401

from vecloom.llm import conversation_trie, license_scan, merkle

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def hexed(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- licences ----
def test_matching_statistics_and_ends():
    rng = random.Random(3)
    for _ in range(30):
        sequences = [[rng.randrange(3) for _ in range(rng.randrange(2, 12))] for _ in range(4)]
        automaton = license_scan.SuffixAutomaton(sequences)
        text = [rng.randrange(4) for _ in range(40)]
        inside = {tuple(s[a:b]) for s in sequences for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
        for i, (state, length) in enumerate(automaton.statistics(text)):
            longest = max((n for n in range(1, i + 2) if tuple(text[i - n + 1 : i + 1]) in inside), default=0)
            assert length == longest
            if length:
                match = text[i - length + 1 : i + 1]
                ends = {(k, e) for k, s in enumerate(sequences) for e in range(length - 1, len(s)) if s[e - length + 1 : e + 1] == match}
                assert set(automaton.ends[state]) == ends and len(automaton.ends[state]) == len(ends)


def test_chains():
    assert license_scan.chains([(3, 3, 4), (9, 9, 4)], gap=5) == [(0, 9, 8)]
    assert sorted(license_scan.chains([(3, 3, 4), (90, 9, 4)], gap=5)) == [(0, 3, 4), (87, 90, 4)]
    assert license_scan.chains([(3, 9, 4), (9, 3, 4)], gap=5)[0][2] == 4  # not in the template's order
    assert license_scan.chains([(5, 5, 6), (7, 7, 4)], gap=5) == [(0, 7, 8)]  # the overlap counts once


def base_places(text):
    found, w = [], words(text)
    for phrase, label in license_scan.PHRASES.items():
        q = phrase.split(" ")
        found += [(i, label) for i in range(len(w) - len(q) + 1) if w[i : i + len(q)] == q]
    return len(w), sorted(found)


def test_license_query_equals_a_plain_search(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").collect()}
    rows = license_scan.op11_suffix_automaton_licenses(spark, f"{TESTDATA}/sf0.01").collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, places = base_places(docs[r.doc_id])
        assert (r.n_words, r.n_base, r.base_labels) == (n, len(places), ",".join(sorted({label for _, label in places})))
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) and r.labels.split(",") == sorted(set(r.labels.split(",")))
        assert (r.score == 1) if places else (0 <= r.score <= 1)
        if not re.search("licen|permission|redistribution|mozilla|unencumbered|provided as", (docs[r.doc_id] or "").lower()):
            assert r.labels == "" and r.score == 0  # clean texts stay unlabelled


def test_licenses_with_changes_and_edge_cases(spark, documents, raw_documents, no_documents):
    mit = license_scan.TEMPLATES["mit"][2]
    notice = license_scan.TEMPLATES["apache-2.0"][1]
    torn = words(mit)
    torn[20] = "copyrightholder"
    torn[60:62] = ["x"]
    texts = [
        "Preface. " + mit + " The end.", " ".join(torn), " ".join(words(mit)[:40]), "This work is licensed under the GNU General Public License, version 3.",
        "GNU\x00General public\tLICENSE mit license MIT LICENSE", notice + " filler " * 50 + notice, "cc by", "the software is provided", None, "",
        ("word and the of " * 50_000) + " Apache License " + ("to use " * 50_000),
    ]
    docs = spark.createDataFrame([(t, i, "x") for i, t in enumerate(texts)], "text string, doc_id int, spans string")
    rows = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    labels = {i: {s.label for s in r.spans} for i, r in rows.items()}
    assert [labels[i] for i in range(4)] == [{"mit"}, {"mit"}, set(), {"gpl-3.0"}]
    assert (rows[0].spans[0].first, rows[0].spans[0].last, rows[0].spans[0].share) == (1, len(words(mit)), 1.0)
    assert 0.9 < rows[1].spans[0].share < 1
    assert [(p.word, p.label) for p in rows[4].phrases] == [(0, "gpl"), (4, "mit"), (6, "mit")]
    whole = [(s.first, s.last) for s in rows[5].spans if s.label == "apache-2.0"]
    n = len(words(notice))
    assert whole == [(0, n - 1), (n + 50, 2 * n + 49)]
    assert [(p.word, p.label) for p in rows[6].phrases] == [(0, "cc-by")] and not rows[7].phrases and not rows[7].spans
    assert rows[8].n_words == rows[9].n_words == 0 and not rows[8].spans
    assert [(p.word, p.label) for p in rows[10].phrases] == [(200_000, "apache")]
    assert license_scan.scan(documents).count() == len(raw_documents)
    assert license_scan.scan(no_documents).isEmpty()


# ---- conversation tries ----
def test_double_array():
    rng = np.random.default_rng(1)
    for shape in ((50, 4), (400, 3), (60, 400)):
        paths = sorted({tuple(rng.integers(0, shape[1], rng.integers(0, 7)).tolist()) for _ in range(shape[0])})
        rows = [
            {"path": b"".join(t.to_bytes(16, "big") for t in p), "lens": [1] * len(p), "n": [1], "conv": [i], "kids": [0], "leaves": [0], "saved": [0], "ends": ["e"]}
            for i, p in enumerate(paths)
        ]
        shard = conversation_trie.Shard(conversation_trie.Paths(rows))
        nodes = {p[:d] for p in paths for d in range(len(p) + 1)} | {()}
        trie = shard.trie
        assert (trie.check >= 0).sum() == len(nodes)
        used = trie.check[trie.check >= 0]
        assert set(used.tolist()) <= set(np.flatnonzero(trie.check >= 0).tolist())
        assert len(trie.check) < 8 * (len(nodes) + shape[1])
        assert (trie.walk(np.zeros(2, np.int64), np.array([10**9, -5])) == -1).all()


def crc(c):
    return zlib.crc32(str(c).encode())


def brute_trie(rows, family=100, head=6):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hexed(f"{len(role.encode())}:{role}{text}")[:32]
            own[c].append(((turn is not None, turn or 0), key, role, text))
    turns = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in own.items()}
    built = {}
    for c, mine in turns.items():
        base = turns.get(c - int(np.fmod(c, family)), [])
        h = crc(c) % head
        built[c] = base[:h] + mine[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in built.items():
        ends[tuple(path)].append(c)
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    out = []
    for node, convs in members.items():
        below, todo = [], [node]
        while todo:
            x = todo.pop()
            below.append(x)
            todo += kids[x]
        saved = sum((len(members[x]) - 1) * (len(x[-1][1]) if x else 0) for x in below)
        parent = min(members[node[:-1]]) if node else None
        ids = ",".join(map(str, sorted(ends[node])))
        out.append((min(convs), len(node), parent, len(convs), len(kids[node]), sum(not kids[x] for x in below), saved, hexed(ids)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(5)
    rows = []
    for c in [*range(-120, -95), *range(0, 130), *range(205, 260), 70_000, 140_001]:
        for turn in range(rng.randrange(1, 9)):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["hi", "Hé?", "", None, "x" * 40, f"own {c % 7}"])))
    same = [(0, "user", "hello"), (1, "assistant", "hello you")] + [(t, "user", f"again {t}") for t in range(2, 9)]
    for c in range(1000, 1200):  # one conversation, many copies
        rows += [(c, *t) for t in same]
    rows += [(c, None, "user", "no number") for c in (3, 1001)] + [(5, 0, "user", "tie"), (5, 0, "user", "tie"), (5, 0, "user", "tie 2")]
    rows += [(None, 1, "user", "nobody's"), (1150, 50, None, None)]
    return rows + [(2_000, t, "user", f"turn {t}") for t in range(60)]


@pytest.mark.parametrize(("shard_turns", "file_turns"), [(60_000, 400_000), (50, 300), (1, 40)])
def test_trie_equals_brute_force(spark, talks, shard_turns, file_turns):
    df = spark.createDataFrame([(*r, "x", 1) for r in talks], "conv_id bigint, turn bigint, role string, text string, path string, n bigint").repartition(5)
    found = conversation_trie.trie(df, shard_turns=shard_turns, file_turns=file_turns)
    assert sorted(map(tuple, found.collect()), key=repr) == brute_trie(talks)


def test_a_very_long_conversation(spark):
    """A chain of nodes, and one that leaves it halfway."""
    long = spark.range(20_000).selectExpr("1 AS conv_id", "id AS turn", "'user' AS role", "concat('t', id) AS text")
    other = long.where("turn < 10000").selectExpr("7 AS conv_id", "turn", "role", "text")
    for options in ({}, {"shard_turns": 100, "file_turns": 100}):
        found = conversation_trie.trie(long.union(other), family=1, **options)
        shared = found.where("n_convs = 2")
        assert found.count() == 20_001 and shared.count() == 10_001 and found.where("n_leaves <> 1").isEmpty()
        assert found.where("n_children = 0").first().depth == 20_000
        texts = sum(len(f"t{i}") for i in range(10_000))
        assert found.where("depth = 0").first().saved_tokens == texts


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert conversation_trie.trie(none).isEmpty()
    nobody = spark.createDataFrame([(None, 1, "a", "b")], none.schema)
    assert conversation_trie.trie(nobody).isEmpty()


# ---- Merkle manifests ----
def brute_manifest(rows, fan=2, divisor=7):
    """rows: (doc_id, text, lang, source, n_chars)"""

    def leaf(doc_id, text, lang, source, n_chars):
        return hexed("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))

    def levels(digests):
        out = [digests]
        while len(out[-1]) > 1:
            out.append([hexed("".join(out[-1][i : i + fan])) for i in range(0, len(out[-1]), fan)])
        return out

    def climb(digest, i, built, proof):
        for level in built[:-1]:
            first = i - i % fan
            run = level[first : first + fan]
            proof += run[: i - first] + run[i - first + 1 :]
            digest = hexed("".join([*run[: i - first], digest, *run[i - first + 1 :]]))
            i //= fan
        return digest

    trees = defaultdict(list)
    for r in rows:
        trees[r[2]].append(r)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for lang in langs:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        built[lang] = levels([leaf(*r) for r in trees[lang]])
    top = levels([built[lang][-1][0] for lang in langs])
    root, out = top[-1][0], []
    for t, lang in enumerate(langs):
        for i, r in enumerate(trees[lang]):
            bad = r[0] is not None and r[4] is not None and crc(r[0]) % divisor == 0
            proof = []
            digest = leaf(*r[:4], r[4] + 1) if bad else leaf(*r)
            digest = climb(climb(digest, i, built[lang], proof), t, top, proof)
            out.append((r[0], leaf(*r), built[lang][-1][0], root, hexed("".join(proof)), digest, digest == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"lift": 2, "crown_nodes": 6}, {"fan": 3, "lift": 2, "crown_nodes": 20}])
def test_manifest_equals_brute_force(documents, raw_documents, options):
    found = sorted(map(tuple, merkle.manifest(documents, **options).collect()), key=repr)
    expected = brute_manifest([r[:5] for r in raw_documents], options.get("fan", 2))
    assert found == expected
    assert 0 < sum(not r[-1] for r in found) < len(found) / 3


def test_manifest_edge_cases(spark, no_documents):
    assert merkle.manifest(no_documents).isEmpty()
    limits = [spark.conf.get(k) for k in ("spark.sql.cteRecursionRowLimit", "spark.sql.cteRecursionLevelLimit")]
    one = spark.createDataFrame([(9, "a", None, None, None)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    row = merkle.manifest(one).first()
    assert row.leaf == row.subroot == row.root == row.folded_root == hexed("1:9---1:a") and row.proof_sha256 == hexed("") and row.verified
    assert [spark.conf.get(k) for k in ("spark.sql.cteRecursionRowLimit", "spark.sql.cteRecursionLevelLimit")] == limits
    many = [(i, "t", f"l{i:03}", "s", 3) for i in range(60)]  # a language per row
    found = merkle.manifest(spark.createDataFrame(many, one.schema), crown_nodes=10).collect()
    assert sorted(map(tuple, found), key=repr) == brute_manifest(many)
