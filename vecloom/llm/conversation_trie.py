"""The prefix trie of conversations, from double-array tries of bounded shards.

Every conversation is rebuilt as a sequence of turns, a turn being a 128-bit digest of role and text. Equal sequences
become one path with a count. Paths are sorted by range partitioning, and each task cuts its run of the order into shards of
at most ``SHARD_TURNS`` turns. So a prefix that any share of all conversations have in common is spread over as
many shards as it needs. In a shard:

1. its turns get dense ids, by depth of first appearance, so that siblings lie close together;
2. the nodes are packed into BASE and CHECK: the child of node s by turn t stands at slot BASE[s] + t, with CHECK = s;
3. all paths walk through the arrays together, one depth after the other, adding up their members, and sums over subtrees are
   taken from the deepest nodes upward.

Only nodes on the first or the last path of a shard can also occur in other shards. All others are finished. The first
and last paths, with what hangs off them, are the input of the next round, in which they are sorted and merged in the same
way, until one shard is left. A round leaves two paths of a shard, so rounds are few.

Defined results: a row without conv_id belongs to no conversation and is left out; a null role or text is empty; turns
with equal numbers are ordered by the digest of role and text, and a repeated row is another turn; null turns come first; a table without
conversations gives no rows; further columns are ignored. A conversation is held as one row of 40 bytes per turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.staging import small, staged

HEAD_TURNS = 6  # a conversation takes over crc32(conv_id) % HEAD_TURNS turns
FAMILY = 100
SHARD_TURNS = 60_000
FILE_TURNS = 400_000
SHARD_PATHS = 4  # a shard has that many at least, and leaves two
KEY = 16  # bytes of a turn's digest
ID_SPAN = 1 << 16
NO_ENDS = hashlib.sha256(b"").hexdigest()

_ROWS = "path binary, lens array<bigint>, n array<bigint>, conv array<bigint>, kids array<bigint>, leaves array<bigint>, saved array<bigint>, ends array<string>"
_NODES = (
    "done boolean, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string, node binary, parent binary, "
)
_OUT = _NODES + _ROWS


# ---- double-array trie of one shard ----
@dataclass
class DoubleArray:
    """BASE and CHECK over slots; slot 0 is the root, -1 in ``check`` a free slot."""

    base: np.ndarray
    check: np.ndarray

    def walk(self, slots: np.ndarray, turns: np.ndarray) -> np.ndarray:
        """The children of ``slots`` by dense turn ids; -1 where there is none."""
        to = self.base[slots] + turns
        inside = (to > 0) & (to < len(self.check))
        to = np.where(inside, to, 0)
        return np.where(inside & (self.check[to] == slots), to, -1)


def dense_ids(keys: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Ids from 0 for equal keys, in the order of their first appearance by depth."""
    order = np.argsort(depth, kind="stable")
    _, first, inverse = np.unique(keys[order], return_index=True, return_inverse=True)
    rank = np.empty(len(first), np.int64)
    rank[np.argsort(first, kind="stable")] = np.arange(len(first))
    out = np.empty(len(keys), np.int64)
    out[order] = rank[inverse.reshape(-1)]
    return out


def pack(parent: np.ndarray, turn: np.ndarray, n_nodes: int) -> tuple[DoubleArray, np.ndarray]:
    """Pack a trie given by (parent, turn) of the nodes from 1, numbered by depth; the arrays and the slot of every node.

    A node's children take the first free places that fit all of them.
    """
    order = np.lexsort((turn, parent))
    owners, begin = np.unique(parent[order], return_index=True)
    stop = np.append(begin[1:], len(order))
    size = n_nodes + int(turn.max(initial=0)) + 2
    check = np.full(size, -1, np.int64)
    base = np.zeros(size, np.int64)
    slot = np.zeros(n_nodes, np.int64)
    check[0] = 0
    low = 1
    for owner, a, b in zip(owners.tolist(), begin.tolist(), stop.tolist(), strict=True):
        children = order[a:b]
        turns = turn[children]
        span = int(turns[-1] - turns[0])
        at = low
        while True:
            while at < len(check) and check[at] >= 0:
                at += 1
            if at + span >= len(check):
                grown = at + span + len(check) + 1
                check = np.concatenate([check, np.full(grown - len(check), -1, np.int64)])
                base = np.concatenate([base, np.zeros(grown - len(base), np.int64)])
            if b - a == 1 or (check[at + turns - turns[0]] < 0).all():
                break
            at += 1
        places = at + turns - turns[0]
        base[slot[owner]] = at - int(turns[0])
        check[places] = slot[owner]
        slot[children + 1] = places
        while low < len(check) and check[low] >= 0:
            low += 1
    return DoubleArray(base, check), slot


class Paths:
    """Sorted distinct paths: turn keys, text lengths, and per path and depth (the root included) what is known so far."""

    def __init__(self, rows: list[dict]):
        self.rows = rows
        self.size = np.array([len(r["path"]) // KEY for r in rows], np.int64)
        self.keys = np.frombuffer(b"".join(r["path"] for r in rows), f"V{KEY}")
        self.row = np.repeat(np.arange(len(rows)), self.size)
        self.depth = np.arange(len(self.keys)) - np.repeat(np.cumsum(self.size) - self.size, self.size)  # from 0
        self.lens = np.fromiter((x for r in rows for x in r["lens"]), np.int64, len(self.keys))

    def per_node(self, name: str) -> np.ndarray:
        """Values of a column for the nodes of all paths, roots included; a single value stands for all nodes of its path."""
        values = [r[name] if len(r[name]) == s + 1 else r[name] * (s + 1) for r, s in zip(self.rows, self.size.tolist(), strict=True)]
        return np.fromiter((x for v in values for x in v), np.int64, int(self.size.sum()) + len(self.rows))


class Shard:
    """The trie of sorted paths: per slot members, smallest member, children, leaves and savings."""

    def __init__(self, paths: Paths):
        keys, row, depth = paths.keys, paths.row, paths.depth
        n_rows = len(paths.rows)
        turns = dense_ids(keys, depth)
        number = np.arange(len(keys))
        begin = np.cumsum(paths.size) - paths.size
        above = begin[np.maximum(row - 1, 0)] + depth  # the same depth of the path before
        alike = (row > 0) & (depth < paths.size[np.maximum(row - 1, 0)])
        alike &= turns == turns[np.where(alike, above, 0)]
        broken = np.where(alike, len(keys) + 1, depth)
        common = np.full(n_rows, len(keys) + 1)
        np.minimum.at(common, row, broken)  # depth at which a path leaves the one before
        new = depth >= common[row]
        # nodes are numbered by depth, then by path
        fresh = number[new][np.argsort(depth[new], kind="stable")]
        node = np.full(len(keys), -1, np.int64)
        node[fresh] = np.arange(1, len(fresh) + 1)
        node = _inherited(node, new, above)
        parent = np.where(depth > 0, node[np.maximum(number - 1, 0)], 0)[fresh]
        self.trie, slot = pack(parent, turns[fresh], len(fresh) + 1)

        # traversal: every path from the root, all paths at once
        stands = np.zeros(n_rows, np.int64)
        at = np.zeros(len(keys) + n_rows, np.int64)  # slots of all nodes of all paths, roots included
        root = begin + np.arange(n_rows)
        by_depth = np.argsort(depth, kind="stable")
        edges = np.searchsorted(depth[by_depth], np.arange(int(paths.size.max(initial=0)) + 1))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            here = by_depth[a:b]
            stands[row[here]] = self.trie.walk(stands[row[here]], turns[here])
            at[here + row[here] + 1] = stands[row[here]]
        if (at < 0).any():
            raise RuntimeError("a path left the trie that was packed from it")
        self.at, self.root, self.paths = at, root, paths

        n_slots = len(self.trie.check)
        self.slots = np.concatenate([[0], slot[1:]]).astype(np.int64)  # by depth
        self.depth = np.zeros(n_slots, np.int64)
        self.depth[slot[1:]] = depth[fresh] + 1
        self.length = np.zeros(n_slots, np.int64)
        self.length[slot[1:]] = paths.lens[fresh]
        sums = {}
        for name in ("n", "kids", "leaves", "saved"):
            sums[name] = np.zeros(n_slots, np.int64)
            np.add.at(sums[name], at, paths.per_node(name))
        self.n = sums["n"]
        self.conv = np.full(n_slots, np.iinfo(np.int64).max)
        np.minimum.at(self.conv, at, paths.per_node("conv"))
        self.ends: dict[int, str] = {}
        for r, (x, s, first) in enumerate(zip(paths.rows, paths.size.tolist(), root.tolist(), strict=True)):
            if len(x["ends"]) == 1:
                self.ends[int(at[first + s])] = x["ends"][0]
            else:
                self.ends.update((int(at[first + d]), e) for d, e in enumerate(x["ends"]) if e is not None)
        # sums over subtrees without the nodes on the first and last path, the spine
        self.spine = np.zeros(n_slots, bool)
        for r in {0, n_rows - 1}:
            self.spine[at[root[r] : root[r] + paths.size[r] + 1]] = True
        self.kids, self.leaves, self.saved = sums["kids"], sums["leaves"], sums["saved"]

    def add_up(self, spine: np.ndarray) -> None:
        """Complete children, leaves and savings of all nodes outside ``spine``; what hangs off the spine is added to it."""
        check = self.trie.check
        depth = self.depth[self.slots]
        edges = np.searchsorted(depth, np.arange(int(depth.max(initial=0)) + 2))
        for a, b in reversed(list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))):
            here = self.slots[a:b]
            here = here[~spine[here]]
            self.leaves[here] += self.kids[here] == 0
            self.saved[here] += (self.n[here] - 1) * self.length[here]
            below = here[here > 0]
            up = check[below]
            np.add.at(self.kids, up, 1)
            np.add.at(self.leaves, up, self.leaves[below])
            np.add.at(self.saved, up, self.saved[below])


def _inherited(node: np.ndarray, new: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Node numbers of shared places, which are those of the same depth of the path before."""
    source = np.where(new, np.arange(len(node)), above)
    while True:  # pointer jumping over runs of paths that share a prefix
        further = source[source]
        if (further == source).all():
            return node[source]
        source = further


def _digests(path: bytes) -> list[bytes]:
    """Identities of the nodes of a path, from the root: each is a digest of the one above and the turn."""
    out = [b"\0" * KEY]
    for i in range(0, len(path), KEY):
        out.append(hashlib.sha256(out[-1] + path[i : i + KEY]).digest()[:KEY])
    return out


def _finished(shard: Shard, spine: np.ndarray, later: bool) -> pa.RecordBatch | None:
    """Rows of all nodes outside the spine. ``later``: they were on a spine before, so their identities are given."""
    slots = shard.slots[~spine[shard.slots]]
    if not len(slots):
        return None
    up = np.where(slots > 0, shard.trie.check[slots], 0)
    hanging = (slots > 0) & spine[up]
    names: dict[int, bytes] = {}
    for r in range(len(shard.paths.rows)) if later else {0, len(shard.paths.rows) - 1}:
        first, s = shard.root[r], shard.paths.size[r]
        names.update(zip(shard.at[first : first + s + 1].tolist(), _digests(shard.paths.rows[r]["path"]), strict=True))
    parent_conv = np.where(hanging | (slots == 0), -1, shard.conv[up])
    columns = {
        "done": pa.array(np.ones(len(slots), bool)),
        "conv_id": pa.array(shard.conv[slots]),
        "depth": pa.array(shard.depth[slots]),
        "parent_conv_id": pa.array(parent_conv, mask=hanging | (slots == 0)),
        "n_convs": pa.array(shard.n[slots]),
        "n_children": pa.array(shard.kids[slots]),
        "n_leaves": pa.array(shard.leaves[slots]),
        "saved_tokens": pa.array(shard.saved[slots]),
        "ends_sha256": pa.array([shard.ends.get(s, NO_ENDS) for s in slots.tolist()], pa.string()),
        "node": pa.array([names[s] for s in slots.tolist()] if later else [None] * len(slots), pa.binary()),
        "parent": pa.array([names[p] if h else None for p, h in zip(up.tolist(), hanging.tolist(), strict=True)], pa.binary()),
    }
    return _batch(columns, len(slots))


def _batch(columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
    lists = {f: pa.list_(pa.string() if f == "ends" else pa.int64()) for f in ("lens", "n", "conv", "kids", "leaves", "saved", "ends")}
    kinds = {"done": pa.bool_(), "ends_sha256": pa.string(), "node": pa.binary(), "parent": pa.binary(), "path": pa.binary(), **lists}
    names = [c.split(" ")[0] for c in _OUT.split(", ")]
    return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(n, kinds.get(c, pa.int64())) for c in names], names=names)


def _spine_rows(shard: Shard) -> pa.RecordBatch:
    """The first and the last path with what their nodes have; nodes on both count in the first alone."""
    rows: dict[str, list] = {c.split(" ")[0]: [] for c in _ROWS.split(", ")}
    seen = np.zeros(len(shard.trie.check), bool)
    for r in sorted({0, len(shard.paths.rows) - 1}):
        x = shard.paths.rows[r]
        slots = shard.at[shard.root[r] : shard.root[r] + shard.paths.size[r] + 1]
        fresh = ~seen[slots]
        seen[slots] = True
        rows["path"].append(x["path"])
        rows["lens"].append(x["lens"])
        rows["conv"].append(shard.conv[slots].tolist())
        for name in ("n", "kids", "leaves", "saved"):
            rows[name].append(np.where(fresh, getattr(shard, name)[slots], 0).tolist())
        rows["ends"].append([shard.ends.get(s) if f else None for s, f in zip(slots.tolist(), fresh.tolist(), strict=True)])
    n = len(rows["path"])
    columns = {c: pa.array(v, pa.binary() if c == "path" else pa.list_(pa.string() if c == "ends" else pa.int64())) for c, v in rows.items()}
    return _batch({"done": pa.array([False] * n), **columns}, n)


def _shards(batches: Iterator[pa.RecordBatch], turns: int) -> Iterator[list[dict]]:
    """Runs of consecutive rows of at most ``turns`` turns, but of ``SHARD_PATHS`` rows at least, so that every round leaves fewer."""
    held, size = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            more = len(row["path"]) // KEY + 1
            if len(held) >= SHARD_PATHS and size + more > turns:
                yield held
                held, size = [], 0
            held.append(row)
            size += more
    if held:
        yield held


def _round(sorted_rows: DataFrame, turns: int, later: bool, last: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _shards(batches, turns):
            shard = Shard(Paths(rows))
            spine = np.zeros_like(shard.spine) if last else shard.spine
            shard.add_up(spine)
            found = _finished(shard, spine, later)
            if found is not None:
                for at in range(0, found.num_rows, 20_000):
                    yield found.slice(at, 20_000)
            if not last:
                yield _spine_rows(shard)

    return sorted_rows.mapInArrow(run, _OUT)


# ---- conversations to paths ----
def _turn_key() -> Column:
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    return F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * KEY)


def rebuilt(conversations: DataFrame, family: int = FAMILY, head_turns: int = HEAD_TURNS) -> DataFrame:
    """conv_id, path (the digests of its rebuilt turns, joined), lens (code points of their texts)."""
    turn = F.struct("turn", _turn_key().alias("key"), F.length(F.coalesce("text", F.lit(""))).cast("bigint").alias("len"))
    own = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("t"))
    own = staged(own.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")), "conversations")
    first = F.transform(F.slice("turns", 1, head_turns - 1), lambda t: F.struct(t["key"].alias("key"), t["len"].alias("len")))
    heads = own.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("of"), first.alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % head_turns).cast("int")
    joined = own.withColumn("h", h).join(heads, F.col("conv_id") - F.col("conv_id") % family == F.col("of"), "left")
    rest = F.expr("transform(slice(turns, h + 1, greatest(size(turns), 1)), t -> struct(t.key AS key, t.len AS len))")
    head = F.when(F.col("of").isNull(), F.expr("slice(transform(turns, t -> struct(t.key AS key, t.len AS len)), 1, 0)")).otherwise(F.expr("slice(head, 1, h)"))
    whole = joined.select("conv_id", F.concat(head, rest).alias("w"))
    return whole.select("conv_id", F.unhex(F.array_join("w.key", "")).alias("path"), F.col("w.len").alias("lens"))


def distinct_paths(whole: DataFrame) -> DataFrame:
    """path, lens, n (conversations), conv (the smallest) and ends (digest of all their ids) per distinct path.

    Ids are first joined per path and span of ids, so a path of any number of conversations moves as few rows, and one
    task reads them in order without holding them.
    """
    span = F.floor(F.col("conv_id") / F.lit(ID_SPAN))
    parts = whole.groupBy("path", span.alias("span")).agg(
        F.first("lens").alias("lens"), F.count("*").alias("n"), F.min("conv_id").alias("conv"),
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"),
    )
    schema = pa.schema([("path", pa.binary()), ("lens", pa.list_(pa.int64())), ("n", pa.int64()), ("conv", pa.int64()), ("ends", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, state, done = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["path"] == path:
                    done[-1]["n"] += row["n"]
                    state.update(b",")
                else:
                    if done:
                        done[-1]["ends"] = state.hexdigest()
                    if len(done) >= 2000:
                        yield pa.RecordBatch.from_pylist(done, schema)
                        done = []
                    path, state = row["path"], hashlib.sha256()
                    done.append({"path": path, "lens": row["lens"], "n": row["n"], "conv": row["conv"], "ends": None})
                state.update(row["ids"].encode())
        if done:
            done[-1]["ends"] = state.hexdigest()
            yield pa.RecordBatch.from_pylist(done, schema)

    together = parts.repartition("path").sortWithinPartitions("path", "span")
    return together.mapInArrow(run, "path binary, lens array<bigint>, n bigint, conv bigint, ends string")


def trie(
    conversations: DataFrame, family: int = FAMILY, head_turns: int = HEAD_TURNS, shard_turns: int = SHARD_TURNS, file_turns: int = FILE_TURNS
) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    paths = staged(distinct_paths(rebuilt(conversations, family, head_turns)), "paths")
    zero = F.array(F.lit(0).cast("bigint"))
    rows = paths.select(
        "path", "lens", F.array("n").alias("n"), F.array("conv").alias("conv"), zero.alias("kids"), zero.alias("leaves"), zero.alias("saved"),
        F.array("ends").alias("ends"),
    )
    finished, later = [], False
    while True:
        turns, n = rows.agg(F.sum(F.length("path") / KEY + 1), F.count("*")).first()
        last = (turns or 0) <= shard_turns or n <= SHARD_PATHS
        # several shards a file, so that every round leaves fewer paths, however long they are
        files = 1 if last else max(1, min(int(turns // file_turns) + 1, n // (2 * SHARD_PATHS)))
        ordered = (rows.repartition(1) if files == 1 else rows.repartitionByRange(files, "path")).sortWithinPartitions("path")
        found = staged(_round(ordered, shard_turns, later, last), "trie-round")
        finished.append(found.where("done"))
        if last:
            break
        rows, later = found.where("NOT done").select(*(c.split(" ")[0] for c in _ROWS.split(", "))), True
    nodes = finished[0]
    for more in finished[1:]:
        nodes = nodes.union(more)
    if len(finished) > 1:
        spines = finished[1]
        for more in finished[2:]:
            spines = spines.union(more)
        spines = small(staged(spines.select(F.col("node").alias("named"), F.col("conv_id").alias("named_conv")), "spines"))
        nodes = nodes.join(spines, F.col("parent") == F.col("named"), "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "named_conv"))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op12_double_array_trie(spark, sf_dir):
    return trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLE_SQL = rf"""
WITH t AS MATERIALIZED (SELECT conv_id AS c, length(coalesce(text, '')) AS len, sha256(octet_length(encode(coalesce(role, '')))::VARCHAR || ':' ||
    coalesce(role, '') || coalesce(text, '')) AS k, turn FROM conversations WHERE conv_id IS NOT NULL),
  o AS MATERIALIZED (SELECT c, list(k ORDER BY turn NULLS FIRST, k[:{2 * KEY}]) AS ks, list(len ORDER BY turn NULLS FIRST, k[:{2 * KEY}]) AS ls FROM t GROUP BY c),
  x AS (SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(1, length(c::VARCHAR) + 1),
      lambda p: [ascii(substr(c::VARCHAR, p::INT, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda x, e: xor(xor(x, e) >> 1, 3988292384 * (xor(x, e) & 1))),
      4294967295) % {HEAD_TURNS} AS h FROM o),
  r AS MATERIALIZED (SELECT x.c, list_concat(coalesce(o.ks[:h], []), x.ks[h + 1:]) AS ks, list_concat(coalesce(o.ls[:h], []), x.ls[h + 1:]) AS ls
    FROM x LEFT JOIN o ON o.c = x.c - x.c % {FAMILY}),
  p AS MATERIALIZED (SELECT c, d, array_to_string(ks[:d], '') AS path, CASE WHEN d > 0 THEN array_to_string(ks[:d - 1], '') END AS up,
    CASE WHEN d > 0 THEN ls[d] ELSE 0 END AS len, d = len(ks) AS ends FROM (SELECT *, unnest(range(len(ks) + 1)) AS d FROM r)),
  n AS MATERIALIZED (SELECT path, any_value(up) AS up, any_value(d) AS depth, min(c) AS c, count(*) AS n, any_value(len) AS len,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends FROM p GROUP BY path),
  k AS MATERIALIZED (SELECT up AS path, count(*) AS kids FROM n WHERE up IS NOT NULL GROUP BY up),
  a AS (SELECT DISTINCT y.path AS below, z.path FROM (SELECT path, min(c) AS c FROM p GROUP BY path) y
    JOIN p q ON q.c = y.c AND q.path = y.path JOIN p z ON z.c = q.c AND z.d <= q.d),
  s AS (SELECT a.path, sum((k.path IS NULL)::BIGINT)::BIGINT AS leaves, sum((n.n - 1) * n.len)::BIGINT AS saved
    FROM a JOIN n ON n.path = a.below LEFT JOIN k ON k.path = a.below GROUP BY a.path)
SELECT n.c::BIGINT AS conv_id, n.depth::BIGINT AS depth, u.c::BIGINT AS parent_conv_id, n.n::BIGINT AS n_convs, coalesce(kids, 0)::BIGINT AS n_children,
  leaves AS n_leaves, saved AS saved_tokens, n.ends AS ends_sha256
FROM n JOIN s USING (path) LEFT JOIN k USING (path) LEFT JOIN n u ON u.path = n.up
"""
