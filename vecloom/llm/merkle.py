"""A Merkle manifest of a dataset, verified by a recursive climb.

Leaves are digests of rows. A tree is built per language over the leaves in ascending doc_id, and a tree over the
subroots in ascending language gives the root. Levels are built blockwise and stored as node rows, each linked to its
parent and holding what stands before and after it in its run. A recursive query (``WITH RECURSIVE``) then starts at every leaf
and climbs one level per step over these links; a step appends the siblings met as a row and folds the leaf's digest,
the tampered one where there is one, into that of the parent.

Nodes above very many leaves would be hot join keys. They are few: the ``CROWN_NODES`` heaviest are broadcast and climbed by
a second recursive query, so a key of the first, which is joined by a shuffle, has a bounded number of leaves.

Order and numbers come from range-partitioned, sorted and written files: a leaf's index is its place in its file plus
the rows before it, of which only counts per file and language are summed. Nothing is sorted or numbered in one task.

Defined results: nulls are ``-`` in a leaf; a null doc_id comes first in its tree and is never tampered with; null is a language of
its own, before all others; rows that share a doc_id are ordered by their leaf, equal rows are leaves of their own with
equal values but their own proofs; a table without rows gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vecloom.llm.staging import release, small, staged

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_DIVISOR = 7
FAN = 2
LIFT = 10  # levels built in one task: groups of FAN ** LIFT nodes
CROWN_NODES = 50_000
FILE_ROWS = 50_000

_NODES = (
    "tree bigint, level int, idx bigint, digest binary, before binary, after binary, weight bigint, parent_weight bigint, "
    "top boolean, n bigint"
)


def _counted(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_rows(docs: DataFrame, divisor: int = TAMPER_DIVISOR) -> DataFrame:
    """doc_id, lang, leaf, altered (the leaf with 1 added to n_chars, where the rule of ``divisor`` selects the row; else null)."""
    more = F.when(F.col("n_chars").isNotNull(), (F.col("n_chars").cast("decimal(38,0)") + 1).cast("string"))
    parts = [_counted(F.col(c)) for c in FIELDS]
    changed = [_counted(more) if c == "n_chars" else part for c, part in zip(FIELDS, parts, strict=True)]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor == 0
    leaf, altered = (F.unhex(F.sha2(F.concat(*x), 256)) for x in (parts, changed))
    return docs.select("doc_id", "lang", leaf.alias("leaf"), F.when(tampered, altered).alias("altered"))


def numbered(rows: DataFrame, order: list[str], group: str | None = None) -> DataFrame:
    """``rows`` with ``place`` (from 0, by group and order, nulls first) and, with a group, ``idx`` (from 0 inside the group).

    The result is staged; rows that tie in all of ``order`` are spread by their place in the input.
    """
    keys = ([group] if group else []) + order
    known = staged(rows.withColumn("salt", F.monotonically_increasing_id()), "unordered")
    files = max(1, -(-known.count() // FILE_ROWS))
    keys += ["salt"]
    ranged = known.repartitionByRange(files, *keys).sortWithinPartitions(*keys).drop("salt")
    written = staged(ranged.withColumn("part", F.spark_partition_id()), "ordered")
    release(known)
    placed = written.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    runs = ["part", "file"] + ([group] if group else [])
    counts = staged(placed.groupBy(*runs).agg(F.min("row").alias("first"), F.count("*").alias("n")), "run-counts")
    by_file = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    files_of = counts.groupBy("part", "file").agg(F.sum("n").alias("rows"))
    starts = files_of.select("part", "file", F.coalesce(F.sum("rows").over(by_file), F.lit(0)).alias("file_start"))
    offsets = counts.join(small(staged(starts, "file-starts")), ["part", "file"])
    if group:
        inside = Window.partitionBy(group).orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
        offsets = offsets.withColumn("run_start", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    offsets = small(staged(offsets.drop("n"), "run-offsets").withColumnsRenamed({c: f"of_{c}" for c in runs}))
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in runs]
    out = placed.join(offsets, same, "left")
    kept = [F.col(c) for c in rows.columns] + [(F.col("file_start") + F.col("row")).alias("place")]
    if group:
        kept.append((F.col("run_start") + F.col("row") - F.col("first")).alias("idx"))
    out = staged(out.select(*kept), "numbered")
    release(written, counts)
    return out


def _block_levels(level: int, fan: int, lift: int):
    """Builds up to ``lift`` levels above the nodes of one block; rows of the nodes below and, marked as top, the last one's."""

    def run(key: tuple, block: pa.Table) -> pa.Table:
        tree = key[0].as_py()
        block = block.sort_by("idx")
        n = block.column("n")[0].as_py()
        first = block.column("idx")[0].as_py()
        digests, weights = block.column("digest").to_pylist(), block.column("weight").to_pylist()
        out: list[tuple] = []
        at = level
        while n > 1 and at < level + lift:
            above, heavier = [], []
            for i in range(0, len(digests), fan):
                run_of = [d.hex() for d in digests[i : i + fan]]
                weight = sum(weights[i : i + fan])
                above.append(hashlib.sha256("".join(run_of).encode()).digest())
                heavier.append(weight)
                for k in range(len(run_of)):
                    before, after = digests[i : i + k], digests[i + k + 1 : i + fan]
                    out.append((tree, at, first + i + k, digests[i + k], b"".join(before), b"".join(after), weights[i + k], weight, False, n))
            digests, weights, first, n, at = above, heavier, first // fan, -(-n // fan), at + 1
        out += [(tree, at, first + i, d, None, None, w, None, True, n) for i, (d, w) in enumerate(zip(digests, weights, strict=True))]
        names = [c.split(" ")[0] for c in _NODES.split(", ")]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return run


def build_levels(bottom: DataFrame, most: int, fan: int = FAN, lift: int = LIFT) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Node rows and top rows of all trees over ``bottom`` (tree, idx, digest, weight, n), of which the largest has ``most``
    leaves, and the staged tables they are read from."""
    nodes, tops, tables, level = [], [], [], 0
    current = bottom.select("tree", "idx", "digest", "weight", "n")
    while True:
        grouped = current.groupBy("tree", F.floor(F.col("idx") / F.lit(fan**lift)).alias("block"))
        built = staged(grouped.applyInArrow(_block_levels(level, fan, lift), _NODES), "levels")
        tables.append(built)
        nodes.append(built.where("NOT top"))
        tops.append(built.where("top AND n = 1"))
        level, most = level + lift, -(-most // fan**lift)
        if most <= 1:
            break
        current = built.where("top AND n > 1").select("tree", "idx", "digest", "weight", "n")
    joined = [nodes[0], tops[0]]
    for a, b in zip(nodes[1:], tops[1:], strict=True):
        joined = [joined[0].union(a), joined[1].union(b)]
    return joined[0], joined[1], tables


_CLIMB = """
WITH RECURSIVE climb AS (
  SELECT place, tree, level, idx, heavy, folded, siblings, step FROM {start}
  UNION ALL
  SELECT {hint} c.place, m.parent_tree, m.parent_level, m.parent_idx, m.parent_heavy,
    unhex(sha2(concat(hex_lower(m.before), hex_lower(c.folded), hex_lower(m.after)), 256)), concat(m.before, m.after), c.step + 1
  FROM climb c JOIN {nodes} m ON c.tree = m.tree AND c.level = m.level AND c.idx = m.idx)
SELECT * FROM climb
"""


def climb(start: DataFrame, nodes: DataFrame, sent: bool) -> DataFrame:
    """Rows of ``start`` and one row for each step from them over the links of ``nodes``, staged.

    place, tree, level, idx, heavy: where the row stands; folded: the digest it got there; siblings: those met in the
    step, left to right; step. ``sent`` broadcasts the nodes. The session's limits on recursion are put back at the end.
    """
    spark = start.sparkSession
    query = _CLIMB.replace("{hint}", "/*+ BROADCAST(m) */" if sent else "")
    for column in ("m.before", "c.folded", "m.after"):
        query = query.replace(f"hex_lower({column})", f"lower(hex({column}))")
    limits = ("spark.sql.cteRecursionRowLimit", "spark.sql.cteRecursionLevelLimit")
    before = {key: spark.conf.get(key) for key in limits}
    try:
        for key in limits:
            spark.conf.set(key, "-1")
        return staged(spark.sql(query, start=start, nodes=nodes), "climb")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _bits(weight: str) -> Column:
    return F.length(F.bin(F.col(weight))) - 1


def manifest(docs: DataFrame, divisor: int = TAMPER_DIVISOR, fan: int = FAN, lift: int = LIFT, crown_nodes: int = CROWN_NODES) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    leaves = numbered(leaf_rows(docs, divisor), ["doc_id", "leaf"], "lang")
    langs = staged(leaves.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    ranked = numbered(langs, ["lang"]).withColumnRenamed("place", "rank")
    # trees of languages have numbers from 1; tree 0 stands over their subroots
    trees = small(staged(ranked.select(F.col("lang").alias("of"), (F.col("rank") + 1).alias("tree"), "n"), "trees"))
    by_lang = leaves
    leaves = staged(by_lang.join(trees, F.col("lang").eqNullSafe(F.col("of"))).drop("of", "lang"), "leaves-of-trees")
    release(by_lang)
    most, n_trees = langs.agg(F.max("n"), F.count("*")).first()
    bottom = leaves.select("tree", "idx", F.col("leaf").alias("digest"), F.lit(1).cast("bigint").alias("weight"), "n")
    below, subroots, built = build_levels(bottom, most or 0, fan, lift)
    subroots = staged(subroots.select(F.col("tree").alias("of"), "digest", "weight"), "subroots")
    over = subroots.select(F.lit(0).cast("bigint").alias("tree"), (F.col("of") - 1).alias("idx"), "digest", "weight", F.lit(n_trees).alias("n"))
    above, roots, over_built = build_levels(over, n_trees, fan, lift)
    root = roots.select("digest", "level").first()
    root, height = (bytes(root["digest"]), root["level"]) if root else (b"", 0)

    last = F.ceil(F.col("n") / F.lit(fan)) == 1  # the parent is the only node of its level
    to_top = (F.col("tree") > 0) & last
    linked = below.union(above).select(
        "tree", "level", "idx", "before", "after", "weight",
        F.when(to_top, 0).otherwise(F.col("tree")).cast("bigint").alias("parent_tree"),
        F.when(to_top, 0).otherwise(F.col("level") + 1).cast("int").alias("parent_level"),
        F.when(to_top, F.col("tree") - 1).otherwise(F.floor(F.col("idx") / F.lit(fan))).cast("bigint").alias("parent_idx"),
        "parent_weight",
    )
    linked = staged(linked, "nodes")
    release(*built, *over_built)
    heavy, bits = _heaviest(linked, crown_nodes)
    nodes = linked.withColumn("parent_heavy", F.col("parent_weight") >= heavy)

    lone = F.col("n") == 1
    start = leaves.select(
        "place", F.when(lone, 0).otherwise(F.col("tree")).cast("bigint").alias("tree"), F.lit(0).alias("level"),
        F.when(lone, F.col("tree") - 1).otherwise(F.col("idx")).cast("bigint").alias("idx"), F.lit(bits == 0).alias("heavy"),
        F.coalesce("altered", "leaf").alias("folded"), F.lit(None).cast("binary").alias("siblings"), F.lit(0).alias("step"),
    )
    lower = start if bits == 0 else climb(start, nodes.where(F.col("weight") < heavy), False)
    upper = climb(lower.where("heavy"), nodes.where(F.col("weight") >= heavy), True)
    release(linked)
    at_root = (F.col("tree") == 0) & (F.col("level") == height)
    steps = lower.where("NOT heavy").union(upper).select(
        "place", "step", "siblings", F.when(at_root, F.col("folded")).alias("folded"),
        *(F.lit(None).cast(kind).alias(c) for c, kind in (*((x, docs.schema[x].dataType) for x in ("doc_id",)), ("leaf", "binary"), ("of_tree", "bigint"))),
    )
    known = leaves.select(
        "place", F.lit(-1).alias("step"), F.lit(None).cast("binary").alias("siblings"), F.lit(None).cast("binary").alias("folded"),
        "doc_id", "leaf", F.col("tree").alias("of_tree"),
    )
    met = F.array_sort(F.collect_list(F.when(F.col("siblings").isNotNull(), F.struct("step", "siblings"))))
    found = steps.union(known).groupBy("place").agg(
        F.max("doc_id").alias("doc_id"), F.max("leaf").alias("leaf"), F.max("of_tree").alias("of_tree"), F.max("folded").alias("folded"), met.alias("met")
    )
    proof = F.sha2(F.array_join(F.transform("met", lambda x: F.lower(F.hex(x["siblings"]))), ""), 256)
    found = found.join(small(subroots), F.col("of_tree") == F.col("of"))
    text = lambda c: F.lower(F.hex(F.col(c)))
    return found.select(
        "doc_id", text("leaf").alias("leaf"), text("digest").alias("subroot"), F.lit(root.hex()).alias("root"), proof.alias("proof_sha256"),
        text("folded").alias("folded_root"), (text("folded") == F.lit(root.hex())).alias("verified"),
    )


def _heaviest(nodes: DataFrame, limit: int) -> tuple[int, int]:
    """The smallest power of two that at most ``limit`` nodes reach in weight, and its exponent; read from counts per exponent."""
    counts = {row["b"]: row["count"] for row in nodes.groupBy(_bits("weight").alias("b")).count().collect()}
    bits = max(counts, default=-1) + 1
    while bits and sum(n for b, n in counts.items() if b >= bits - 1) <= limit:
        bits -= 1
    return 1 << bits, bits


def op13_merkle_climb(spark, sf_dir):
    return manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_H = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode({0}::VARCHAR))::VARCHAR || ':' || {0}::VARCHAR END"
_LEAF = " || ".join(_H.format(c) for c in FIELDS)
ORACLE_SQL = rf"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, lang, n_chars, sha256({_LEAF}) AS leaf,
    sha256({_LEAF.replace("n_chars", "(n_chars::HUGEINT + 1)")}) AS altered, xor(list_reduce(list_concat([4294967295::BIGINT],
      flatten(list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda p: [ascii(substr(doc_id::VARCHAR, p::INT, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda x, e: xor(xor(x, e) >> 1, 3988292384 * (xor(x, e) & 1))), 4294967295) % {TAMPER_DIVISOR} = 0 AS tampered FROM documents),
  l AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS t, count(*) OVER (PARTITION BY lang) AS n FROM d),
  a AS (SELECT t, 0 AS level, i, leaf AS h, n FROM l UNION ALL
    SELECT t, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 1) // 2) FROM a WHERE n > 1 GROUP BY t, level, i // 2),
  s AS MATERIALIZED (SELECT t, h, count(*) OVER () AS n FROM a WHERE n = 1),
  b AS (SELECT 0 AS level, t AS i, h, n FROM s UNION ALL
    SELECT level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 1) // 2) FROM b WHERE n > 1 GROUP BY level, i // 2),
  m AS MATERIALIZED (SELECT t, level, i, h, n FROM a UNION ALL SELECT -1, level, i, h, n FROM b),
  links AS MATERIALIZED (SELECT x.t, x.level, x.i, coalesce(y.h, '') AS sib, x.i % 2 AS r FROM m x
    LEFT JOIN m y ON x.t = y.t AND x.level = y.level AND y.i = xor(x.i, 1) WHERE x.n > 1),
  top AS (SELECT h AS root FROM b WHERE n = 1),
  c AS (SELECT t AS tree, i AS leaf_i, t AS spot, 0 AS level, i, CASE WHEN tampered AND n_chars IS NOT NULL THEN altered ELSE leaf END AS f,
      '' AS proof, n FROM l UNION ALL
    SELECT tree, leaf_i, CASE WHEN n = 1 THEN -1 ELSE spot END, CASE WHEN n = 1 THEN 0 ELSE c.level + 1 END, CASE WHEN n = 1 THEN spot ELSE c.i // 2 END,
      CASE WHEN n = 1 THEN f WHEN r = 0 THEN sha256(f || sib) ELSE sha256(sib || f) END, proof || CASE WHEN n = 1 THEN '' ELSE sib END,
      CASE WHEN n = 1 THEN (SELECT count(*) FROM s) ELSE (n + 1) // 2 END
    FROM c LEFT JOIN links k ON k.t = c.spot AND k.level = c.level AND k.i = c.i WHERE n > 1 OR spot >= 0)
SELECT l.doc_id, l.leaf, s.h AS subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified
FROM l JOIN s USING (t) JOIN c ON c.tree = l.t AND c.leaf_i = l.i AND c.spot = -1 AND c.n = 1, top
"""
