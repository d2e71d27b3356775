"""Near-duplicate documents from bottom-k sketches, exact in the end.

A document's set is its distinct 5-word shingles; its sketch the ``SKETCH`` smallest values of one hash function over the
set. Documents of equal sets are one node. Inverted lists of the retained values give candidates:

1. Every list has a pivot, the member whose values are the most shared. Each node meets the pivot that leads most of its
   lists and is of that pivot's family. A large family of near copies has its common original as pivot and falls into one
   component here, with one candidate per member.
2. Members of one family meet by what sets them apart from the pivot. Of two members, what they have in common inside the
   pivot's set is at most the lesser of what each has in common with the pivot, which is known exactly by now. So a link
   needs either as many common values outside the pivot's set as are missing from that bound, which are counted in lists
   of such values alone, or sizes so small that none are missing, which are looked up by size. Both are exact, on full
   sets; the members of a family that are linked to nothing meet nothing.
3. Members of different families meet in the lists of the sketches. Long lists (boilerplate that many documents share) are
   only read for nodes that consist of such values to more than half; any other node shares enough of its remaining
   values with each of its near-duplicates to meet them in short lists. Lists drop pairs whose sketches have too few
   values in common, long lists counted as common where they were not read.

Nodes that are in one component already never meet, which loses no link, as links inside a component change nothing. Of
a list, the members outside its largest group meet all others, so a group of any size costs nothing by itself.

Candidates pass if the sketch of their union, estimated from both sketches, does not exclude the threshold, and links
are those whose full sets do reach it. With 96 values a pair at the threshold is missed with a probability of at most
1.1e-6 (binomial: 50 or fewer values in common, where step 3 asks for 51), with or without long lists, and of 2.8e-10 by
the estimate (43 or fewer); pairs above the threshold are missed less often.

Defined results: null and empty texts have n_shingles 0 and are linked with nothing; rows that share a doc_id are one
document; rows without doc_id are linked with nothing, have component_id null and are kept; further columns are ignored
or passed through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.llm import words as W
from vecloom.llm.components import components
from vecloom.llm.staging import free_name, small, staged

SHINGLE = 5
SKETCH = 96
NUMERATOR, DENOMINATOR = 75, 100
SLACK = 0.3  # 6.8 standard deviations of the estimate
LONG_LIST = 50
PIVOT_SHARE = 0.15  # of its values that a node meets its pivot in; nodes without such a pivot are a family each
SALT_ROWS = 512  # members of a family that meet one copy of their pivot's set
#: Share of a sketch that links have in common at least: the threshold less five standard deviations.
COMMON = 0.53


def shingle_sets(column: pa.Array, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle values (63 bits) of every row."""
    data, offsets = W.text_bytes(column)
    for a, b in W.row_slices(offsets):
        raw = data[offsets[a] : offsets[b]]
        starts, ends, words = W.split_words(raw, offsets[a : b + 1] - offsets[a], W.NOT_SPACE)
        codes = W.fingerprints(W.LOWER[raw], starts, ends)
        rolled = W.window_codes(codes, width) >> np.uint64(1)
        for i, j in zip(words[:-1].tolist(), words[1:].tolist(), strict=True):
            if j - i >= width:
                yield np.unique(rolled[i : j - width + 1])
            elif j > i:
                yield (W.window_codes(codes[i:j], j - i) ^ W.scramble(np.uint64([j - i]))) >> np.uint64(1)
            else:
                yield rolled[:0]


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int64)))


def sketches(docs: DataFrame, k: int = SKETCH) -> DataFrame:
    """doc_id, n (shingles), digest of the set (null if empty), sketch."""
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("digest", T.StringType()),
        T.StructField("sketch", T.ArrayType(T.LongType())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, kept = [], [], []
            for values in shingle_sets(batch.column(1)):
                sizes.append(len(values))
                digests.append(hashlib.blake2b(values.tobytes(), digest_size=16).hexdigest() if len(values) else None)
                kept.append(values[:k].copy())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), _lists(kept)], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(W.tidy(run), schema)


def _sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, members): the full sets of the documents in ``ids``, as sorted 8-byte values."""
    wanted = docs.select("doc_id", "text").join(small(ids), F.col("doc_id") == F.col("id"), "left_semi")
    schema = T.StructType([T.StructField("id", docs.schema["doc_id"].dataType), T.StructField("members", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = pa.array([values.tobytes() for values in shingle_sets(batch.column(1))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), members], names=schema.names)

    return wanted.mapInArrow(W.tidy(run), schema)


def _may_reach(batches: Iterator[pa.RecordBatch], k: int, least: float) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) of which the sketch of the union, made of both sketches, allows a Jaccard similarity of ``least``."""
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        (i, x), (j, y) = ((c.offsets.to_numpy(), c.values.to_numpy()) for c in (batch.column(2), batch.column(3)))
        for row in range(batch.num_rows):
            u, v = x[i[row] : i[row + 1]], y[j[row] : j[row + 1]]
            union = np.union1d(u, v)[:k]
            both = np.intersect1d(u, v, assume_unique=True)
            keep[row] = np.searchsorted(both, union[-1], side="right") >= (least - SLACK) * len(union)
        yield batch.select([0, 1]).filter(pa.array(keep))


def _confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Those of the staged pairs (a, b) whose full sets reach num / den."""
    left = nodes.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
    right = nodes.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
    fits = F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num
    near = pairs.join(left, "a").join(right, "b").where(fits).select("a", "b", "sketch_a", "sketch_b")
    near = staged(near.mapInArrow(lambda it: _may_reach(it, k, num / den), pairs.schema).distinct(), "candidates")
    sets = staged(_sets(docs, near.select(F.col("a").alias("id")).union(near.select("b")).distinct()), "sets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    with_a = near.join(sets.select(F.col("id").alias("a"), F.col("members").alias("members_a")), "a")
    full = with_a.join(sets.select(F.col("id").alias("b"), F.col("members").alias("members_b")), "b")
    return staged(full.select("a", "b", "members_a", "members_b").mapInArrow(W.tidy(run), near.schema), "links")


def _pivot_pairs(listed: DataFrame) -> DataFrame:
    """(a, b): each node with the pivot that leads most of its lists."""
    members = listed.select("rep", "size", "shared", F.explode("lists.v").alias("v"))
    pivots = staged(members.groupBy("v").agg(F.max(F.struct("shared", (-F.col("rep")).alias("r"))).alias("m")).select("v", (-F.col("m.r")).alias("pivot")), "pivots")
    led = members.join(pivots, "v").where("rep <> pivot").groupBy("rep", "size", "pivot").agg(F.count("*").alias("n"))
    led = led.where(F.col("n") >= PIVOT_SHARE * F.col("size"))
    best = led.groupBy("rep").agg(F.max(F.struct("n", (-F.col("pivot")).alias("p"))).alias("m"))
    return staged(best.select(F.col("rep").alias("a"), (-F.col("m.p")).alias("b")), "pivot-pairs")


def _families(pivot_pairs: DataFrame) -> DataFrame:
    """(node, fam): the pivot that each node has met; pivots that have met none lead their own family."""
    heads = pivot_pairs.select(F.col("b").alias("head")).distinct().join(pivot_pairs.select("a"), F.col("head") == F.col("a"), "left_anti")
    return staged(pivot_pairs.select(F.col("a").alias("node"), F.col("b").alias("fam")).union(heads.select("head", F.col("head"))), "families")


def _met(rows: DataFrame, on: list[str], group: str, facts: tuple[str, ...]) -> DataFrame:
    """Pairs (a, b) of members of a list (equal ``on``) in different groups, with both sides' facts, once per list.

    Those outside the largest group of a list meet all others, so that one large group does not cost its square.
    """
    groups = rows.groupBy(*on, F.col(group).alias("g")).agg(F.count("*").alias("k"))
    lists = groups.groupBy(*on).agg(F.max(F.struct("k", "g")).alias("top"), F.count("*").alias("groups")).where("groups > 1")
    lists = staged(lists.select(*on, F.col("top.g").alias("largest")), "open-lists")
    rows = staged(rows.join(lists, on).withColumn("minor", F.col(group) != F.col("largest")).drop("largest"), "open-members")
    a = rows.where("minor").select(*on, F.col("node").alias("a"), *(F.col(c).alias(f"{c}_a") for c in facts))
    b = rows.select(*on, F.col("node").alias("b"), *(F.col(c).alias(f"{c}_b") for c in facts), "minor")
    return a.join(b, on).where(f"{group}_a <> {group}_b AND label_a <> label_b AND (a < b OR NOT minor)")


def _ordered(pairs: DataFrame, label: str) -> DataFrame:
    return staged(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), label)


def _open_families(families: DataFrame, labels: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Members of families that are in several components: node, fam, label, n, least_n (the smallest n of the family),
    apart (not in the pivot's component), c (common values with the pivot), own (values that the pivot does not have)."""
    sized = families.join(nodes.groupBy("rep").agg(F.min("n").alias("n")), F.col("node") == F.col("rep")).drop("rep")
    known = labels.select(F.col("node").alias("known"), "label")
    members = staged(sized.join(known, F.col("node") == F.col("known"), "left").select("node", "fam", "n", F.coalesce("label", "node").alias("label")), "members")
    seen = members.groupBy("fam").agg(F.count("*").alias("k"), F.min("n").alias("least_n"), F.min("label").alias("x"), F.max("label").alias("y"))
    seen = seen.where("k > 2 AND x <> y").join(known, F.col("fam") == F.col("known"), "left")
    salts = (1 + F.floor(F.col("k") / SALT_ROWS)).cast("int").alias("salts")
    seen = staged(seen.select("fam", "least_n", F.coalesce("label", "fam").alias("head"), salts), "open-families")
    members = staged(members.join(seen, "fam"), "open-family-members")
    ids = staged(members.select(F.col("node").alias("id")).union(seen.select("fam")).distinct(), "open-ids")
    sets = staged(_sets(docs, ids), "family-sets")

    copies = seen.select("fam", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    pivots = copies.join(sets.select(F.col("id").alias("fam"), F.col("members").alias("pivot")), "fam")
    salted = members.withColumn("salt", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int")).drop("salts")
    both = salted.join(sets.select(F.col("id").alias("node"), "members"), "node").join(pivots, ["fam", "salt"])
    both = both.select("node", "fam", "label", "n", "least_n", (F.col("label") != F.col("head")).alias("apart"), "members", "pivot")
    schema = T.StructType([*both.schema.fields[:6], T.StructField("c", T.LongType()), T.StructField("own", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common, own = [], []
            for x, p in zip(batch.column(6), batch.column(7), strict=True):
                x, p = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(p.as_buffer(), np.uint64)
                own.append(np.setdiff1d(x, p, assume_unique=True))
                common.append(len(x) - len(own[-1]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(common, pa.int64()), _lists(own)], names=schema.names)

    return staged(both.mapInArrow(W.tidy(run), schema), "family-values")


def _family_pairs(opened: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): members of one family, of different components, whose full sets may reach num / den."""
    both = num + den
    # a link has at least num * (n_a + n_b) / both common values
    facts = opened.groupBy("node", "fam", "label", "least_n", "apart").agg(F.min("n").alias("n"), F.max("c").alias("c"))
    facts = facts.withColumn("partner", F.greatest("least_n", F.ceil(F.col("n") * num / den)))
    facts = staged(facts.withColumn("missing", F.ceil((F.col("n") + F.col("partner")) * num / both) - F.col("c")), "family-facts")

    rows = opened.select("node", "fam", F.explode("own").alias("v")).distinct()
    shared = staged(rows.groupBy("fam", "v").agg(F.count("*").alias("k")).where("k > 1").select("fam", "v"), "own-lists")
    rows = staged(rows.join(shared, ["fam", "v"]), "own-members")
    able = rows.groupBy("node").agg(F.count("*").alias("k")).join(facts, "node").where("k >= missing").select("node", "n", "c", "label")
    met = _met(rows.join(able, "node"), ["fam", "v"], "label", ("n", "c", "label"))
    least = F.ceil((F.col("n_a") + F.col("n_b")) * num / both) - F.least("c_a", "c_b")
    by_value = met.groupBy("a", "b", least.alias("least")).agg(F.count("*").alias("k")).where("k >= least")

    def bucket(n):
        return F.floor(8 * F.log(n)).cast("int")

    reach = F.floor(F.col("c") * both / num) - F.col("n")  # the largest partner that needs no common value of its own
    facts = facts.select("node", "fam", "label", "n", "c", "partner", reach.alias("reach"), "apart")
    near = facts.where("apart AND reach >= partner").withColumn("bucket", F.explode(F.sequence(bucket(F.col("partner")), bucket(F.col("reach")))))
    names = ("label", "n", "c")
    x = small(staged(near.select("fam", "bucket", F.col("node").alias("a"), *(F.col(c).alias(f"{c}_a") for c in names)), "seekers"))
    y = facts.select("fam", bucket(F.col("n")).alias("bucket"), F.col("node").alias("b"), *(F.col(c).alias(f"{c}_b") for c in names), "apart")
    fits = F.least("c_a", "c_b") * both >= (F.col("n_a") + F.col("n_b")) * num
    by_size = y.join(x, ["fam", "bucket"]).where(fits & F.expr("label_a <> label_b AND (a < b OR NOT apart)"))
    return _ordered(by_value.select("a", "b").union(by_size.select("a", "b")), "family-pairs")


def _open_pairs(listed: DataFrame, labels: DataFrame, families: DataFrame, long_list: int, num: int, den: int) -> DataFrame:
    """(a, b): members of a list that are of different families and components and share enough values."""
    related = listed.where(F.size("lists") >= COMMON * F.col("size"))
    known = labels.select(F.col("node").alias("known"), "label")
    related = related.join(known, F.col("rep") == F.col("known"), "left").join(families, F.col("rep") == F.col("node"), "left")
    facts = ("n", "label", "fam", "size", "held", "hot_node")
    related = related.select(F.col("rep").alias("node"), "n", F.coalesce("label", "rep").alias("label"), F.coalesce("fam", "rep").alias("fam"), "size", "held", "hot_node", F.explode("lists").alias("l"))
    values = staged(related.where(F.col("hot_node") | (F.col("l.cnt") <= long_list)).select("node", *facts, "l.v"), "list-members")
    sizes = F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num
    met = _met(values, ["v"], "fam", facts).where(sizes)
    all_lists = F.col("hot_node_a") & F.col("hot_node_b")
    least = COMMON * F.least("size_a", "size_b") - F.when(all_lists, F.lit(0)).otherwise(F.least("held_a", "held_b"))
    ordered = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), least.alias("least"))
    counted = ordered.groupBy("a", "b", "least").agg(F.count("*").alias("shared"))
    return staged(counted.where("shared >= least").select("a", "b"), "open-pairs")


def near_duplicates(
    docs: DataFrame, k: int = SKETCH, numerator: int = NUMERATOR, denominator: int = DENOMINATOR, long_list: int = LONG_LIST
) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept."""
    sketched = staged(sketches(docs, k), "sketches")
    real = sketched.where("n > 0 AND doc_id IS NOT NULL")
    classes = staged(real.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("members")), "classes")
    repeated = small(classes.where("members > 1").select(F.col("digest").alias("d"), "rep"))
    copies = real.select("doc_id", "digest").join(repeated, (F.col("digest") == F.col("d")) & (F.col("doc_id") > F.col("rep")))
    copies = small(staged(copies.select(F.col("doc_id").alias("copy"), "d").distinct(), "copies"))
    first = real.join(copies, (F.col("doc_id") == F.col("copy")) & (F.col("digest") == F.col("d")), "left_anti")
    nodes = first.select(F.col("doc_id").alias("rep"), "n", "sketch")

    values = nodes.select("rep", "n", F.size("sketch").alias("size"), F.explode("sketch").alias("v"))
    shared = staged(values.groupBy("v").agg(F.count("*").alias("cnt")).where("cnt > 1"), "shared-values")
    lists = values.join(shared, "v").groupBy("rep", "n", "size").agg(F.collect_list(F.struct("v", "cnt")).alias("lists"))
    held = F.size(F.filter("lists", lambda x: x["cnt"] > long_list))
    listed = lists.select(
        "rep", "n", "size", "lists", F.aggregate("lists", F.lit(0).cast("bigint"), lambda s, x: s + x["cnt"]).alias("shared"),
        held.alias("held"), (2 * held > F.col("size")).alias("hot_node"),
    )
    listed = staged(listed, "listed")

    pivot_pairs = _pivot_pairs(listed)
    links = _confirmed(pivot_pairs, nodes, docs, k, numerator, denominator)
    found, families = components(links), _families(pivot_pairs)
    inside = _family_pairs(_open_families(families, found, nodes, docs), numerator, denominator)
    across = _open_pairs(listed, found, families, long_list, numerator, denominator)
    more = _confirmed(inside.union(across), nodes, docs, k, numerator, denominator)
    labels = components(links.union(more))

    named = classes.join(labels, F.col("rep") == F.col("node"), "left")
    named = staged(named.select(F.col("digest").alias("d"), F.coalesce("label", "rep").alias("label")), "labelled-classes")
    out = sketched.select("doc_id", "n", "digest").join(named, F.col("digest") == F.col("d"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id")).alias("component_id")
    kept = F.col("doc_id").isNull() | (F.col("doc_id") == F.coalesce("label", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component, kept.alias("kept"))


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The documents that are kept, with all their columns."""
    name = free_name(docs, "__gone")
    gone = staged(near_duplicates(docs, **options).where(~F.col("kept")).select(F.col("doc_id").alias(name)).distinct(), "near-duplicates")
    return docs.join(small(gone), F.col("doc_id") == F.col(name), "left_anti")


def op5_bottom_k_near_dedup(spark, sf_dir):
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = r"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
  s AS MATERIALIZED (SELECT DISTINCT doc_id, md5(array_to_string(w[p:p + 4], ' ')) AS g FROM
      (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
  n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  e AS MATERIALIZED (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y USING (g)
      WHERE x.doc_id <> y.doc_id GROUP BY ALL) JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id
      WHERE 100 * i >= 75 * (na.n + nb.n - i)),
  r AS (SELECT doc_id AS x, doc_id AS c FROM d UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.x WHERE r.c < e.b),
  m AS (SELECT x, min(c) AS c FROM r GROUP BY x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c AS component_id, doc_id = c AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN m ON m.x = doc_id
"""
