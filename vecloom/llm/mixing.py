"""Mixing sources to target weights by Pareto order sampling.

A source that is to give r times its words gives each document floor(r) certain copies; one more copy goes to a sample
with inclusion probability p = r - floor(r). Documents are ranked by their random odds u / (1 - u) divided by their
inclusion odds p / (1 - p) and taken in that order until the words still missing are reached, so that the size of the
sample is fixed in words. The last document is taken if that comes nearer to the target.

Inside a source the inclusion odds are constant, so the order by Pareto rank is the order by u; u comes from an MD5 of
doc_id and text, and the MD5 itself breaks ties. Reruns and retried tasks therefore agree. The cut is found without
sorting a source: words are summed per 1/4096 of the hash range, and only the slice in which the cut lies is ordered.

Defined results: sources are ordered by code point, a null source is a source and comes last; a null text has no words;
a source without words has target 0 and gives nothing; rows with equal doc_id and text are taken together; columns
other than doc_id, source and text are ignored or passed through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.llm import words as W
from vecloom.llm.staging import small, staged

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
SLICE_DIGITS = 3


def rank_key(seed: int) -> Column:
    """Hexadecimal random rank of a document."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit("")))))


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, source, rank key and number of words of each document."""
    narrow = docs.select("doc_id", F.col("source").cast("string").alias("source"), rank_key(seed).alias("h"), "text")
    schema = T.StructType([*narrow.drop("text").schema.fields, T.StructField("size", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.text_bytes(batch.column(3))
            counts = [np.zeros(0, np.int64)]
            for a, b in W.row_slices(offsets):
                raw = data[offsets[a] : offsets[b]]
                counts.append(np.diff(W.split_words(raw, offsets[a : b + 1] - offsets[a], W.NOT_SPACE)[2]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.concatenate(counts), pa.int64())], names=schema.names)

    return narrow.mapInArrow(run, schema)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, target from (source, source_size): shares by weight, none above ``most`` times its size.

    The excess of capped sources goes to the others by weight. That ends where one common rate per weight serves all
    sources below their cap: with sources ordered by cap per weight, those before the first that the rate of the
    remaining ones suits are capped.
    """
    every = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weighed = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("bigint"))
    weighed = weighed.withColumn("cap", F.lit(most).cast("bigint") * F.col("source_size"))
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), F.asc_nulls_last("source"))
    upto = by_cap.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = weighed.select(
        "*",
        F.row_number().over(by_cap).alias("i"),
        (F.sum("source_size").over(every) - F.sum("cap").over(upto) + F.col("cap")).alias("rest"),
        (F.sum("w").over(every) - F.sum("w").over(upto) + F.col("w")).alias("rest_w"),
    )
    fits = F.col("rest") * F.col("w") <= F.col("cap") * F.col("rest_w")
    first = F.min(F.when(fits, F.struct("i", "rest", "rest_w"))).over(every)
    met = ranked.withColumn("first", first)
    target = F.when(F.col("i") >= F.col("first.i"), F.col("first.rest").cast("double") * F.col("w") / F.col("first.rest_w"))
    return met.select("source", "source_size", F.coalesce(target, F.col("cap").cast("double")).alias("target"))


def _plan(sized: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """Per source: source_size, target, certain copies and the largest rank key that gets one copy more."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    full = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most)))
    sources = source_targets(totals, weights, most).withColumn("full", F.coalesce(full, F.lit(0)).cast("bigint"))
    sources = staged(sources.withColumn("need", F.col("target") - F.col("full") * F.col("source_size")), "mix-sources")

    part = F.substring("h", 1, SLICE_DIGITS)
    sliced = sized.groupBy("source", part.alias("slice")).agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = sliced.withColumn("upto", F.sum("words").over(upto))
    need = small(sources.select(F.col("source").alias("of"), "need"))
    crossing = summed.join(need, F.col("source").eqNullSafe(F.col("of"))).where("upto - words <= need AND need < upto")
    crossing = staged(crossing.select("of", "slice", (F.col("upto") - F.col("words")).alias("before"), "need"), "mix-slices")

    inside = sized.join(small(crossing), F.col("source").eqNullSafe(F.col("of")) & (part == F.col("slice")))
    tied = inside.groupBy("of", "slice", "before", "need", "h").agg(F.sum("size").alias("words"))
    order = Window.partitionBy("of").orderBy("h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = tied.withColumn("upto", F.col("before") + F.sum("words").over(order))
    nearer = F.col("upto") - F.col("need") < F.col("need") - (F.col("upto") - F.col("words"))
    taken = F.max(F.when((F.col("upto") <= F.col("need")) | ((F.col("upto") - F.col("words") <= F.col("need")) & nearer), F.col("h")))
    cuts = run.groupBy("of", "slice").agg(taken.alias("last")).select("of", F.coalesce("last", "slice").alias("cut"))
    # no crossing slice: either nothing is missing, or all words are (which rounding may leave just short of a copy)
    cut = F.coalesce("cut", F.when(F.col("need") > 0, F.lit("g")).otherwise(F.lit("")))
    joined = sources.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left")
    return staged(joined.select("source", "source_size", "target", "full", cut.alias("cut")), "mix-plan")


def _copies(rows: DataFrame, plan: DataFrame, most: int) -> DataFrame:
    """``rows`` (with __source and __h) plus __size, __target and __copies."""
    named = plan.select(*(F.col(c).alias(f"__{c}_of") for c in plan.columns))
    joined = rows.join(small(named), F.col("__source").eqNullSafe(F.col("__source_of")), "left")
    more = F.col("__full_of") + (F.col("__h") <= F.col("__cut_of")).cast("bigint")
    return joined.withColumn("__copies", F.least(more, F.lit(most).cast("bigint")))


def mix_report(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: int = 9) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target (its source's), copies, taken (words with repeats)."""
    sized = staged(_sized(docs, seed), "mix-sizes")
    rows = sized.select("*", F.col("source").alias("__source"), F.col("h").alias("__h"))
    return _copies(rows, _plan(sized, weights, most), most).select(
        "doc_id", "source", "size", F.col("__source_size_of").alias("source_size"), F.col("__target_of").alias("target"),
        F.col("__copies").alias("copies"), (F.col("__copies") * F.col("size")).alias("taken"),
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: int = 9) -> DataFrame:
    """The mixture: every document as often as it is taken, with the columns of ``docs``."""
    plan = _plan(staged(_sized(docs, seed), "mix-sizes"), weights, most)
    # a row is held as one value, so that no column of it can clash with those beside it
    rows = docs.select(F.struct("*").alias("row"), F.col("source").cast("string").alias("__source"), rank_key(seed).alias("__h"))
    copies = F.array_repeat(F.lit(0), F.col("__copies").cast("int"))
    return _copies(rows, plan, most).withColumn("copy", F.explode(copies)).select("row.*")


def op9_pareto_mix(spark, sf_dir):
    return mix_report(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
      md5(concat('9:', coalesce(doc_id::VARCHAR, ''), ':', md5(coalesce(text, '')))) AS h FROM documents),
  s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
  w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS w, 3 * source_size AS cap FROM s),
  r AS (SELECT *, row_number() OVER o AS i, (SELECT sum(source_size) FROM w) - sum(cap) OVER o + cap AS rest,
      (SELECT sum(w) FROM w) - sum(w) OVER o + w AS rest_w FROM w WINDOW o AS (ORDER BY cap / w, source NULLS LAST)),
  f AS (SELECT min(i) AS fi, arg_min(rest, i) AS fr, arg_min(rest_w, i) AS fw FROM r WHERE rest * w <= cap * rest_w),
  t AS (SELECT source, source_size, coalesce(CASE WHEN i >= fi THEN fr::DOUBLE * w / fw END, cap::DOUBLE) AS target FROM r, f),
  p AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END AS fl FROM t),
  q AS (SELECT *, target - fl * source_size AS need FROM p),
  k AS (SELECT doc_id, size, d.source, source_size, target, fl, need, h,
      sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE UNBOUNDED PRECEDING) AS upto,
      sum(size) OVER (PARTITION BY d.source, h) AS tied FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target, size * least(fl::BIGINT + (need > 0 AND (upto <= need OR
  (upto - tied <= need AND upto - need < need - (upto - tied))))::BIGINT, 3)::BIGINT AS taken FROM k
"""
