"""Bulk add of ready vectors."""

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom import schemas
from vecloom.functions import metadata, vectors
from vecloom.functions import text as T
from vecloom.operators import numbering
from vecloom.store import VectorStore


def dim_violations(df: DataFrame, dim: int, vector: str = "embedding") -> DataFrame:
    return df.where(vectors.wrong_dimension(F.col(vector), dim))


def vector_faults(df: DataFrame, dim: int, vector: str = "embedding") -> DataFrame:
    """Rows whose vector :func:`add_vectors` would not store, with the ``reason``."""
    return df.withColumn("reason", vectors.fault(F.col(vector), dim)).where(F.col("reason").isNotNull())


def vector_items(df: DataFrame, doc_type: str | None, embedding: str = "embedding") -> DataFrame:
    """Unit vector, random id and metadata of each row; a row's own ``metadata`` map wins over the common fields."""
    columns = df.columns
    base = metadata.metadata_map(
        {
            "doc_type": F.lit(doc_type).cast("string"),
            "url": F.col("url") if "url" in columns else F.lit(None),
            "created_at": T.shown_time(F.current_timestamp()),
        }
    )
    own = F.col("metadata") if "metadata" in columns else F.lit(None)
    return df.select(
        "vec_id",
        vectors.normalize(F.col(embedding)).alias("embedding"),
        T.external_id_16().alias("external_id"),
        (F.col("text") if "text" in columns else F.lit(None)).cast("string").alias("text"),
        metadata.merge(base, own.cast(schemas.METADATA)).alias("metadata"),
    )


def add_vectors(
    store: VectorStore,
    df: DataFrame,
    doc_type: str | None = None,
    order_by: Sequence[str] = (),
    on_mismatch: Literal["raise", "reject"] = "raise",
    keep_text: bool = False,
    dim: int | None = None,
) -> dict:
    """Append ``embedding`` rows (optional ``url``, ``text``, ``metadata`` map) to the store.

    The first add fixes the dimension: ``dim``, or the commonest length of its vectors. A vector of another length or
    with null, NaN or infinite elements makes the call fail with nothing added, or is left out and counted with
    ``on_mismatch="reject"``. Null and empty vectors are left out and counted as ``skipped``. Ids follow ``order_by``
    when it is given, at the cost of one range shuffle.
    """
    if dim is not None:
        store.check_dim(dim)
    dim = store.head.dim if store.head.dim is not None else dim
    if dim is None:
        lengths = df.where(F.size("embedding") > 0).groupBy(F.size("embedding").alias("n")).count()
        commonest = lengths.orderBy(F.desc("count"), "n").first()
        if commonest is None:
            return {"added": 0, "rejected": 0, "skipped": df.count(), "first_id": None, "dim": None}
        dim = commonest.n
    marked = df.withColumn("_fault", vectors.fault(F.col("embedding"), dim))
    if order_by:
        marked = marked.repartitionByRange(*order_by)
    # Rows to be left out go last in their partition: kept rows are numbered by their place in the staged file.
    marked = marked.sortWithinPartitions(F.col("_fault").isNotNull(), *order_by)
    copy = numbering.stage(marked, "vectors")
    try:
        staged = copy.positioned()
        faults = {row[0]: row[1] for row in staged.where("_fault IS NOT NULL").groupBy("_fault").count().collect()}
        skipped = faults.pop("missing", 0)
        rejected = sum(faults.values())
        if rejected and on_mismatch == "raise":
            raise ValueError(f"{rejected} vectors do not fit dimension {dim} of the store: {faults}")
        first_id = store.head.next_id
        kept = staged.where("_fault IS NULL").drop("_fault", *([] if keep_text else ["text"]))
        result = numbering.number_staged(kept, first_id)
        store.write("items", vector_items(result.rows, doc_type))
        store.commit(added=result.total, dim=dim)
    finally:
        copy.discard()
    return {"added": result.total, "rejected": rejected, "skipped": skipped, "first_id": first_id, "dim": dim}
