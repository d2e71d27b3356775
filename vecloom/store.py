"""The vector store: append-only parquet tables whose batches become visible by one small commit row.

    <root>/items/batch=N/run=R       vectors with their metadata
    <root>/documents/batch=N/run=R   document registry
    <root>/processed/batch=N/run=R   ledger of finished files
    <root>/known/batch=N/run=R       bitmaps of the hashes of the documents
    <root>/regions/build=B           regions of the vectors of whole batches, made by index_regions
    <root>/info/version=N            one row; version N makes run R of batch N of every table visible

A run writes its rows under batch N+1 and a run name of its own, then its info row in a folder beside, and commits by
renaming that folder to version N+1, which fails if there is one. So of two writers one commits and the other is
refused, and neither touches the other's rows. Readers filter on batch and run, partition columns, and never see half
a batch or the rows of a run that died or was refused.
"""

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from vecloom import schemas
from vecloom.operators import membership, regions
from vecloom.session import has_files, make_folder, remove_folder, rename_folder, ship_package

_TABLES = {"items": schemas.ITEMS, "documents": schemas.DOCUMENTS, "processed": schemas.PROCESSED, "known": schemas.KNOWN}
ITEMS_PER_FILE = 500_000
LAYOUT = 2
#: Filters for single values of columns with many; their size follows from the values of a row group.
_BLOOM = {"parquet.bloom.filter.adaptive.enabled": "true"} | {f"parquet.bloom.filter.enabled#{c}": "true" for c in ("url", "doc_ref")}


@dataclass(frozen=True)
class Head:
    version: int
    model_name: str | None
    dim: int | None
    next_id: int


class VectorStore:
    def __init__(self, spark: SparkSession, root: str, model_name: str | None = None, keep_full_text: bool = False):
        self.spark, self.root, self.keep_full_text = ship_package(spark), root.rstrip("/"), keep_full_text
        self._model_name = model_name
        self._run = uuid.uuid4().hex
        if not self._committed(0):
            for name in _TABLES:
                make_folder(spark, f"{self.root}/{name}")
            self._publish(Head(0, model_name, None, 1))
            self._run = uuid.uuid4().hex  # a run's name stands for one batch
        self.head = self._load_head()

    def _committed(self, version: int) -> bool:
        return has_files(self.spark, f"{self.root}/info/version={version}/*.parquet")

    # ---- reading ----
    def _load_head(self) -> Head:
        history = self._read("info", schemas.INFO, "version").orderBy("version").collect()
        base = max((i for i, row in enumerate(history) if row.compacted), default=0)
        self._history = history[base:]
        last = self._history[-1]
        return Head(last.version, last.model_name or self._model_name, last.dim, last.next_id)

    def _read(self, name: str, schema: StructType, *partitions: StructField | str) -> DataFrame:
        fields = [StructField(p, IntegerType()) if isinstance(p, str) else p for p in partitions]
        return self.spark.read.schema(StructType([*schema.fields, *fields])).parquet(f"{self.root}/{name}")

    def _visible(self, name: str) -> DataFrame:
        return self._committed_rows(name).drop("batch")

    def _committed_rows(self, name: str) -> DataFrame:
        rows = self._read(name, _TABLES[name], "batch", StructField("run", StringType()))
        runs = [row.run for row in self._history if row.version <= self.head.version]
        return rows.where((F.col("batch") <= self.head.version) & F.col("run").isin(runs)).drop("run")

    def items_by_batch(self) -> DataFrame:
        """Items with their ``batch``, the partition column."""
        return self._committed_rows("items")

    def batch_starts(self) -> tuple[list[int], list[int]]:
        """First id and number of each batch that holds items, ascending: one entry per committed run."""
        history = [row for row in self._history if row.version <= self.head.version]
        pairs = [(before.next_id, row.version) for before, row in zip(history, history[1:]) if row.next_id > before.next_id]
        if history and history[0].compacted and history[0].next_id > 1:
            pairs.insert(0, (1, history[0].version))
        return [first for first, _ in pairs], [version for _, version in pairs]

    def refresh(self) -> "VectorStore":
        self.head = self._load_head()
        return self

    def items(self) -> DataFrame:
        return self._visible("items")

    def vectors(self) -> DataFrame:
        return self.items().select("vec_id", "embedding")

    def meta(self) -> DataFrame:
        return self.items().select("vec_id", "external_id", "text", "metadata")

    def documents(self) -> DataFrame:
        return self._visible("documents")

    def processed(self) -> DataFrame:
        return self._visible("processed")

    @property
    def has_layout(self) -> bool:
        """Whether all visible batches have promoted columns, and bitmaps of their documents."""
        return all(row.layout == LAYOUT for row in self._history if row.version <= self.head.version)

    def known_hashes(self) -> DataFrame | None:
        """``bits, bucket, bitmap`` over all commits, or None if a batch is older than the bitmaps."""
        if not self.has_layout:
            return None
        return membership.combined(self._visible("known"))

    def regions(self) -> tuple[DataFrame, list[int]] | None:
        """Regions of visible batches and the numbers of these batches, one per commit; None if there are none."""
        if not has_files(self.spark, f"{self.root}/regions/build=*/*.parquet"):
            return None
        known = self._read("regions", regions.REGIONS, StructField("build", StringType()))
        known = known.where(F.col("batch").isin(self.batch_starts()[1]))
        covered = sorted(row.batch for row in known.select("batch").distinct().collect())
        return (known.drop("build"), covered) if covered else None

    def info(self) -> DataFrame:
        return self._read("info", schemas.INFO, "version").where(F.col("version") == self.head.version).drop("version", "run")

    def chunks(self) -> DataFrame:
        """Typed view of the chunk fields that document vectors carry in their metadata."""
        field = F.col("metadata").getItem
        rows = self.items().where(field("doc_ref").isNotNull())
        return rows.select(
            "vec_id",
            field("doc_ref").alias("doc_ref"),
            field("chunk_index").cast("int").alias("chunk_index"),
            field("total_chunks").cast("int").alias("total_chunks"),
            field("sha1").alias("sha1"),
            F.from_json(field("h_path"), "array<string>").alias("h_path"),
            field("char_start").cast("int").alias("char_start"),
            field("char_end").cast("int").alias("char_end"),
            "external_id",
        )

    # ---- writing ----
    @property
    def next_batch(self) -> int:
        return self.head.version + 1

    def check_dim(self, dim: int) -> None:
        if self.head.dim is not None and self.head.dim != dim:
            raise ValueError(f"vectors of dimension {dim} do not fit this store of dimension {self.head.dim}")

    def _folder(self, name: str) -> str:
        return f"{self.root}/{name}/batch={self.next_batch}/run={self._run}"

    def write(self, name: str, rows: DataFrame) -> None:
        """Write this run's rows of a table; invisible until :meth:`commit`. Columns not given become null."""
        given = set(rows.columns)
        shaped = rows.select(
            *[
                self._column(name, f.name, given).cast(f.dataType).alias(f.name)
                for f in _TABLES[name].fields
            ]
        )
        shaped.write.mode("overwrite").options(**(_BLOOM if name == "items" else {})).parquet(self._folder(name))

    def _column(self, table: str, name: str, given: set[str]) -> Column:
        if name in given:
            return F.col(name)
        promoted = table == "items" and name in schemas.PROMOTED and "metadata" in given
        return F.col("metadata")[name] if promoted else F.lit(None)

    def written(self, name: str) -> DataFrame:
        """Rows this run has written and not yet committed."""
        return self.spark.read.schema(_TABLES[name]).parquet(self._folder(name))

    def _publish(self, head: Head, compacted: bool = False) -> bool:
        """Make ``head`` the version of its number; False if another run has done so."""
        row = self.spark.range(1, numPartitions=1).select(
            F.lit(head.model_name).cast("string").alias("model_name"),
            F.lit(head.dim).cast("int").alias("dim"),
            F.lit(head.next_id).cast("bigint").alias("next_id"),
            F.current_timestamp().alias("created_or_updated_at"),
            F.lit(self._run).alias("run"),
            F.lit(compacted).alias("compacted"),
            F.lit(LAYOUT).cast("int").alias("layout"),
        )
        pending = f"{self.root}/pending/{self._run}"
        row.write.mode("overwrite").parquet(pending)
        make_folder(self.spark, f"{self.root}/info")
        published = rename_folder(self.spark, pending, f"{self.root}/info/version={head.version}")
        if not published:
            remove_folder(self.spark, pending)
        return published

    def discard_run(self) -> None:
        """Remove what this run has written and not committed, and begin a new run."""
        for name in _TABLES:
            remove_folder(self.spark, self._folder(name))
        self._run = uuid.uuid4().hex

    def commit(
        self, *, added: int = 0, dim: int | None = None, model_name: str | None = None, compacted: bool = False
    ) -> None:
        """Make the written batch visible."""
        old = self.head
        dim = old.dim if old.dim is not None else dim
        head = Head(self.next_batch, model_name or old.model_name, dim, old.next_id + added)
        if self._committed(self.next_batch) or not self._publish(head, compacted):
            self.discard_run()
            raise RuntimeError("another writer has committed to this store; refresh it and try again")
        row = Row(version=head.version, next_id=head.next_id, run=self._run, compacted=compacted, layout=LAYOUT)
        self._history = [*([] if compacted else self._history), row]
        self.head, self._run = head, uuid.uuid4().hex


def index_regions(store: VectorStore, region_rows: int = regions.REGION_ROWS) -> list[int]:
    """Describe the regions of the batches that have none, so that searches can pass over regions without hits.

    Returns the batches described. Their regions become visible together by one rename; two runs at once describe a
    batch twice, which does no harm. Batches without regions, as later ones, are searched in full.
    """
    known = store.regions()
    missing = sorted(set(store.batch_starts()[1]) - set(known[1] if known else ()))
    if not missing:
        return []
    rows = store.items_by_batch().where(F.col("batch").isin(missing)).select("batch", "vec_id", "embedding")
    build = uuid.uuid4().hex
    pending = f"{store.root}/pending/regions-{build}"
    regions.describe(rows, store.head.dim, region_rows).write.parquet(pending)
    make_folder(store.spark, f"{store.root}/regions")
    rename_folder(store.spark, pending, f"{store.root}/regions/build={build}")
    return missing


def compact(store: VectorStore, items_per_file: int = ITEMS_PER_FILE) -> None:
    """Write all visible rows anew as one batch of larger files and commit it; ids stay, searches need no earlier batch.

    Items stay in ranges of ids. Earlier batches are left for readers that opened the store before; :func:`vacuum`
    removes them. A commit of another writer meanwhile refuses the compaction, which can be run again.
    """
    items = store.items()
    files = max(1, -(-(store.head.next_id - 1) // items_per_file))
    items = items.drop(*schemas.PROMOTED)  # taken from the metadata anew, as older batches have none
    store.write("items", items.repartitionByRange(files, "vec_id").sortWithinPartitions("vec_id"))
    store.write("known", membership.bitmaps(store.documents().select("full_text_sha1"), store.head.next_id))
    for name in ("documents", "processed"):
        store.write(name, store._visible(name).repartition(max(1, files // 4)))
    store.commit(compacted=True)


def vacuum(store: VectorStore) -> int:
    """Remove the batches and versions before the last compaction, which no reader opened since can see. Returns how
    many versions were removed. Readers that still use an earlier version fail and have to refresh."""
    base = store.refresh()._history[0]
    if not base.compacted:
        return 0
    versions = store._read("info", schemas.INFO, "version").where(F.col("version").between(1, base.version - 1))
    gone = [row.version for row in versions.select("version").collect()]
    for version in gone:
        for name in _TABLES:
            remove_folder(store.spark, f"{store.root}/{name}/batch={version}")
        remove_folder(store.spark, f"{store.root}/info/version={version}")
    return len(gone)


def open_store(
    spark: SparkSession, root: str, model_name: str | None = None, keep_full_text: bool = False
) -> VectorStore:
    """Open the store at ``root``, creating empty tables when there are none. A broken store raises."""
    return VectorStore(spark, root, model_name, keep_full_text)
