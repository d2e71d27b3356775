"""Scan of text files whose text and url columns have different names."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from vecloom.functions import text as T
from vecloom.sources.files import literal_path

COLUMNS = "file_uri string, row_index bigint, text string, url string"


def _group_schema(text_col: str, text_type: str, url_col: str | None, url_type: str | None) -> StructType:
    fields = [StructField(text_col, DataType.fromDDL(text_type))]
    if url_col:
        fields.append(StructField(url_col, DataType.fromDDL(url_type)))
    return StructType(fields)


def _read_group(spark: SparkSession, key: tuple, paths: Sequence[str]) -> DataFrame:
    text_col, _, url_col, _ = key
    # A bad footer was sorted out by the census. ignoreCorruptFiles turns a page that breaks later into missing
    # rows, which ingest detects by comparing the rows scanned with the rows the footer promises.
    rows = spark.read.schema(_group_schema(*key)).option("ignoreCorruptFiles", "true").parquet(*map(literal_path, paths))
    url = F.col(f"`{url_col}`").cast("string") if url_col else F.lit(None).cast("string")
    row_index = F.col("_metadata.row_index")
    return rows.select(
        F.col("_metadata.file_path").alias("file_uri"),
        row_index.alias("row_index"),
        T.strip(F.col(f"`{text_col}`").cast("string")).alias("text"),
        T.default_url(url, F.col("_metadata.file_name"), row_index).alias("url"),
    )


def read_corpus(spark: SparkSession, files: Sequence[Row]) -> DataFrame:
    """``file_uri, row_index, text, url`` of census rows with status ok; text is stripped, url never empty.

    Which column is read is decided per file by its schema, never per row: files are grouped by their resolved
    columns and types, and there is one scan per group.
    """
    groups: dict[tuple, list[str]] = {}
    for file in files:
        groups.setdefault((file.text_col, file.text_type, file.url_col, file.url_type), []).append(file.path)
    if not groups:
        return spark.createDataFrame([], COLUMNS)
    rows = reduce(DataFrame.unionByName, [_read_group(spark, key, paths) for key, paths in groups.items()])
    for file in files:
        if file.from_row:  # files that a row limit had cut, a few at most
            rows = rows.where((F.col("file_uri") != file.file_uri) | (F.col("row_index") >= file.from_row))
    return rows


def in_band(corpus: DataFrame, low: int, high: int) -> DataFrame:
    """Rows whose ``text`` has low..high characters. Exploding a filtered one-element array evaluates the text
    expression once; a WHERE is pushed below the projection and strips each text again for every comparison."""
    kept = F.filter(F.array("text"), lambda text: T.in_length_band(text, low, high))
    return corpus.select(*[c for c in corpus.columns if c != "text"], F.explode(kept).alias("text"))
