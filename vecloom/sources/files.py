"""Discovery of parquet files and the ledger of finished ones."""

import re
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom import schemas
from vecloom.functions import text as T
from vecloom.session import has_files, matching_paths, remove_folder, rename_folder

PARQUET = "*.parquet"
#: Spark's file stream passes over files older than this. It must never bite, as copies often keep old times.
STREAM_MAX_AGE = "36500d"


def literal_path(path: str) -> str:
    """``path`` with the characters escaped that a reader would take for a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def _roots(root: str, allow: Sequence[str] | None) -> list[str]:
    base = root.rstrip("/")
    return [f"{base}/{pattern}" for pattern in allow] if allow else [base]


def list_files(spark: SparkSession, root: str, allow: Sequence[str] | None = None) -> DataFrame:
    """All parquet files below ``root``: ``path``, ``file_uri`` (as rows of the file report it) and ``length``.

    ``allow`` restricts the listing to path globs relative to ``root``. File contents are not read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", PARQUET)
    return file_columns(reader.load(_roots(root, allow)))


def stream_files(spark: SparkSession, root: str, max_files: int, max_bytes: str | None = None) -> DataFrame:
    """The same columns as a stream of files that arrive below ``root``."""
    reader = spark.readStream.format("binaryFile").schema(schemas.BINARY_FILE)
    reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", PARQUET)
    reader = reader.option("maxFileAge", STREAM_MAX_AGE)
    bound = ("maxBytesPerTrigger", max_bytes) if max_bytes else ("maxFilesPerTrigger", max_files)
    return file_columns(reader.option(*bound).load(root))


def file_columns(files: DataFrame) -> DataFrame:
    return files.select("path", F.col("_metadata.file_path").alias("file_uri"), "length")


def unprocessed(files: DataFrame, processed: DataFrame) -> DataFrame:
    """Files the ledger does not name, with ``from_row``, the first row to read. Files whose read broke off are offered
    again, as are files that a row limit cut, from the row behind the last one taken."""
    done = processed.where(~F.col("status").isin("failed", "limited")).select(F.col("path").alias("file_uri"))
    left = files.join(done, "file_uri", "left_anti")
    if "last_row" not in processed.columns:
        return left.withColumn("from_row", F.lit(0).cast("bigint"))
    cut = processed.where(F.col("status") == "limited").groupBy(F.col("path").alias("file_uri")).agg(F.max("last_row").alias("_last"))
    return left.join(cut, "file_uri", "left").withColumn("from_row", F.coalesce(F.col("_last") + 1, F.lit(0))).drop("_last")


def to_retry(spark: SparkSession, processed: DataFrame) -> DataFrame | None:
    """Files of the ledger that are to be read again and still exist, in the columns of :func:`list_files`."""
    finished = processed.where(~F.col("status").isin("failed", "limited")).select("path")
    open_paths = processed.where(F.col("status").isin("failed", "limited")).select("path").distinct().join(finished, "path", "left_anti")
    paths = [unquote(row.path) for row in open_paths.collect()]
    paths = [path for path in map(literal_path, paths) if has_files(spark, path)]
    if not paths:
        return None
    return file_columns(spark.read.format("binaryFile").load(paths))


def read_ledger_text(spark: SparkSession, path: str) -> DataFrame:
    """A plain text ledger, one path per line; blank lines are dropped."""
    lines = spark.read.text(path).select(T.strip(F.col("value")).alias("path")).where(F.col("path") != "")
    return lines.select(
        "path", F.lit("ok").alias("status"), F.lit(None).cast("bigint").alias("rows_sent"),
        F.lit(None).cast("bigint").alias("rows_skipped"), F.lit(None).cast("bigint").alias("last_row"),
    )


def read_metadata_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.METADATA_LINE).json(path)


def export_watermark(spark: SparkSession, path: str) -> int:
    """The largest id of the exports published below ``path``, 0 if there is none."""
    ends = matching_paths(spark, f"{literal_path(path)}/from-*/to-*")
    return max((int(end.rsplit("-", 1)[1]) for end in ends), default=0)


def publish_metadata_lines(df: DataFrame, path: str, first: int, last: int) -> bool:
    """Write ``id, url, created_at`` as JSON lines and publish them below ``path`` together with their range of ids.

    An export becomes visible by one rename to ``from-<first>``, which fails if there is one, so of two exports that begin at
    the same id one is refused, and one that died leaves nothing that is read.
    """
    spark = df.sparkSession
    pending = f"{path}/pending/{uuid.uuid4().hex}"
    write_metadata_lines(df, f"{pending}/to-{last}")
    if rename_folder(spark, pending, f"{path}/from-{first}"):
        return True
    remove_folder(spark, pending)
    return False


def read_exported_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.METADATA_LINE).json(f"{literal_path(path)}/from-*/to-*")


def write_metadata_lines(df: DataFrame, path: str) -> None:
    """Append ``id, url, created_at`` as JSON lines; nulls are written."""
    df.select("id", "url", "created_at").write.mode("append").option("ignoreNullFields", "false").json(path)
