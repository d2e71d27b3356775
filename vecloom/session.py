"""Session settings and the shared folder that holds staged tables."""

import shutil
import tempfile
import uuid
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_LOCAL_FALLBACK: dict[str, str] = {}
_SHIPPED: set[str] = set()


def build_session(app_name: str = "vecloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Make this package importable in the Python workers of the application, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parent
        archive = f"{tempfile.mkdtemp(prefix='vecloom-')}/{package.name}"
        spark.sparkContext.addPyFile(shutil.make_archive(archive, "zip", package.parent, package.name))
        _SHIPPED.add(app)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    Only a local session may run without the setting; a cluster must name a shared folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FALLBACK:
        _LOCAL_FALLBACK[app] = tempfile.mkdtemp(prefix="vecloom-")
    return _LOCAL_FALLBACK[app]


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/vecloom/{label}-{uuid.uuid4().hex}"


def _hadoop_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def has_files(spark: SparkSession, pattern: str) -> bool:
    fs, target = _hadoop_path(spark, pattern)
    return bool(fs.globStatus(target))


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    fs, target = _hadoop_path(spark, pattern)
    return [status.getPath().toString() for status in fs.globStatus(target) or []]


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _hadoop_path(spark, path)
    fs.mkdirs(target)


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, target = _hadoop_path(spark, path)
    if fs.exists(target):
        fs.delete(target, True)


def rename_folder(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder unless the target exists, in one step where the file system has atomic renames."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    paths = [hadoop.Path(source), hadoop.Path(target)]
    qualified = [p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p) for p in paths]
    context = hadoop.FileContext.getFileContext(qualified[0].toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(*qualified, spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0))
    except Py4JJavaError as error:
        fs, path = _hadoop_path(spark, target)
        if fs.exists(path):
            return False
        raise error
    return True


def hidden_files(spark: SparkSession, root: str, suffix: str) -> list[str]:
    """Files below ``root`` that Spark's sources pass over, as their names or folders begin with ``_`` or ``.``."""
    fs, target = _hadoop_path(spark, root)
    found, base = [], fs.makeQualified(target).toString()
    files = fs.listFiles(target, True)
    while files.hasNext():
        path = files.next().getPath().toString()
        if path.endswith(suffix) and any(part[:1] in ("_", ".") for part in path[len(base) :].split("/")):
            found.append(path)
    return found


def discard(spark: SparkSession, path: str) -> None:
    """Drop a staged table made by :func:`new_folder` once its rows are committed elsewhere."""
    if not path.startswith(f"{shared_dir(spark)}/vecloom/"):
        raise ValueError(f"not a staged folder: {path}")
    remove_folder(spark, path)
