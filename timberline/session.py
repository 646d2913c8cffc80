"""Session helpers: a tuned local session for tests and the shared folder for intermediate tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
import gc
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}
_scopes: list[list[str]] = []


def local_session(cores: int | str = "*", app_name: str = "timberline") -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the cluster's checkpoint folder, for a table that cuts lineage.

    The folder must be reachable from every executor, so a machine-local one is used only when
    Spark itself runs on one machine and the cluster setting is absent.
    """
    root = _root(spark)
    path = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    for scope in _scopes:
        scope.append(path)
    return path


def _root(spark: SparkSession) -> str:
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors can reach")
        if context.applicationId not in _local_roots:
            _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="timberline-")
        root = _local_roots[context.applicationId]
    return root


def remove_folder(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).delete(_hadoop_path(spark, path), True)


def _hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _hadoop_path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


@contextmanager
def released_folders(spark: SparkSession) -> Iterator[None]:
    """Removes at its end every shared folder named inside; for jobs whose results lie elsewhere."""
    scope: list[str] = []
    _scopes.append(scope)
    try:
        yield
    finally:
        _close(scope)
        for path in scope:
            remove_folder(spark, path)


@contextmanager
def named_folders() -> Iterator[list[str]]:
    """The shared folders that are named inside, for those who remove them later."""
    scope: list[str] = []
    _scopes.append(scope)
    try:
        yield scope
    finally:
        _close(scope)


def _close(scope: list[str]) -> None:
    _scopes[:] = [other for other in _scopes if other is not scope]


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of finished queries now.

    It does so when the driver's garbage collection finds nothing that refers to them, which may be
    long after the disk is needed.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def read_small_text(spark: SparkSession, path: str) -> str:
    """The content of a small text file."""
    stream = _file_system(spark, path).open(_hadoop_path(spark, path))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_small_text(spark: SparkSession, path: str, content: str) -> bool:
    """Writes a small text file in one step; False if another has taken its place before."""
    system, place = _file_system(spark, path), _hadoop_path(spark, path)
    folder, name = path.rsplit("/", 1)
    fresh = _hadoop_path(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    stream = system.create(fresh, True)
    stream.write(content.encode())
    stream.close()
    context = spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        system.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    no_options = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(system.makeQualified(fresh), system.makeQualified(place), no_options)
    except Py4JJavaError as error:
        system.delete(fresh, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def settled(table: DataFrame, purpose: str) -> DataFrame:
    """The table written once to the shared folder and read back, for results with several readers."""
    path = shared_folder(table.sparkSession, purpose)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names of files and folders in a folder; none if there is no such folder."""
    system, place = _file_system(spark, path), _hadoop_path(spark, path)
    return [status.getPath().getName() for status in system.listStatus(place)] if system.exists(place) else []


def folder_exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_hadoop_path(spark, path))
