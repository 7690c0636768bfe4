"""Session setup and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
import weakref
from collections.abc import Iterator

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "salescast", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster pass in the cluster's own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.scheduler.mode", "FAIR")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where the setting is missing, a local session gets a temporary folder; a cluster session is refused.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or _folders.get(context.applicationId)
    if not folder:
        folder = context.getCheckpointDir()  # set by hand, before anything was written
        if folder is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if folder is None:
            folder = tempfile.mkdtemp(prefix="salescast-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        # Spark adds a folder of its own to what it is told, so that its answer is not the place to ask again.
        _folders[context.applicationId] = folder
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


_folders: dict[str, str] = {}


ARROW_TYPES = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}


def small_table(spark: SparkSession, rows: list[tuple], /, **types: str) -> DataFrame:
    """A table of a few driver rows. Made from Arrow it is part of the plan; no Python worker produces it."""
    columns = zip(*rows) if rows else [()] * len(types)
    arrays = {name: pa.array(values, ARROW_TYPES[types[name]]) for name, values in zip(types, columns)}
    return spark.createDataFrame(pa.table(arrays))


def gathered(df: DataFrame) -> DataFrame:
    """A table of a few rows by its nature (one per model, feature or column), computed once and kept in the plan."""
    return df.sparkSession.createDataFrame(df.toArrow())


def _run_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/salescast-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in this application's part of the shared folder, deleted when the driver ends."""
    folder = _run_folder(spark)
    if folder not in _delete_at_exit:
        _delete_at_exit.add(folder)
        atexit.register(_delete_quietly, spark, spark._jsc.hadoopConfiguration(), folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


_delete_at_exit: set[str] = set()


def _delete(spark: SparkSession, settings, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(settings).delete(path, True)


def _delete_quietly(*args) -> None:
    with contextlib.suppress(Py4JError, OSError):  # the JVM may be gone already
        _delete(*args)


def release(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application now; nothing may read them any more."""
    _delete(spark, spark._jsc.hadoopConfiguration(), _run_folder(spark))


def materialize(df: DataFrame, name: str, by: tuple[str, ...] = (), compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result survives lost executors, is not recomputed, and carries its true size, so that Catalyst
    decides from a measured number whether a later join may broadcast it. With ``by``, rows lie in a folder for each value, so
    that a filter on it reads only what it needs. ``compression`` is the session's by default; a denser one pays for copies of
    whole texts.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(*by).parquet(path, compression=compression)
    table = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    _written[table] = path
    return table


_written: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that ``materialize`` gave, once all that is made from them is written itself.

    A table written from them reads its own files, so lost executors need nothing of these any more. Tables that were not
    written by ``materialize``, or have gone already, are passed over.
    """
    for table in tables:
        path = _written.pop(table, None)
        if path:
            spark = table.sparkSession
            _delete(spark, spark._jsc.hadoopConfiguration(), path)


@contextlib.contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Inside, a query's shuffle files go as soon as it ends. For queries that write or collect: nothing else of them is read again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def written(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path`` if its write has ended, else None."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return spark.read.parquet(path) if mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark) else None
