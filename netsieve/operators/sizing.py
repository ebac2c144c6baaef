"""Size checks before anything is broadcast, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SMALL_ROWS = 10_000

_local_folders: dict[str, str] = {}


def small_table(frame: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame | None:
    """The table as a local relation marked for broadcast, or None if it has more than ``max_rows`` rows.

    Meant for aggregates that are expected to be tiny. At most ``max_rows + 1`` rows reach the
    driver. The mark makes a join with it leave the other side where it is.
    """
    rows = frame.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return None
    return F.broadcast(frame.sparkSession.createDataFrame(rows, frame.schema))


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a temporary one in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="netsieve-")
    return _local_folders[application]


def qualified(spark: SparkSession, path: str) -> str:
    """The whole address of a path, as Hadoop completes it."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place).toString()


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and a maker of its paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def claim_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file under a name that nobody has taken; False if it is taken. The name appears with its whole text: it is
    written aside and renamed, and a rename onto a taken name is refused."""
    files, make = _files(spark, path)
    if files.exists(make(path)):
        return False
    folder, name = path.rsplit("/", 1)
    aside = make(f"{folder}/.{name}-{uuid.uuid4().hex}")
    out = files.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if files.exists(make(path)) or not files.rename(aside, make(path)):
        files.delete(aside, False)
        return False
    return True


def file_exists(spark: SparkSession, path: str) -> bool:
    files, make = _files(spark, path)
    return files.exists(make(path))


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder of few files, without those written aside; empty if there is no such folder."""
    files, make = _files(spark, folder)
    if not files.exists(make(folder)):
        return []
    names = [status.getPath().getName() for status in files.listStatus(make(folder))]
    return sorted(name for name in names if not name.startswith("."))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpoint_table(frame: DataFrame, name: str, partition_by: tuple[str, ...] = (), file_rows: int = 0) -> DataFrame:
    """Write once, read back: later stages restart from the table when executors are lost.

    With ``file_rows`` no file holds more rows than that, so a scan can deal the table evenly to its tasks: one row group
    is never read by two of them.
    """
    path = scratch_path(frame.sparkSession, name)
    writer = frame.write.mode("overwrite")
    if file_rows:
        writer = writer.option("maxRecordsPerFile", file_rows)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return frame.sparkSession.read.parquet(path)
