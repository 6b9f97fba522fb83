"""Shared folder for intermediate tables, outliving any single executor."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_made: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names; a temporary one only in local mode, where none may be set."""
    context = spark.sparkContext
    folder = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {SETTING} to a folder that every node can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="shopfloor-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark)}/shopfloor/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def remove_made(spark: SparkSession) -> None:
    """Delete the intermediate tables of this process, when nothing will read them any more."""
    while _made:
        remove(spark, _made.pop())


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it."""
    files, folder = _hadoop(spark, path)
    files.delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _hadoop(spark, path)
    return files.exists(folder)


def _move(spark: SparkSession, source: str, target: str) -> None:
    (files, old), (_, new) = _hadoop(spark, source), _hadoop(spark, target)
    if not files.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")


def _aside(path: str) -> str:
    return f"{path.rstrip('/')}.earlier"


def staging_path(path: str) -> str:
    """A folder beside ``path``, on the same file system, to write its next content to."""
    return f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Make the complete folder ``staged`` the content of ``path`` by renaming it.

    Nothing is copied. What was there before is moved aside, and deleted once ``staged`` has its
    name. If the second rename fails, the earlier content gets its name back; after a crash between
    the two, ``recover`` does that.
    """
    recover(spark, path)
    aside = _aside(path)
    earlier = exists(spark, path)
    if earlier:
        _move(spark, path, aside)
    try:
        _move(spark, staged, path)
    except Exception:
        if earlier:
            _move(spark, aside, path)
        raise
    remove(spark, aside)


def recover(spark: SparkSession, path: str) -> None:
    """Give earlier content its name back, or delete it, if a ``publish`` did not get to its end."""
    aside = _aside(path)
    if not exists(spark, aside):
        return
    if exists(spark, path):
        remove(spark, aside)
    else:
        _move(spark, aside, path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: later jobs start from the files, not from the lineage."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
