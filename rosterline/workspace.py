"""Where intermediate tables live, and the few file-system questions Spark has no API for.

Intermediate tables go below the shared folder named by ``spark.checkpoint.dir``, so
every executor sees them and a lost executor loses nothing. Only a local session
without that setting gets a temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder for intermediate tables of this application."""
    app = spark.sparkContext.applicationId
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return f"{configured.rstrip('/')}/rosterline/{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="rosterline-")
    return _local_roots[app]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder below :func:`shared_root`."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str, measure: Column) -> tuple[DataFrame, int]:
    """Writes a table to a fresh folder; gives it back as a scan, with an aggregate seen on the way."""
    path = fresh_dir(df.sparkSession, label)
    written = Observation()
    df.observe(written, measure.alias("measure")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), written.get["measure"]


def sized(df: DataFrame, label: str) -> DataFrame:
    """Stores a result that is likely small and gives it back as a scan of known size.

    The optimizer cannot tell how far an aggregate shrinks its input, so it would shuffle
    the large side of a join with it. From a stored table it knows: below the broadcast
    threshold the large side stays where it is, above it both sides are shuffled as usual.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Spark's setting by which a job's shuffle files are deleted when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Jobs started within delete their shuffle files at their end, not at some later collection of garbage.

    For steps that store tables: what follows reads the table, so the files of its job serve nobody.
    """
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _path(spark, path)
    return fs.exists(hadoop_path)


def committed_names(spark: SparkSession, base: str, prefix: str) -> list[str]:
    """Names of the sub-folders of ``base`` that begin with ``prefix`` and whose write job finished."""
    fs, hadoop_path = _path(spark, base)
    if not fs.exists(hadoop_path):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(hadoop_path)]
    return sorted(n for n in names if n.startswith(prefix) and path_exists(spark, f"{base}/{n}/_SUCCESS"))


def child_names(spark: SparkSession, base: str, prefix: str) -> list[str]:
    """Names of the sub-folders of ``base`` that begin with ``prefix``; what they hold is not looked at."""
    fs, hadoop_path = _path(spark, base)
    if not fs.exists(hadoop_path):
        return []
    return sorted(n for s in fs.listStatus(hadoop_path) if s.isDirectory() and (n := s.getPath().getName()).startswith(prefix))


def remove_tree(spark: SparkSession, path: str) -> None:
    """Deletes a folder that nothing reads any more."""
    fs, hadoop_path = _path(spark, path)
    fs.delete(hadoop_path, True)


def committed_children(spark: SparkSession, base: str, prefix: str) -> list[int]:
    """Numbers ``n`` of the sub-folders ``<prefix>n`` of ``base`` whose write job finished."""
    return sorted(int(name[len(prefix):]) for name in committed_names(spark, base, prefix))
