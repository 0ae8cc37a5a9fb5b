"""Where intermediate results live: the folder the cluster shares between its machines."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []  # paths of this process's own, removed when it ends
_conf: list = []  # the session's file system settings, once known


def discard(paths: list[str]) -> None:
    """Delete paths through the file system they belong to."""
    jvm = SparkContext._jvm
    if jvm is None or not _conf:
        return
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(_conf[0]).delete(place, True)


@atexit.register
def _clean_up() -> None:
    try:
        discard(_made)
    except Exception:  # noqa: BLE001 - the JVM may be gone already
        pass


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    A local session without the setting gets a folder of its own; a cluster session must name one,
    since executors cannot read each other's temporary folders.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="tidemark-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses; it goes when this process ends."""
    if not _conf:
        _conf.append(spark.sparkContext._jsc.hadoopConfiguration())
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def materialise(df: DataFrame) -> DataFrame:
    """Cut lineage through a reliable checkpoint, for frames that several branches rescan."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
