"""Tables between two jobs, in storage that survives the loss of executors."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_folders: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session may fall back to a temporary folder; a cluster
    without the setting is an error, because a machine-local folder would be
    lost together with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    path = tempfile.mkdtemp(prefix="tissueframe-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def clear(spark: SparkSession | None = None) -> None:
    """Delete what sessions (or the given one) stored; also done when Python ends.

    Frames built on stored tables can no longer be read afterwards.
    """
    for folder, owner in list(_folders.items()):
        if spark is None or owner is spark:
            try:
                _delete(owner, folder)
            except Exception:  # the session has ended before; its folder stays
                pass
            del _folders[folder]


atexit.register(clear)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table written between two jobs, below a folder of this application."""
    folder = f"{shared_dir(spark).rstrip('/')}/tissueframe/{spark.sparkContext.applicationId}"
    _folders[folder] = spark
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Unlike a checkpoint the result keeps size statistics and column pruning.
    Stored tables stay until :func:`drop_stored` or :func:`clear`.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._stored_at = path
    return found


def drop_stored(df: DataFrame) -> None:
    """Delete the table behind a frame of :func:`store`, once nothing reads it any more."""
    path = getattr(df, "_stored_at", None)
    if path:
        _delete(df.sparkSession, path)
