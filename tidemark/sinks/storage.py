"""The few file-system questions the sinks ask, answered by Spark's Hadoop client."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def is_empty(spark: SparkSession, path: str) -> bool:
    """Whether nothing is stored at ``path``: no such folder, or one without any entry."""
    fs, target = _fs(spark, path)
    return not fs.exists(target) or len(fs.listStatus(target)) == 0


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob."""
    fs, target = _fs(spark, pattern)
    return [status.getPath().toString() for status in fs.globStatus(target) or []]


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``."""
    fs, target = _fs(spark, path)
    return fs.getContentSummary(target).getLength()


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _fs(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def swap_in(spark: SparkSession, staged: str, path: str) -> None:
    """Put the completely written folder ``staged`` in the place of ``path``.

    The old folder is moved aside, and back if the new one cannot take its
    place; it is deleted only after the swap.
    """
    fs, new = _fs(spark, staged)
    if not exists(spark, f"{staged}/_SUCCESS"):
        raise RuntimeError(f"{staged} was not written to its end")
    _, target = _fs(spark, path)
    aside = None
    if fs.exists(target):
        _, aside = _fs(spark, _beside(path, "old"))
        if not fs.rename(target, aside):
            raise RuntimeError(f"cannot move {path} aside")
    else:
        fs.mkdirs(target.getParent())
    if not fs.rename(new, target):
        if aside is not None:
            fs.rename(aside, target)
        raise RuntimeError(f"cannot move {staged} to {path}")
    if aside is not None:
        fs.delete(aside, True)


def _beside(path: str, what: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{what}-{name}-{uuid.uuid4().hex}"


def staging(path: str) -> str:
    """A fresh folder beside ``path`` that Spark's readers pass over."""
    return _beside(path, "new")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared checkpoint directory of the session."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint directory. Only a session on one machine may leave it unset: it gets a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    if not base:
        # setCheckpointDir appends a folder of its own, once per application.
        if spark.sparkContext.getCheckpointDir() is None:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        base = spark.sparkContext.getCheckpointDir()
    return base
