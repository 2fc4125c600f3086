"""Paths on whatever file system the session uses, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_SCRATCH = re.compile(r"^[a-z_-]+-[0-9a-f]{32}$")
_LOCAL: dict[str, str] = {}


def _resolve(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _resolve(spark, path)
    return fs.exists(jpath)


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, jpath = _resolve(spark, path)
    return fs.exists(jpath) and fs.getFileStatus(jpath).isDirectory()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path``; empty when it does not exist."""
    fs, jpath = _resolve(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(jpath))


def remove_tree(spark: SparkSession, path: str) -> None:
    fs, jpath = _resolve(spark, path)
    fs.delete(jpath, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, replaced if it exists."""
    fs, jpath = _resolve(spark, path)
    out = fs.create(jpath, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file; ``None`` when it does not exist."""
    fs, jpath = _resolve(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str, step: int = 4096) -> str | None:
    """The first line of a text file, decompressed by its name's ending; ``None`` for an empty file."""
    fs, jpath = _resolve(spark, path)
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(jpath)
    stream = fs.open(jpath)
    if codec is not None:
        stream = codec.createInputStream(stream)
    try:
        found = b""
        while b"\n" not in found and (more := bytes(stream.readNBytes(step))):
            found += more
        return found.split(b"\n")[0].rstrip(b"\r").decode("utf-8", "replace") if found else None
    finally:
        stream.close()


def move_new(spark: SparkSession, source: str, target: str) -> bool:
    """Give a file its name in one step; false when the name is taken."""
    fs, old = _resolve(spark, source)
    _, new = _resolve(spark, target)
    # Some file systems rename over an existing file without a word.
    return not fs.exists(new) and fs.rename(old, new)


def sweep_scratch(spark: SparkSession, older_than_hours: float, now: float | None = None) -> list[str]:
    """Remove scratch folders whose last change is older than that; returns their names.

    Scratch tables are read lazily, so nothing knows when their last reader is done: the
    operator runs this with an age above that of its longest job.
    """
    base = _scratch_base(spark)
    fs, jpath = _resolve(spark, base)
    limit = ((time.time() if now is None else now) - older_than_hours * 3600) * 1000
    removed = []
    for status in fs.listStatus(jpath) if fs.exists(jpath) else []:
        name = status.getPath().getName()
        if _SCRATCH.match(name) and status.getModificationTime() < limit:
            fs.delete(status.getPath(), True)
            removed.append(name)
    return sorted(removed)


def _scratch_base(spark: SparkSession) -> str:
    base = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    # One folder for the session, so that a sweep finds what it left.
    session = spark.sparkContext.applicationId
    if session not in _LOCAL:
        _LOCAL[session] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL[session]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the cluster's shared ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of this machine; on a
    cluster the executors could not see it, so that case is an error.
    """
    return f"{_scratch_base(spark)}/{label}-{uuid.uuid4().hex}"
