"""Files on the session's shared storage, through Hadoop's file systems (driver side)."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p = _path(spark, path)
    return _system(spark, p).exists(p)


def remove(spark: SparkSession, path: str) -> None:
    p = _path(spark, path)
    _system(spark, p).delete(p, True)


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Have a folder removed when the driver ends."""
    p = _path(spark, path)
    _system(spark, p).deleteOnExit(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder (none if it does not exist)."""
    p = _path(spark, folder)
    fs = _system(spark, p)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def files_state(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """(path, length, modification time) of the files under a path, in order."""
    p = _path(spark, path)
    found, listing = [], _system(spark, p).listFiles(p, True)
    while listing.hasNext():
        s = listing.next()
        found.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return tuple(sorted(found))


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or None if there is no such file."""
    p = _path(spark, path)
    fs = _system(spark, p)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _rename_over(spark: SparkSession, source, target) -> None:
    """Rename a file, replacing the target in the same step."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(source, target, options)


def replace_json(spark: SparkSession, path: str, value: object) -> None:
    """Write a small JSON file; readers see the old one or the new one, whole."""
    target = _path(spark, path)
    temporary = _path(spark, f"{path}.{uuid.uuid4().hex}")
    fs = _system(spark, target)
    fs.mkdirs(target.getParent())
    out = fs.create(temporary, True)
    try:
        out.write(json.dumps(value, sort_keys=True).encode())
    finally:
        out.close()
    _rename_over(spark, temporary, target)


def join_files(spark: SparkSession, head: bytes, folder: str, suffix: str, path: str) -> None:
    """Files of a folder that all start with ``head``, as one file that has it once.

    They follow in order of their names. Bytes are copied in small pieces to a temporary name, which is then renamed
    over ``path``: there is the old file or the whole new one.
    """
    target, temporary = _path(spark, path), _path(spark, f"{path}.{uuid.uuid4().hex}")
    fs, conf = _system(spark, target), spark._jsc.hadoopConfiguration()
    copy = spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes
    out = fs.create(temporary, True)
    try:
        out.write(head)
        for name in names(spark, folder):
            if name.endswith(suffix):
                part = _path(spark, f"{folder}/{name}")
                if _system(spark, part).getFileStatus(part).getLen() <= len(head):
                    continue
                stream = _system(spark, part).open(part)
                try:
                    stream.seek(len(head))
                    copy(stream, out, conf, False)
                finally:
                    stream.close()
    finally:
        out.close()
    _rename_over(spark, temporary, target)
