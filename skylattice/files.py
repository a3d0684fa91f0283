"""Calls to the cluster's file system; the one place that goes through the JVM gateway."""

from __future__ import annotations

import os
import time
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder, sorted; nothing if there is none."""
    fs, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def matching(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Paths under ``path``, relative to it, that fit a glob pattern."""
    fs, where = _at(spark, path)
    depth = pattern.count("/") + 1
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(where, pattern)) or []
    return sorted("/".join(s.getPath().toString().split("/")[-depth:]) for s in found)


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def modified(spark: SparkSession, path: str) -> float:
    """When a file was written, in seconds; now if it is gone."""
    fs, where = _at(spark, path)
    return fs.getFileStatus(where).getModificationTime() / 1000 if fs.exists(where) else time.time()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """A new file that is there whole or not at all; FileExistsError if it is already there.

    A rename takes a name only once on a distributed file system. On a local one
    it would replace the file, so there the name is given by a link.
    """
    fs, where = _at(spark, path)
    folder, _, name = path.rpartition("/")
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/.{name}.{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if fs.getUri().getScheme() == "file":
            os.link(draft.toUri().getPath(), where.toUri().getPath())
        elif fs.exists(where) or not fs.rename(draft, where):
            raise FileExistsError(f"another writer has made {path}")
    finally:
        if fs.exists(draft):
            fs.delete(draft, False)
