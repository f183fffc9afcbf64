"""Versioned model folders: a new version becomes current by one rename.

``base/data/<id>`` holds the files of a version, ``base/versions/<number>`` one small file that
names it. A version is written whole before its pointer appears under its number, so a
reader sees the old version or the new one, never half of it; two writers cannot take one number.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current(spark: SparkSession, base: str) -> tuple[int, str] | None:
    """(number, folder) of the current version; None if there is none."""
    jvm, p, fs = _fs(spark, f"{base}/versions")
    if not fs.exists(p):
        return None
    names = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().isdigit()]
    if not names:
        return None
    last = max(names, key=lambda x: int(x.getName()))
    stream = fs.open(last)
    try:
        folder = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return int(last.getName()), folder


def publish(spark: SparkSession, base: str, write: Callable[[str], None], tries: int = 20) -> int:
    """Write a version with ``write(folder)`` and make it the current one; returns its number."""
    folder = f"{base}/data/{uuid.uuid4().hex}"
    write(folder)
    jvm, draft, fs = _fs(spark, f"{base}/drafts/{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(folder.encode())
    out.close()
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(f"{base}/versions"))
    for _ in range(tries):
        known = current(spark, base)
        number = 1 + (known[0] if known else 0)
        target = jvm.org.apache.hadoop.fs.Path(f"{base}/versions/{number:012d}")
        if not fs.exists(target) and fs.rename(draft, target):
            return number
    raise RuntimeError(f"no free version number in {base}")


class Versioned:
    """The current version, loaded once: ``get()`` loads again only if the number has changed."""

    def __init__(self, spark: SparkSession, base: str, load: Callable[[str], Any]):
        self.spark, self.base, self.load = spark, base, load
        self.number, self.value, self.loads = None, None, 0

    def get(self) -> Any:
        found = current(self.spark, self.base)
        if found is None:
            raise ValueError(f"no version in {self.base}")
        if found[0] != self.number:
            self.value, self.number = self.load(found[1]), found[0]
            self.loads += 1
        return self.value
