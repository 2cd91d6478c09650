"""Small steps on the file system that a path's URL names, for tables published folder by folder.

What a reader must not see yet lies in a folder whose name starts with an underscore, which Spark's readers
skip, and becomes visible by one rename. As for Spark's own checkpoints, the file system must rename a
folder in one step (HDFS and the like do).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession

STAGING = "_staging"


class Files:
    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def is_file(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p) and fs.getFileStatus(p).isFile()

    def names(self, path: str) -> Iterator[str]:
        """Names of what lies in a folder; none if it is missing."""
        fs, p = self._at(path)
        if fs.exists(p):
            for status in fs.listStatus(p):
                yield status.getPath().getName()

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def publish(self, staged: str, final: str) -> bool:
        """Rename a folder into place. False (and the staged folder goes) if it is there already: a rerun of published work."""
        fs, source = self._at(staged)
        _, target = self._at(final)
        if fs.exists(target):
            fs.delete(source, True)
            return False
        if not fs.exists(source):
            return False  # nothing was written
        fs.mkdirs(target.getParent())
        if not fs.rename(source, target):
            raise OSError(f"could not rename {staged} to {final}")
        return True

    def write_text(self, path: str, text: str) -> None:
        """One small file, whole or not at all: written aside, then renamed over what was there."""
        fs, target = self._at(path)
        aside = self._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{target.getName()}.new")
        out = fs.create(aside, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if fs.exists(target):
            fs.delete(target, False)
        if not fs.rename(aside, target):
            raise OSError(f"could not write {path}")

    def read_text(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
