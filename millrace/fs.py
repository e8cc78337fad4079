"""File operations on whatever file system Spark itself uses."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class SharedFiles:
    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()

    def _open(self, path: str):
        target = self._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self._conf), target

    def exists(self, path: str) -> bool:
        fs, target = self._open(path)
        return fs.exists(target)

    def names(self, path: str) -> list[str]:
        fs, target = self._open(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []

    def files(self, path: str) -> dict[str, int]:
        """All files below ``path`` by their relative names, with their sizes."""
        fs, target = self._open(path)
        if not fs.exists(target):
            return {}
        root, found = fs.makeQualified(target).toString().rstrip("/"), {}
        walk = fs.listFiles(target, True)
        while walk.hasNext():
            status = walk.next()
            found[status.getPath().toString()[len(root) + 1:]] = status.getLen()
        return found

    def write_text(self, path: str, text: str) -> None:
        fs, target = self._open(path)
        out = fs.create(target, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def create(self, path: str, text: str) -> bool:
        """Write a new file; False, and nothing done, if there is one of that name."""
        fs, target = self._open(path)
        try:
            out = fs.create(target, False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        return True

    def read_text(self, path: str) -> str | None:
        """The text of a file, or None if there is none."""
        fs, target = self._open(path)
        if not fs.exists(target):
            return None
        source = fs.open(target)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()

    def delete(self, path: str) -> None:
        fs, target = self._open(path)
        fs.delete(target, True)

    def rename(self, source: str, target: str) -> None:
        fs, src = self._open(source)
        if not fs.exists(src):
            raise FileNotFoundError(source)
        dst = self._jvm.org.apache.hadoop.fs.Path(target)
        fs.mkdirs(dst.getParent())
        if not fs.rename(src, dst):
            raise OSError(f"could not move {source} to {target}")
