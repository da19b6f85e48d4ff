"""Small files of any store that Spark's paths name, by way of Hadoop's file systems."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def join(folder: str, name: str) -> str:
    """``name`` below ``folder``, unless it is absolute or names its own store."""
    return name if name.startswith("/") or "://" in name or name.startswith("file:/") else f"{str(folder).rstrip('/')}/{name}"


@contextmanager
def _as_os_error(path: str) -> Iterator[None]:
    try:
        yield
    except Py4JJavaError as e:
        kind, text = e.java_exception.getClass().getSimpleName(), str(e.java_exception.getMessage())
        if "NotFound" in kind or "NoSuchFile" in kind:
            raise FileNotFoundError(2, text, path) from e
        if "AccessControl" in kind or "AccessDenied" in kind or "Permission denied" in text:
            raise PermissionError(13, text, path) from e
        raise OSError(5, f"{kind}: {text}", path) from e


class Store:
    def __init__(self, spark: SparkSession) -> None:
        self.spark, self._jvm = spark, spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _open(self, path: str) -> tuple:
        at = self._jvm.org.apache.hadoop.fs.Path(str(path))
        return at.getFileSystem(self._conf), at

    def exists(self, path: str) -> bool:
        with _as_os_error(path):
            fs, at = self._open(path)
            return fs.exists(at)

    def is_folder(self, path: str) -> bool:
        with _as_os_error(path):
            fs, at = self._open(path)
            return fs.exists(at) and fs.getFileStatus(at).isDirectory()

    def files(self, folder: str, suffix: str = "") -> list[tuple[str, int]]:
        """Names and sizes of the files in a folder, by name; none if there is no such folder."""
        if not self.is_folder(folder):
            return []
        with _as_os_error(folder):
            fs, at = self._open(folder)
            found = [(s.getPath().getName(), s.getLen()) for s in fs.listStatus(at) if s.isFile()]
        return sorted((n, size) for n, size in found if n.endswith(suffix) and not n.startswith("."))

    def make(self, folder: str) -> None:
        with _as_os_error(folder):
            fs, at = self._open(folder)
            fs.mkdirs(at)

    def remove(self, path: str) -> None:
        with _as_os_error(path):
            fs, at = self._open(path)
            fs.delete(at, True)

    def read(self, path: str) -> str | None:
        """A file's text; None if there is none."""
        if not self.exists(path):
            return None
        with _as_os_error(path):
            fs, at = self._open(path)
            stream = fs.open(at)
            try:
                return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()

    def write(self, path: str, text: str) -> None:
        """Written beside the target and then renamed to it, so that a reader sees the old text or the new one."""
        beside = f"{path}.tmp"
        with _as_os_error(path):
            fs, at = self._open(beside)
            stream = fs.create(at, True)
            try:
                stream.write(bytearray(text.encode()))
            finally:
                stream.close()
        self.move(beside, path)

    def move(self, source: str, target: str) -> None:
        """Renames a file, over another one if there is one."""
        with _as_os_error(target):
            fs, at = self._open(source)
            to = self._jvm.org.apache.hadoop.fs.Path(str(target))
            rename = self._jvm.org.apache.hadoop.fs.Options.Rename
            options = self.spark.sparkContext._gateway.new_array(rename, 1)
            options[0] = rename.OVERWRITE
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf).rename(fs.makeQualified(at), fs.makeQualified(to), options)
