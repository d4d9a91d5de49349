"""The few file operations that Spark's readers and writers lack, on any Hadoop filesystem."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class PathTaken(FileExistsError):
    """The name of a file that was to be published exists already."""


class SharedFiles:
    """Listing, small text files, publishing by rename, and removal, below one root folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.root = root.rstrip("/")
        self._gateway = spark.sparkContext._gateway
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str = "") -> list[str]:
        """Names in a folder, sorted; none if there is no such folder."""
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(path))

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish_text(self, name: str, draft: str, text: str) -> None:
        """Write ``text`` as ``draft`` and rename it to ``name``, which must not exist."""
        stream = self._fs.create(self._path(draft), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        qualified = [self._fs.makeQualified(self._path(n)) for n in (draft, name)]
        no_options = self._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(*qualified, no_options)
        except Py4JJavaError as failed:
            self.remove(draft)
            if "FileAlreadyExists" in failed.java_exception.getClass().getName():
                raise PathTaken(f"{self.root}/{name} exists") from failed
            raise

    def remove(self, name: str) -> None:
        """Remove a file or a folder with all that it holds, if it is there."""
        self._fs.delete(self._path(name), True)
