"""Small files of a table's log, through the file system of the cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """A folder on whatever file system its path names."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path(path)
        self._files = self._path.getFileSystem(spark._jsc.hadoopConfiguration())

    def is_folder(self) -> bool:
        """False for files, patterns and what is not there."""
        return self._files.exists(self._path) and self._files.getFileStatus(self._path).isDirectory()

    def _child(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._path, name)

    def names(self) -> list[str]:
        """Sorted; none where the folder is missing."""
        if not self._files.exists(self._path):
            return []
        return sorted(status.getPath().getName() for status in self._files.listStatus(self._path))

    def read(self, name: str) -> str:
        stream = self._files.open(self._child(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Write a new file; one that is there already is an error."""
        stream = self._files.create(self._child(name), False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self._files.delete(self._child(name), True)
