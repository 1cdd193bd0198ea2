"""Files by URI, through the file systems that Spark's own readers use (``hdfs://``, ``s3a://``, ``file://``, ...)."""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession


def is_uri(path: Any) -> bool:
    return "://" in str(path)


class Remote(str):
    """The URI of a folder or file. It can be joined and named as a path can; what it holds is read through Spark."""

    def __new__(cls, uri: str) -> Remote:
        return super().__new__(cls, uri.rstrip("/"))

    def __truediv__(self, name: str) -> Remote:
        return Remote(f"{self}/{name}")

    @property
    def name(self) -> str:
        return self.rsplit("/", 1)[-1]

    @property
    def stem(self) -> str:
        return self.name.rsplit(".", 1)[0]

    def _at(self) -> tuple[Any, Any]:
        spark = SparkSession.active()
        path = spark._jvm.org.apache.hadoop.fs.Path(str(self))
        return path, path.getFileSystem(spark._jsc.hadoopConfiguration())

    def is_dir(self) -> bool:
        path, files = self._at()
        return bool(files.exists(path) and files.getFileStatus(path).isDirectory())

    def is_file(self) -> bool:
        path, files = self._at()
        return bool(files.exists(path) and files.getFileStatus(path).isFile())

    def sizes(self) -> dict[str, int]:
        """The names in a folder and their bytes, by one listing."""
        path, files = self._at()
        return {x.getPath().getName(): x.getLen() for x in files.listStatus(path)}

    def resolve(self) -> Remote:
        """The URI as Spark's readers name it."""
        path, files = self._at()
        return Remote(files.makeQualified(path).toString())

    def read_text(self, encoding: str = "utf-8") -> str:
        path, files = self._at()
        stream = files.open(path)
        try:
            return bytes(SparkSession.active()._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode(encoding)
        finally:
            stream.close()
