"""Files of any Hadoop file system, seen from the driver: small state files and names, never data."""

from __future__ import annotations

import re
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


class Files:
    """The file system that ``root`` is on."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def make(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names of what lies directly in a folder, sorted; none if there is no such folder."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)))

    def files_below(self, path: str) -> list[str]:
        """Paths of all files below a folder, sorted."""
        found, out = self._fs.listFiles(self._path(path), True), []
        while found.hasNext():
            out.append(found.next().getPath().toString())
        return sorted(out)

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def move(self, source: str, target: str) -> None:
        """Puts a file in the place of another, if there is one."""
        self.make(target.rsplit("/", 1)[0])
        self.delete(target)
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def set_time(self, path: str, millis: int) -> None:
        self._fs.setTimes(self._path(path), millis, -1)

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, path: str, text: str) -> None:
        """A new file that is there whole or not at all."""
        draft = f"{path}.{uuid.uuid4().hex}.tmp"
        stream = self._fs.create(self._path(draft))
        stream.write(bytearray(text.encode()))
        stream.close()
        if self.exists(path) or not self._fs.rename(self._path(draft), self._path(path)):
            self.delete(draft)
            raise FileExistsError(path)


def plain_path(path: Column, encoded: bool) -> Column:
    """One spelling of a path: ``_metadata.file_path`` is ``encoded``, the path column of the binary reader is not."""
    if encoded:
        path = F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(path, "^([a-zA-Z0-9.+-]+):/+", "$1:/")


def literal(path: str) -> str:
    """A path as a pattern that matches it alone."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def partition_value(name: str) -> str:
    """The value in the name of a partition folder."""
    return unquote(name.split("=", 1)[1])
