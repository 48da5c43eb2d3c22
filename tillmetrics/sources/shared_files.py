"""Small files in shared folders: listed, read, published once, removed.

Data goes through Spark's readers and writers. These few operations are for the pointers beside it,
which have to appear as a whole or not at all; they work on any store that Hadoop reaches.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class SharedFiles:
    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        where = self._hadoop.Path(path)
        return where, where.getFileSystem(self._conf)

    def names(self, folder: str) -> list[str]:
        """Names in a folder, sorted; none where there is no such folder."""
        where, fs = self._at(folder)
        if not fs.exists(where):
            return []
        return sorted(status.getPath().getName() for status in fs.listStatus(where))

    def exists(self, path: str) -> bool:
        where, fs = self._at(path)
        return fs.exists(where)

    def read(self, path: str) -> str:
        where, fs = self._at(path)
        stream = fs.open(where)
        try:
            return self._spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, path: str, text: str) -> bool:
        """Make a file with this text appear at once. False where the path is taken already."""
        where, fs = self._at(path)
        fs.mkdirs(where.getParent())
        waiting, _ = self._at(f"{where.getParent().toString()}/.{uuid.uuid4().hex}")
        stream = fs.create(waiting, True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        context = self._hadoop.FileContext.getFileContext(fs.getUri(), self._conf)
        kind = getattr(self._hadoop, "Options$Rename")
        try:
            context.rename(
                fs.makeQualified(waiting), fs.makeQualified(where), self._spark.sparkContext._gateway.new_array(kind, 0)
            )
        except Exception:
            fs.delete(waiting, False)
            if fs.exists(where):
                return False
            raise
        return True

    def move(self, source: str, target: str) -> None:
        """Move a file or folder; the folder above the target is made."""
        (where, fs), (to, _) = self._at(source), self._at(target)
        fs.mkdirs(to.getParent())
        if not fs.rename(where, to):
            raise OSError(f"{source} could not be moved to {target}")

    def delete(self, path: str) -> None:
        where, fs = self._at(path)
        fs.delete(where, True)
