"""Small files of a shared store (manifests), by Hadoop's file system, so any
path that Spark reads will do."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    path: str
    is_dir: bool
    size: int
    modified: int  # milliseconds


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self.root = root.rstrip("/")
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    @staticmethod
    def _entry(status) -> Entry:
        return Entry(status.getPath().toString(), status.isDirectory(), status.getLen(), status.getModificationTime())

    def glob(self, pattern: str) -> list[Entry]:
        return [self._entry(s) for s in self._fs.globStatus(self._path(pattern)) or []]

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def files(self, path: str, suffix: str = ".parquet") -> list[tuple[str, int]]:
        """(path below ``path``, bytes) of all its data files, in order."""
        if not self.exists(path):
            return []
        base = self._fs.resolvePath(self._path(path)).toString().rstrip("/") + "/"
        out, each = [], self._fs.listFiles(self._path(path), True)
        while each.hasNext():
            s = each.next()
            name = s.getPath().toString()
            name = name[len(base):] if name.startswith(base) else name.split(path.rstrip("/") + "/", 1)[-1]
            if name.endswith(suffix) and not any(p.startswith(("_", ".")) for p in name.split("/")):
                out.append((name, s.getLen()))
        return sorted(out)

    def size(self, path: str) -> int:
        """Bytes of the file or folder; 0 if there is none."""
        return self._fs.getContentSummary(self._path(path)).getLength() if self.exists(path) else 0

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Write a new file; False if there is one of this name already."""
        try:
            stream = self._fs.create(self._path(path), False)
        except Exception as e:  # noqa: BLE001 - which class says so differs by store
            if self.exists(path):
                return False
            raise e
        try:
            stream.write(text.encode("utf-8"))
        finally:
            stream.close()
        return True

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
