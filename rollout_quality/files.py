"""Files and folders of the store that a path belongs to, as Spark reaches it; never the local disk by assumption."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """Operations on whole files and folders below `root`; paths are given in full."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, folder: str) -> list[str]:
        """Sorted names of what is in a folder; none if it is not there."""
        if not self.exists(folder):
            return []
        return sorted(f.getPath().getName() for f in self._fs.listStatus(self._path(folder)))

    def delete(self, path: str) -> None:
        """A file, or a folder with all that is in it; nothing happens if it is not there."""
        self._fs.delete(self._path(path), True)

    def move(self, source: str, target: str) -> None:
        """To a place that is free."""
        to = self._path(target)
        self._fs.mkdirs(to.getParent())
        if not self._fs.rename(self._path(source), to):
            raise OSError(f"cannot move {source} to {target}")

    def write_text(self, path: str, text: str) -> None:
        """The file appears with its whole text: it is written under another name first."""
        part = f"{path}.part"
        out = self._fs.create(self._path(part), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.delete(path)
        self.move(part, path)

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
