"""Files below a folder, through the file system that Spark uses for its path."""

from __future__ import annotations

from pyspark.sql import SparkSession

# What Spark writes as %XX in the folder of a partition value, and its name for a missing one.
_ESCAPED = set("\"#%'*/:=?\\{[]^\x7f") | {chr(c) for c in range(1, 32)}
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def partition_folder(column: str, text: str | None) -> str:
    """Folder name of a partition value, given as text."""
    return f"{_escaped(column)}={_escaped(text) if text else NO_VALUE}"


def _escaped(text: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in text)


class Folder:
    """A folder's files.  Paths are as Spark names them; a missing file is no error."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._fs = self._path(self.root).getFileSystem(self._conf)

    def exists(self, path: str = "") -> bool:
        return self._fs.exists(self._at(path))

    def files(self, path: str = "") -> list[str]:
        """Every file below, hidden ones left out, as a path from the root."""
        at = self._at(path)
        if not self._fs.exists(at):
            return []
        found, walk = [], self._fs.listFiles(at, True)
        while walk.hasNext():
            name = self._below(walk.next().getPath())
            if not name.rsplit("/", 1)[-1].startswith(("_", ".")):
                found.append(name)
        return sorted(found)

    def matching(self, pattern: str) -> list[tuple[str, int, bool]]:
        """(path from the root, bytes, whether it is a folder) of what a path pattern below the root names."""
        found = self._fs.globStatus(self._path(f"{self.root}/{pattern}"))
        return [(self._below(x.getPath()), x.getLen(), x.isDirectory()) for x in found or []]

    def sizes(self, path: str) -> dict[str, int]:
        """Bytes of a file, or of every file below a folder, hidden ones left out, by path from the root."""
        return {f: self._fs.getFileStatus(self._at(f)).getLen() for f in self.files(path)}

    def first_line(self, path: str) -> str | None:
        """The first line of a text file that is not blank."""
        stream = self._fs.open(self._at(path))
        try:
            lines = self._jvm.java.io.BufferedReader(self._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            while (line := lines.readLine()) is not None:
                if line.strip():
                    return line.removeprefix("\ufeff")
            return None
        finally:
            stream.close()

    def relative(self, uri: str) -> str:
        """A file's path from the root, by the URI in which a scan reports it."""
        return self._below(self._path(self._jvm.java.net.URI.create(uri)))

    def _below(self, path) -> str:
        base = self._fs.makeQualified(self._at("")).toString().rstrip("/") + "/"
        return self._fs.makeQualified(path).toString().removeprefix(base)

    def delete(self, path: str) -> None:
        self._fs.delete(self._at(path), True)

    def move(self, path: str, to: str) -> None:
        """Move a file unless it has been moved already."""
        source, target = self._at(path), self._at(to)
        if self._fs.exists(source):
            self._fs.mkdirs(target.getParent())
            if not self._fs.rename(source, target):
                raise OSError(f"could not move {path} to {to} in {self.root}")

    def _at(self, path: str):
        return self._path(f"{self.root}/{path}" if path else self.root)
