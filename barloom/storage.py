"""Small files and renames on the file system of a path, through Hadoop's API."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self.path().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def exists(self, *parts: str) -> bool:
        return self._fs.exists(self.path(*parts))

    def names(self, *parts: str) -> list[str]:
        if not self.exists(*parts):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self.path(*parts)))

    def read_text(self, *parts: str) -> str:
        stream = self._fs.open(self.path(*parts))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def write_new(self, text: str, *parts: str) -> bool:
        """Puts a file in place in one step that fails where there is one already; False if another writer was first. On a local file system that step is a hard link, elsewhere the rename that doesn't replace."""
        final = self.path(*parts)
        tmp = self._jvm.org.apache.hadoop.fs.Path(final.getParent(), f".{final.getName()}.{self._jvm.java.util.UUID.randomUUID()}")
        stream = self._fs.create(tmp, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        try:
            if self._fs.getUri().getScheme() == "file":
                local = lambda p: self._jvm.java.nio.file.Paths.get(p.toUri().getPath(), self.spark.sparkContext._gateway.new_array(self._jvm.java.lang.String, 0))
                self._jvm.java.nio.file.Files.createLink(local(final), local(tmp))
            else:
                conf = self.spark.sparkContext._jsc.hadoopConfiguration()
                none = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
                how = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
                how[0] = none
                self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf).rename(tmp, final, how)
            return True
        except Py4JJavaError:
            if not self._fs.exists(final):
                raise
            return False
        finally:
            if self._fs.exists(tmp):
                self._fs.delete(tmp, False)

    def delete(self, *parts: str) -> None:
        self._fs.delete(self.path(*parts), True)

    def rename(self, a: list[str], b: list[str]) -> bool:
        self._fs.mkdirs(self.path(*b).getParent())
        return self._fs.rename(self.path(*a), self.path(*b))


def arrow_place(path: str):
    """The file system of a path for Arrow, and the path on it; for Python workers that read and write files where they run. A local path is taken as it stands, as Hadoop does; elsewhere what a URI can't hold (other scripts, blanks, #) is escaped, while % and ? mean what they mean to Arrow."""
    from urllib.parse import quote

    from pyarrow import fs

    if path.startswith("file:") or "://" not in path:
        local = path.removeprefix("file:")
        return fs.LocalFileSystem(), "/" + local.strip("/") if local.startswith("/") else local
    for other in ("s3a://", "s3n://"):
        path = path.replace(other, "s3://", 1) if path.startswith(other) else path
    return fs.FileSystem.from_uri(quote(path, safe="/:?@[]!$&'()*+,;=%~"))
