"""Listing, reading and publishing single files by the file system of a path."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """The few file operations that Spark's readers and writers do not offer, by the table's own file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.root = root

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def system(self):
        return self.path("").getFileSystem(self.conf)

    def names(self, folder: str = "") -> list[str]:
        """What lies in a folder, without hidden and marker files; nothing if it is absent."""
        system, path = self.system(), self.path(folder)
        found = [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []
        return sorted(n for n in found if n[0] not in "._")

    def read(self, name: str) -> str:
        stream = self.system().open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Publish a whole file under a name; False if the name is taken."""
        system, target = self.system(), self.path(name)
        draft = self.jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
        out = system.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        hadoop = self.jvm.org.apache.hadoop.fs
        rename = hadoop.Options.Rename.NONE
        kinds = self.jvm.java.lang.reflect.Array.newInstance(rename.getClass(), 1)
        kinds[0] = rename
        try:
            hadoop.FileContext.getFileContext(target.toUri(), self.conf).rename(draft, target, kinds)
            return True
        except Exception as error:
            system.delete(draft, False)
            if "FileAlreadyExists" in str(error):
                return False
            raise

    def delete(self, name: str) -> None:
        self.system().delete(self.path(name), True)
