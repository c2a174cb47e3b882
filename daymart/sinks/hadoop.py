"""Small metadata files through Hadoop's file system: read, write once, list, delete."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """The file system that holds ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self.fs = self.path(self.root).getFileSystem(self._conf)

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def listed(self, folder: str) -> list[tuple[str, bool, int]]:
        """(name, is a folder, milliseconds of the last change) of what a folder holds."""
        if not self.exists(folder):
            return []
        return [(s.getPath().getName(), s.isDirectory(), s.getModificationTime()) for s in self.fs.listStatus(self.path(folder))]

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def read_json(self, name: str):
        stream = self.fs.open(self.path(name))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def create_json(self, name: str, doc) -> bool:
        """True if the file is now there with ``doc``; False if one of that name was there before. It appears whole or
        not at all: it is written under a draft name and renamed, which fails if the name is taken."""
        target = self.path(name)
        folder = target.getParent()
        self.fs.mkdirs(folder)
        draft = self.path(f"{folder.toString()}/.{target.getName()}-{uuid.uuid4().hex}.tmp")
        out = self.fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(doc, sort_keys=True, indent=1).encode("utf-8")))
        finally:
            out.close()
        hadoop = self._jvm.org.apache.hadoop.fs
        options = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        context = hadoop.FileContext.getFileContext(self.fs.getUri(), self._conf)
        try:
            context.rename(self.fs.makeQualified(draft), self.fs.makeQualified(target), options)
        except Py4JJavaError as exc:
            self.fs.delete(draft, False)
            if "FileAlreadyExistsException" in exc.java_exception.getClass().getName():
                return False
            raise
        return True
