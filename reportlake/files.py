"""Small files of the driver's own (locks, manifests), created only where none is."""

from __future__ import annotations

import os
import re
import uuid
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class LocalFiles:
    """Small files in a folder that the driver can open."""

    def __init__(self, root: str) -> None:
        self.root = re.sub("^file:/*", "/", root)

    def names(self, folder: str) -> list[str]:
        try:
            return os.listdir(os.path.join(self.root, folder))
        except FileNotFoundError:
            return []

    def read(self, name: str) -> tuple[str, datetime]:
        path = os.path.join(self.root, name)
        with open(path) as f:
            return f.read(), datetime.fromtimestamp(os.path.getmtime(path), timezone.utc)

    def create(self, name: str, text: str) -> bool:
        path = os.path.join(self.root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        whole = os.path.join(os.path.dirname(path), f".{uuid.uuid4().hex}")
        with open(whole, "x") as f:
            f.write(text)
        try:
            os.link(whole, path)
        except FileExistsError:
            return False
        finally:
            os.unlink(whole)
        return True

    def delete(self, name: str) -> None:
        try:
            os.unlink(os.path.join(self.root, name))
        except FileNotFoundError:
            pass


class HadoopFiles:
    """Small files of any store that Hadoop knows."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.jvm, self.root = spark._jvm, root
        self.store = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return [f.getPath().getName() for f in self.store.listStatus(path)] if self.store.exists(path) else []

    def read(self, name: str) -> tuple[str, datetime]:
        path = self._path(name)
        try:
            stream = self.store.open(path)
        except Py4JJavaError as e:
            raise FileNotFoundError(name) from e
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return text, datetime.fromtimestamp(self.store.getFileStatus(path).getModificationTime() / 1000, timezone.utc)

    def create(self, name: str, text: str) -> bool:
        try:
            out = self.store.create(self._path(name), False)
        except Py4JJavaError as e:
            if "exist" in str(e.java_exception):
                return False
            raise
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        return True

    def delete(self, name: str) -> None:
        self.store.delete(self._path(name), False)


def files_at(spark: SparkSession, root: str) -> LocalFiles | HadoopFiles:
    """The files below a path or URI."""
    local = re.match("(file:)?/", root) and not re.match("[a-z0-9]+://[^/]", root)
    return LocalFiles(root) if local else HadoopFiles(spark, root)
