"""Folders whose content is replaced as a whole, in any store that Spark reads."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def new_run() -> str:
    """A name that no other run has."""
    return uuid.uuid4().hex[:12]


class Folder:
    """A folder of any store that Spark reads, and what stands aside for it: siblings whose
    names begin with an underscore, which no reader of the parent takes for data."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.place = self._path(path)
        self.store = self.place.getFileSystem(spark._jsc.hadoopConfiguration())

    def aside(self, kind: str) -> str:
        return self._path(self.place.getParent(), f"_{self.place.getName()}-{kind}-{new_run()}").toString()

    def _asides(self, kind: str) -> list:
        parent, begins = self.place.getParent(), f"_{self.place.getName()}-{kind}-"
        if parent is None or not self.store.exists(parent):
            return []
        found = [x for x in self.store.listStatus(parent) if x.getPath().getName().startswith(begins)]
        return [x.getPath() for x in sorted(found, key=lambda x: x.getModificationTime())]

    def _move(self, source: object, target: object) -> None:
        if not self.store.rename(source, target):
            raise OSError(f"{source} could not be renamed to {target}")

    def replace(self, aside: str) -> None:
        """Let the folder ``aside`` take the place; what was there goes last."""
        old = None
        if self.store.exists(self.place):
            old = self._path(self.aside("old"))
            self._move(self.place, old)
        try:
            self._move(self._path(aside), self.place)
        except BaseException:
            if old is not None:
                self._move(old, self.place)
            raise
        if old is not None:
            self.store.delete(old, True)

    def recover(self) -> bool:
        """Whether the place was empty and its old rows stood aside; they are back now."""
        if self.store.exists(self.place):
            return False
        left = self._asides("old")
        if left:
            self._move(left[-1], self.place)
        return bool(left)

    def remove(self, aside: str) -> None:
        """Delete what a failed write left, if that can still be done."""
        try:
            self.store.delete(self._path(aside), True)
        except Exception as error:  # the failure that brought us here matters more
            print(f"{aside} is left over: {error}")
