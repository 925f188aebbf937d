"""Versioned manifests in a Hadoop folder: a version appears whole or not at all."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from .common import file_system


class Conflict(Exception):
    """Another writer committed this version first."""


class Manifests:
    """``v00000001.json`` and so on under a path; a version's name can be taken once.

    A version is written beside and renamed to its name. That claims the name on
    file systems whose rename is atomic and fails where the target exists (HDFS,
    ABFS; on a local disk up to the moment between look and rename). An object
    store's rename is a copy and claims nothing: such stores are refused, unless
    the path is ``private``, that is known to one writer only.
    """

    STORES = ("file", "hdfs", "viewfs", "abfs", "abfss")

    def __init__(self, spark: SparkSession, path: str, private: bool = False):
        self.spark, self.path, self.private = spark, path.rstrip("/"), private
        self.fs, self.make = file_system(spark, path)

    def numbers(self) -> list[int]:
        """The versions there are, in order."""
        top = self.make(self.path)
        if not self.fs.exists(top):
            return []
        found = [s.getPath().getName() for s in self.fs.listStatus(top)]
        return sorted(int(x[1:-5]) for x in found if x.startswith("v") and x.endswith(".json"))

    def latest(self) -> tuple[int, dict]:
        """(number, content) of the newest version; (0, {}) if there is none."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (0, {})

    def forget(self, before: int) -> None:
        """Deletes the versions before a number."""
        for n in self.numbers():
            if n < before:
                self.fs.delete(self.make(f"{self.path}/v{n:08}.json"), False)

    def read(self, version: int) -> dict:
        jvm = self.spark.sparkContext._jvm
        stream = self.fs.open(self.make(f"{self.path}/v{version:08}.json"))
        try:
            return json.loads(bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def commit(self, version: int, content: dict) -> None:
        """Makes ``content`` the version; raises Conflict if there is one already."""
        draft, final = self.make(f"{self.path}/.draft-{uuid.uuid4().hex}"), self.make(f"{self.path}/v{version:08}.json")
        if (scheme := self.fs.getUri().getScheme()) not in self.STORES and not self.private:
            raise ValueError(f"a manifest needs an atomic rename, which {scheme}: does not have; keep it in one of {', '.join(self.STORES)}")
        out = self.fs.create(draft, True)
        out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        out.close()
        if self.fs.exists(final) or not self.fs.rename(draft, final):
            self.fs.delete(draft, False)
            raise Conflict(f"version {version} of {self.path} exists")

    def update(self, change: Callable[[int, dict], dict | None]) -> tuple[int, dict]:
        """Commits what ``change`` makes of the newest version, anew after each conflict; None leaves it as it is. The version that then holds."""
        while True:
            version, now = self.latest()
            made = change(version, now)
            if made is None:
                return version, now
            try:
                self.commit(version + 1, made)
            except Conflict:
                continue
            return version + 1, made
