"""Numbered manifests: a folder's contents as of a version, published at once.

Data files are written first, below names no reader knows. Then one small file names them; it is created
only if its number is not taken, so that of two writers one fails instead of hiding the other's work.
Readers take the newest complete manifest, and what it doesn't name doesn't exist for them. All
access goes through the file systems that Spark itself uses.
"""

from __future__ import annotations

import json
import re
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

NAME = re.compile(r"v(\d{12})\.json")


class Conflict(RuntimeError):
    """Another writer has published this version."""


class Versions:
    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm = spark._jvm
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def listed(self, name: str) -> list[str]:
        """Names directly below a folder, none if there is no such folder."""
        path = self._path(name)
        if not self._fs.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path))

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)

    def numbers(self) -> list[int]:
        found = (NAME.fullmatch(name) for name in self.listed("manifest"))
        return sorted(int(m[1]) for m in found if m)

    def read(self, number: int) -> dict[str, Any] | None:
        """Contents of a version; None if its writer died over it, or it was swept away."""
        path = self._path(f"manifest/v{number:012}.json")
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def current(self) -> tuple[int, dict[str, Any]]:
        """Number and contents of the newest complete version; 0 and nothing before the first."""
        for number in reversed(self.numbers()):
            content = self.read(number)
            if content is not None:
                return number, content
        return 0, {}

    def publish(self, after: int, content: dict[str, Any]) -> int:
        """The next version; fails if anyone has published since version `after`."""
        if self.current()[0] != after:
            raise Conflict(f"{self.root} has moved on from version {after}")
        number = max([0, *self.numbers()]) + 1
        text = bytearray(json.dumps(content, sort_keys=True).encode())
        try:
            stream = self._fs.create(self._path(f"manifest/v{number:012}.json"), False)
        except Py4JJavaError as exc:
            raise Conflict(f"{self.root} has a version {number} already") from exc
        try:
            stream.write(text)
        finally:
            stream.close()
        return number

    def forget(self, keep: int) -> list[dict[str, Any]]:
        """Delete all but the newest `keep` manifests; returns the contents of those kept."""
        numbers = self.numbers()
        for number in numbers[: -keep or None]:
            self.delete(f"manifest/v{number:012}.json")
        kept = [self.read(n) for n in numbers[-keep:]]
        return [c for c in kept if c is not None]
