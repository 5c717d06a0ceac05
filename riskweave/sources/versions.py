"""Numbered versions of stored tables, and which of them holds.

A version is a folder that is written whole; a small file named by its number,
made after the folder is complete, declares it. Readers take the highest number
declared, so they see the old version until the new one is whole, and a write
that fails changes nothing for them. Making one small file is atomic on file
systems and object stores alike; nothing is renamed or overwritten.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession

# Spark's readers skip names that begin with an underscore.
MANIFESTS = "_versions"
# Readers that have planned on the version before the last one can still finish.
KEPT = 2


class Files:
    """The few file operations that versions need, on any file system Spark reads."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._charset = spark._jvm.java.nio.charset.StandardCharsets.UTF_8
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """What lies in a folder; nothing if there is no such folder."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)))

    def make_folder(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def write(self, path: str, text: str) -> None:
        out = self._fs.create(self._path(path), True)
        try:
            out.write(text.encode())
        finally:
            out.close()

    def read(self, path: str) -> str:
        source = self._fs.open(self._path(path))
        try:
            return self._io.toString(source, self._charset)
        finally:
            source.close()


class Versions:
    """The versions declared below ``root``; each has a small manifest, any JSON value."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.root = root.rstrip("/")
        self.files = Files(spark, self.root)

    def _manifest(self, version: int) -> str:
        return f"{self.root}/{MANIFESTS}/{version:012d}.json"

    def declared(self) -> list[int]:
        names = self.files.names(f"{self.root}/{MANIFESTS}")
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit()]

    def current(self) -> int | None:
        return max(self.declared(), default=None)

    def manifest(self, version: int):
        return json.loads(self.files.read(self._manifest(version)))

    def declare(self, version: int, manifest=None) -> None:
        self.files.write(self._manifest(version), json.dumps(manifest))

    def forget(self, before: int) -> None:
        """Drop the manifests of versions below ``before``."""
        for version in self.declared():
            if version < before:
                self.files.delete(self._manifest(version))


def folder(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/version={version}"


def publish(spark: SparkSession, root: str, write: Callable[[str], None], keep: int = KEPT) -> int:
    """Have ``write`` fill the folder of the next version of ``root``, then declare it.

    If it raises, what readers see does not change; the folder it left is
    replaced by the next attempt. Versions older than the last ``keep`` go.
    """
    versions = Versions(spark, root)
    now = versions.current()
    version = 0 if now is None else now + 1
    target = folder(root, version)
    versions.files.delete(target)
    write(target)
    versions.declare(version)
    oldest = version - keep + 1
    versions.forget(oldest)
    drop_folders(versions.files, root, (n for n in versions.files.names(root) if _number(n, "version") < oldest))
    return version


def published(spark: SparkSession, root: str) -> str:
    """The folder of the version that holds; ``root`` itself where nothing was ever published."""
    now = Versions(spark, root).current()
    return root.rstrip("/") if now is None else folder(root, now)


def _number(name: str, key: str) -> float:
    return int(name.removeprefix(f"{key}=")) if name.startswith(f"{key}=") else float("inf")


def drop_folders(files: Files, root: str, names: Iterable[str]) -> None:
    for name in list(names):
        files.delete(f"{root.rstrip('/')}/{name}")
