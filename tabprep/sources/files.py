"""File listing and small file-system actions on any path Spark can read."""

from __future__ import annotations

import fnmatch
import re
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class NoInputFiles(ValueError):
    """The folder is missing, or holds no matching file."""


class FileSystem:
    """Existence checks, deletes and renames through the Hadoop file system of a path."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _open(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._open(path)
        return fs.exists(p)

    def delete(self, path: str) -> bool:
        fs, p = self._open(path)
        return fs.delete(p, True)

    def names(self, folder: str) -> list[str]:
        """Names directly below a folder; none if it is missing."""
        fs, p = self._open(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def modified(self, folder: str) -> dict[str, int]:
        """Names directly below a folder with their modification times; none if it is missing."""
        fs, p = self._open(folder)
        return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(p)} if fs.exists(p) else {}

    def make_folder(self, path: str) -> None:
        fs, p = self._open(path)
        fs.mkdirs(p)

    def size(self, path: str) -> int:
        """Bytes below a path."""
        fs, p = self._open(path)
        return fs.getContentSummary(p).getLength()

    def empty_files(self, folder: str, pattern: str) -> list[str]:
        """Names of matching files without any byte, which Spark's own listings leave out."""
        fs, p = self._open(folder)
        found = [s for s in fs.listStatus(p) if s.getLen() == 0 and s.isFile()]
        names = [s.getPath().getName() for s in found]
        return sorted(n for n in names if fnmatch.fnmatchcase(n, pattern))

    def write_text(self, path: str, text: str) -> None:
        """A small file that is there in full or not at all; an older one is replaced."""
        fs, p = self._open(path)
        fs.mkdirs(p.getParent())
        _, fresh = self._open(f"{p.getParent()}/.{p.getName()}-{uuid.uuid4().hex[:12]}")
        out = fs.create(fresh)
        out.write(bytearray(text.encode()))
        out.close()
        if not fs.rename(fresh, p):
            fs.delete(p, False)
            if not fs.rename(fresh, p):
                raise OSError(f"cannot write {path}")

    def read_text(self, path: str) -> str | None:
        """The content of a small file; ``None`` if it is missing."""
        fs, p = self._open(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def rename(self, source: str, target: str) -> None:
        fs, s = self._open(source)
        _, t = self._open(target)
        fs.mkdirs(t.getParent())
        if not fs.rename(s, t):
            raise OSError(f"cannot rename {source} to {target}")


def plain_path(uri: Column) -> Column:
    """A readable path from a file URI, decoded and with one spelling of the local scheme."""
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, r"\Afile:/+", "file:/")


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def glob_escaped(path: str) -> str:
    """A literal path in a form that the reader does not take for a glob pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def file_inventory(
    spark: SparkSession, folder: str | list[str], pattern: str = "*.csv", recursive: bool = False,
    exclude: str | Sequence[str] = (),
) -> DataFrame:
    """Path, name, modification time and size of every matching file; contents are not read.

    Files whose name matches a pattern of ``exclude`` (``*``, ``?`` and ``[...]``) are left out.
    """
    patterns = [exclude] if isinstance(exclude, str) else list(exclude)
    unwanted = reduce(or_, [F.col("name").rlike(rf"\A(?:{fnmatch.translate(p)})") for p in patterns], F.lit(False))
    return _listed(spark, folder, pattern, recursive).where(~unwanted)


def _listed(spark: SparkSession, folder: str | list[str], pattern: str, recursive: bool) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(folder)
        .select(
            F.regexp_replace("path", r"\Afile:/+", "file:/").alias("path"),
            file_name(F.col("path")).alias("name"),
            F.col("modificationTime").alias("modified"),
            F.col("length"),
        )
    )


def require_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """The inventory of ``folder``; raises if it is missing or holds no matching file."""
    if not FileSystem(spark).exists(folder):
        raise NoInputFiles(f"folder not found: {folder}")
    inventory = file_inventory(spark, folder, pattern)
    if inventory.isEmpty() and not FileSystem(spark).empty_files(folder, pattern):
        raise NoInputFiles(f"no {pattern} files in {folder}")
    return inventory
