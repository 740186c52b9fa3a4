"""Delimited files, one folder of part files per table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..operators.clean import TableRecord
from ..operators.tables import observed_rows
from ..sources.files import FileSystem
from .base import CREATED, REPLACED, SKIPPED, LoadResult


def write_delimited(df: DataFrame, path: str, separator: str = "|", encoding: str = "UTF-8") -> int:
    """Write ``df`` with a header line per part file; returns the number of rows written."""
    counted, seen = observed_rows(df)
    counted.write.options(
        sep=separator, header="true", encoding=encoding, quote='"', escape='"',
        ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
    ).csv(path)
    return seen.get["rows"]


class DelimitedSink:
    """Pipe-separated UTF-8 files below ``root``.

    An existing target is replaced or left alone, as asked.  A replacement is
    written in full next to the target before the old files are removed.
    """

    name = "delimited"

    def __init__(self, root: str, replace: bool = True, separator: str = "|"):
        self.root = root.rstrip("/")
        self.replace = replace
        self.separator = separator

    def prepare(self, records) -> None:
        names = [r.output_name for r in records]
        if len(set(names)) != len(names):
            raise ValueError("two tables share an output name")

    def target(self, record: TableRecord) -> str:
        return f"{self.root}/{record.output_name}"

    def load(self, record: TableRecord) -> LoadResult:
        target = self.target(record)
        files = FileSystem(record.df.sparkSession)
        existed = files.exists(target)
        columns = len(record.df.columns)
        if existed and not self.replace:
            return LoadResult(self.name, target, record.name, record.rows, columns, SKIPPED)
        staged = f"{self.root}/.stage-{uuid.uuid4().hex[:12]}"
        rows = write_delimited(record.df, staged, self.separator)
        if existed:
            files.delete(target)
        files.rename(staged, target)
        return LoadResult(
            self.name, target, record.name, rows, columns, REPLACED if existed else CREATED
        )
