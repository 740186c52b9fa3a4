"""Loading only the rows that keep given rules, and the others aside."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from ..operators.clean import TableRecord
from ..operators.validate import Check, split_by_rules, validate
from ..session import scratch_path
from .base import LoadResult, Sink


class QuarantineSink:
    """Sends rows that keep all ``checks`` to one sink, and the others, with the rules they break, to another.

    Rows are judged in one pass and written once; both sinks read that copy.  A table that breaks
    a rule of the table is not loaded at all.  What was loaded last counts as the result; the
    outcome per rule is in ``reports``.
    """

    def __init__(self, spark: SparkSession, good: Sink, bad: Sink, checks: Sequence[Check], stage_root: str | None = None):
        self.spark = spark
        self.good, self.bad = good, bad
        self.checks = list(checks)
        self.name = good.name
        self.stage_root = stage_root
        self.reports: dict[str, DataFrame] = {}
        self.set_aside: dict[str, LoadResult] = {}

    def prepare(self, records: Sequence[TableRecord]) -> None:
        self.good.prepare(records)
        self.bad.prepare(records)

    def target(self, record: TableRecord) -> str:
        return self.good.target(record)

    def load(self, record: TableRecord) -> LoadResult:
        stage = scratch_path(self.spark, "judged") if self.stage_root is None else f"{self.stage_root}/{record.output_name}"
        good, bad = split_by_rules(record.df, self.checks, stage)
        self.reports[record.name] = validate(record.df, self.checks)
        self.set_aside[record.name] = self.bad.load(replace(record, df=bad))
        return self.good.load(replace(record, df=good))
