"""What every sink reports, and loading many tables into many sinks."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import astuple, dataclass, replace
from typing import Protocol

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import TableRecord
from ..sources.files import FileSystem

REPORT_SCHEMA = (
    "sink string, target string, source string, row_count bigint, column_count int, "
    "action string, status string, error string"
)

CREATED, REPLACED, SKIPPED, APPENDED = "created", "replaced", "skipped", "appended"


@dataclass(frozen=True)
class LoadResult:
    """One table's outcome in one sink."""

    sink: str
    target: str
    source: str
    row_count: int | None
    column_count: int | None
    action: str | None
    status: str = "ok"
    error: str | None = None


class LoadLedger:
    """Which file's content reached which target: one small file for each finished load.

    A load is listed after it is finished.  A driver that is lost in between finds it unlisted
    and loads it again; replacing sinks then replace, and appending ones know the load by its key.
    """

    SCHEMA = "sink string, target string, source string, content string, batch string, row_count bigint, column_count int, action string"

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def loaded(self, sink: Sink, record: TableRecord, batch: str) -> LoadResult:
        target = sink.target(record)
        key = hashlib.sha256("\x1f".join((sink.name, target, record.name, record.content)).encode()).hexdigest()[:40]
        place, files = f"{self.root}/{sink.name}/{key}.json", FileSystem(self.spark)
        held = files.read_text(place)
        if held is not None:
            entry = json.loads(held)
            return LoadResult(sink.name, target, record.name, entry["row_count"], entry["column_count"], SKIPPED)
        result = sink.load(replace(record, load_key=key))
        entry = {"sink": sink.name, "target": target, "source": record.name, "content": record.content, "batch": batch,
                 "row_count": result.row_count, "column_count": result.column_count, "action": result.action}
        files.write_text(place, json.dumps(entry))
        return result

    def entries(self) -> DataFrame:
        """All finished loads."""
        if not FileSystem(self.spark).exists(self.root):
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(self.root)


class Sink(Protocol):
    name: str

    def target(self, record: TableRecord) -> str:
        """Where a table goes."""

    def prepare(self, records: Sequence[TableRecord]) -> None:
        """Settle target names for all records; raises on a collision."""

    def load(self, record: TableRecord) -> LoadResult:
        """Write one table and report what happened."""


def load_all(
    records: Sequence[TableRecord],
    sinks: Sequence[Sink],
    on_error: str = "continue",
    parallelism: int = 4,
    persist: bool = False,
    ledger: LoadLedger | None = None,
    batch: str = "",
) -> list[LoadResult]:
    """Write every good table to every sink; each pair of both is a unit of work of its own.

    ``on_error='continue'`` records a failed table and goes on; ``'fail'`` raises.
    Tables cleaned with ``stage_to`` are read back from their staged copy by each
    sink; ``persist`` instead keeps an unstaged table in memory or on local disk
    while it is written.  With a ``ledger``, a table whose file has content is loaded
    into each sink once: loads that the ledger lists are skipped, others are listed
    when they are finished, under ``batch``.
    """
    if on_error not in ("continue", "fail"):
        raise ValueError(f"unknown on_error: {on_error}")
    good = [r for r in records if r.status == "ok"]
    for sink in sinks:
        sink.prepare(good)

    def one(sink: Sink, record: TableRecord) -> LoadResult:
        try:
            if ledger is None or record.content is None:
                return sink.load(record)
            return ledger.loaded(sink, record, batch)
        except Exception as e:
            if on_error == "fail":
                raise
            error = f"{type(e).__name__}: {e}"
            return LoadResult(sink.name, record.output_name, record.name, None, None, None, "failed", error)

    if persist:
        for record in good:
            record.df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            units = [pool.submit(one, sink, record) for record in good for sink in sinks]
            return [unit.result() for unit in units]
    finally:
        if persist:
            for record in good:
                record.df.unpersist()


def load_report(spark: SparkSession, results: Sequence[LoadResult]) -> DataFrame:
    return spark.createDataFrame([astuple(r) for r in results], REPORT_SCHEMA)


def load_summary(report: DataFrame) -> DataFrame:
    """Per sink: tables written, created, replaced, and rows of successful writes."""
    ok = F.col("status") == "ok"
    written = ok & (F.col("action") != SKIPPED)
    return report.groupBy("sink").agg(
        F.count_if(written).alias("uploaded"),
        F.count_if(ok & (F.col("action") == CREATED)).alias("created"),
        F.count_if(ok & (F.col("action") == REPLACED)).alias("replaced"),
        F.count_if(ok & (F.col("action") == SKIPPED)).alias("skipped"),
        F.count_if(~ok).alias("failed"),
        F.coalesce(F.sum(F.when(written, F.col("row_count"))), F.lit(0)).alias("total_rows"),
    )
