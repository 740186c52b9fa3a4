"""The whole path from a folder of files to loaded, verified tables, at once or as files arrive."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.names import normalize_columns
from ..operators.clean import CleanConfig, TableRecord, clean_report, clean_tables
from ..session import scratch_path
from ..sinks.base import LoadLedger, LoadResult, Sink, load_all, load_report, load_summary
from ..sources.delimited import extract, extract_parts
from ..sources.files import file_inventory, file_name
from ..streaming.intake import DEFAULT_INTERVAL, FileCursor, FileLog


@dataclass
class PipelineResult:
    records: list[TableRecord]
    cleaning: DataFrame
    loads: list[LoadResult]
    report: DataFrame
    summary: DataFrame


def run_pipeline(
    spark: SparkSession,
    folder: str,
    sinks: Sequence[Sink],
    config: CleanConfig | None = None,
    *,
    pattern: str = "*.csv",
    by_layout: bool = False,
    on_error: str = "continue",
    parallelism: int = 4,
    stage_root: str | None = None,
    paths: Sequence[str] | None = None,
    strict: bool = True,
    ledger: LoadLedger | None = None,
    batch: str = "",
) -> PipelineResult:
    """Extract, clean and load every file of a folder, or those of its files that ``paths`` names.

    Each file is one table, or with ``by_layout`` all files of one layout are.
    Cleaned rows are staged once in shared storage, so that each sink reads the
    finished columns instead of cleaning again.  Unless ``strict``, files of which none
    can be used are reported like any other.  With a ``ledger``, a file's content is
    loaded into each sink once, however often the same run is tried.
    """
    if by_layout and paths is not None:
        raise ValueError("by_layout takes whole folders")
    found = extract_parts(spark, folder, pattern) if by_layout else extract(spark, folder, pattern, paths=paths, strict=strict)
    stage = stage_root or scratch_path(spark, "stage")
    good = [r for r in found if r.status == "ok"]
    cleaned = clean_tables(good, config, parallelism=parallelism, stage_root=stage, strict=strict)
    records = cleaned + [r for r in found if r.status != "ok"]
    loads = load_all(records, sinks, on_error=on_error, parallelism=parallelism, ledger=ledger, batch=batch)
    report = load_report(spark, loads)
    return PipelineResult(records, clean_report(spark, records), loads, report, load_summary(report))


def process_partition(
    spark: SparkSession, folder: str, partition: dict[str, str], sinks: Sequence[Sink],
    config: CleanConfig | None = None, *, pattern: str = "*.csv", parallelism: int = 4, on_error: str = "continue",
) -> PipelineResult:
    """Extract, clean and load the files of one partition, such as ``{"day": "2024-05-01"}``, of a partitioned folder.

    Files below ``folder/day=2024-05-01`` are read, one table for each layout; cleaned rows get the
    partition's values as columns.  A ``PartitionedSink`` then replaces this partition alone.
    """
    place = "/".join([folder.rstrip("/"), *(f"{k}={v}" for k, v in partition.items())])
    good = clean_tables(extract_parts(spark, place, pattern), config, parallelism=parallelism, stage_root=scratch_path(spark, "stage"))
    values = {normalize_columns([k])[0]: F.lit(v) for k, v in partition.items()}
    records = [replace(r, df=r.df.withColumns(values)) if r.status == "ok" else r for r in good]
    loads = load_all(records, sinks, on_error=on_error, parallelism=parallelism)
    report = load_report(spark, loads)
    return PipelineResult(records, clean_report(spark, records), loads, report, load_summary(report))


def outcomes(spark: SparkSession, result: PipelineResult) -> DataFrame:
    """What became of each file: ``name``, ``status``, ``error``, ``content``; a file that a sink failed on is ``failed``."""
    failed = {x.source: f"{x.sink}: {x.error}" for x in result.loads if x.status == "failed"}
    rows = []
    for r in result.records:
        status = "failed" if r.name in failed else "loaded" if r.status == "ok" else r.status
        rows.append((r.name, status, failed.get(r.name, r.error), r.content))
    return spark.createDataFrame(rows, "name string, status string, error string, content string")


def process_new(
    spark: SparkSession, folder: str, cursor: FileCursor, sinks: Sequence[Sink],
    config: CleanConfig | None = None, *, pattern: str = "*.csv", log: FileLog | None = None, **options,
) -> PipelineResult | None:
    """Take in the files that ``cursor`` has not seen, then advance it; ``None`` if there are none.

    One stored listing serves both, and the cursor moves after loading: a run that
    fails finds the same files again.  With a ``log``, files that hold nothing or cannot be
    loaded are noted there and passed by; they are taken in again once they have changed.
    """
    path = scratch_path(spark, "listing")
    file_inventory(spark, folder, pattern).write.parquet(path)
    listing = spark.read.parquet(path)
    due = cursor.pending(listing)
    if log is not None:
        due = due.unionByName(log.due(listing)).distinct()
    names = [r.path for r in due.select("path").collect()]
    result = None
    if names:
        number = log.next_batch() if log is not None else None
        options.setdefault("batch", "" if number is None else str(number))
        result = run_pipeline(spark, folder, sinks, config, pattern=pattern, paths=names, strict=log is None, **options)
        if log is not None:
            log.record(number, listing, outcomes(spark, result))
    cursor.advance(listing)
    return result


_FILES = "path string, modificationTime timestamp, length long, content binary"


def stream_to_targets(
    spark: SparkSession, folder: str, work: str, sinks: Sequence[Sink],
    config: CleanConfig | None = None, *, pattern: str = "*.csv",
    interval: str | None = DEFAULT_INTERVAL, max_files: int | None = None, **options,
) -> StreamingQuery:
    """Extract, clean and load files as they arrive, each with its own dialect and header.

    The stream carries paths only.  A batch that is replayed loads each file into each sink
    once: ``stream_ledger`` lists what is finished, and appends know their loads.  Files that
    cannot be used are listed by ``stream_log`` and do not stop the stream.  With
    ``interval=None`` it takes what is there and stops.
    """
    reader = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    arriving = reader.load(folder).select(
        F.regexp_replace("path", r"\Afile:/+", "file:/").alias("path"), F.col("modificationTime").alias("modified"), "length"
    )
    ledger, log = stream_ledger(spark, work), stream_log(spark, work)

    def take_in(batch: DataFrame, batch_id: int) -> None:
        held = scratch_path(spark, "arrived")
        batch.withColumn("name", file_name(F.col("path"))).write.parquet(held)
        listing = spark.read.parquet(held)
        names = [r.path for r in listing.select("path").collect()]
        if names:
            result = run_pipeline(spark, folder, sinks, config, pattern=pattern, paths=names, strict=False,
                                  ledger=ledger, batch=str(batch_id), **options)
            log.record(batch_id, listing, outcomes(spark, result))

    writer = arriving.writeStream.foreachBatch(take_in).option("checkpointLocation", f"{work.rstrip('/')}/checkpoint")
    return writer.trigger(**({"availableNow": True} if interval is None else {"processingTime": interval})).start()


def stream_ledger(spark: SparkSession, work: str) -> LoadLedger:
    """The finished loads of a stream with this work folder."""
    return LoadLedger(spark, f"{work.rstrip('/')}/ledger")


def stream_log(spark: SparkSession, work: str) -> FileLog:
    """What became of the files of a stream with this work folder."""
    return FileLog(spark, f"{work.rstrip('/')}/files")
