"""Taking in new files: listing differences, cursors, and a file stream."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.names import normalize_columns
from ..operators.additive import AdditivePlan
from ..operators.clean import CleanConfig, CleanPlan, clean_table
from ..operators.tables import TableStore
from ..sources.delimited import NA_TOKENS, read_header, reader_options, shaped, text_schema
from ..sources.dialect import UTF8, Dialect
from ..sources.files import FileSystem, glob_escaped, plain_path

DEFAULT_INTERVAL = "10 seconds"


def new_files(current: DataFrame, seen: DataFrame, key="path", modified: str | None = None) -> DataFrame:
    """Listed files that were not seen before; with ``modified``, changed files count as new."""
    keys = [key] if modified is None else [key, modified]
    return current.join(seen.select(*keys).distinct(), keys, "left_anti")


def batch_summary(files: DataFrame, name: str = "name") -> DataFrame:
    """Number of new files and their names, joined in order: one row to show, for listings of modest size."""
    names = F.sort_array(F.collect_set(name))
    return files.agg(
        F.count_distinct(name).alias("file_count"), F.concat_ws(",", names).alias("new_files")
    )


class FileCursor:
    """Which files were present at the last check, kept as a table.

    Advancing replaces the cursor by the current listing: a file that vanished
    is forgotten, and is new again when it comes back.
    """

    def __init__(self, store: TableStore, name: str, detect_modified: bool = False):
        self.store = store
        self.name = name
        self.modified = "modified" if detect_modified else None

    def pending(self, current: DataFrame) -> DataFrame:
        if not self.store.exists(self.name):
            return current
        return new_files(current, self.store.table(self.name), "path", self.modified)

    def advance(self, current: DataFrame) -> int:
        columns = ["path", "name"] + ([self.modified] if self.modified else [])
        checked = current.select(*columns).withColumn("last_check", F.current_timestamp())
        return self.store.replace(self.name, checked)

    def reset(self) -> bool:
        """Forget everything, so that all files are new."""
        return self.store.drop(self.name)


class FileLog:
    """What became of every file that was taken in: ``loaded``, ``empty`` or ``failed``, and how often it was tried.

    Each check adds a folder of its own, which a check that is repeated overwrites.  A file
    that was not loaded stops nothing: it is listed here, and is due again when it changes.
    """

    SCHEMA = "path string, name string, modified timestamp, length bigint, content string, status string, error string, tries int, batch bigint"

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def next_batch(self) -> int:
        taken = [int(n.split("=")[1]) for n in FileSystem(self.spark).names(self.root) if n.startswith("check=")]
        return max(taken, default=-1) + 1

    def record(self, batch: int, listing: DataFrame, outcomes: DataFrame) -> None:
        """Note ``outcomes`` (``name``, ``status``, ``error``, ``content``) of the files of ``listing``."""
        tried = self.latest(before=batch).select("path", F.col("tries").alias("__tries"))
        rows = (
            listing.join(outcomes, "name").join(tried, "path", "left")
            .withColumns({"tries": (F.coalesce("__tries", F.lit(0)) + 1).cast("int"), "batch": F.lit(batch).cast("bigint")})
        )
        columns = [c.split(" ")[0] for c in self.SCHEMA.split(", ")]
        rows.select(*columns).write.mode("overwrite").parquet(f"{self.root}/check={batch}")

    def history(self) -> DataFrame:
        """Every try of every file."""
        if not FileSystem(self.spark).names(self.root):
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(f"{self.root}/check=*")

    def latest(self, before: int | None = None) -> DataFrame:
        """The last try of every file, before a given check if one is named."""
        rows = self.history()
        if before is not None:
            rows = rows.where(F.col("batch") < before)
        last = rows.groupBy("path").agg(F.max_by(F.struct(*rows.columns), "batch").alias("last"))
        return last.select("last.*")

    def due(self, listing: DataFrame) -> DataFrame:
        """Listed files that were tried without being loaded, and have changed since."""
        tried = self.latest().where("status <> 'loaded'").select("path", F.col("modified").alias("__modified"), F.col("length").alias("__length"))
        changed = ~(F.col("modified").eqNullSafe(F.col("__modified")) & F.col("length").eqNullSafe(F.col("__length")))
        return listing.join(tried, "path").where(changed).select(*listing.columns)

    def edited(self, current: DataFrame) -> DataFrame:
        """Files of ``current`` (``path``, ``content``) that were loaded with another content under the same path."""
        held = self.latest().where("status = 'loaded'").select("path", F.col("content").alias("__content"))
        return current.join(held, "path").where(~F.col("content").eqNullSafe(F.col("__content"))).select(*current.columns)

    def renamed(self, current: DataFrame) -> DataFrame:
        """Files of ``current`` whose path is new but whose content was loaded: with the first path it came under, ``former``."""
        known = self.latest().where("status = 'loaded' and content is not null")
        former = known.groupBy("content").agg(F.min_by("path", F.struct("batch", "path")).alias("former"))
        fresh = current.join(known.select("path"), "path", "left_anti")
        return fresh.join(former, "content").select(*current.columns, "former")


class HeaderMismatch(ValueError):
    """A file's header is not the one that its stream is for."""


class FileIntake:
    """A stream of delimited files of one layout into a landing folder of raw text columns.

    A file whose header names other columns, or the same in another order, is refused:
    nothing of its batch lands and the stream stops, or with ``on_mismatch='skip'`` the
    file alone is left out and listed by ``refused``.  Files of several layouts are for
    ``stream_to_targets``.

    Each micro-batch is written aside, checked, and then moved to a subfolder of its own
    in place of what an earlier try left there, so a batch that is replayed after a
    failure leaves no duplicates.  Whole-table decisions are not made
    per batch: ``clean`` decides over everything landed, or applies an earlier
    plan unchanged.
    """

    def __init__(self, spark: SparkSession, source: str, columns: Sequence[str], work: str,
                 dialect: Dialect = Dialect(), pattern: str = "*.csv", run: str = "first",
                 max_files: int | None = None, on_mismatch: str = "raise"):
        if on_mismatch not in ("raise", "skip"):
            raise ValueError(f"unknown on_mismatch: {on_mismatch}")
        self.on_mismatch = on_mismatch
        self.spark = spark
        self.source = source
        self.names = normalize_columns(columns)
        self.dialect = dialect
        self.pattern = pattern
        self.max_files = max_files
        # A new run name starts from an empty checkpoint: every file is taken in again.
        self.base = f"{work.rstrip('/')}/{run}"
        self.landing = f"{self.base}/landing"
        self.log = f"{self.base}/batches"
        self.refusals = f"{self.base}/refused"

    def _stream(self) -> DataFrame:
        reader = (
            self.spark.readStream.schema(text_schema(len(self.names)))
            .options(**reader_options(self.dialect))
            .option("pathGlobFilter", self.pattern)
        )
        if self.max_files:
            reader = reader.option("maxFilesPerTrigger", str(self.max_files))
        path = plain_path(F.col("_metadata.file_path")).alias("__path")
        return shaped(reader.csv(self.source), self.names, self.dialect, NA_TOKENS, path)

    def _land(self, batch: DataFrame, batch_id: int) -> None:
        spark, files = batch.sparkSession, FileSystem(self.spark)
        aside, target = f"{self.base}/arriving/batch_id={batch_id}", f"{self.landing}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(aside)
        arrived = spark.read.parquet(aside)
        paths = [r["__path"] for r in arrived.select("__path").distinct().collect()]
        bad = self._mismatches(paths)
        if bad and self.on_mismatch == "raise":
            raise HeaderMismatch("; ".join(f"{path}: {fields}" for path, fields in sorted(bad.items())))
        if bad:
            kept = f"{aside}-kept"
            arrived.where(~F.col("__path").isin(list(bad))).write.mode("overwrite").parquet(kept)
            refused = [(batch_id, path, path.rsplit("/", 1)[-1], ",".join(x or "" for x in fields)) for path, fields in bad.items()]
            spark.createDataFrame(refused, self.REFUSED).write.mode("overwrite").parquet(f"{self.refusals}/check={batch_id}")
            files.delete(aside)
            aside = kept
        names = spark.createDataFrame([(p.rsplit("/", 1)[-1],) for p in paths if p not in bad], "name string")
        names.distinct().write.mode("overwrite").parquet(f"{self.log}/batch_id={batch_id}")
        files.delete(target)
        files.rename(aside, target)

    REFUSED = "batch_id bigint, path string, name string, header string"

    def merged_plan(self, config: CleanConfig | None = None) -> tuple[CleanPlan, list[str]]:
        """The plan over all landed rows, and the batches that were read for it: as a rule the new ones only."""
        batches = [n for n in FileSystem(self.spark).names(self.landing) if n.startswith("batch_id=")]
        read = lambda b: self.spark.read.parquet(f"{self.landing}/{b}").drop("__path")
        states = AdditivePlan(self.spark, f"{self.base}/states", self.names, config)
        return states.plan(batches, read, text_schema(len(self.names)))

    def refused(self) -> DataFrame:
        """Files that were left out for their header."""
        if not FileSystem(self.spark).names(self.refusals):
            return self.spark.createDataFrame([], self.REFUSED)
        return self.spark.read.schema(self.REFUSED).parquet(f"{self.refusals}/check=*")

    def _mismatches(self, files: Sequence[str]) -> dict[str, list]:
        """The fields of every file of a batch whose header is another one; one small row a file reaches the driver."""
        if not files:
            return {}
        if self.dialect.encoding == UTF8:
            lines = self.spark.read.text([glob_escaped(f) for f in files]).select(
                "value", plain_path(F.col("_metadata.file_path")).alias("file"),
                F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"),
            )
            first = lines.where("block = 0 and trim(value) <> ''").groupBy("file").agg(F.min_by("value", "place").alias("line"))
            heads = {r.file: next(csv.reader([r.line.removeprefix("\ufeff")], delimiter=self.dialect.separator), []) for r in first.collect()}
        else:  # a line read as text would not show its names
            heads = {f: read_header(self.spark, f, self.dialect) for f in files}
        return {f: fields for f, fields in heads.items() if list(normalize_columns(fields)) != list(self.names)}

    def start(self, interval: str | None = DEFAULT_INTERVAL) -> StreamingQuery:
        """Start the stream; with ``interval=None`` it takes what is there and stops."""
        writer = (
            self._stream()
            .writeStream.foreachBatch(self._land)
            .option("checkpointLocation", f"{self.base}/checkpoint")
        )
        trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
        return writer.trigger(**trigger).start()

    def run_once(self) -> None:
        self.start(interval=None).awaitTermination()

    def landed(self) -> DataFrame:
        """Everything taken in so far, raw."""
        return self.spark.read.parquet(self.landing).drop("batch_id", "__path")

    def batches(self) -> DataFrame:
        """The files of each micro-batch, one row for each: ``batch_id``, ``name``."""
        if not FileSystem(self.spark).exists(self.log):
            return self.spark.createDataFrame([], "batch_id int, name string")
        return self.spark.read.parquet(self.log).select("batch_id", "name")

    def clean(self, config: CleanConfig | None = None, plan: CleanPlan | None = None,
              stage_to: str | None = None, additive: bool = False) -> tuple[DataFrame, CleanPlan]:
        """Clean the landed rows: by ``plan`` if given, else by decisions over all of them.

        ``additive`` takes the decisions from what is kept of each batch; see ``merged_plan``.
        """
        if additive and plan is None:
            plan, _ = self.merged_plan(config)
        if plan is not None:
            return plan.apply(self.landed()), plan
        return clean_table(self.landed(), config, untyped=True, stage_to=stage_to)
