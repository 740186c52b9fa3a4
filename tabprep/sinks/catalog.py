"""Catalog tables, relational targets and document collections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from ..functions.names import target_names
from ..operators.clean import TableRecord
from ..operators.documents import DocumentStore
from ..operators.tables import TableStore, observed_rows
from .base import APPENDED, CREATED, REPLACED, SKIPPED, LoadResult


def once(sink, target: str, record: TableRecord, existed: bool, append) -> LoadResult:
    """Append a table by its load's key; a load that was finished before is skipped."""
    rows, fresh = append(target, record.df, record.load_key)
    action = SKIPPED if not fresh else APPENDED if existed else CREATED
    return LoadResult(sink.name, target, record.name, rows, len(record.df.columns), action)


class _NamedTables:
    """Target names are settled for all tables at once, so that collisions show."""

    prefix = "tbl_"

    def __init__(self, on_collision: str = "error", name_prefix: str = ""):
        self.on_collision = on_collision
        self.name_prefix = name_prefix
        self._names: dict[str, str] = {}

    def prepare(self, records: Sequence[TableRecord]) -> None:
        names = target_names([r.output_name for r in records], self.prefix, self.on_collision)
        self._names = {r.name: self.name_prefix + v for r, v in zip(records, names)}

    def target(self, record: TableRecord) -> str:
        if record.name not in self._names:
            self.prepare([record])
        return self._names[record.name]


class TableSink(_NamedTables):
    """Create-or-replace analytic tables, verified after loading.

    Each table is also offered to the session as the view ``temp_<table>``.
    """

    name = "analytic"

    def __init__(self, store: TableStore, on_collision: str = "error", name_prefix: str = ""):
        super().__init__(on_collision, name_prefix)
        self.store = store

    def load(self, record: TableRecord) -> LoadResult:
        target = self.target(record)
        record.df.createOrReplaceTempView(f"temp_{target}")
        existed = self.store.exists(target)
        written = self.store.replace(target, record.df)
        rows, columns = self.store.verify(target, written, len(record.df.columns))
        action = REPLACED if existed else CREATED
        return LoadResult(self.name, target, record.name, rows, columns, action)


class RelationalSink(_NamedTables):
    """Tables loaded by policy ``fail``, ``replace`` or ``append``, verified after loading."""

    name = "relational"

    def __init__(self, store: TableStore, if_exists: str = "replace", on_collision: str = "error",
                 name_prefix: str = ""):
        super().__init__(on_collision, name_prefix)
        self.store = store
        self.if_exists = if_exists

    def load(self, record: TableRecord) -> LoadResult:
        target = self.target(record)
        existed = self.store.exists(target)
        if self.if_exists == "append" and record.load_key:
            return once(self, target, record, existed, self.store.append_once)
        if existed:
            self.store._refresh(target)
        before = self.store.table(target).count() if existed and self.if_exists == "append" else 0
        written = self.store.load(target, record.df, self.if_exists)
        columns = len(self.store.table(target).columns)
        rows, columns = self.store.verify(target, before + written, columns)
        action = CREATED if not existed else APPENDED if self.if_exists == "append" else REPLACED
        return LoadResult(self.name, target, record.name, rows, columns, action)


class DocumentSink(_NamedTables):
    """Rows as documents of one collection per table."""

    name = "documents"
    prefix = "col_"

    def __init__(self, store: DocumentStore, replace: bool = True, on_collision: str = "error",
                 name_prefix: str = ""):
        super().__init__(on_collision, name_prefix)
        self.store = store
        self.replace = replace

    def load(self, record: TableRecord) -> LoadResult:
        target = self.target(record)
        existed = self.store.exists(target)
        if not self.replace and record.load_key:
            return once(self, target, record, existed, self.store.insert_once)
        count = self.store.insert_dataframe(target, record.df, replace=self.replace)
        action = CREATED if not existed else REPLACED if self.replace else APPENDED
        return LoadResult(
            self.name, target, record.name, count, len(record.df.columns), action
        )


_JDBC_MODES = {"fail": "error", "replace": "overwrite", "append": "append"}


class ConnectorSink(_NamedTables):
    """Any installed Spark connector that takes a table name, such as ``jdbc``.

    Every partition writes through its own connection; ``partitions`` bounds how many.
    """

    def __init__(self, spark: SparkSession, fmt: str, options: dict[str, str],
                 if_exists: str = "replace", table_option: str = "dbtable",
                 partitions: int | None = None, batch_size: int = 10_000,
                 on_collision: str = "error"):
        super().__init__(on_collision)
        if if_exists not in _JDBC_MODES:
            raise ValueError(f"unknown if_exists: {if_exists}")
        self.name = fmt
        self.spark = spark
        self.format = fmt
        self.options = dict(options)
        self.if_exists = if_exists
        self.table_option = table_option
        if fmt == "jdbc":
            self.options.setdefault("batchsize", str(batch_size))
            if partitions:
                self.options.setdefault("numPartitions", str(partitions))

    def writer_options(self, target: str) -> tuple[str, dict[str, str]]:
        return _JDBC_MODES[self.if_exists], {**self.options, self.table_option: target}

    def load(self, record: TableRecord) -> LoadResult:
        target = self.target(record)
        mode, options = self.writer_options(target)
        counted, seen = observed_rows(record.df)
        counted.write.format(self.format).options(**options).mode(mode).save()
        action = APPENDED if self.if_exists == "append" else REPLACED if mode == "overwrite" else CREATED
        return LoadResult(
            self.name, target, record.name, seen.get["rows"], len(record.df.columns), action
        )
