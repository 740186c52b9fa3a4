"""Catalog tables: replace, append, update, delete, verify.

A table is an external Parquet table below a root folder.  Each rewrite is
written in full to a new version folder first and becomes visible with a
change of the table's location, so a failed job leaves the table as it was.
Older versions stay for whoever is reading them until ``vacuum``.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import col, quoted
from ..sources.files import FileSystem


class TableExists(ValueError):
    """The target exists and may not be replaced."""


class LossyChange(TypeError):
    """A value would not survive in the type of its column."""


class LoadMismatch(RuntimeError):
    """A loaded table does not hold what was written."""


def observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` with metrics that are gathered while it is written, instead of by a second scan."""
    observation = Observation(f"tabprep-{uuid.uuid4().hex}")
    return df.observe(observation, *[c.alias(k) for k, c in metrics.items()]), observation


def gathered(seen: Observation) -> dict[str, int]:
    """The metrics of a written frame; all nought if its plan, with no row in it, was folded away with them."""
    try:
        return seen.get
    except Py4JJavaError:
        return defaultdict(int)


def observed_rows(df: DataFrame) -> tuple[DataFrame, Observation]:
    return observed(df, rows=F.count(F.lit(1)))


class TableStore:
    """Tables of one root folder, registered in the session catalog."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- lookup -----------------------------------------------------------------------

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(quoted(name))

    def table(self, name: str) -> DataFrame:
        return self.spark.table(quoted(name))

    def preview(self, name: str, order_by, n: int = 10) -> DataFrame:
        """The first ``n`` rows by the given order: a bounded top-n, no full sort."""
        return self.table(name).orderBy(*_as_list(order_by)).limit(n)

    def location(self, name: str) -> str:
        details = self.spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").collect()
        about = next(i for i, r in enumerate(details) if r.col_name == "# Detailed Table Information")
        return next(r.data_type for r in details[about:] if r.col_name == "Location")

    # -- whole tables -----------------------------------------------------------------

    def _new_version(self, name: str) -> str:
        return f"{self.root}/{name}/v-{uuid.uuid4().hex[:12]}"

    def _write(self, df: DataFrame, path: str) -> None:
        """Store rows in the form that the files of a table have."""
        df.write.parquet(path)

    def _shown(self, name: str) -> set[str]:
        """The versions that a table shows."""
        return {self.location(name).rstrip("/").rsplit("/", 1)[-1]} if self.exists(name) else set()

    def versions(self, name: str) -> list[str]:
        """All versions of a table that are still stored, the latest first."""
        folder = f"{self.root}/{name}"
        found = {n: t for n, t in FileSystem(self.spark).modified(folder).items() if n.startswith("v-")}
        return sorted(found, key=lambda n: (found[n], n), reverse=True)

    def vacuum(self, name: str, keep: int = 0) -> int:
        """Delete versions that a table no longer shows, but for the ``keep`` latest of them; returns how many."""
        shown = self._shown(name)
        old = [v for v in self.versions(name) if v not in shown][keep:]
        return sum(FileSystem(self.spark).delete(f"{self.root}/{name}/{v}") for v in old)

    def read_version(self, name: str, version: str) -> DataFrame:
        """The rows of a version as it was written; only whole rewrites write all rows of a table."""
        return self.spark.read.parquet(f"{self.root}/{name}/{version}")

    def _publish(self, name: str, version: str, schema) -> None:
        if self.exists(name):
            if self.table(name).schema == schema:
                place = version.replace("\\", "\\\\").replace("'", "\\'")
                self.spark.sql(f"ALTER TABLE {quoted(name)} SET LOCATION '{place}'")
                self.spark.catalog.refreshTable(quoted(name))
            else:
                self.spark.sql(f"DROP TABLE {quoted(name)}")
                self._create(name, version, schema)
        else:
            self._create(name, version, schema)

    def _create(self, name: str, version: str, schema) -> None:
        self.spark.catalog.createTable(quoted(name), path=version, source="parquet", schema=schema)

    def replace(self, name: str, df: DataFrame) -> int:
        """Create or replace a table with the rows of ``df``; returns the number written."""
        version = self._new_version(name)
        counted, seen = observed_rows(df)
        self._write(counted, version)
        rows = gathered(seen)["rows"]
        self._publish(name, version, _nullable(df))
        return rows

    def append(self, name: str, df: DataFrame) -> int:
        """Add rows by column name; columns that the table lacks are added to it.

        Values keep their worth: where some would not survive in the type of their
        column, the column is widened (which rewrites the table), or it raises.
        """
        if not self.exists(name):
            return self.replace(name, df)
        counted, seen = observed_rows(self._aligned(name, df))
        self._insert(counted, name)
        self._refresh(name)
        return gathered(seen)["rows"]

    def _insert(self, df: DataFrame, name: str) -> None:
        df.write.insertInto(quoted(name))

    def _refresh(self, name: str) -> None:
        """Forget the listing of a table's files: another session may have written some."""
        self.spark.catalog.refreshTable(quoted(name))

    def _aligned(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` with the columns of a table, which is widened and gets new columns where needed."""
        self._refresh(name)
        current = self.table(name)
        wider = _wider_types(df, current)
        if wider:
            _require_survival(current, wider)
            widened = current.select(*[col(c).cast(wider[c]).alias(c) if c in wider else col(c) for c in current.columns])
            self.replace(name, widened)
            current = self.table(name)
        missing = [f for f in df.schema.fields if f.name not in current.columns]
        if missing:
            added = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in missing)
            self.spark.sql(f"ALTER TABLE {quoted(name)} ADD COLUMNS ({added})")
            current = self.table(name)
        return df.select(
            *[
                (col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in current.schema.fields
            ]
        )

    def append_once(self, name: str, df: DataFrame, key: str) -> tuple[int, bool]:
        """Append the rows of one load; returns their number and whether this call did it.

        A load with the same ``key`` is never appended twice, wherever an earlier try of it
        stopped.  Rows are written to a folder of their own, noted as complete, and their files
        then moved into the table one by one: what is not moved yet is still in that folder.
        The note of a finished load stays.  One writer at a time for each table.
        """
        files = FileSystem(self.spark)
        place = f"{self.root}/.loads/{name}/{key}"
        note = json.loads(files.read_text(f"{place}.json") or "{}")
        if note.get("done"):
            return note["rows"], False
        if not note:
            files.delete(place)
            if not self.exists(name):
                self.replace(name, df.limit(0))
            counted, seen = observed_rows(self._aligned(name, df))
            self._write(counted, place)
            note = {"rows": gathered(seen)["rows"], "done": False}
            files.write_text(f"{place}.json", json.dumps(note))
        for folder, target in self._destinations(name, place):
            for part in files.names(folder):
                if part.startswith("part-"):
                    files.rename(f"{folder}/{part}", f"{target}/load-{key[:16]}-{part}")
        self._refresh(name)
        files.write_text(f"{place}.json", json.dumps({**note, "done": True}))
        files.delete(place)
        return note["rows"], True

    def _destinations(self, name: str, place: str) -> list[tuple[str, str]]:
        """Folders of written rows, and where their files belong."""
        return [(place, self.location(name))]

    def begun(self, name: str, key: str) -> bool:
        """Whether a load of ``append_once`` has all its rows written, be they in the table yet or not."""
        return FileSystem(self.spark).exists(f"{self.root}/.loads/{name}/{key}.json")

    def replace_partitions(self, name: str, df: DataFrame, by: Sequence[str]) -> int:
        """Write ``df`` into a table partitioned by these columns, in place of the partitions that it holds rows of.

        Partitions of which ``df`` has no row keep their files.  The first load creates the table.
        Rows of a partition are brought together before they are written; a large one is split.
        """
        missing = [c for c in by if c not in df.columns]
        if missing:
            raise ValueError(f"no such columns: {missing}")
        ordered = df.select(*[col(c) for c in df.columns if c not in by], *[col(c) for c in by])
        if self.exists(name):
            counted, seen = observed_rows(self._aligned(name, ordered).hint("rebalance", *by))
            where = counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)
            where.parquet(self.location(name))
            self.spark.sql(f"ALTER TABLE {quoted(name)} RECOVER PARTITIONS")
        else:
            version = self._new_version(name)
            counted, seen = observed_rows(ordered.hint("rebalance", *by))
            counted.write.partitionBy(*by).parquet(version)
            fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in ordered.schema.fields)
            place = version.replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(f"CREATE TABLE {quoted(name)} ({fields}) USING parquet PARTITIONED BY ({', '.join(map(quoted, by))}) LOCATION '{place}'")
            self.spark.sql(f"ALTER TABLE {quoted(name)} RECOVER PARTITIONS")
        self._refresh(name)
        return gathered(seen)["rows"]

    def load(self, name: str, df: DataFrame, if_exists: str = "fail") -> int:
        """Write by policy: ``fail``, ``replace`` or ``append``."""
        if if_exists not in ("fail", "replace", "append"):
            raise ValueError(f"unknown if_exists: {if_exists}")
        if if_exists == "fail" and self.exists(name):
            raise TableExists(name)
        return self.append(name, df) if if_exists == "append" else self.replace(name, df)

    def drop(self, name: str) -> bool:
        """Drop a table and its files; false if there was none."""
        if not self.exists(name):
            return False
        self.spark.sql(f"DROP TABLE {quoted(name)}")
        self.vacuum(name)
        FileSystem(self.spark).delete(f"{self.root}/.loads/{name}")
        return True

    def create(self, name: str, schema: str) -> bool:
        """Create an empty table if absent; false if it exists."""
        if self.exists(name):
            return False
        self.replace(name, self.spark.createDataFrame([], schema))
        return True

    def verify(self, name: str, rows: int, columns: int) -> tuple[int, int]:
        """Row and column counts read back from the table; raises if they differ from what was written."""
        self._refresh(name)
        table = self.table(name)
        found = (table.count(), len(table.columns))
        if found != (rows, columns):
            raise LoadMismatch(f"{name}: wrote {(rows, columns)}, found {found}")
        return found

    # -- changing rows ----------------------------------------------------------------

    def update(self, name: str, where: Column, assignments: dict[str, Column]) -> tuple[int, int]:
        """Set columns on matching rows; returns (matched, modified).

        One pass: counts are gathered while the new version is written.  A column
        that cannot hold a new value is widened, or it raises.
        """
        matches = F.coalesce(where, F.lit(False))
        table = self._wide_enough(self.table(name), matches, assignments)
        out, seen = self._changed(table, matches, assignments)
        version = self._new_version(name)
        self._write(out, version)
        got = gathered(seen)
        self._publish(name, version, _nullable(out))
        return got["matched"], got["modified"]

    def _wide_enough(self, table: DataFrame, matches: Column, assignments: dict[str, Column]) -> DataFrame:
        """``table`` with the columns widened that cannot hold what they are set to."""
        changed = table.filter(matches).select(*[e.alias(n) for n, e in assignments.items()])
        wider = _wider_types(changed, table)
        if wider:
            _require_survival(table, wider)
            table = table.select(*[col(c).cast(wider[c]).alias(c) if c in wider else col(c) for c in table.columns])
        return table

    def _changed(self, table: DataFrame, matches: Column, assignments: dict[str, Column]) -> tuple[DataFrame, Observation]:
        """All rows of ``table``, the matching ones changed; matches and changes are counted."""
        types = {f.name: f.dataType for f in table.schema.fields}
        new = {
            n: e.cast(types[n]) if n in types else e for n, e in assignments.items()
        }
        changes = F.lit(False)
        for n, e in new.items():
            old = col(n) if n in types else F.lit(None)
            changes = changes | ~old.eqNullSafe(e)
        counted, seen = observed(
            table, matched=F.count_if(matches), modified=F.count_if(matches & changes)
        )
        out = counted.select(
            *[
                F.when(matches, new[n]).otherwise(col(n)).alias(n) if n in new else col(n)
                for n in table.columns
            ],
            *[F.when(matches, e).alias(n) for n, e in new.items() if n not in types],
        )
        return out, seen

    def delete(self, name: str, where: Column) -> int:
        """Delete matching rows; returns how many.

        The rows that stay are counted above the filter: a filter that keeps none is
        folded away with all that lies below it.
        """
        table = self.table(name)
        before = table.count()
        kept, seen = observed_rows(table.filter(~F.coalesce(where, F.lit(False))))
        version = self._new_version(name)
        kept.write.parquet(version)
        deleted = before - gathered(seen)["rows"]
        self._publish(name, version, _nullable(table))
        return deleted


def _as_list(x):
    return list(x) if isinstance(x, (list, tuple)) else [x]


def _nullable(df: DataFrame):
    """The schema as a file-based table reports it: every field may be null."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])


_WIDTH = {T.ByteType(): 1, T.ShortType(): 2, T.IntegerType(): 3, T.LongType(): 4}


def _survives(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """Whether a value is the same again after a cast to ``target`` and back."""
    return c.isNull() | c.try_cast(target).try_cast(source).eqNullSafe(c)


def _always_fits(source: T.DataType, target: T.DataType) -> bool:
    if source == target or isinstance(source, T.NullType) or isinstance(target, T.StringType):
        return True
    if source in _WIDTH:
        return _WIDTH[source] <= _WIDTH.get(target, 0) or isinstance(target, T.DoubleType) and _WIDTH[source] < 4
    return isinstance(source, T.FloatType) and isinstance(target, T.DoubleType)


def _wider_types(new: DataFrame, table: DataFrame) -> dict[str, T.DataType]:
    """Columns of ``table`` whose type cannot hold all values of ``new``, with one that can.

    One aggregate over the columns in question.  Raises if no number type holds both.
    """
    types = {f.name: f.dataType for f in table.schema.fields}
    doubtful = [f for f in new.schema.fields if f.name in types and not _always_fits(f.dataType, types[f.name])]
    if not doubtful:
        return {}
    lost = new.agg(*[F.count_if(~_survives(col(f.name), f.dataType, types[f.name])) for f in doubtful]).first()
    wider = {}
    for f, n in zip(doubtful, lost):
        if n:
            old = types[f.name]
            if not isinstance(f.dataType, T.NumericType) or not isinstance(old, T.NumericType):
                raise LossyChange(f"{f.name} holds {old.simpleString()}; {n} values of {f.dataType.simpleString()} do not fit")
            whole = f.dataType in _WIDTH and old in _WIDTH
            wider[f.name] = f.dataType if whole else T.DoubleType()
    _require_survival(new, wider)
    return wider


def _require_survival(df: DataFrame, types: dict[str, T.DataType]) -> None:
    """Raises if a value of ``df`` would change in a cast to these types."""
    fields = [f for f in df.schema.fields if f.name in types and not _always_fits(f.dataType, types[f.name])]
    if not fields:
        return
    lost = df.agg(*[F.count_if(~_survives(col(f.name), f.dataType, types[f.name])) for f in fields]).first()
    bad = [f.name for f, n in zip(fields, lost) if n]
    if bad:
        raise LossyChange(f"no type holds all values of {bad}")


def value_counts(df: DataFrame, column: str, count_name: str = "count") -> DataFrame:
    """Rows per value, most frequent first; ties in value order.

    Counts are combined in each task before the shuffle, so a value that holds
    most rows costs no more than any other.
    """
    return (
        df.groupBy(col(column))
        .agg(F.count(F.lit(1)).alias(count_name))
        .orderBy(F.desc(count_name), col(column))
    )


def run_sql(spark: SparkSession, text: str, params=None) -> DataFrame:
    """Run a query with positional (list) or named (dict) parameters bound by Spark."""
    return spark.sql(text, args=params) if params else spark.sql(text)
