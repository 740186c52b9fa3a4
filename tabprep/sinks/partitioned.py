"""Tables partitioned by date or category, of which a load replaces only the partitions that it brings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from ..functions.names import col
from ..operators.clean import TableRecord
from ..operators.tables import LoadMismatch, TableStore
from .base import CREATED, REPLACED, LoadResult
from .catalog import _NamedTables


class PartitionedSink(_NamedTables):
    """Loads tables partition by partition, and verifies the partitions that were loaded."""

    name = "partitioned"

    def __init__(self, store: TableStore, by: Sequence[str], on_collision: str = "error", name_prefix: str = ""):
        super().__init__(on_collision, name_prefix)
        self.store = store
        self.by = list(by)

    def load(self, record: TableRecord) -> LoadResult:
        target = self.target(record)
        existed = self.store.exists(target)
        written = self.store.replace_partitions(target, record.df, self.by)
        table = self.store.table(target)
        brought = record.df.select(*[col(c).alias(f"__{c}") for c in self.by]).distinct()
        same = reduce(and_, [col(c).eqNullSafe(F.col(f"__{c}").cast(table.schema[c].dataType)) for c in self.by])
        found = table.join(brought, same, "left_semi").count()
        if found != written:
            raise LoadMismatch(f"{target}: wrote {written} rows, found {found} in their partitions")
        return LoadResult(self.name, target, record.name, written, len(table.columns), REPLACED if existed else CREATED)
