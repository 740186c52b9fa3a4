"""Document collections as typed tables with an ``_id`` column.

Documents loaded from tables have one layout, so a collection is stored in
columns: filters reach the Parquet scan and only the needed fields are read.
Batches with new fields widen the collection; ``as_json`` gives the document
form back.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.docfilter import filter_column, update_columns
from ..functions.names import col, quoted
from ..session import scratch_path
from .tables import TableStore

ID = "_id"


@dataclass(frozen=True)
class Inserted:
    count: int
    ids: DataFrame


class DuplicateIds(ValueError):
    """An id is null, occurs twice in a batch, or is already in the collection."""


def document_id(keys) -> Column:
    """A repeatable id from the columns that identify a document.

    Unlike keys have unlike encodings: a null is a mark of its own, and separators
    within a value are escaped.
    """
    mark, separator = "\x1e", "\x1f"

    def encoded(key: str) -> Column:
        text = F.replace(col(key).cast("string"), F.lit(mark), F.lit(mark + "m"))
        return F.coalesce(F.replace(text, F.lit(separator), F.lit(mark + "s")), F.lit(mark))

    return F.sha2(F.concat_ws(separator, *[encoded(k) for k in keys]), 256)


def as_json(df: DataFrame, name: str = "doc") -> DataFrame:
    """Each row as one JSON document; null fields are kept."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(name))


class DocumentStore(TableStore):
    """Set-based document operations; ``one`` operations need an order, ``_id`` breaking ties."""

    def insert_many(self, name: str, df: DataFrame, keys=None) -> Inserted:
        """Append documents; ids come from ``keys`` or are random.

        Random ids are fixed by writing the batch once before it is appended.
        Given ids must be new: see ``require_new_ids``.
        """
        if ID in df.columns or keys:
            batch = df if ID in df.columns else df.withColumn(ID, document_id(keys))
            self.require_new_ids(name, batch)
        else:
            path = scratch_path(self.spark, "batch")
            df.withColumn(ID, F.expr("uuid()")).write.parquet(path)
            batch = self.spark.read.parquet(path)
        return Inserted(self.append(name, batch), batch.select(ID))

    def require_new_ids(self, name: str, batch: DataFrame, alone: bool = False) -> None:
        """Raises if an id of ``batch`` is null, repeated, or (unless ``alone``) in the collection."""
        ids = batch.select(col(ID).alias("id"))
        bad = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or id is null").select("id")
        if not alone and self.exists(name):
            bad = bad.union(ids.join(self.table(name).select(col(ID).alias("id")), "id", "left_semi"))
        found = bad.limit(3).collect()
        if found:
            raise DuplicateIds(f"{name}: {[r.id for r in found]}")

    def insert_dataframe(self, name: str, df: DataFrame, replace: bool = False, keys=None) -> int:
        """Store the rows of ``df`` as documents, optionally dropping the collection first."""
        batch = df if ID in df.columns else df.withColumn(
            ID, document_id(keys) if keys else F.expr("uuid()")
        )
        if ID in df.columns or keys:
            self.require_new_ids(name, batch, alone=replace)
        return self.replace(name, batch) if replace else self.append(name, batch)

    def insert_once(self, name: str, df: DataFrame, key: str, keys=None) -> tuple[int, bool]:
        """Insert the documents of one load once, however often it is tried: see ``append_once``."""
        batch = df if ID in df.columns else df.withColumn(
            ID, document_id(keys) if keys else F.expr("uuid()")
        )
        if (ID in df.columns or keys) and not self.begun(name, key):
            self.require_new_ids(name, batch)
        return self.append_once(name, batch, key)

    def _where(self, name: str, query: dict | None) -> Column:
        return filter_column(self.table(name).schema, query)

    def find_many(self, name: str, query: dict | None = None, limit: int = 0, order_by=None):
        """Matching documents; with a limit, the first ones by the given order."""
        found = self.table(name).filter(self._where(name, query))
        return found.orderBy(*_order(order_by)).limit(limit) if limit else found

    def find_one(self, name: str, query: dict | None = None, order_by=None) -> DataFrame:
        """The first matching document by the given order, or no row."""
        return self.find_many(name, query, limit=1, order_by=order_by)

    def aggregate(self, name: str, stages: str | list[dict]) -> DataFrame:
        """A chain of ``$match``, ``$group``, ``$sort`` and ``$limit`` over a collection, as one plan.

        ``stages`` may be JSON text. A group's ``_id`` is a field (``"$field"``), several by name, or null
        for all documents; its other fields are ``$sum`` (of a field, or of a number for each
        document), ``$avg``, ``$min`` and ``$max``. Missing values count for nothing: a sum of none
        is 0, the others are null. Anything else raises.
        """
        out = self.table(name)
        for stage in json.loads(stages) if isinstance(stages, str) else stages:
            if len(stage) != 1:
                raise ValueError(f"a stage has one operator: {stage}")
            ((operator, given),) = stage.items()
            if operator == "$match":
                out = out.filter(filter_column(out.schema, given))
            elif operator == "$group":
                out = _grouped(out, given)
            elif operator == "$sort":
                out = out.orderBy(*[F.asc_nulls_first(quoted(k)) if way == 1 else F.desc_nulls_last(quoted(k)) for k, way in _ways(given)])
            elif operator == "$limit":
                out = out.limit(int(given))
            else:
                raise ValueError(f"unknown stage: {operator}")
        return out

    def _only_first(self, name: str, query: dict | None, order_by) -> Column:
        first = self.find_one(name, query, order_by).select(ID).first()
        return F.lit(False) if first is None else col(ID) == F.lit(first[0])

    def update_many(self, name: str, query: dict | None, update: dict) -> int:
        """Update matching documents; returns how many really changed."""
        return self._update(name, self._where(name, query), update)

    def update_one(self, name: str, query: dict | None, update: dict, order_by=None) -> int:
        """Update the first matching document by the given order; returns 0 or 1."""
        return self._update(name, self._only_first(name, query, order_by), update)

    def _update(self, name: str, where: Column, update: dict) -> int:
        changes = update_columns(self.table(name).schema, update)
        return self.update(name, where, changes)[1] if changes else 0

    def delete_many(self, name: str, query: dict | None) -> int:
        return self.delete(name, self._where(name, query))

    def delete_one(self, name: str, query: dict | None, order_by=None) -> int:
        return self.delete(name, self._only_first(name, query, order_by))

    def create_collection(self, name: str, schema: str | None = None) -> bool:
        """Create an empty collection if absent; tells whether it did."""
        return self.create(name, f"{ID} string" + (f", {schema}" if schema else ""))

    def drop_collection(self, name: str) -> bool:
        return self.drop(name)


def _field(name) -> Column:
    if not isinstance(name, str) or not name.startswith("$"):
        raise ValueError(f"not a field: {name}")
    return col(name[1:])


def _ways(given: dict) -> list[tuple[str, int]]:
    if any(way not in (1, -1) for way in given.values()):
        raise ValueError(f"an order is 1 or -1: {given}")
    return list(given.items())


def _grouped(df: DataFrame, given: dict) -> DataFrame:
    fields = dict(given)
    if ID not in fields:
        raise ValueError("a group needs an _id")
    by = fields.pop(ID)
    totals = []
    for out, how in fields.items():
        ((operator, what),) = how.items()
        if operator == "$sum":
            each = F.lit(what) if isinstance(what, (int, float)) else _field(what)
            totals.append(F.coalesce(F.sum(each), F.lit(0)).alias(out))
        elif operator in ("$avg", "$min", "$max"):
            totals.append(getattr(F, operator[1:])(_field(what)).alias(out))
        else:
            raise ValueError(f"unknown total: {operator}")
    counted = [*totals, F.count(F.lit(1)).alias("__documents")]
    if by is None:
        found = df.agg(F.lit(None).cast("string").alias(ID), *counted)
    else:
        key = F.struct(*[_field(v).alias(k) for k, v in by.items()]) if isinstance(by, dict) else _field(by)
        found = df.groupBy(key.alias(ID)).agg(*counted)
    return found.where("__documents > 0").drop("__documents")


def _order(order_by) -> list:
    keys = [] if order_by is None else list(order_by) if isinstance(order_by, (list, tuple)) else [order_by]
    return [*keys, col(ID)]
