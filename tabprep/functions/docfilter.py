"""Document filters and updates as Columns.

A filter such as ``{"age": {"$gte": 30}, "city": "X"}`` becomes one Boolean
Column, so Catalyst can push it into the scan.  A field that is absent or null
is missing: it matches no comparison, equals ``None`` and differs from any
value.  Values are compared only with fields of their own kind, so a number
never matches a text field.
"""

from __future__ import annotations

import datetime as dt
import decimal
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .names import col, quoted

_COMPARE = {
    "$gt": lambda c, v: c > v,
    "$gte": lambda c, v: c >= v,
    "$lt": lambda c, v: c < v,
    "$lte": lambda c, v: c <= v,
}


def _kind_of_type(dtype: T.DataType) -> str:
    if isinstance(dtype, T.BooleanType):
        return "bool"
    if isinstance(dtype, T.NumericType):
        return "number"
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return "text"
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "time"
    return dtype.typeName()


def _kind_of_value(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, (int, float, decimal.Decimal)):
        return "number"
    if isinstance(value, str):
        return "text"
    if isinstance(value, (dt.date, dt.datetime)):
        return "time"
    return type(value).__name__


def _field(schema: T.StructType, path: str) -> tuple[Column, T.DataType] | None:
    """Column and type of a field or dotted path; ``None`` if there is no such field."""
    if path in schema.names:
        return col(path), schema[path].dataType
    dtype: T.DataType = schema
    for part in path.split("."):
        if not isinstance(dtype, T.StructType) or part not in dtype.names:
            return None
        dtype = dtype[part].dataType
    return F.col(".".join(quoted(p) for p in path.split("."))), dtype


def _equals(schema, path: str, value) -> Column:
    found = _field(schema, path)
    if value is None:
        return F.lit(True) if found is None else found[0].isNull()
    if found is None or _kind_of_type(found[1]) != _kind_of_value(value):
        return F.lit(False)
    return found[0] == F.lit(value)


def _not(c: Column) -> Column:
    """The opposite, true also where the field is missing."""
    return ~F.coalesce(c, F.lit(False))


def _among(schema, path: str, values) -> Column:
    found = _field(schema, path)
    kind = None if found is None else _kind_of_type(found[1])
    same = [v for v in values if v is not None and _kind_of_value(v) == kind]
    hit = found[0].isin(same) if same else F.lit(False)
    return hit | _equals(schema, path, None) if None in values else hit


def _condition(schema, path: str, operator: str, value) -> Column:
    if operator == "$eq":
        return _equals(schema, path, value)
    if operator == "$ne":
        return _not(_equals(schema, path, value))
    if operator in ("$in", "$nin"):
        hits = _among(schema, path, list(value))
        return hits if operator == "$in" else _not(hits)
    found = _field(schema, path)
    if operator == "$exists":
        present = F.lit(False) if found is None else found[0].isNotNull()
        return present if value else ~present
    if operator in _COMPARE:
        if found is None or _kind_of_type(found[1]) != _kind_of_value(value):
            return F.lit(False)
        return _COMPARE[operator](found[0], F.lit(value))
    raise ValueError(f"unsupported filter operator: {operator}")


def filter_column(schema: T.StructType, query: dict | None) -> Column:
    """The filter as a Column, true where a document matches and false or null elsewhere.

    Comparisons stay plain, so that the scan can use them to skip data.
    """
    terms = []
    for key, value in (query or {}).items():
        if key in ("$and", "$or"):
            parts = [filter_column(schema, q) for q in value]
            if not parts:
                raise ValueError(f"{key} needs at least one filter")
            terms.append(reduce(and_ if key == "$and" else or_, parts))
        elif key.startswith("$"):
            raise ValueError(f"unsupported filter operator: {key}")
        elif isinstance(value, dict) and any(k.startswith("$") for k in value):
            terms += [_condition(schema, key, op, v) for op, v in value.items()]
        else:
            terms.append(_equals(schema, key, value))
    return reduce(and_, terms) if terms else F.lit(True)


def update_columns(schema: T.StructType, update: dict) -> dict[str, Column]:
    """New value per updated field, for ``$set``, ``$unset`` and ``$inc`` on top-level fields."""
    out: dict[str, Column] = {}
    for operator, changes in update.items():
        if operator not in ("$set", "$unset", "$inc"):
            raise ValueError(f"unsupported update operator: {operator}")
        for name, value in changes.items():
            if name in out:
                raise ValueError(f"field updated twice: {name}")
            dtype = schema[name].dataType if name in schema.names else None
            if operator == "$unset":
                if dtype is not None:
                    out[name] = F.lit(None).cast(dtype)
                continue
            if dtype is not None and value is not None:
                if _kind_of_type(dtype) != _kind_of_value(value):
                    raise TypeError(f"{name} holds {dtype.simpleString()}, not {value!r}")
            if operator == "$inc":
                if _kind_of_value(value) != "number":
                    raise TypeError(f"$inc needs a number: {value!r}")
                if dtype is None:
                    out[name] = F.lit(value)
                else:
                    out[name] = F.coalesce(col(name), F.lit(0)) + F.lit(value)
            else:
                out[name] = F.lit(value)
    return out


def matching(df: DataFrame, query: dict | None) -> DataFrame:
    return df.filter(filter_column(df.schema, query))
