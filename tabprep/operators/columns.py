"""Dropping columns: sparse, low-variety and duplicate ones.

Each operator reads the table in flat aggregates and then prunes columns with
a plain ``select``; no row is moved for it.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import col, normalize_columns
from .profile import is_comparable, is_number_type, is_text_type, profile_table, two_step_agg


def with_normalized_names(df: DataFrame) -> DataFrame:
    """Rename all columns by position (metadata only)."""
    return df.toDF(*normalize_columns(df.columns))


def select_columns(df: DataFrame, names) -> DataFrame:
    return df.select(*[col(n) for n in names])


def drop_sparse_columns(df: DataFrame, max_missing: float = 0.9) -> DataFrame:
    dropped = set(profile_table(df).sparse(max_missing))
    return select_columns(df, [n for n in df.columns if n not in dropped])


# --- variety ---------------------------------------------------------------------------


def value_class(dtype: T.DataType) -> str:
    """Columns are only ever compared within one class: number 1 differs from text '1'."""
    if is_number_type(dtype):
        return "number"
    if is_text_type(dtype):
        return "text"
    return dtype.simpleString()


def comparable_value(c: Column, dtype: T.DataType) -> Column:
    """Numbers as double without negative zero, everything else as it is."""
    return c.cast("double") + F.lit(0.0) if is_number_type(dtype) else c


def distinct_value(c: Column, dtype: T.DataType) -> Column:
    """The value itself; only floating types need one spelling of zero."""
    return c + F.lit(0).cast(dtype) if isinstance(dtype, _FLOATING) else c


_FLOATING = (T.DoubleType, T.FloatType)


def equal_values(a: Column, a_type: T.DataType, b: Column, b_type: T.DataType) -> Column:
    """Whether two columns of one class agree in a row; exact types are compared exactly."""
    if isinstance(a_type, _FLOATING) or isinstance(b_type, _FLOATING):
        a, b = comparable_value(a, a_type), comparable_value(b, b_type)
    elif a_type != b_type and T.BooleanType() in (a_type, b_type):
        a, b = comparable_value(a, a_type), comparable_value(b, b_type)
    return a.eqNullSafe(b)


BITS = 64


MOST_WORDS = 64


def bitmap_words(min_distinct: int) -> int:
    """Words of a bitmap that can prove so many distinct values, with room for equal hashes."""
    words = max(1, -(-2 * min_distinct // BITS)) if min_distinct > BITS // 2 else 1
    if words > MOST_WORDS:
        raise ValueError(f"min_distinct above {MOST_WORDS * BITS // 2}: {min_distinct}")
    return words


def proven_distinct(*words: int) -> int:
    """A number of distinct values that a bitmap proves.

    Each value, null included, sets one bit by its hash, so there are at
    least as many distinct values as bits are set.
    """
    return sum((bits & (2**BITS - 1)).bit_count() for bits in words)


def variety_partials(df: DataFrame, words: int = 1) -> tuple[dict, dict, DataFrame]:
    """Per column: a bitmap of value hashes, of so many words, and an order-free fingerprint.

    The fingerprint sums hashes salted with a row number.  Equal columns get
    equal sums in the same job, whatever the row order; a column that is merely
    a permutation of another does not.  Sums of 20-bit pieces cannot overflow
    below 2**43 rows.  All buffers are single longs, updated in generated code.
    """
    partials: dict[str, Column] = {"rows": F.count(F.lit(1))}
    merge = {"rows": "sum"}
    numbered = df.withColumn("__row", F.monotonically_increasing_id())
    members: dict[str, int] = defaultdict(int)
    for field in df.schema.fields:
        members[value_class(field.dataType)] += 1
    one = F.lit(1).cast("bigint")
    for i, field in enumerate(df.schema.fields):
        if not is_comparable(field.dataType):
            continue
        own = distinct_value(col(field.name), field.dataType)
        position = F.xxhash64(own).bitwiseAND(F.lit(BITS - 1)).cast("int")
        bit = F.call_function("shiftleft", one, position)
        word = F.pmod(F.shiftright(F.xxhash64(own), 6), F.lit(words))
        for w in range(words):
            mine = bit if words == 1 else F.when(word == w, bit).otherwise(F.lit(0).cast("bigint"))
            partials[f"bits_{i}_{w}"] = F.bit_or(mine)
            merge[f"bits_{i}_{w}"] = "bit_or"
        if members[value_class(field.dataType)] > 1:
            value = comparable_value(col(field.name), field.dataType)
            h = F.xxhash64(value, F.col("__row"))
            partials[f"low_{i}"] = F.sum(h.bitwiseAND(F.lit(0xFFFFF)))
            partials[f"high_{i}"] = F.sum(F.shiftrightunsigned(h, 44))
            merge[f"low_{i}"] = merge[f"high_{i}"] = "sum"
    return partials, merge, numbered


class Variety:
    """What one pass over cleaned rows tells about its columns."""

    def __init__(self, df: DataFrame, min_distinct: int = 3, unfiltered: DataFrame | None = None,
                 unfiltered_rows: int | None = None):
        """``unfiltered`` is ``df`` without its row filter, and has ``unfiltered_rows`` rows.

        If the filter turns out to remove nothing, the follow-up checks use that
        form: they then read only the columns they are about.
        """
        self.min_distinct = min_distinct
        self.words = bitmap_words(min_distinct)
        partials, merge, numbered = variety_partials(df, self.words)
        self.measured = two_step_agg(numbered, partials, merge)
        self.rows: int = self.measured["rows"]
        self.df = unfiltered if unfiltered is not None and self.rows == unfiltered_rows else df

    def low_variety(self) -> list[str]:
        """Columns with fewer than ``min_distinct`` values, a null counting as one value.

        The bitmap clears most columns; only the rest are counted exactly.
        """
        if self.min_distinct <= 1:
            return []
        doubtful = []
        for i, field in enumerate(self.df.schema.fields):
            if not is_comparable(field.dataType):
                continue
            if proven_distinct(*(self.measured[f"bits_{i}_{w}"] for w in range(self.words))) < self.min_distinct:
                doubtful.append(field.name)
        if not doubtful or not self.rows:
            return doubtful
        counts = exact_distinct_counts(self.df, doubtful)
        return [n for n in doubtful if counts.get(n, 0) < self.min_distinct]

    def duplicates(self, names) -> list[str]:
        """Columns among ``names`` that equal, row by row, a column further left."""
        groups: dict[tuple, list[str]] = defaultdict(list)
        wanted = set(names)
        for i, field in enumerate(self.df.schema.fields):
            if field.name in wanted and f"low_{i}" in self.measured:
                key = (
                    value_class(field.dataType),
                    self.measured[f"low_{i}"],
                    self.measured[f"high_{i}"],
                )
                groups[key].append(field.name)
        return confirm_duplicates(self.df, [g for g in groups.values() if len(g) > 1])


def exact_distinct_counts(df: DataFrame, names) -> dict[str, int]:
    """Exact number of distinct values per column, nulls counting as one value.

    Values are deduplicated in each task before they are shuffled.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    entries = [
        F.struct(
            F.lit(i).alias("c"), distinct_value(col(n), types[n]).cast("string").alias("v")
        )
        for i, n in enumerate(names)
    ]
    pairs = df.select(F.explode(F.array(*entries)).alias("e")).select("e.c", "e.v").distinct()
    return {names[r.c]: r.n for r in pairs.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}


def confirm_duplicates(df: DataFrame, groups: list[list[str]]) -> list[str]:
    """Check fingerprint matches value by value and return the columns to drop.

    Columns are compared with the leftmost one of their group; any that differ
    (a fingerprint collision) form a group of their own and are checked again.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    dropped: list[str] = []
    while groups:
        checks = [(group[0], other) for group in groups for other in group[1:]]
        same = df.agg(
            *[
                F.bool_and(equal_values(col(a), types[a], col(b), types[b])).alias(f"p{i}")
                for i, (a, b) in enumerate(checks)
            ]
        ).first()
        verdict = {b: bool(same[i]) for i, (_, b) in enumerate(checks)}
        dropped += [b for b, equal in verdict.items() if equal]
        leftover = [[b for b in group[1:] if not verdict[b]] for group in groups]
        groups = [g for g in leftover if len(g) > 1]
    return dropped


def drop_low_variety_columns(df: DataFrame, min_distinct: int = 3) -> DataFrame:
    dropped = set(Variety(df, min_distinct).low_variety())
    return select_columns(df, [n for n in df.columns if n not in dropped])


def drop_duplicate_columns(df: DataFrame) -> DataFrame:
    dropped = set(Variety(df).duplicates(df.columns))
    return select_columns(df, [n for n in df.columns if n not in dropped])
