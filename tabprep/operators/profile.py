"""Column decisions that need one pass over the whole table.

Only schema-sized numbers reach the driver.  All aggregation buffers are
fixed-width, so Spark keeps them in a hash aggregate inside generated code,
and partial results are merged in two steps, so that no single task receives
one partial row from every input split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import numeric
from ..functions.names import col

MERGE_FAN_IN = 64

TEXT, NUMBER, KEEP = "text", "number", "keep"


def two_step_agg(df: DataFrame, partials: dict[str, Column], merge: dict[str, str]) -> dict:
    """Aggregate all rows to one driver-side dict, merging partial results in two steps.

    ``merge`` names the function (``sum``, ``max``...) that combines partial values.
    """
    bucketed = df.withColumn("__bucket", F.spark_partition_id() % F.lit(MERGE_FAN_IN))
    partial = bucketed.groupBy("__bucket").agg(*[e.alias(k) for k, e in partials.items()])
    final = partial.agg(*[getattr(F, merge[k])(col(k)).alias(k) for k in partials])
    row = final.first().asDict()
    return {k: (0 if v is None else v) for k, v in row.items()}


def is_number_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.NumericType, T.BooleanType))


def is_text_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.CharType, T.VarcharType))


def is_comparable(dtype: T.DataType) -> bool:
    """Flat types, whose values can be counted and compared."""
    return not isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.VariantType))


def present(c: Column, dtype: T.DataType) -> Column:
    """The value, or null where it counts as missing (null or NaN)."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), c)
    return c


@dataclass(frozen=True)
class ColumnProfile:
    name: str
    dtype: str
    non_null: int
    numeric: int
    integral: int
    boolean: int
    #: Whole numbers that floating point may change, that are beyond 64 bits, and beyond any number type.
    long_whole: int = 0
    beyond_long: int = 0
    beyond_wide: int = 0


@dataclass(frozen=True)
class TableProfile:
    rows: int
    columns: tuple[ColumnProfile, ...]

    def sparse(self, max_missing: float = 0.9) -> list[str]:
        """Columns with fewer present values than the threshold."""
        threshold = sparse_threshold(self.rows, max_missing)
        return [c.name for c in self.columns if c.non_null < threshold]


def sparse_threshold(rows: int, max_missing: float = 0.9) -> int:
    return max(1, int(rows * round(1 - max_missing, 12)))


def profile_table(df: DataFrame, untyped: bool = False) -> TableProfile:
    """Row count, and per column how many values are present, numeric, integral, boolean.

    ``untyped`` marks tables read as text, whose truth values are not typed yet.
    """
    return profile_of(df.schema.fields, profile_sums(df, untyped))


LONG_KINDS = ("long_whole", "beyond_long", "beyond_wide")


def profile_sums(df: DataFrame, untyped: bool = False) -> dict[str, int]:
    """The sums behind a profile; columns that hold whole numbers of many digits are read once more."""
    fields = df.schema.fields
    got = _column_sums(df, untyped)
    long = [i for i in range(len(fields)) if got.get(f"digits_{i}")]
    if long:
        kinds = {f"{k}_{i}": F.count_if(getattr(numeric, k)(col(fields[i].name))) for i in long for k in LONG_KINDS}
        got |= two_step_agg(df.select(*[col(fields[i].name) for i in long]), kinds, dict.fromkeys(kinds, "sum"))
    return got


def _column_sums(df: DataFrame, untyped: bool) -> dict[str, int]:
    """``profile_partials`` over all rows, text columns one below the other.

    The sums of one column make a method that the JVM compiles; side by side, those of some
    columns make one beyond the size it takes, which is then interpreted.
    """
    fields = df.schema.fields
    text = [i for i, f in enumerate(fields) if f.dataType == T.StringType()]
    if len(text) < 2:
        partials = profile_partials(fields, untyped)
        return two_step_agg(df, partials, dict.fromkeys(partials, "sum"))
    rest = [i for i in range(len(fields)) if i not in set(text)]
    below = F.posexplode(F.array(*[col(fields[i].name) for i in text])).alias("__column", "__text")
    rows = df.select(*[col(fields[i].name).alias(f"__{i}") for i in rest], below)
    partials = profile_partials([T.StructField(f"__{i}", fields[i].dataType) for i in rest], untyped)
    each = profile_partials([T.StructField("__text", T.StringType())], untyped)
    names = {f"{k}_{n}": f"{k}_{i}" for n, i in enumerate(rest) for k in ("present", *TEXT_SUMS)}
    own = {k.removesuffix("_0"): e for k, e in each.items() if k != "rows"}
    sums = {**partials, **{f"__{k}": e for k, e in own.items()}}
    partial = rows.groupBy((F.spark_partition_id() % F.lit(MERGE_FAN_IN)).alias("__bucket"), "__column").agg(
        *[e.alias(k) for k, e in sums.items()]
    )
    got = {"rows": 0} | {f"{k}_{i}": 0 for i in text for k in own} | {names.get(k, k): 0 for k in partials}
    for row in partial.groupBy("__column").agg(*[F.sum(k).alias(k) for k in sums]).collect():  # one for each text column
        got |= {f"{k}_{text[row['__column']]}": row[f"__{k}"] for k in own}
        got |= {names.get(k, k): row[k] for k in partials}  # the same beside every text column
    return got


TEXT_SUMS = ("numeric", "integral", "digits", "boolean")


def profile_partials(fields, untyped: bool = False) -> dict[str, Column]:
    """The sums behind a profile; those of several tables of one layout add up."""
    partials: dict[str, Column] = {"rows": F.count(F.lit(1))}
    for i, field in enumerate(fields):
        c = col(field.name)
        partials[f"present_{i}"] = F.count(present(c, field.dataType))
        if is_text_type(field.dataType):
            partials[f"numeric_{i}"] = F.count_if(numeric.looks_numeric(c))
            partials[f"integral_{i}"] = F.count(numeric.text_to_long(c))
            partials[f"digits_{i}"] = F.count_if(numeric.long_digits(c))
            if untyped:
                partials[f"boolean_{i}"] = F.count_if(numeric.looks_boolean(c))
    return partials


def profile_of(fields, got: dict) -> TableProfile:
    """The profile that these sums tell."""
    columns = []
    for i, field in enumerate(fields):
        n = got[f"present_{i}"]
        typed = is_number_type(field.dataType)
        columns.append(
            ColumnProfile(
                name=field.name,
                dtype=field.dataType.simpleString(),
                non_null=n,
                numeric=n if typed else got.get(f"numeric_{i}", 0),
                integral=got.get(f"integral_{i}", 0),
                boolean=got.get(f"boolean_{i}", 0),
                **{k: got.get(f"{k}_{i}", 0) for k in LONG_KINDS},
            )
        )
    return TableProfile(got["rows"], tuple(columns))


def classify(column: ColumnProfile, rows: int, dtype: T.DataType, min_numeric: float = 0.5) -> str:
    """``number`` if more than ``min_numeric`` of all rows parse, else ``text``; other types are kept."""
    if is_number_type(dtype) or is_text_type(dtype):
        share = column.numeric
        if column.boolean and column.boolean == column.non_null:
            share = column.boolean
        if column.beyond_wide and column.numeric == column.integral + column.beyond_long:
            return TEXT  # whole numbers, such as ids, that no number type holds
        return NUMBER if rows and share / rows > min_numeric else TEXT
    return KEEP
