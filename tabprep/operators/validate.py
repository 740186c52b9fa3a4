"""What a table's columns hold, and whether its rows keep given rules: one aggregate each."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import col
from ..functions.numeric import looks_numeric
from .columns import exact_distinct_counts
from .profile import present

PROFILE = (
    "column_name string, column_type string, row_count bigint, null_count bigint, distinct_count bigint, "
    "min_number double, max_number double, min_text string, max_text string"
)


def profile_columns(df: DataFrame) -> DataFrame:
    """One row per column: rows, nulls, distinct values (a null counts as one), least and greatest value.

    Numbers have their extremes as numbers, other comparable columns as text; the rest have none.
    """
    metrics = [F.count(F.lit(1)).alias("rows")]
    plain = [f for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))]
    for i, f in enumerate(df.schema.fields):
        metrics.append(F.count_if(col(f.name).isNull()).alias(f"nulls_{i}"))
        if f in plain:
            metrics += [F.min(col(f.name)).alias(f"min_{i}"), F.max(col(f.name)).alias(f"max_{i}")]
    found = df.agg(*metrics).first()
    distinct = exact_distinct_counts(df, [f.name for f in plain]) if found["rows"] else {}
    out = []
    for i, f in enumerate(df.schema.fields):
        low, high = (found[f"min_{i}"], found[f"max_{i}"]) if f in plain else (None, None)
        number = isinstance(f.dataType, T.NumericType) and low is not None
        text = not isinstance(f.dataType, T.NumericType) and low is not None
        out.append(
            (f.name, f.dataType.simpleString(), found["rows"], found[f"nulls_{i}"], distinct.get(f.name, 0) if f in plain else None,
             float(low) if number else None, float(high) if number else None, str(low) if text else None, str(high) if text else None)
        )
    return df.sparkSession.createDataFrame(out, PROFILE)


QUALITY = (
    "column_name string, row_count bigint, completeness double, consistency double, distinct_estimate bigint, "
    "quartiles array<double>, frequent array<struct<value: string, share: double>>, quality double"
)
#: Relative error of ``distinct_estimate`` (three standard errors of a sketch of 2^12 cells), and the
#: share of all rows by which a quartile may be misplaced.
DISTINCT_ERROR = 0.05
RANK_ERROR = 1e-4


def profile_quality(df: DataFrame, frequent: int = 3) -> DataFrame:
    """One row per flat column: how complete and how uniform it is, what it holds, and a score.

    ``completeness`` is the share of values that are present (neither null nor NaN); ``consistency``
    the share of present values of the commoner kind, numbers or other texts, in a text column, and of
    finite ones in a column of numbers. ``quality`` is their product, and nought for a column that
    is empty or holds one value only. These are exact. Distinct values are estimated by a HyperLogLog
    sketch, quartiles (of columns of numbers) by Spark's quantile sketch, within the errors above.
    ``frequent`` has the commonest present values, the first in order among equals, with their exact
    share of all rows; values are counted in each task before they are shuffled.

    Two passes: one aggregate of fixed-size sketches, one count of values.
    """
    fields = [f for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))]
    metrics = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(fields):
        c = present(col(f.name), f.dataType)
        metrics += [F.count(c).alias(f"present_{i}"), F.hll_sketch_estimate(F.hll_sketch_agg(c.cast("string"), 12)).alias(f"distinct_{i}")]
        if isinstance(f.dataType, T.NumericType):
            real = c.cast("double")
            finite = F.when(F.abs(real) < float("inf"), real)
            metrics += [F.count(finite).alias(f"same_{i}"), F.percentile_approx(finite, [0.25, 0.5, 0.75], int(1 / RANK_ERROR)).alias(f"quartiles_{i}")]
        elif isinstance(f.dataType, T.StringType):
            number = looks_numeric(c)
            metrics += [F.count_if(number).alias(f"numbers_{i}")]
    got = df.agg(*metrics).first()
    entries = [F.struct(F.lit(i).alias("c"), present(col(f.name), f.dataType).cast("string").alias("v")) for i, f in enumerate(fields)]
    counts = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*").where("v is not null").groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    ranked = counts.withColumn("r", F.row_number().over(Window.partitionBy("c").orderBy(F.desc("n"), "v"))).where(F.col("r") <= frequent)
    top: dict[int, list] = {}
    for r in ranked.orderBy("c", "r").collect() if fields else []:
        top.setdefault(r.c, []).append((r.v, r.n / got["rows"]))
    out = []
    for i, f in enumerate(fields):
        rows, there = got["rows"], got[f"present_{i}"]
        same = got[f"same_{i}"] if isinstance(f.dataType, T.NumericType) else max(got[f"numbers_{i}"], there - got[f"numbers_{i}"]) if isinstance(f.dataType, T.StringType) else there
        completeness, consistency = there / rows if rows else 0.0, same / there if there else 0.0
        varied = len(top.get(i, [])) > 1
        quartiles = got[f"quartiles_{i}"] if isinstance(f.dataType, T.NumericType) else None
        out.append((f.name, rows, completeness, consistency, got[f"distinct_{i}"] or 0, quartiles, top.get(i, []), completeness * consistency * varied))
    return df.sparkSession.createDataFrame(out, QUALITY)


@dataclass(frozen=True)
class Check:
    """A rule of rows (``holds`` is true), of a column's present values together (``unique``), or of the table.

    A table rule has the fewest and the most ``rows``, or the ``required`` columns.  ``columns``
    are those that a rule of rows looks at: where the table lacks one, the rule is broken as a whole.
    """

    name: str
    holds: Column | None = None
    unique: str | None = None
    rows: tuple[int, int | None] | None = None
    required: tuple[str, ...] | None = None
    columns: tuple[str, ...] = ()

    def missing(self, df: DataFrame) -> list[str]:
        wanted = [*self.columns, *(self.required or ()), *([self.unique] if self.unique else [])]
        return [c for c in wanted if c not in df.columns]


def not_null(column: str) -> Check:
    return Check(f"{column} not null", col(column).isNotNull(), columns=(column,))


def between(column: str, low, high) -> Check:
    return Check(f"{column} between {low} and {high}", col(column).isNull() | col(column).between(low, high), columns=(column,))


def one_of(column: str, values: Sequence) -> Check:
    return Check(f"{column} one of {len(values)}", col(column).isNull() | col(column).isin(list(values)), columns=(column,))


def matches(column: str, pattern: str) -> Check:
    return Check(f"{column} matches {pattern}", col(column).isNull() | col(column).rlike(pattern), columns=(column,))


def unique(column: str) -> Check:
    return Check(f"{column} unique", unique=column)


def row_count(least: int, most: int | None = None) -> Check:
    return Check(f"rows at least {least}" + ("" if most is None else f" and at most {most}"), rows=(least, most))


def required_columns(*columns: str) -> Check:
    return Check(f"has {', '.join(columns)}", required=columns)


def _repeated(df: DataFrame, column: str) -> DataFrame:
    """Present values that several rows hold, with their number; counted before they are shuffled."""
    return df.where(col(column).isNotNull()).groupBy(col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def validate(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: ``rule``, ``failed`` rows and ``passed``.

    Checks of rows are one aggregate. A unique column fails by as many rows as hold a value that
    another row holds too. A table with too few or too many rows fails by the difference, one
    without required columns by their number, and a rule whose column is missing by all rows.
    """
    spark = df.sparkSession
    by_row = [c for c in checks if c.holds is not None and not c.missing(df)]
    found = df.agg(F.count(F.lit(1)), *[F.count_if(~F.coalesce(c.holds, F.lit(False))) for c in by_row]).first()
    failed = {c.name: n for c, n in zip(by_row, found[1:])}
    broken = set()
    for c in checks:
        if c.required is not None:
            failed[c.name] = len(c.missing(df))
        elif c.rows is not None:
            least, most = c.rows
            failed[c.name] = max(0, least - found[0], 0 if most is None else found[0] - most)
        elif c.missing(df):
            failed[c.name] = found[0]
            broken.add(c.name)
        elif c.unique is not None:
            failed[c.name] = _repeated(df, c.unique).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows = [(c.name, failed[c.name], failed[c.name] == 0 and c.name not in broken) for c in checks]
    return spark.createDataFrame(rows, "rule string, failed bigint, passed boolean")


BROKEN = "broken_rules"


def tagged(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``df`` with ``broken_rules``: the names of the rules that each row breaks, in the order given.

    Rules of rows are one projection. For a unique column, the values that occur repeatedly are
    joined to the rows; Spark splits a value that very many rows hold. Rules of the table tag no row.
    """
    if BROKEN in df.columns:
        raise ValueError(f"the table has a column {BROKEN}")
    out, marks = df, []
    for i, c in enumerate(checks):
        if c.rows is not None or c.required is not None:
            continue
        if c.missing(df):
            marks.append(F.lit(c.name))
        elif c.holds is not None:
            marks.append(F.when(~F.coalesce(c.holds, F.lit(False)), F.lit(c.name)))
        else:
            repeated = _repeated(df, c.unique).select(F.col("value").alias(f"__value_{i}"), F.lit(True).alias(f"__repeated_{i}"))
            out = out.join(repeated, col(c.unique) == F.col(f"__value_{i}"), "left")
            marks.append(F.when(F.col(f"__repeated_{i}"), F.lit(c.name)))
    names = F.filter(F.array(*marks), lambda x: x.isNotNull()) if marks else F.array().cast("array<string>")
    return out.select(*[col(c) for c in df.columns], names.alias(BROKEN))


def violations(df: DataFrame, checks: Sequence[Check], key: Sequence[str]) -> DataFrame:
    """One row for each row and rule that it breaks: the ``key`` columns and ``rule``; a rule of the table has null keys."""
    found = tagged(df, checks).select(*[col(k) for k in key], F.explode(BROKEN).alias("rule"))
    of_table = [c for c in checks if c.rows is not None or c.required is not None]
    if not of_table:
        return found
    failed = validate(df, of_table).where("not passed")
    types = {f.name: f.dataType for f in df.schema.fields}
    return found.unionByName(failed.select(*[F.lit(None).cast(types[k]).alias(k) for k in key], "rule"))


class TableRefused(ValueError):
    """A table breaks a rule that holds for it as a whole."""


def split_by_rules(df: DataFrame, checks: Sequence[Check], stage_to: str) -> tuple[DataFrame, DataFrame]:
    """The rows that keep all rules, and the others with ``broken_rules``; rows are judged and written once.

    Raises if a rule of the table is broken: then neither part is of use.
    """
    of_table = [c for c in checks if c.rows is not None or c.required is not None]
    if of_table:
        failed = [r.rule for r in validate(df, of_table).where("not passed").collect()]
        if failed:
            raise TableRefused("; ".join(failed))
    judged = tagged(df, checks).withColumn("__kept", F.size(BROKEN) == 0)
    judged.write.mode("overwrite").partitionBy("__kept").parquet(stage_to)
    back = df.sparkSession.read.schema(judged.schema).parquet(stage_to)
    return back.where("__kept").drop("__kept", BROKEN), back.where("not __kept").drop("__kept")
