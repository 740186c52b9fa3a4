"""The cleaning recipe: decide once per table, then apply as one lazy plan.

``fit_plan`` runs the aggregates that choose columns and classes and returns a
``CleanPlan``: a small, serializable contract.  ``CleanPlan.apply`` turns any
table of the same layout into the cleaned DataFrame with a single projection
and filter, so it fuses into the scan and works on streams as well.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import numeric, strings
from ..functions.names import col, normalize_columns, output_name
from .columns import Variety, select_columns
from .profile import KEEP, NUMBER, TEXT, classify, profile_table


class EmptyTable(ValueError):
    """No rows or no columns are left after cleaning."""


@dataclass(frozen=True)
class CleanConfig:
    """Parameters of the recipe; the defaults are the recipe's fixed values."""

    max_missing: float = 0.9
    min_numeric: float = 0.5
    min_distinct: int = 3
    na: str = strings.MISSING
    null_tokens: tuple[str, ...] = strings.NULL_TOKENS
    numeric_fill: float = 0
    keep_chars: str = ""
    require_zero_numeric: bool = False
    string_columns: tuple[str, ...] = ()
    extra_steps: tuple[Callable[[DataFrame], DataFrame], ...] = ()


@dataclass(frozen=True)
class ColumnRule:
    """How one column is cleaned: its normalized name, class and target type."""

    name: str
    kind: str
    source_type: str
    target_type: str
    as_float: bool = False
    as_boolean: bool = False


@dataclass(frozen=True)
class Step:
    """Counts before and after one step of the recipe."""

    step: str
    rows_before: int
    rows_after: int
    columns_before: int
    columns_after: int


@dataclass(frozen=True)
class CleanPlan:
    """Everything decided about a table; JSON in and out via ``to_json``/``from_json``."""

    names: tuple[str, ...]
    rules: tuple[ColumnRule, ...]
    kept: tuple[str, ...] = ()
    steps: tuple[Step, ...] = ()
    config: CleanConfig = field(default_factory=CleanConfig)

    def to_json(self) -> str:
        """The plan as text.  ``extra_steps`` are code: take them off first and give them to ``from_json``."""
        if self.config.extra_steps:
            raise ValueError("a plan with extra_steps cannot be written as JSON")
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str, extra_steps: Sequence[Callable[[DataFrame], DataFrame]] = ()) -> CleanPlan:
        raw = json.loads(text)
        config = {k: tuple(v) if isinstance(v, list) else v for k, v in raw["config"].items()}
        return CleanPlan(
            names=tuple(raw["names"]),
            rules=tuple(ColumnRule(**r) for r in raw["rules"]),
            kept=tuple(raw["kept"]),
            steps=tuple(Step(**s) for s in raw["steps"]),
            config=replace(CleanConfig(**config), extra_steps=tuple(extra_steps)),
        )

    # -- expressions ----------------------------------------------------------------

    def _text_input(self, rule: ColumnRule) -> Column:
        c = col(rule.name)
        if rule.as_float:
            return strings.float_text(numeric.text_to_double(c))
        if rule.source_type in ("double", "float"):
            return strings.float_text(c)
        return c if rule.source_type == "string" else c.cast("string")

    def _cleaned(self, rule: ColumnRule) -> Column:
        cfg = self.config
        if rule.kind == TEXT:
            return strings.clean_text(
                self._text_input(rule), tokens=cfg.null_tokens, na=cfg.na, keep_chars=cfg.keep_chars
            )
        if rule.kind == NUMBER:
            return numeric.fill_number(self._number(rule), rule.target_type, cfg.numeric_fill)
        return col(rule.name)

    def _number(self, rule: ColumnRule) -> Column:
        c = col(rule.name)
        if rule.source_type != "string":
            return c.cast(rule.target_type)
        if rule.as_boolean:
            return c.try_cast("boolean").cast(rule.target_type)
        parsers = {"bigint": numeric.text_to_long, numeric.WIDE: numeric.text_to_wide}
        return parsers.get(rule.target_type, numeric.text_to_double)(c)

    def _has_content(self) -> Column | None:
        """True for rows that hold something; ``None`` when no column can tell.

        A cheap test per column settles almost every row.  The exact test after
        it is one expression over all text columns, so that the plan of a wide
        table does not hold every column's cleaning a second time.
        """
        cfg = self.config
        texts = [r for r in self.rules if r.kind == TEXT]
        if not texts:
            return None
        options = {"tokens": cfg.null_tokens, "na": cfg.na}
        inputs = [self._text_input(r) for r in texts]
        tests = [
            F.coalesce(strings.surely_not_missing(c, **options), F.lit(False)) for c in inputs
        ]
        tests.append(
            F.exists(
                F.array(*inputs),
                lambda x: strings.clean_text(x, keep_chars=cfg.keep_chars, **options) != F.lit(cfg.na),
            )
        )
        if cfg.require_zero_numeric:
            tests += [self._cleaned(r) != F.lit(0) for r in self.rules if r.kind == NUMBER]
        return reduce(or_, tests)

    def rows_removed(self) -> int | None:
        """How many empty rows the fitted table had, if known."""
        for s in self.steps:
            if s.step == "empty_rows":
                return s.rows_before - s.rows_after
        return None

    # -- application ----------------------------------------------------------------

    def apply(self, df: DataFrame, same_rows: bool = False) -> DataFrame:
        """The cleaned table.

        ``same_rows`` says that ``df`` is the very table the plan was fitted on.
        If that had no empty row, the row filter is left out, and columns that
        were dropped need not be read.
        """
        named = df.toDF(*self.names)
        cleaned = self.cleaned_columns()
        if not (same_rows and self.rows_removed() == 0):
            named = self.filtered(named)
        return reduce(lambda d, f: d.transform(f), self.config.extra_steps, self.project(named, cleaned))

    def cleaned_columns(self) -> dict[str, Column]:
        """Each cleaned column as an expression."""
        return {r.name: self._cleaned(r) for r in self.rules}

    def filtered(self, named: DataFrame) -> DataFrame:
        condition = self._has_content()
        return named if condition is None else named.filter(condition)

    def project(self, named: DataFrame, cleaned: dict[str, Column]) -> DataFrame:
        """The surviving columns, cleaned, of a table with normalized names."""
        keep = set(self.kept) if self.steps else set(cleaned)
        return named.select(*[e.alias(n) for n, e in cleaned.items() if n in keep])


def _normalized(wanted: Sequence[str], columns: Sequence[str], names: Sequence[str]) -> tuple[str, ...]:
    """Columns given by their own or their normalized name, as normalized; raises on others."""
    by_own = dict(zip(columns, names))
    unknown = [c for c in wanted if c not in by_own and c not in names]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    return tuple(c if c in names else by_own[c] for c in wanted)


def _rule(column, dtype: T.DataType, rows: int, cfg: CleanConfig, untyped: bool) -> ColumnRule:
    kind = classify(column, rows, dtype, cfg.min_numeric)
    if column.name in cfg.string_columns and kind == NUMBER:
        kind = TEXT
    is_text = isinstance(dtype, T.StringType)
    target = column.dtype
    as_boolean = untyped and is_text and 0 < column.non_null == column.boolean
    if kind == NUMBER and isinstance(dtype, T.BooleanType):
        target = "int"
    elif kind == NUMBER and as_boolean:
        target = "int"
    elif kind == NUMBER and is_text:
        whole = column.numeric == column.integral + column.beyond_long
        if column.integral == rows:
            target = "bigint"
        else:
            target = numeric.WIDE if whole and column.long_whole else "double"
    elif kind == TEXT:
        target = "string"
    # A numeric column of an untyped file holds floats once it has gaps, and prints as such.
    as_float = (
        untyped
        and is_text
        and kind == TEXT
        and column.name not in cfg.string_columns
        and 0 < column.non_null == column.numeric
        and not (column.long_whole and column.numeric == column.integral + column.beyond_long)
    )
    return ColumnRule(
        column.name, kind, "string" if is_text else column.dtype, target, as_float, as_boolean
    )


def fit_plan(
    df: DataFrame, config: CleanConfig | None = None, untyped: bool = False
) -> CleanPlan:
    """Decide names, columns and classes for a table (two full passes, a third on few columns)."""
    plan, _ = _fit(df, config or CleanConfig(), untyped, None)
    return plan


def _fit(df: DataFrame, cfg: CleanConfig, untyped: bool, stage_to: str | None):
    names = tuple(normalize_columns(df.columns))
    cfg = replace(cfg, string_columns=_normalized(cfg.string_columns, df.columns, names))
    named = df.toDF(*names)
    profile = profile_table(named, untyped)
    n = profile.rows
    rules = rules_for(profile, named.schema.fields, cfg, untyped)
    plan = CleanPlan(names=names, rules=rules, config=replace(cfg, extra_steps=()))
    if n == 0 or not rules:
        raise EmptyTable(f"{n} rows, {len(rules)} columns left after dropping sparse columns")

    expressions = plan.cleaned_columns()
    cleaned = plan.project(plan.filtered(named), expressions)
    if stage_to is not None:
        cleaned.write.mode("overwrite").parquet(stage_to)
        cleaned = df.sparkSession.read.parquet(stage_to)
        variety = Variety(cleaned, cfg.min_distinct)
    else:
        variety = Variety(cleaned, cfg.min_distinct, plan.project(named, expressions), n)
    low = set(variety.low_variety())
    varied = [r.name for r in rules if r.name not in low]
    copies = set(variety.duplicates(varied)) if variety.rows else set()
    plan = decided(plan, cfg, n, variety.rows, varied, copies)
    return plan, cleaned if stage_to is not None else None


def rules_for(profile, fields, cfg: CleanConfig, untyped: bool) -> tuple[ColumnRule, ...]:
    """How each column that is not sparse is cleaned."""
    sparse = set(profile.sparse(cfg.max_missing))
    dtypes = {f.name: f.dataType for f in fields}
    return tuple(_rule(c, dtypes[c.name], profile.rows, cfg, untyped) for c in profile.columns if c.name not in sparse)


def decided(plan: CleanPlan, cfg: CleanConfig, n: int, rows: int, varied: Sequence[str], copies) -> CleanPlan:
    """``plan`` with the columns to keep: the varied ones that copy none further left."""
    names, rules = plan.names, plan.rules
    kept = tuple(c for c in varied if c not in copies)
    steps = (
        Step("normalize_names", n, n, len(names), len(names)),
        Step("sparse_columns", n, n, len(names), len(rules)),
        Step("empty_rows", n, rows, len(rules), len(rules)),
        Step("low_variety_columns", rows, rows, len(rules), len(varied)),
        Step("duplicate_columns", rows, rows, len(varied), len(kept)),
    )
    return replace(plan, kept=kept, steps=steps, config=cfg)


def clean_table(
    df: DataFrame,
    config: CleanConfig | None = None,
    *,
    untyped: bool = False,
    stage_to: str | None = None,
) -> tuple[DataFrame, CleanPlan]:
    """Run the whole recipe; returns the cleaned table and the plan behind it.

    With ``stage_to`` (a shared path) the cleaned rows are written there once as
    Parquet and everything later reads the needed columns of that copy.  Use it
    for large tables with much text or with several targets: cleaning then runs
    once instead of once per pass.
    """
    cfg = config or CleanConfig()
    plan, staged = _fit(df, cfg, untyped, stage_to)
    if not plan.kept or not plan.steps[-1].rows_after:
        raise EmptyTable("no rows or columns left after cleaning")
    if staged is None:
        return plan.apply(df, same_rows=True), plan
    out = select_columns(staged, plan.kept)
    return reduce(lambda d, f: d.transform(f), cfg.extra_steps, out), plan


# --- several tables --------------------------------------------------------------------


@dataclass
class TableRecord:
    """A table on its way through the pipeline."""

    name: str
    df: DataFrame
    dialect: object | None = None
    untyped: bool = False
    rows: int | None = None
    plan: CleanPlan | None = None
    status: str = "ok"
    error: str | None = None
    #: Tells the file's lines from others, where the table is that of a file.
    content: str | None = None
    #: Of a load that may be repeated: the same file with the same content has the same key.
    load_key: str | None = None

    @property
    def output_name(self) -> str:
        return output_name(self.name)


REPORT_SCHEMA = (
    "table_name string, output_name string, step string, rows_before bigint, rows_after bigint, "
    "columns_before int, columns_after int, status string, error string"
)


def clean_tables(
    records: Sequence[TableRecord],
    config: CleanConfig | None = None,
    *,
    parallelism: int = 4,
    stage_root: str | None = None,
    strict: bool = True,
) -> list[TableRecord]:
    """Clean each table as its own Spark jobs; a failing table is recorded, not fatal.

    Returns a record per input, with ``status`` ``ok``, ``empty`` or ``failed``;
    raises (if ``strict``) when none survives.
    """

    def one(numbered: tuple[int, TableRecord]) -> TableRecord:
        number, record = numbered
        stage = f"{stage_root}/{number}-{record.output_name}" if stage_root else None
        try:
            out, plan = clean_table(record.df, config, untyped=record.untyped, stage_to=stage)
            return replace(record, df=out, plan=plan, rows=plan.steps[-1].rows_after)
        except EmptyTable as e:
            return replace(record, rows=0, status="empty", error=str(e))
        except Exception as e:  # isolation of one table's failure from the others
            return replace(record, status="failed", error=f"{type(e).__name__}: {e}")

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        results = list(pool.map(one, enumerate(records)))
    if strict and not any(r.status == "ok" for r in results):
        raise ValueError("no table could be cleaned")
    return results


def clean_report(spark: SparkSession, records: Sequence[TableRecord]) -> DataFrame:
    """One row per table and step; a table that did not survive has a single row."""
    rows = []
    for r in records:
        if r.plan is None:
            rows.append((r.name, r.output_name, None, None, None, None, None, r.status, r.error))
            continue
        for s in r.plan.steps:
            rows.append(
                (r.name, r.output_name, s.step, s.rows_before, s.rows_after, s.columns_before,
                 s.columns_after, r.status, r.error)
            )
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def clean_summary(spark: SparkSession, records: Sequence[TableRecord]) -> DataFrame:
    """Number of surviving tables, their rows, and their output names."""
    ok = [r for r in records if r.status == "ok"]
    return spark.createDataFrame(
        [(len(ok), sum(r.rows or 0 for r in ok), [r.output_name for r in ok])],
        "files_transformed int, total_rows bigint, file_names array<string>",
    )


# --- single steps on whole tables ------------------------------------------------------


def column_classes(df: DataFrame, min_numeric: float = 0.5) -> DataFrame:
    """Class of every column, with the counts behind it."""
    p = profile_table(df)
    fields = {f.name: f.dataType for f in df.schema.fields}
    rows = [
        (c.name, classify(c, p.rows, fields[c.name], min_numeric), c.non_null, c.numeric)
        for c in p.columns
    ]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, column_class string, present bigint, numeric_values bigint"
    )


def clean_text_columns(df: DataFrame, config: CleanConfig | None = None) -> DataFrame:
    """Clean the columns classified as text; leave the others as they are."""
    return _clean_kind(df, config or CleanConfig(), TEXT)


def coerce_numeric_columns(df: DataFrame, config: CleanConfig | None = None) -> DataFrame:
    """Coerce the columns classified as numeric; leave the others as they are."""
    return _clean_kind(df, config or CleanConfig(), NUMBER)


def _clean_kind(df: DataFrame, cfg: CleanConfig, kind: str) -> DataFrame:
    profile = profile_table(df)
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    rules = [_rule(c, dtypes[c.name], profile.rows, cfg, False) for c in profile.columns]
    plan = CleanPlan(
        names=tuple(df.columns),
        rules=tuple(r if r.kind == kind else replace(r, kind=KEEP) for r in rules),
        config=cfg,
    )
    return df.select(*[plan._cleaned(r).alias(r.name) for r in plan.rules])


def drop_empty_rows(df: DataFrame, na: str = strings.MISSING, text_columns=None) -> DataFrame:
    """Drop rows whose text columns all hold ``na``; a table without text columns is unchanged."""
    texts = list(text_columns) if text_columns is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)
    ]
    if not texts:
        return df
    return df.filter(~reduce(lambda a, b: a & b, [col(n).eqNullSafe(F.lit(na)) for n in texts]))
