"""Reading delimited files: header, ragged rows, missing tokens, many files."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.charmap import cp1252_tables
from ..functions.names import col, normalize_columns
from ..operators.clean import TableRecord
from .dialect import CP1252, LATIN1, Dialect, detect_dialects, first_match
from .files import FileSystem, file_inventory, file_name, glob_escaped, plain_path, require_files

# Field texts that mean "missing" when a file is read.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

_BAD = "__bad_line"


def read_header(spark: SparkSession, path: str, dialect: Dialect) -> list[str | None]:
    """The raw header fields of one file: a job that stops after the first line."""
    options = reader_options(dialect, header=False)
    first = spark.read.options(**options).csv(glob_escaped(path)).first()
    fields = [] if first is None else list(first)
    if fields and fields[0]:
        fields[0] = fields[0].removeprefix("\ufeff")
    if dialect.encoding == CP1252:
        table = str.maketrans(*cp1252_tables())
        fields = [f.translate(table) if f else f for f in fields]
    return fields


def _decoded(c: Column, dialect: Dialect) -> Column:
    return F.translate(c, *cp1252_tables()) if dialect.encoding == CP1252 else c


def _surplus_fields(line: Column, dialect: Dialect, fields: int) -> Column:
    """Whether a line that does not fit the header has too many fields, and not too few.

    The reader's own tokens decide: parsed again with one more field, that field holds
    something.  Where the line ends with a separator the last field is empty, which the
    parser does not tell from a missing one, and separators outside quotes are counted.
    """
    schema = ", ".join(f"c{i} string" for i in range(fields + 1))
    options = {k: v for k, v in reader_options(dialect).items() if k in ("sep", "quote", "escape", "mode")}
    overflow = F.from_csv(line, schema, options)[f"c{fields}"].isNotNull()
    bare = F.regexp_replace(line, '"[^"]*+"', "")
    separators = F.char_length(bare) - F.char_length(
        F.replace(bare, F.lit(dialect.separator), F.lit(""))
    )
    return overflow | (line.endswith(dialect.separator) & (separators >= fields))


def text_schema(fields: int) -> T.StructType:
    """Schema of the raw read: every field as text, plus the line itself where it does not fit."""
    names = [f"c{i}" for i in range(fields)] + [_BAD]
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def reader_options(dialect: Dialect, header: bool = True) -> dict[str, str]:
    return {
        "sep": dialect.separator,
        "encoding": LATIN1 if dialect.encoding == CP1252 else dialect.encoding,
        "quote": '"',
        "escape": '"',
        "header": str(header).lower(),
        "multiLine": str(dialect.multiline).lower(),
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _BAD,
        # A pruned parse cannot tell how many fields a line has.
        "columnPruning": "false",
    }


def fits(dialect: Dialect, fields: int) -> Column:
    """Whether a raw row has no more fields than the header."""
    # Always true where it is read, this mention of a field keeps plain row counts legal:
    # Spark refuses queries that need nothing but the bad-line column.
    has_field = F.length(F.coalesce(F.col("c0"), F.col(_BAD))) >= 0
    surplus = _surplus_fields(F.col(_BAD), dialect, fields)
    return F.col(_BAD).isNull() | (~surplus & has_field)


def shaped(raw: DataFrame, names: Sequence[str], dialect: Dialect,
           na_tokens: Sequence[str] = NA_TOKENS, *extra: Column) -> DataFrame:
    """Named columns of a raw read: surplus rows dropped, missing tokens null, text decoded."""
    fields = [f"c{i}" for i in range(len(names))]
    tokens = list(na_tokens)
    values = [
        F.when(~F.col(f).isin(tokens), _decoded(F.col(f), dialect)).alias(n)
        for f, n in zip(fields, names)
    ]
    return raw.where(fits(dialect, len(names))).select(*values, *extra)


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    dialect: Dialect = Dialect(),
    header: Sequence[str | None] | None = None,
    na_tokens: Sequence[str] = NA_TOKENS,
    with_file_name: bool = False,
) -> DataFrame:
    """All columns as text, with normalized names.

    Short rows are padded with nulls and rows with surplus fields are dropped.
    Blank lines are skipped, and missing tokens become null.  Files are split
    and read in parallel unless quoted fields span lines.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if header is None:
        header = read_header(spark, paths[0], dialect)
    names = normalize_columns(header)
    raw = (
        spark.read.options(**reader_options(dialect))
        .schema(text_schema(len(names)))
        .csv([glob_escaped(p) for p in paths])
    )
    extra = [F.col("_metadata.file_name").alias("__file_name")] if with_file_name else []
    return shaped(raw, names, dialect, na_tokens, *extra)


def _layout(row) -> tuple:
    """Files with an equal key have the same dialect and header line.

    A header that goes on over a line break is told apart by its path.
    """
    header = row.path if row.header_open else row.header_hash
    return row.separator, row.encoding, bool(row.detected), row.fields, header


def _headers(spark: SparkSession, rows, parallelism: int) -> dict[tuple, list[str | None]]:
    """One header per distinct layout, so that many files of one layout cost one small read."""
    samples = {_layout(r): r for r in rows}

    def one(row):
        try:
            return read_header(spark, row.path, _dialect(row))
        except Exception as e:  # kept with the files it concerns
            return e

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return dict(zip(samples, pool.map(one, samples.values())))


def _dialect(row) -> Dialect:
    return Dialect(row.separator, row.encoding, bool(row.multiline), bool(row.detected))


def extract(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.csv",
    *,
    strict_first_match: bool = False,
    parallelism: int = 16,
    paths: Sequence[str] | None = None,
    strict: bool = True,
) -> list[TableRecord]:
    """One record per file of a folder, each with a lazy table.

    Files without a data line are recorded as ``empty``, unreadable ones as
    ``failed``.  Raises if there are no files, or (if ``strict``) if none can be
    read.  With ``paths``, as an inventory lists them, only those files are looked at.
    """
    if paths is None:
        inventory = require_files(spark, folder, pattern)
    else:
        inventory = file_inventory(spark, [glob_escaped(p) for p in paths], pattern)
    dialects = detect_dialects(spark, folder if paths is None else [glob_escaped(p) for p in paths], pattern)
    if strict_first_match:
        dialects = first_match(dialects)
    listed = inventory.join(dialects.drop("name"), "path", "left").orderBy("name")

    rows = listed.collect()
    headers = _headers(spark, [r for r in rows if r.lines and r.lines > 1], parallelism)

    def one(row) -> TableRecord:
        if row.lines is None or row.lines < 2:
            return TableRecord(row.name, None, status="empty", rows=0, error="no data rows", content=row.content)
        header = headers[_layout(row)]
        if isinstance(header, Exception):
            return TableRecord(row.name, None, status="failed", error=str(header), content=row.content)
        dialect = _dialect(row)
        df = read_delimited(spark, row.path, dialect, header)
        return TableRecord(row.name, df, dialect=dialect, untyped=True, content=row.content)

    records = [one(row) for row in rows]
    records += [
        TableRecord(name, None, status="empty", rows=0, error="no bytes")
        for name in (FileSystem(spark).empty_files(folder, pattern) if paths is None else ())
    ]
    if strict and not any(r.status == "ok" for r in records):
        raise NoReadableFiles(f"no file in {folder} could be read")
    return records


class NoReadableFiles(ValueError):
    """Files were found but none holds a readable table."""


def extract_parts(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.csv",
    *,
    na_tokens: Sequence[str] = NA_TOKENS,
    with_file_name: bool = False,
    parallelism: int = 16,
) -> list[TableRecord]:
    """One record per distinct layout: files of equal dialect and header are read as one table.

    Use it for folders of many part files: each layout is one scan with the
    usual input splits, however many files it has.
    """
    require_files(spark, folder, pattern)
    rows = detect_dialects(spark, folder, pattern).where("lines > 1").orderBy("path").collect()
    headers = _headers(spark, rows, parallelism)
    groups: dict[tuple, list] = defaultdict(list)
    for row in rows:
        groups[_layout(row)].append(row)
    records = []
    for layout, members in groups.items():
        header = headers[layout]
        if isinstance(header, Exception):
            records.append(TableRecord(members[0].name, None, status="failed", error=str(header)))
            continue
        separator, encoding, detected = layout[:3]
        dialect = Dialect(separator, encoding, any(m.multiline for m in members), detected)
        paths = [m.path for m in members]
        df = read_delimited(spark, paths, dialect, header, na_tokens, with_file_name)
        records.append(TableRecord(members[0].name, df, dialect=dialect, untyped=True))
    if not records:
        raise NoReadableFiles(f"no file in {folder} holds data rows")
    return records


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """Append tables of one layout by column name."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def extraction_metrics(records: Sequence[TableRecord]) -> DataFrame:
    """Rows and columns per extracted table, counted in one job."""
    ok = [r for r in records if r.status == "ok"]
    parts = [
        r.df.select(F.lit(r.name).alias("file_name"), F.lit(len(r.df.columns)).alias("column_count"))
        for r in ok
    ]
    return (
        union_parts(parts)
        .groupBy("file_name", "column_count")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def extraction_report(
    spark: SparkSession, folder: str, pattern: str = "*.csv", parallelism: int = 16
) -> DataFrame:
    """Per file with data lines: dialect, columns, rows read, and lines dropped for surplus fields.

    One scan for each distinct layout, its files told apart by their path; a field
    that spans lines keeps only its own layout from being split.
    """
    require_files(spark, folder, pattern)
    rows = detect_dialects(spark, folder, pattern).where("lines > 1").collect()
    headers = _headers(spark, rows, parallelism)
    layouts: dict[tuple, list] = defaultdict(list)
    for row in rows:
        layouts[_layout(row), bool(row.multiline)].append(row)
    path = plain_path(F.col("_metadata.file_path")).alias("path")
    parts = []
    for (layout, multiline), members in layouts.items():
        header = headers[layout]
        if isinstance(header, Exception):
            continue
        dialect = Dialect(layout[0], layout[1], multiline, layout[2])
        reader = spark.read.options(**reader_options(dialect)).schema(text_schema(len(header)))
        raw = reader.csv([glob_escaped(m.path) for m in members])
        counted = raw.select(path, fits(dialect, len(header)).alias("fits")).groupBy("path").agg(
            F.count_if("fits").alias("row_count"), F.count_if(~F.col("fits")).alias("dropped_lines")
        )
        about = {"separator": dialect.separator, "encoding": dialect.encoding, "column_count": len(header)}
        parts.append(counted.withColumns({k: F.lit(v) for k, v in about.items()}))
    if not parts:
        raise NoReadableFiles(f"no file in {folder} holds data rows")
    return union_parts(parts).withColumn("file_name", file_name(F.col("path")))


def inferred(df: DataFrame) -> DataFrame:
    """Give text columns the type that all their present values share (integer, float, truth value)."""
    from ..operators.profile import profile_table

    profile = profile_table(df, untyped=True)
    out = []
    for c in profile.columns:
        value = col(c.name)
        if c.dtype == "string" and c.non_null:
            # the profile has tried every value: what is no number is null
            if c.integral == profile.rows:
                value = value.try_cast("bigint")
            elif c.numeric == c.non_null:
                value = value.try_cast("double")
            elif c.boolean == profile.rows:
                value = value.try_cast("boolean")
        out.append(value.alias(c.name))
    return df.select(*out)
