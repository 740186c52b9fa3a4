"""Encoding and separator detection for whole folders in one distributed pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import file_name, plain_path

# Candidate separators, most preferred first.
SEPARATORS = ("»", ",", ";", "|", "\t")
UTF8, LATIN1, CP1252 = "UTF-8", "ISO-8859-1", "windows-1252"


@dataclass(frozen=True)
class Dialect:
    """How a delimited file is to be read."""

    separator: str = ","
    encoding: str = UTF8
    multiline: bool = False
    detected: bool = True


FALLBACK = Dialect(detected=False)


def _occurrences(text: Column, ch: str) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(ch), F.lit("")))


#: Sums of these parts of the lines' hashes tell the content of a file, in whatever order its lines are read.
PIECES = ("hash_low", "hash_mid", "hash_high")


def _pieces(line_hash: Column) -> dict[str, Column]:
    """Three parts of a 64-bit hash whose sums do not overflow below 2**39 lines."""
    mid = F.shiftrightunsigned(line_hash, 20).bitwiseAND(F.lit(0xFFFFFF))
    return dict(zip(PIECES, (line_hash.bitwiseAND(F.lit(0xFFFFF)), mid, F.shiftrightunsigned(line_hash, 44))))


def _lines(spark: SparkSession, folder: str | list[str], pattern: str) -> DataFrame:
    raw = (
        spark.read.option("pathGlobFilter", pattern)
        .text(folder)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
        )
        .where(F.trim("value") != "")
    )
    # The earliest line of the first block is the header; line numbers grow within a block.
    placed = raw.select(
        "file",
        "value",
        F.when(F.col("block") == 0, F.monotonically_increasing_id()).alias("position"),
        F.is_valid_utf8("value").alias("valid"),
        F.xxhash64("value").alias("line_hash"),
    )
    decoded = placed.select(
        "file",
        "position",
        "valid",
        "line_hash",
        F.when(F.col("valid"), F.col("value"))
        .otherwise(F.decode(F.col("value").cast("binary"), LATIN1))
        .alias("text"),
    )
    return decoded.select(
        "file",
        "position",
        "valid",
        "line_hash",
        (~F.col("valid") & F.col("text").rlike(r"[\x80-\x9f]")).alias("c1"),
        (_occurrences(F.col("text"), '"') % 2 == 1).alias("open_quote"),
        F.when(F.contains("text", F.lit('"')), F.regexp_replace("text", '"[^"]*+"', "")).otherwise(F.col("text")).alias("bare"),
    )


def detect_dialects(spark: SparkSession, folder: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """One row per non-empty file of a folder, or of the paths given: its encoding, separator, and how well the lines agree.

    Every line is read once.  Lines are first reduced to distinct vectors of
    separator counts within each task, so a file of any size is spread over all
    tasks that read it, and only counts are shuffled.  The separator is the one
    found in the header for which most lines have as many as the header; ties go
    to the preferred one.  A file without any is read as one column.  ``content``
    is the same for files with the same header and lines, whatever they are named.
    """
    counts = [f"n{i}" for i in range(len(SEPARATORS))]
    lines = _lines(spark, folder, pattern).select(
        "file",
        "position",
        "valid",
        "line_hash",
        "c1",
        "open_quote",
        *[_occurrences(F.col("bare"), s).alias(n) for n, s in zip(counts, SEPARATORS)],
    )
    vectors = lines.groupBy("file", *counts).agg(
        F.count(F.lit(1)).alias("lines"),
        *[F.sum(piece).alias(n) for n, piece in _pieces(F.col("line_hash")).items()],
        F.min_by("line_hash", "position").alias("line_hash"),
        F.min_by("open_quote", "position").alias("header_open"),
        F.min("position").alias("position"),
        F.min("valid").alias("valid"),
        F.max("c1").alias("c1"),
        F.max("open_quote").alias("open_quote"),
    )
    candidates = F.explode(
        F.array(
            *[
                F.struct(F.lit(i).alias("rank"), F.col(n).alias("n"))
                for i, n in enumerate(counts)
            ]
        )
    ).alias("c")
    per_count = (
        vectors.select(
            "file", "lines", "line_hash", "header_open", "position", "valid", "c1", "open_quote", *PIECES, candidates
        )
        .groupBy("file", F.col("c.rank").alias("rank"), F.col("c.n").alias("n"))
        .agg(
            F.sum("lines").alias("lines"),
            *[F.sum(p).alias(p) for p in PIECES],
            F.min_by("line_hash", "position").alias("line_hash"),
            F.min_by("header_open", "position").alias("header_open"),
            F.min("position").alias("position"),
            F.min("valid").alias("valid"),
            F.max("c1").alias("c1"),
            F.max("open_quote").alias("open_quote"),
        )
    )
    per_separator = per_count.groupBy("file", "rank").agg(
        F.min_by("n", "position").alias("header_count"),
        F.min_by("lines", "position").alias("agreeing"),
        F.min_by("line_hash", "position").alias("header_hash"),
        F.min_by("header_open", "position").alias("header_open"),
        F.sum("lines").alias("lines"),
        *[F.sum(p).alias(p) for p in PIECES],
        F.min("valid").alias("valid"),
        F.max("c1").alias("c1"),
        F.max("open_quote").alias("open_quote"),
    )
    score = F.struct(
        F.col("header_count") > 0, F.col("agreeing") / F.col("lines"), "header_count", -F.col("rank")
    )
    best = per_separator.groupBy("file").agg(
        F.max_by(F.struct("rank", "header_count", "agreeing"), score).alias("best"),
        F.max("lines").alias("lines"),
        *[F.max(p).alias(p) for p in PIECES],
        F.min("valid").alias("valid"),
        F.max("c1").alias("c1"),
        F.max("open_quote").alias("multiline"),
        F.max("header_hash").alias("header_hash"),
        F.max("header_open").alias("header_open"),
    )
    found = F.col("best.header_count") > 0
    separator = F.element_at(F.array(*[F.lit(s) for s in SEPARATORS]), F.col("best.rank") + 1)
    path = plain_path(F.col("file"))
    return best.select(
        path.alias("path"),
        file_name(path).alias("name"),
        F.when(found, separator).otherwise(F.lit(FALLBACK.separator)).alias("separator"),
        F.when(F.col("valid"), F.lit(UTF8))
        .when(F.col("c1"), F.lit(CP1252))
        .otherwise(F.lit(LATIN1))
        .alias("encoding"),
        "multiline",
        found.alias("detected"),
        (F.when(found, F.col("best.header_count")).otherwise(0) + 1).cast("int").alias("fields"),
        "lines",
        F.when(found, F.col("best.agreeing")).otherwise(F.col("lines")).alias("agreeing_lines"),
        "header_hash",
        "header_open",
        F.sha2(F.concat_ws(":", "lines", "header_hash", *PIECES), 256).alias("content"),
    )


def first_match(detected: DataFrame) -> DataFrame:
    """Replace detection by the first combination that yields a row, as a strict first-match would.

    Any bytes decode as ISO-8859-1 and any text parses as one column, so every
    file with a data line gets the first separator.
    """
    has_rows = F.col("lines") > 1
    return detected.withColumns(
        {
            "separator": F.when(has_rows, F.lit(SEPARATORS[0])).otherwise(F.col("separator")),
            "encoding": F.when(has_rows, F.lit(LATIN1)).otherwise(F.col("encoding")),
        }
    )
