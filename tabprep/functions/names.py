"""Names of columns, output files and tables.

Column names are schema-sized, so they are handled as plain strings; the file
and table name rules also exist as Column expressions for whole listings.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .charmap import fold_text
from .strings import fold_accents

OUTPUT_SUFFIX = "_transformed.csv"


def normalize_columns(names: Sequence[str | None]) -> list[str]:
    """Strip and uppercase; blanks become ``COLUMN_i``; repeats get ``_1, _2, ...``.

    Continues numbering until a name is free, so the result is always unique.
    """
    taken: set[str] = set()
    repeats: dict[str, int] = {}
    out = []
    for position, raw in enumerate(names):
        stripped = "" if raw is None else str(raw).strip()
        base = (stripped or f"COLUMN_{position}").upper()
        name = base
        while name in taken:
            repeats[base] = repeats.get(base, 0) + 1
            name = f"{base}_{repeats[base]}"
        taken.add(name)
        out.append(name)
    return out


def output_name(file_name: str) -> str:
    """``data.csv`` -> ``data_transformed.csv`` (only the last extension goes)."""
    return file_name.rsplit(".", 1)[0] + OUTPUT_SUFFIX


def output_name_column(c: Column) -> Column:
    return F.concat(F.regexp_replace(c, r"(?s)\.[^.]*\z", ""), F.lit(OUTPUT_SUFFIX))


def table_name(file_name: str, prefix: str = "tbl_") -> str:
    """A plain identifier from a file name; a leading digit gets ``prefix``."""
    # Accented letters are folded, so that the name is a plain identifier on every catalog.
    base = fold_text(file_name.rsplit(".", 1)[0].lower()).lower()
    name = re.sub(r"[^a-z0-9]", "_", base)
    return prefix + name if name[:1].isdigit() else name


def table_name_column(c: Column, prefix: str = "tbl_") -> Column:
    base = F.lower(fold_accents(F.lower(F.regexp_replace(c, r"(?s)\.[^.]*\z", ""))))
    name = F.regexp_replace(base, "[^a-z0-9]", "_")
    return F.regexp_replace(name, r"\A(?=[0-9])", prefix)


class NameCollision(ValueError):
    """Two files map to one table name."""


def table_names(
    file_names: Iterable[str], prefix: str = "tbl_", on_collision: str = "error"
) -> dict[str, str]:
    """Table name per file; collisions raise, get a suffix, or share one name (``replace``)."""
    names = list(dict.fromkeys(file_names))
    return dict(zip(names, target_names(names, prefix, on_collision)))


def target_names(
    file_names: Iterable[str], prefix: str = "tbl_", on_collision: str = "error"
) -> list[str]:
    """Table names in the order of the files, which may repeat; collisions as in ``table_names``."""
    if on_collision not in ("error", "suffix", "replace"):
        raise ValueError(f"unknown on_collision: {on_collision}")
    result: list[str] = []
    owner: dict[str, str] = {}
    for file_name in file_names:
        base = name = table_name(file_name, prefix)
        n = 0
        while name in owner and on_collision != "replace":
            if on_collision == "error":
                raise NameCollision(f"{owner[name]!r} and {file_name!r} both map to {name!r}")
            n += 1
            name = f"{base}_{n}"
        owner[name] = file_name
        result.append(name)
    return result


def quoted(name: str) -> str:
    """Backtick-quoted identifier, safe for names holding dots, spaces or backticks."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))
