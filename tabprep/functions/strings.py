"""Text standardization as Catalyst expressions (no Python workers).

Every expression mentions its input column only once per branch.  That matters
because Catalyst pushes filters below projections by substituting the whole
expression: a step that mentions its input three times would be evaluated
three times over.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .charmap import (
    KEPT_CHARACTERS,
    OTHER_SPACES,
    SHARP_S,
    SHARP_S_UPPER,
    WHITESPACE_CLASS,
    expansion_class,
    fold_tables,
)

# Cleaned values that stand for "missing".
NULL_TOKENS = ("NAN", "NONE", "NULL", "", " ")
MISSING = "NA"

_WS_EDGES = f"^[{WHITESPACE_CLASS}]+|[{WHITESPACE_CLASS}]+$"


def strip_whitespace(c: Column) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.regexp_replace(c, _WS_EDGES.replace("$", r"\z"), "")


def collapse_whitespace(c: Column) -> Column:
    """Turn each whitespace run into one space.

    Translating first leaves a pattern of one plain character, which the regex
    engine scans several times faster than a class of all whitespace.
    """
    spaces = F.translate(c, OTHER_SPACES, " " * len(OTHER_SPACES))
    return F.regexp_replace(spaces, " {2,}", " ")


def squeeze(c: Column) -> Column:
    """Strip and collapse in one regex pass: after collapsing, only U+0020 is left to trim."""
    return F.trim(collapse_whitespace(c))


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


def _expand(c: Column) -> Column:
    """Replace characters that decompose to several ASCII characters.

    The text is cut only at those characters, so the work is proportional to
    how often they occur and not to the length of the text.
    """
    pairs = "\x01".join(f"{k}\x02{v}" for k, v in fold_tables()[2].items())
    table = F.str_to_map(F.lit(pairs), F.lit("\x01"), F.lit("\x02"))
    cls = expansion_class()
    parts = F.regexp_extract_all(c, F.lit(f"([{cls}]|(?:(?![{cls}])(?s:.))++)"), F.lit(1))
    return F.array_join(
        F.transform(parts, lambda p: F.coalesce(F.element_at(table, p), p)), ""
    )


def _fold_single(c: Column) -> Column:
    src, dst, _ = fold_tables()
    return F.replace(F.translate(c, src, dst), F.lit(SHARP_S), F.lit(SHARP_S_UPPER))


def _by_alphabet(c: Column, step) -> Column:
    """Apply ``step(text, fold)`` with the cheapest fold that is exact for the value.

    ASCII needs none, most accented text a one-to-one translation, and only
    values that hold ligatures, fractions and the like need expansion.  The
    tests read the raw column, so nothing is evaluated twice.
    """
    return (
        F.when(is_ascii(c), step(c, lambda x: x))
        .when(c.rlike(f"[{expansion_class()}]"), step(c, lambda x: _fold_single(_expand(x))))
        .otherwise(step(c, _fold_single))
    )


def fold_accents(c: Column) -> Column:
    """Replace accented and compatibility characters by their upper-case ASCII base."""
    return _by_alphabet(c, lambda x, fold: fold(x))


def uppercase(c: Column) -> Column:
    return F.upper(c)


def keep_whitelist(c: Column, keep_chars: str = "", spaces: str = WHITESPACE_CLASS) -> Column:
    """Drop everything but ``A-Z 0-9 @ / . - _``, whitespace and ``keep_chars``.

    The characters are listed one by one because the regex engine then tests
    them with a single table lookup, which is several times faster than ranges.
    """
    kept = _escaped(KEPT_CHARACTERS + keep_chars)
    return F.regexp_replace(c, f"[^{kept}{spaces}]+", "")


def null_tokens_to_na(c: Column, tokens=NULL_TOKENS, na: str = MISSING) -> Column:
    """Replace a value that *is* one of ``tokens`` (whole value) by ``na``."""
    pattern = "|".join(_escaped(t) for t in sorted(tokens, key=len, reverse=True))
    return F.regexp_replace(c, rf"\A(?:{pattern})\z", na)


def _escaped(text: str) -> str:
    """``text`` with its punctuation escaped for a regex."""
    return "".join(ch if ch.isalnum() or ch == " " else "\\" + ch for ch in text)


def fill_na(c: Column, na: str = MISSING) -> Column:
    return F.coalesce(c, F.lit(na))


def clean_text(c: Column, *, tokens=NULL_TOKENS, na: str = MISSING, keep_chars: str = "") -> Column:
    """The whole text recipe: squeeze, fold, uppercase, whitelist, tokens, fill."""

    def step(x: Column, fold) -> Column:
        return keep_whitelist(uppercase(fold(squeeze(x))), keep_chars, spaces=" ")

    full = null_tokens_to_na(_by_alphabet(c, step), tokens, na)
    ready = F.upper(c).rlike(_ready_pattern(tokens, keep_chars))
    return fill_na(F.when(ready, F.upper(c)).otherwise(full), na)


def _ready_pattern(tokens, keep_chars: str) -> str:
    """Upper-case values that are clean already: kept characters, single inner spaces, no token.

    Codes and names usually are, and one match is cheaper than three replacements.
    """
    kept = _escaped(KEPT_CHARACTERS + keep_chars)
    none_of = "|".join(_escaped(t) for t in tokens if t.strip())
    return rf"\A(?!(?:{none_of})\z)[{kept}]++(?: [{kept}]++)*+\z"


def surely_not_missing(c: Column, *, tokens=NULL_TOKENS, na: str = MISSING) -> Column:
    """True only for raw values whose cleaned form cannot be missing.

    An ASCII letter, digit or mark that occurs in no token survives cleaning,
    so one early-exit scan settles almost every value without cleaning it.
    """
    used = set("".join(tokens) + na)
    telling = "".join(
        ch + ch.lower() if ch.isalpha() else _escaped(ch) for ch in KEPT_CHARACTERS if ch not in used
    )
    return c.rlike(f"[{telling}]")


def float_text(c: Column) -> Column:
    """A floating-point value as text in plain notation (``12.0``, ``10000000.0``, ``1e+16``)."""
    wide = c.cast("double")
    size = F.abs(wide)
    shortest = c.cast("string")
    plain = F.regexp_replace(
        shortest.try_cast("decimal(38,21)").cast("string"), r"(\.[0-9]+?)0+\z", "$1"
    )
    mantissa = F.regexp_replace(F.substring_index(shortest, "E", 1), r"\.0\z", "")
    exponent = F.substring_index(shortest, "E", -1)
    scientific = F.concat(
        mantissa,
        F.when(exponent.startswith("-"), F.lit("e-")).otherwise(F.lit("e+")),
        F.regexp_replace(F.regexp_replace(exponent, "-", ""), r"\A([0-9])\z", "0$1"),
    )
    return (
        F.when(F.isnan(wide), F.lit(None).cast("string"))
        .when(size == F.lit(float("inf")), F.when(wide > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when((size == 0) | ((size >= 1e-3) & (size < 1e7)), shortest)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(scientific)
    )
