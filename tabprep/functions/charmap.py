"""Character tables for accent folding, derived from the Unicode database.

Compatibility decomposition, upper-casing and the character whitelist all act
on one code point at a time, so their composition is a plain mapping from a
code point to a (possibly empty) ASCII string.  The mapping is computed once
here and handed to Spark as literals, which keeps folding on the JVM side.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

# The characters that survive cleaning, besides whitespace.
KEPT_CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789@/.-_"

# The sharp s and its upper-case form.
SHARP_S, SHARP_S_UPPER = "ß", "SS"

# The characters besides U+0020 that count as whitespace, as a regex class body.
OTHER_WHITESPACE = (
    r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE_CLASS = " " + OTHER_WHITESPACE
OTHER_SPACES = "".join(chr(cp) for cp in range(1, 0x3001) if chr(cp).isspace() and cp != 0x20)


def fold_code_point(ch: str) -> str:
    """ASCII text that one character contributes to a cleaned value."""
    upper = unicodedata.normalize("NFKD", ch).upper()
    return "".join(c for c in upper if c in KEPT_CHARACTERS or c.isspace())


@lru_cache(maxsize=None)
def fold_tables() -> tuple[str, str, dict[str, str]]:
    """``(from, to, expansions)`` over all non-ASCII, non-whitespace characters.

    ``from``/``to`` list the characters that become exactly one ASCII
    character; ``expansions`` holds those that become several.
    """
    single_from, single_to, expansions = [], [], {}
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        if ch.isspace():
            continue
        folded = fold_code_point(ch)
        if len(folded) == 1:
            single_from.append(ch)
            single_to.append(folded)
        elif folded:
            expansions[ch] = folded
    del expansions[SHARP_S]  # frequent in German text: SHARP_S is replaced on its own
    return "".join(single_from), "".join(single_to), expansions


@lru_cache(maxsize=None)
def expansion_class(gap: int = 32) -> str:
    """Regex class covering every expansion with few ranges, to be put in brackets.

    Nearby code points are merged into one range.  The class may therefore
    cover characters that need no expansion, which is harmless, and it stays
    short, so testing one character against it is cheap.
    """
    ranges: list[list[int]] = []
    for cp in sorted(map(ord, fold_tables()[2])):
        if ranges and cp - ranges[-1][1] <= gap:
            ranges[-1][1] = cp
        else:
            ranges.append([cp, cp])
    body = "".join(f"{chr(lo)}-{chr(hi)}" for lo, hi in ranges)
    # Letters before and between the first two ranges are most of accented text;
    # ruling them out first leaves two tests for them instead of one per range.
    (first_lo, first_hi), (second_lo, _) = ranges[:2]
    common = f"\\x00-{chr(first_lo - 1)}{chr(first_hi + 1)}-{chr(second_lo - 1)}"
    return f"[^{common}]&&[{body}]"


def fold_text(text: str) -> str:
    """Fold one short driver-side string (a file name); unmapped characters stay."""
    return "".join(ch if ord(ch) < 0x80 else fold_code_point(ch) or ch for ch in text)


@lru_cache(maxsize=None)
def cp1252_tables() -> tuple[str, str]:
    """C1 control characters and the Windows-1252 characters they stand for."""
    pairs = []
    for byte in range(0x80, 0xA0):
        try:
            pairs.append((chr(byte), bytes([byte]).decode("cp1252")))
        except UnicodeDecodeError:
            continue
    return "".join(p[0] for p in pairs), "".join(p[1] for p in pairs)
