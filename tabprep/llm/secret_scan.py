"""Secret scans: pattern hits, and key material confirmed by its structure.

Three plain patterns give base spans. Candidates of base64 or hex are then decoded and parsed: a key
is reported only if its encoding holds together (nested lengths fill their parent exactly, the parts
are those of a private key), a signed token only if its header names an algorithm and its payload is
an object. Texts without a long run of key characters or an assignment sign are settled by whole-array
byte tests and never reach the patterns.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import struct
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tabprep.llm import scan

#: Kinds in the order in which spans of one start are listed; the first three are the base patterns.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "pem", "jwt", "key", "hexkey")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
BEGIN = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----")
END = re.compile(r"-----END ((?:[A-Z0-9]+ )*PRIVATE KEY)-----")
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")
RUN = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
HEX_RUN = re.compile(r"[0-9A-Fa-f]{48,}")
#: How base64 of a DER sequence with a long length, or of an OpenSSH key, begins.
KEY_START = re.compile(r"M[CDEFGHI]|b3BlbnNzaC1rZXktdjEA")
OPENSSH = b"openssh-key-v1\0"
#: The same in hex: a DER sequence of a plausible length, or an OpenSSH key.
HEX_KEY_START = re.compile(f"30(?:8[1-4]|[2-7][0-9a-f])|{OPENSSH.hex()}")

_CHARACTERS = np.zeros(256, bool)
_CHARACTERS[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"]] = True
_TOKEN_CHARACTERS = _CHARACTERS.copy()
_TOKEN_CHARACTERS[[*b"+/"]] = False
_SIGNS = np.zeros(256, bool)
_SIGNS[[*b":="]] = True
SHORTEST_RUN = 20


def _decoded(text: str) -> bytes | None:
    """Base64 of either alphabet, padded or not; the longest whole part."""
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text[: len(text) - (len(text) % 4 == 1)] + "=" * (-len(text) % 4 if len(text) % 4 != 1 else 0))
    except binascii.Error:
        return None


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, content start and content end of the DER element at ``at``; None if it does not fit before ``end``."""
    if at + 2 > end:
        return None
    tag, size, start = data[at], data[at + 1], at + 2
    if size & 0x80:
        width = size & 0x7F
        if not 1 <= width <= 4 or start + width > end:
            return None
        size = int.from_bytes(data[start : start + width], "big")
        start += width
        if size < 0x80:
            return None
    return (tag, start, start + size) if start + size <= end else None


def _parts(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``at`` to ``end`` exactly."""
    found = []
    while at < end:
        part = _element(data, at, end)
        if part is None:
            return None
        found.append(part)
        at = part[2]
    return found


def private_key_size(data: bytes) -> int | None:
    """Bytes that a DER private key at the start of ``data`` takes; None if there is none."""
    outer = _element(data, 0, len(data))
    if outer is None or outer[0] != 0x30:
        return None
    parts = _parts(data, outer[1], outer[2])
    if not parts or len(parts) < 2:
        return None
    tags = [t for t, _, _ in parts]
    inner = [_parts(data, a, b) if t == 0x30 else None for t, a, b in parts]
    algorithm = lambda p: bool(p) and p[0][0] == 0x06
    integers = tags[:6] == [0x02] * 6 and len(tags) in (6, 9, 10)  # DSA; RSA
    wrapped = tags[:3] == [0x02, 0x30, 0x04] and algorithm(inner[1])
    elliptic = tags[:2] == [0x02, 0x04] and all(t in (0xA0, 0xA1) for t in tags[2:])
    sealed = tags == [0x30, 0x04] and algorithm(inner[0])
    return outer[2] if integers or wrapped or elliptic or sealed else None


def _string(data: bytes, at: int) -> tuple[bytes, int] | None:
    if at + 4 > len(data):
        return None
    (size,) = struct.unpack_from(">I", data, at)
    return (data[at + 4 : at + 4 + size], at + 4 + size) if at + 4 + size <= len(data) else None


def openssh_key_size(data: bytes) -> int | None:
    """Bytes that an OpenSSH private key at the start of ``data`` takes; None if there is none."""
    if not data.startswith(OPENSSH):
        return None
    at = len(OPENSSH)
    for _ in range(3):  # cipher, derivation, its options
        part = _string(data, at)
        if part is None:
            return None
        at = part[1]
    if at + 4 > len(data):
        return None
    (keys,) = struct.unpack_from(">I", data, at)
    at += 4
    if not 1 <= keys <= 64:
        return None
    for _ in range(keys + 1):  # public keys, the private part
        part = _string(data, at)
        if part is None or not part[0]:
            return None
        at = part[1]
    return at


def key_size(data: bytes) -> int | None:
    return private_key_size(data) or openssh_key_size(data)


def _object(text: str) -> dict | None:
    data = _decoded(text)
    try:
        value = json.loads(data) if data is not None else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _keys_in(run: str) -> Iterator[tuple[int, int]]:
    """Places of private keys in a run of base64 characters; each stated length is checked before decoding on."""
    at = 0
    while (m := KEY_START.search(run, at)) is not None:
        start = m.start()
        at = start + 1
        head = _decoded(run[start : start + 8]) or b""
        size = None
        if head[:1] == b"\x30" and len(head) >= 6:
            long = head[1] & 0x80
            width = head[1] & 0x7F if long else 0
            size = 2 + width + (int.from_bytes(head[2 : 2 + width], "big") if long else head[1]) if width <= 4 else None
        if size is not None and -(-size * 4 // 3) <= len(run) - start:
            chars = -(-size * 4 // 3)
            data = _decoded(run[start : start + chars])
            if data is not None and private_key_size(data) == size:
                pad = len(run[start + chars :]) - len(run[start + chars :].lstrip("="))
                yield start, start + chars + pad
                at = start + chars
        elif run.startswith("b3BlbnNzaC1rZXktdjEA", start):
            data = _decoded(run[start:])
            size = openssh_key_size(data) if data else None
            if size:
                end = min(len(run), start + -(-size * 4 // 3) + (-size % 3))
                yield start, end
                at = end


def _hex_keys_in(run: str) -> Iterator[tuple[int, int]]:
    """Places of private keys in a run of hex digits, wherever in it they begin."""
    run, at = run.lower(), 0
    while (m := HEX_KEY_START.search(run, at)) is not None:
        start = m.start()
        at = start + 1
        if m[0].startswith("30"):
            head = bytes.fromhex(run[start : start + 16])
            width = head[1] & 0x7F if head[1] & 0x80 else 0
            size = 2 + width + (int.from_bytes(head[2 : 2 + width], "big") if width else head[1])
            if start + 2 * size > len(run) or private_key_size(bytes.fromhex(run[start : start + 2 * size])) != size:
                continue
        else:
            size = openssh_key_size(bytes.fromhex(run[start : start + (len(run) - start) // 2 * 2]))
            if not size:
                continue
        at = start + 2 * size
        yield start, at


def _armoured(text: str) -> Iterator[tuple[int, int, str]]:
    """Stretches from a begin mark to the first end mark of the same label, with what is between; each mark is looked at once."""
    ends: dict[str, list[re.Match]] = {}
    for m in END.finditer(text) if "-----END " in text else ():
        ends.setdefault(m[1], []).append(m)
    at = 0
    for m in BEGIN.finditer(text) if ends else ():
        same = ends.get(m[1], [])
        k = bisect_left(same, m.end(), key=re.Match.start)
        if m.start() >= at and k < len(same):
            at = same[k].end()
            yield m.start(), at, text[m.end() : same[k].start()]


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """All spans of a text as (kind, start, end), in code points, by start and then by kind."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    for start, end, inner in _armoured(text):
        lines = inner.replace("\\r", "").replace("\\n", "\n").splitlines()  # line breaks may be written out
        body = "".join(x.strip() for x in lines if ":" not in x)
        data = _decoded(body) if re.fullmatch(r"[A-Za-z0-9+/]+={0,2}", body) else None
        sealed = data is not None and "ENCRYPTED" in inner and len(data) >= 32 and len(data) % 8 == 0
        if data is not None and (key_size(data) or sealed):
            found.append(("pem", start, end))
    for m in TOKEN.finditer(text):
        header = _object(m[1])
        if header is not None and isinstance(header.get("alg"), str) and _object(m[2]) is not None:
            found.append(("jwt", m.start(), m.end()))
    for m in RUN.finditer(text):
        found += [("key", m.start() + a, m.start() + b) for a, b in _keys_in(m[0])]
    for m in HEX_RUN.finditer(text):
        found += [("hexkey", m.start() + a, m.start() + b) for a, b in _hex_keys_in(m[0])]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def redacted(text: str, spans: list[tuple[str, int, int]], mask: str = "[SECRET]") -> str:
    """The text with every stretch that spans cover, overlaps joined, replaced by ``mask``."""
    out, at = [], 0
    cover: list[list[int]] = []
    for _, a, b in sorted(spans, key=lambda s: s[1]):
        if cover and a < cover[-1][1]:
            cover[-1][1] = max(cover[-1][1], b)
        else:
            cover.append([a, b])
    for a, b in cover:
        out += [text[at:a], mask]
        at = b
    return "".join([*out, text[at:]])


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def _dotted(raw: np.ndarray) -> np.ndarray:
    """Dots after eight characters of a signed token, with two or more of them up to another dot."""
    dots = np.flatnonzero(raw == 0x2E)
    first, second = dots[:-1], dots[1:]
    wide = (second - first > 2) & (first >= 8)
    first, second = first[wide], second[wide]
    near = second - first <= 1 << 12  # a longer middle part is a run of key characters by itself
    first, second = first[near], second[near]
    inside = np.zeros(len(raw) + 1, np.int32)
    np.cumsum(_TOKEN_CHARACTERS[raw], out=inside[1:])
    return first[(inside[second] - inside[first + 1] == second - first - 1) & (inside[first] - inside[first - 8] == 8)]


def _suspects(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Documents with a run of key characters, an assignment sign or three dotted parts; no other can hold a span."""
    starts, ends, _ = scan.word_bounds(_CHARACTERS[raw], offsets)
    places = np.concatenate([starts[ends - starts >= SHORTEST_RUN], np.flatnonzero(_SIGNS[raw]), _dotted(raw)])
    return np.unique(np.searchsorted(offsets, places, "right") - 1)


def _scanned(keep: Sequence[str], redact: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, offsets in scan.slices(batches, "text"):
            texts = rows.column("text")
            spans: list[list] = [[] for _ in range(rows.num_rows)]
            clean: dict[int, str] = {}
            for i in _suspects(raw, offsets).tolist():
                text = texts[i].as_py()
                spans[i] = spans_of(text)
                if redact and spans[i]:
                    clean[i] = redacted(text, spans[i])
            columns = [rows.column(c) for c in keep]
            if clean and "text" in keep:
                values = texts.to_pylist()
                for i, text in clean.items():
                    values[i] = text
                columns[list(keep).index("text")] = pa.array(values, pa.string())
            rows_of = [[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in spans]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(rows_of, pa.list_(_SPAN))], names=[*keep, "secrets"])

    return run


def secrets(docs: DataFrame, keep: Sequence[str] | None = None, redact: bool = False) -> DataFrame:
    """``docs`` with ``secrets``: an array of (kind, start, end), in code points, end exclusive.

    Ordered by start, then as in ``KINDS``. With ``redact``, each covered stretch of ``text`` is
    replaced by ``[SECRET]``. ``keep`` names the columns to return (all, if not given); a column
    named ``secrets`` is replaced. A null text has no secrets and stays null; repeated rows each give
    their own row; an empty table stays empty. Texts are scanned whole, whatever their length.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != "secrets"]
    needed = list(dict.fromkeys([*keep, "text"]))
    rows = docs.select(*(docs[c].cast("string").alias(c) if c == "text" else docs[c] for c in needed))
    fields = [rows.schema[c] for c in keep]
    return rows.mapInArrow(_scanned(keep, redact), T.StructType([*fields, T.StructField("secrets", SPANS)]))
