"""Secrets in texts: patterns, and structural confirmation of encoded keys and tokens.

Patterns alone give the base findings. Beyond them, runs of base64 or hex, armoured blocks
and dotted tokens are decoded, and reported only if what they hold is built like a secret: a
DER key whose nested lengths fit exactly, an OpenSSH key whose fields fill it, a signed token
whose header names its algorithm.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGNED, ACCESS_LENGTH, HEX_LENGTH = 8, 16, 32
BASE_KINDS = ("assign", "access", "hex")
#: Kinds in the order in which findings of the same start are listed.
KINDS = (*BASE_KINDS, "key", "signed_token")

_WORDS = ("passw", "secret", "token", "api")
#: Shorter runs hold no key.
KEY_RUN = 40
#: Elements that one part of a key has at most: an RSA key, the longest kind, has nine.
KEY_PARTS = 64
_BEGIN = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----")
_HEADER = re.compile(r"^[ \t]*[\w-]+:[^\n]*$", re.MULTILINE)
# What code and JSON write in the place of a line break, a slash, or a sign.
_ESCAPE = re.compile(r"(?<!\\)\\++(?:[nrt]|u00(?:2[bBfF]|3[dD]|0[aAdD])|(?=/))")
#: What may stand between the lines of a key: white space, quotes joined by a sign, comment signs.
_GAP = re.compile(r"""(?:(?<!\\)\\*+["'`]\s*+[+.&,\\]?\s*+\\*+["'`]|\\?\s|(?<=\s)[>#*|]+|\x00)+""")
# Where the bytes of DER (0x30, a length) or of "openssh" may begin.
_BASE64_START = re.compile(r"M(?:[A-P]|(?=[\s\x00\\\"'`]))|b3Bl")
# In one run, a short length is followed by the number that every key begins with.
_HEX_START = re.compile(
    r"30(?=8[1-4]|[0-7][0-9A-Fa-f](?:02|[^0-9A-Fa-f])|[^0-9A-Fa-f]|[0-9A-Fa-f][^0-9A-Fa-f])|6[fF]70"
)
_BASE64_PIECE = re.compile(r"[A-Za-z0-9+/_-]+")
_HEX_PIECE = re.compile(r"[0-9A-Fa-f]+")
_HEX_GAP = re.compile(r"""(?:(?<!\\)\\*+["'`]\s*+[+.&,\\]?\s*+\\*+["'`]|\\x|0[xX]|\\?\s|[:,\x00]|(?<=\s)[>#*|]+)+""")
_BASE64_END = re.compile(r"(?![A-Za-z0-9+/_-])|(?=-----)")
_HEX_END = re.compile(r"(?![0-9A-Fa-f])")
_PADDING = re.compile(r"(?:\x00*=){0,2}")
_DOTTED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]*+)++")


def _members(of: str) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[ord(c) for c in of]] = True
    return table


_DIGITS = "0123456789"
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_IN_HEX = _members(_DIGITS + "abcdefABCDEF")


def _longest_run(raw: np.ndarray, members: np.ndarray) -> int:
    breaks = np.flatnonzero(~members[raw])
    if not len(breaks):
        return len(raw)
    return int(max(breaks[0], len(raw) - 1 - breaks[-1], np.diff(breaks).max(initial=1) - 1))


# --- What decoded bytes are ------------------------------------------------------------


def _der(data: bytes | _Bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, content start, content end) of the elements that fill the range, or None."""
    found = []
    while at < end:
        if at + 2 > end or len(found) == KEY_PARTS:
            return None
        head = data[at : at + 6]
        tag, length, at = head[0], head[1], at + 2
        if length >= 0x80:
            size = length & 0x7F
            if not 1 <= size <= 4 or at + size > end:
                return None
            length = int.from_bytes(head[2 : 2 + size], "big")
            if length < 0x80:  # DER has a shorter form for it
                return None
            at += size
        if at + length > end:
            return None
        found.append((tag, at, at + length))
        at += length
    return found


_INTEGER, _OCTETS, _OID, _SEQUENCE = 0x02, 0x04, 0x06, 0x30


def is_der_private_key(data: bytes | _Bytes) -> bool:
    """PKCS #1, PKCS #8, SEC 1 or DSA, by the types and nested lengths of its parts."""
    outer = _der(data, 0, len(data))
    if not outer or len(outer) != 1 or outer[0][0] != _SEQUENCE:
        return False
    parts = _der(data, *outer[0][1:])
    if not parts or parts[0][0] != _INTEGER or parts[0][2] - parts[0][1] > 16:
        return False
    tags = [tag for tag, _, _ in parts]
    first = int.from_bytes(data[parts[0][1] : parts[0][2]], "big")
    if first == 0 and len(tags) >= 6 and set(tags) == {_INTEGER}:
        return True
    if first <= 1 and tags[1:3] == [_SEQUENCE, _OCTETS]:
        algorithm = _der(data, *parts[1][1:])
        return bool(algorithm) and algorithm[0][0] == _OID
    if first == 1 and tags[1:2] == [_OCTETS] and parts[1][2] - parts[1][1] >= 16:
        return all(0xA0 <= tag <= 0xA1 and _der(data, s, e) for tag, s, e in parts[2:])
    return False


_OPENSSH = b"openssh-key-v1\0"


def is_openssh_key(data: bytes | _Bytes) -> bool:
    if data[: len(_OPENSSH)] != _OPENSSH:
        return False

    def field(at: int) -> int:
        return at + 4 + int.from_bytes(data[at : at + 4], "big") if at + 4 <= len(data) else -1

    at = len(_OPENSSH)
    for _ in range(3):  # cipher, key derivation, its options
        at = field(at)
        if not 0 <= at <= len(data):
            return False
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    if not 1 <= keys <= 16:
        return False
    for _ in range(keys + 1):  # public keys, and the private ones together
        at = field(at)
        if not 0 <= at <= len(data):
            return False
    return at == len(data)


def _is_key(data: bytes | _Bytes) -> bool:
    return is_der_private_key(data) or is_openssh_key(data)


def _from_base64(run: str) -> bytes | None:
    run = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(run) % 4 == 1:
        return None
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except binascii.Error:
        return None


def is_signed_token(run: str) -> bool:
    """Three parts, the first a JSON object that names an algorithm, the second an object."""
    parts = []
    for piece in run.split(".")[:2]:
        data = _from_base64(piece)
        try:
            parts.append(json.loads(data) if data else None)
        except (ValueError, RecursionError):
            return False
    return all(isinstance(p, dict) for p in parts) and isinstance(parts[0].get("alg"), str)


# --- Findings --------------------------------------------------------------------------

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end


def base_spans(text: str) -> list[Span]:
    """Findings of the three base patterns, leftmost and not overlapping per kind."""
    found = []
    low = text.lower()
    if any(word in low for word in _WORDS):
        found += [
            (m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGNED
        ]
    if "AKIA" in text:
        found += [
            (m.start(), 1, m.end())
            for m in ACCESS.finditer(text)
            if m.end() - m.start() >= ACCESS_LENGTH
        ]
    if _longest_run(np.frombuffer(text.encode(), dtype=np.uint8), _IN_HEX) >= HEX_LENGTH:
        found += [
            (m.start(), 2, m.end())
            for m in HEX.finditer(text)
            if m.end() - m.start() >= HEX_LENGTH
        ]
    return sorted(found)


def _plain(text: str) -> str:
    """The text with escapes as what they stand for, each in as many characters as it had."""
    if "\\" not in text:
        return text

    def written(m: re.Match) -> str:
        run = m[0]
        if run[-1] in "nrt":
            return "\n" * len(run)
        if run[-1] == "\\":
            return "\0" * len(run)
        sign = chr(int(run[-2:], 16))
        return "\n" * len(run) if sign in "\n\r" else "\0" * (len(run) - 1) + sign

    return _ESCAPE.sub(written, text)


@dataclass(frozen=True)
class _Code:
    """How bytes are written: where they may begin, in which pieces and gaps they go on."""

    start: re.Pattern
    piece: re.Pattern
    gap: re.Pattern
    end: re.Pattern
    bits: int

    def decoded(self, run: str) -> bytes:
        return (_from_base64(run) or b"") if self.bits == 6 else bytes.fromhex(run)

    def digits(self, size: int) -> int:
        return -(-size * 8 // self.bits)


class _Stretch:
    """Pieces and gaps that follow one another from a place on. Their digits are numbered through,
    so where bytes lie and end is found without reading those between."""

    def __init__(self, code: _Code, text: str, at: int) -> None:
        self.code, self.text = code, text
        self.starts, self.before = array("q"), array("q")
        self.digits = 0
        piece = code.piece.match(text, at)
        while piece:
            self.starts.append(piece.start())
            self.before.append(self.digits)
            self.end = piece.end()
            self.digits += self.end - piece.start()
            gap = code.gap.match(text, self.end)
            piece = gap and code.piece.match(text, gap.end())

    def number(self, at: int) -> int:
        """Digits before a place in a piece."""
        k = bisect_right(self.starts, at) - 1
        return self.before[k] + at - self.starts[k]

    def after(self, digits: int) -> int:
        """The place behind so many digits."""
        k = bisect_left(self.before, digits) - 1
        return self.starts[k] + digits - self.before[k]

    def read(self, first: int, last: int) -> str:
        """The digits from one number up to another."""
        k, parts = bisect_right(self.before, first) - 1, []
        while first < last:
            stop = self.before[k + 1] if k + 1 < len(self.before) else self.digits
            at = self.starts[k] - self.before[k]
            upto = min(last, stop)
            parts.append(self.text[at + first : at + upto])
            first, k = upto, k + 1
        return "".join(parts)


class _Bytes:
    """Bytes written in a stretch, decoded where they are looked at."""

    def __init__(self, stretch: _Stretch, first: int, size: int) -> None:
        self.stretch, self.first, self.size = stretch, first, size

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, part: slice) -> bytes:
        start, stop, _ = part.indices(self.size)
        code = self.stretch.code
        # Three bytes are four digits of base64, one byte is two of hex.
        octets, digits = (3, 4) if code.bits == 6 else (1, 2)
        group = start // octets
        last = min(-(-stop // octets) * digits, code.digits(self.size))
        run = self.stretch.read(self.first + group * digits, self.first + last)
        return code.decoded(run)[start - group * octets : stop - group * octets]


def key_end(stretch: _Stretch, at: int) -> int | None:
    """Where a key that begins at a place of the stretch ends, if one does.

    Looks at few bytes: where the key says that it ends, the stretch has to hold it and a piece
    to end; then the heads of its parts have to lead there."""
    code, text, first = stretch.code, stretch.text, stretch.number(at)
    size = _key_size(_Bytes(stretch, first, (stretch.digits - first) * code.bits // 8))
    if size is None or code.digits(size) < KEY_RUN or first + code.digits(size) > stretch.digits:
        return None
    end = stretch.after(first + code.digits(size))
    if not code.end.match(text, end) or not _is_key(_Bytes(stretch, first, size)):
        return None
    return _PADDING.match(text, end).end() if code.bits == 6 else end


_CODES = (
    _Code(_BASE64_START, _BASE64_PIECE, _GAP, _BASE64_END, 6),
    _Code(_HEX_START, _HEX_PIECE, _HEX_GAP, _HEX_END, 4),
)


def _key_size(data: _Bytes) -> int | None:
    """How many bytes a key has by what its first ones say."""
    head = data[:8]
    if len(head) < 8:
        return None
    if head[0] == _SEQUENCE:
        more = head[1] & 0x7F if head[1] >= 0x80 else 0
        if more > 4 or head[2 + more] != _INTEGER:
            return None
        return 2 + more + (int.from_bytes(head[2 : 2 + more], "big") if more else head[1])
    if head != _OPENSSH[:8]:
        return None

    def number(at: int) -> int | None:
        found = data[at : at + 4]
        return int.from_bytes(found, "big") if len(found) == 4 else None

    at = len(_OPENSSH)
    for _ in range(3):  # cipher, key derivation, its options
        if (length := number(at)) is None:
            return None
        at += 4 + length
    if (keys := number(at)) is None or not 1 <= keys <= 16:
        return None
    at += 4
    for _ in range(keys + 1):  # public keys, and the private ones together
        if (length := number(at)) is None:
            return None
        at += 4 + length
    return at


def _armoured(text: str) -> Iterator[tuple[int, int]]:
    """Starts and ends of armoured keys; an armour that another one interrupts is none."""
    begins = list(_BEGIN.finditer(text))
    for m, after in zip(begins, [*(n.start() for n in begins[1:]), len(text)]):
        close = f"-----END {m[1]}-----"
        end = text.find(close, m.end(), after)
        if end < 0:
            continue
        body = _GAP.sub(lambda g: g[0] if g[0].isspace() else "\n", text[m.end() : end])
        headers = " ".join(_HEADER.findall(body))
        data = _from_base64(re.sub(r"\s+", "", _HEADER.sub("", body)))
        # An encrypted key shows no structure; its armour says what it is.
        if data and (_is_key(data) or "ENCRYPTED" in m[1] or "ENCRYPTED" in headers):
            yield m.start(), end + len(close)


def confirmed_spans(text: str) -> list[Span]:
    """Findings whose decoded content is built like a key or a signed token.

    A key may be wrapped over lines, in quotes or with escaped line breaks, with or without
    armour; it is as long as its own lengths say, and its run ends there. The time is in
    proportion to the text, whatever lengths are claimed in it.
    """
    found, place = set(), KINDS.index("key")
    plain = _plain(text)
    if "-----BEGIN " in plain:
        found.update((start, place, end) for start, end in _armoured(plain))
    for code in _CODES:
        done, stretch = 0, None
        for m in code.start.finditer(plain):
            if m.start() < done:
                continue
            # No key begins in a gap, so every stretch is gone through once.
            if stretch is None or m.start() >= stretch.end:
                stretch = _Stretch(code, plain, m.start())
            if end := key_end(stretch, m.start()):
                found.add((m.start(), place, end))
                done = end
    if plain.count(".") > 1:
        for m in _DOTTED.finditer(plain):
            pieces, at, done = m[0].split("."), m.start(), 0
            for i, piece in enumerate(pieces[:-2]):
                if i >= done and is_signed_token(run := ".".join(pieces[i : i + 3])):
                    found.add((at, KINDS.index("signed_token"), at + len(run)))
                    done = i + 3
                at += len(piece) + 1
    return sorted(found)


def find_secrets(docs: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """``docs`` with an array of ``(kind, start, end, confirmed)``, by start, then kind.

    Offsets count code points, the end is exclusive. ``confirmed`` findings come from decoded
    structure, the others from the base patterns; findings of different kinds may overlap.
    Null and empty texts have none, and texts are read whole, in time proportional to them. Repeated rows are answered
    alike; a column of the name ``spans_col`` is replaced. An empty table gives an empty one.
    """
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("confirmed", pa.bool_())])
    )

    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for item in batch:
                text = item.as_py() or ""
                found = [(s, False) for s in base_spans(text)]
                found += [(s, True) for s in confirmed_spans(text)]
                rows.append([
                    {"kind": KINDS[place], "start": start, "end": end, "confirmed": confirmed}
                    for (start, place, end), confirmed in sorted(found)
                ])
            yield pa.array(rows, type=kind)

    answer = F.arrow_udf(
        spans, "array<struct<kind:string,start:long,end:long,confirmed:boolean>>"
    )
    kept = [c for c in docs.columns if c != spans_col]
    return docs.select(
        *(F.col(f"`{c}`") for c in kept),
        answer(F.col(text_col).cast("string")).alias(spans_col),
    )


def joined_spans(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def _without(text: str | None, spans) -> str | None:
    if text is None or spans is None or not len(spans):
        return text
    out, done = [], 0
    for span in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        start = max(span["start"], done)
        if span["end"] <= done:
            continue
        if span["start"] >= done:
            out += [text[done:start], f"[{span['kind']}]"]
        done = span["end"]
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """``docs`` with each finding's kind in brackets in its place; overlapping findings are
    one. Other characters, and texts without findings, stay as they are."""

    def replaced(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in batches:
            yield pa.array(
                [_without(t.as_py(), s.as_py()) for t, s in zip(texts, spans)], type=pa.string()
            )

    answer = F.arrow_udf(replaced, "string")
    text = F.col(text_col).cast("string")
    # Both sides of a condition are computed for all rows, so texts without findings stay behind by their own.
    some = F.size(spans_col) > 0
    cleaned = F.when(some, answer(F.when(some, text), F.col(spans_col))).otherwise(text)
    return docs.withColumn(text_col, cleaned)
