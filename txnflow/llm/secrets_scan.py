"""Secret scan: patterns first, then candidates confirmed by their decoded structure.

Assignments, access keys and long hex runs are found by pattern. Beyond them,
all base64 and hex runs, joined over line breaks (real, or written out as in
JSON), are decoded and reported only if the bytes, or those of an armoured key
found in them, hold together:
a private key in DER (every nested length fills its parent exactly and the
members are those of a key format), an OpenSSH key (length-prefixed strings to
the last byte), or a signed token whose header and payload are JSON objects
and name an algorithm.

Defined cases: NULL or empty text has no spans; texts of any length are
scanned whole; rows that repeat are scanned alike; other columns pass through.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnflow.llm.common import row_struct, whole_text

#: Kinds in their order; the first three are patterns, the others confirmed structures.
BASE_KINDS = ["assign", "access", "hex"]
KINDS = [*BASE_KINDS, "der", "openssh", "token"]

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?((?-i:[A-Za-z0-9+/_.=-]+))""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_BREAK = r"[\x20\t]*(?:(?:\\+[rn]|[\r\n])[\x20\t]*)+"  # real or written out
_ARMOUR = re.compile(
    r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----((?:[A-Za-z0-9+/=\s]|\\+[rnt])+)-----END [A-Z0-9 ]*PRIVATE KEY-----"
)


def _chain(alphabet: str, least: int, end: str = "") -> re.Pattern:
    """Runs of an alphabet over line breaks, from a line of at least so many characters on."""
    return re.compile(rf"(?:(?<=\\[rnt])|(?<![{alphabet}])(?!(?<=\\)[rnt]))[{alphabet}]{{{least},}}+(?:{_BREAK}[{alphabet}]++)*{end}")


_BASE64_CHAIN = _chain("A-Za-z0-9+/_-", 16, "={0,2}")
_HEX_CHAIN = _chain("0-9A-Fa-f", 32)
_BASE64_LINE, _HEX_LINE = (re.compile(rf"(?:\\+[rn]|\s)+|[{x}]+") for x in ("A-Za-z0-9+/_-", "0-9A-Fa-f"))
_WRITTEN = re.compile(r"\\+[rnt]")
_MAGIC = b"openssh-key-v1\x00"
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])e[wy][A-Za-z0-9_-]{8,}\.e[wy3][A-Za-z0-9_-]*\.[A-Za-z0-9_-]*")

_INT, _OCTETS, _OID, _SEQ = 0x02, 0x04, 0x06, 0x30
_MAX_DEPTH = 16


def decode_base64(text: str) -> bytes | None:
    """Either alphabet, with or without padding and line breaks."""
    plain = _WRITTEN.sub("", "".join(text.split())).rstrip("=").replace("-", "+").replace("_", "/")
    if len(plain) % 4 == 1:
        return None
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_members(data: bytes, depth: int = 0) -> list[tuple[int, object]] | None:
    """(tag, bytes or members) that fill ``data`` exactly, or None."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data) or data[at] & 0x1F == 0x1F:
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size >= 0x80:
            wide = size & 0x7F
            if not 1 <= wide <= 4 or at + wide > len(data) or data[at] == 0:
                return None
            size, at = int.from_bytes(data[at : at + wide], "big"), at + wide
            if size < 0x80:
                return None  # lengths are written the shortest way
        if at + size > len(data):
            return None
        value: object = data[at : at + size]
        if tag & 0x20:
            value = der_members(data[at : at + size], depth + 1) if depth < _MAX_DEPTH else None
            if value is None:
                return None
        elif tag in (_INT, _OID) and not size:
            return None
        out.append((tag, value))
        at += size
    return out


def is_private_key(data: bytes) -> bool:
    """One DER sequence with the members of a PKCS#1, DSA, SEC1 or (encrypted) PKCS#8 private key."""
    whole = der_members(data)
    if not whole or len(whole) != 1 or whole[0][0] != _SEQ:
        return False
    members = whole[0][1]
    tags = [t for t, _ in members]
    if len(tags) >= 2 and tags[0] == _SEQ and tags[1] == _OCTETS:
        return len(tags) == 2 and bool(members[0][1]) and members[0][1][0][0] == _OID
    if not tags or tags[0] != _INT or int.from_bytes(members[0][1], "big") > 1:
        return False
    if len(tags) in (6, 9) and all(t == _INT for t in tags):
        return True
    if len(tags) >= 2 and tags[1] == _OCTETS:
        return len(members[1][1]) >= 16 and all(t in (0xA0, 0xA1) for t in tags[2:])
    return len(tags) >= 3 and tags[1:3] == [_SEQ, _OCTETS] and bool(members[1][1]) and members[1][1][0][0] == _OID


def _openssh_size(data: bytes) -> int | None:
    """The magic, three strings, a key count, and as many public keys and one private part: where they end."""
    if not data.startswith(_MAGIC):
        return None
    at, strings, left = len(_MAGIC), 0, 3
    while left:
        if at + 4 > len(data):
            return None
        size = int.from_bytes(data[at : at + 4], "big")
        at += 4
        if strings == 3:  # the number of keys
            if not 1 <= size <= 64:
                return None
            left = size + 1
        else:
            at += size
            left -= 1
            if strings == 2:
                left = 1
        strings += 1
    return at


def is_openssh_key(data: bytes) -> bool:
    """The structure fills the data to the last byte."""
    return _openssh_size(data) == len(data)


def _der_size(data: bytes) -> int | None:
    """The length of the DER sequence that ``data`` begins with, by its header."""
    if len(data) < 2 or data[0] != _SEQ:
        return None
    if data[1] < 0x80:
        return 2 + data[1]
    wide = data[1] & 0x7F
    return 2 + wide + int.from_bytes(data[2 : 2 + wide], "big") if 1 <= wide <= 4 else None


def is_signed_token(text: str) -> bool:
    head, body, mark = text.split(".")
    try:
        head, body = (json.loads(decode_base64(p) or b"") for p in (head, body))
    except (ValueError, RecursionError):
        return False
    named = isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(body, dict)
    return named and (len(mark) >= 16 or head["alg"].lower() == "none")


def _kind_of(data: bytes | None) -> str | None:
    if data is None:
        return None
    return "der" if data[:1] == b"\x30" and is_private_key(data) else "openssh" if is_openssh_key(data) else None


def _armoured(text: str) -> list[tuple[str, int, int]]:
    """Armoured keys whose content holds together."""
    return [(kind, *m.span()) for m in _ARMOUR.finditer(text) if (kind := _kind_of(decode_base64(m[1])))]


def _unhex(text: str) -> bytes | None:
    return bytes.fromhex(text) if len(text) % 2 == 0 else None


def _in_chain(text: str, m: re.Match, line: re.Pattern, decode, size: int, bits: int) -> list[tuple[str, int, int]]:
    """Keys in a run over lines: each from the start of a line to the end of one.

    ``size`` characters hold ``size * bits / 8`` whole bytes. A key says in its
    header where it ends, so lines of text before and after it do no harm.
    """
    lines = [x.span() for x in line.finditer(text, *m.span()) if not (x[0][0].isspace() or x[0][0] == "\\")]
    plain = "".join(text[a:b] for a, b in lines)
    ends, n = {}, 0  # characters up to a line's end: its number
    starts = []
    for i, (a, b) in enumerate(lines):
        starts.append(n)
        n += b - a
        ends[n] = i
    found = []
    free = 0
    for i, at in enumerate(starts):
        if i < free:
            continue
        head = decode(plain[at : at + 6 * size]) or b""
        whole = _der_size(head)
        if whole is None and _MAGIC.startswith(head[:15]) and len(head) >= 3:
            rest = n - at
            whole = _openssh_size(decode(plain[at : n - (rest % size == 1)]) or b"")
        last = ends.get(at - (-8 * whole // bits)) if whole else None
        if last is not None and (kind := _kind_of(decode(plain[at : at - (-8 * whole // bits)]))):
            found.append((kind, lines[i][0], m.end() if last == len(lines) - 1 else lines[last][1]))
            free = last + 1
    for skip in range(size):  # an armoured key inside; lines before it shift the decoding by less than a group
        length = (n - skip) // size * size + (n - skip) % size * (size == 4 and (n - skip) % size > 1)
        inner = decode(plain[skip : skip + length]) or b""
        if b"-----BEGIN" in inner:
            for kind, a, b in _armoured(inner.decode("latin-1")):
                i = bisect_right(starts, skip + 8 * a // bits) - 1
                j = bisect_right(starts, skip + (8 * b - 1) // bits) - 1
                found.append((kind, lines[i][0], m.end() if j == len(lines) - 1 else lines[j][1]))
    return found


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind."""
    found = []
    if ":" in text or "=" in text:
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    armoured = _armoured(text) if "-----BEGIN" in text else []
    keys = []
    for m in _BASE64_CHAIN.finditer(text):
        keys += _in_chain(text, m, _BASE64_LINE, decode_base64, 4, 6)
    for m in _HEX_CHAIN.finditer(text):
        keys += _in_chain(text, m, _HEX_LINE, _unhex, 2, 4)
    found += armoured
    found += sorted({k for k in keys if not any(a <= k[1] < b for _, a, b in armoured)})
    if "." in text and ("ey" in text or "ew" in text):
        found += [("token", *m.span()) for m in _TOKEN.finditer(text) if is_signed_token(m[0])]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with the column secrets: array of (kind, start, end)."""
    keep = [c for c in docs.columns if c != "secrets"]
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                [{"kind": k, "start": a, "end": b} for k, a, b in spans_of(text.as_py())] for text in batch.column("text")
            ]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(rows, pa.list_(kind))], ["row", "secrets"])

    source = docs.select(row_struct(keep).alias("row"), whole_text(docs).alias("text"))
    made = T.StructType.fromDDL("secrets array<struct<kind: string, start: bigint, end: bigint>>")
    return source.mapInArrow(task, T.StructType([source.schema["row"], *made.fields])).select("row.*", "secrets")


def span_list(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
