"""Secret scans with structural confirmation.

Plain patterns give the base spans. Base64, hex and dotted candidates are
reported beyond that only if they decode and parse: DER key encodings whose
nested lengths add up, SSH key blobs field by field, armoured key blocks, and
signed tokens whose header and body are JSON and name an algorithm. Encodings may
run over line breaks, real or escaped as in JSON, and hex may be of either case.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.llm.common import map_batches

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "armour", "der", "ssh", "token")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_BLOB = re.compile(r"[A-Za-z0-9+/_-]{24,}={0,2}")
_ANY_HEX = re.compile(r"[0-9A-Fa-f]{24,}")
# a run may stand after an escaped line break, whose letter is no part of it
_EDGE = r"(?:(?<![A-Za-z0-9_-])|(?<=\\[nrt]))"
_TOKEN = re.compile(_EDGE + r"(?=([A-Za-z0-9_-]{14,}\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*))")
_BEGIN = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----")
_ESCAPED = re.compile(r"\\+(?:u00([0-9A-Fa-f]{2})|([nrt/]))")
_HEADERS = re.compile(r"\s*((?:[A-Za-z][A-Za-z-]*:[^\n]*(?:\n[ \t][^\n]*)*\n\s*)+)")
_CIPHER = re.compile(r"DEK-Info:\s*[A-Za-z0-9-]+,\s*([0-9A-Fa-f]{16,32})\s*(?:\n|$)")
# how an encoding begins: a DER sequence, SSH fields, the private container
_START = re.compile(r"(?:(?<![A-Za-z0-9+/=_-])|(?<=\\[nrt]))(?=M[B-I]|AAAA|b3BlbnNzaC1r)[A-Za-z0-9+/_-]{8}")
_HEX_START = re.compile(r"(?<![0-9A-Fa-f])(?=30|000000|6[Ff]70656[Ee])[0-9A-Fa-f]{8}")
_BREAK = r"[ \t]*(?:\r\n|\n|\r|\\+[nr])(?:\s|\\+[nrt])*"
_LINES = re.compile(rf"[A-Za-z0-9+/_-]+(?:{_BREAK}[A-Za-z0-9+/_-]+)*")
_HEX_LINES = re.compile(rf"[0-9A-Fa-f]+(?:{_BREAK}[0-9A-Fa-f]+)*")
_GAP = re.compile(_BREAK)
_PAD = re.compile(r"={0,2}")
_FIELDS = {b"ssh-rsa": 3, b"ssh-dss": 5, b"ssh-ed25519": 2, b"sk-ssh-ed25519@openssh.com": 3,
           b"sk-ecdsa-sha2-nistp256@openssh.com": 4}
_CONTAINER = b"openssh-key-v1\x00"
PARTS = 32  # values or fields on one level of a key, at most


def _decoded(text: str) -> bytes | None:
    """Bytes of a base64 string in either alphabet, padded or not."""
    plain = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(plain) % 4 == 1:
        return None
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes | _View, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the values that fill ``data[start:end]`` exactly, else None. No
    key has more than ``PARTS`` values at one level; a longer list is none, and is not read on."""
    items = []
    while start < end:
        if start + 2 > end or len(items) == PARTS:
            return None
        tag, length, at = data[start], data[start + 1], start + 2
        if length >= 0x80:
            n = length & 0x7F
            if not 1 <= n <= 4 or at + n > end or data[at] == 0:
                return None
            length, at = int.from_bytes(data[at : at + n], "big"), at + n
        if at + length > end:
            return None
        items.append((tag, at, at + length))
        start = at + length
    return items


def is_key_der(data: bytes | _View) -> bool:
    """A DER sequence that holds a key: numbers only (RSA, DSA), a version with
    an algorithm or an octet string (PKCS 8, EC), an algorithm with a bit string, or
    one with parameters and an octet string (encrypted PKCS 8; a digest has none)."""
    top = der_items(data, 0, len(data))
    if not top or len(top) != 1 or top[0][0] != 0x30:
        return False
    parts = der_items(data, *top[0][1:])
    if not parts:
        return False
    nested = [der_items(data, a, b) for tag, a, b in parts if tag & 0x20]
    if any(not n for n in nested):
        return False
    tags = [tag for tag, _, _ in parts]
    names = [n[0][0] for n in nested]
    if set(tags) == {0x02}:
        return len(tags) >= 2 and max(b - a for _, a, b in parts) >= 16
    if tags[0] == 0x02:
        return 0x04 in tags and (0x06 in names or len(tags) >= 2 and tags[1] == 0x04)
    if tags == [0x30, 0x04]:
        return [tag for tag, _, _ in nested[0]] == [0x06, 0x30] and parts[1][2] - parts[1][1] >= 8
    return tags == [0x30, 0x03] and names == [0x06]


def _fields(data: bytes | _View, at: int, count: int | None = None) -> tuple[list[tuple[int, int]], int] | None:
    """Fields of a four-byte length each from ``at``, as (start, end), to the end or as many as
    ``count``, and where they end; None if one does not fit, or if there are more than any key has."""
    fields = []
    while at < len(data) if count is None else len(fields) < count:
        length = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + length > len(data) or count is None and len(fields) == PARTS:
            return None
        fields.append((at + 4, at + 4 + length))
        at += 4 + length
    return fields, at


def container_end(data: bytes | _View) -> int | None:
    """Where the private container ends: cipher, kdf and its options, the count of
    keys, a public blob each and one private part; None if it is none."""
    start = _fields(data, len(_CONTAINER), 3) if data[: len(_CONTAINER)] == _CONTAINER else None
    if not start or any(a == b for a, b in start[0][:2]):
        return None
    keys = int.from_bytes(data[start[1] : start[1] + 4], "big")
    if not 1 <= keys <= PARTS:
        return None
    rest = _fields(data, start[1] + 4, keys + 1)
    if not rest or rest[0][-1][0] == rest[0][-1][1]:
        return None
    return rest[1] if all(is_ssh_blob(data[a:b]) for a, b in rest[0][:-1]) else None


def _key_kind(data: bytes | _View) -> bytes | None:
    """The first field, if it names a kind of key."""
    first = _fields(data, 0, 1)
    if not first or not 4 < first[1] <= 68:
        return None
    name = data[4 : first[1]]
    return name if re.fullmatch(rb"(ssh|ecdsa|sk)-[a-z0-9@.-]+", name) else None


def is_ssh_blob(data: bytes | _View) -> bool:
    """Fields of a four-byte length each that fill the blob, the first a key kind;
    or the private container, its fields read to the end."""
    if data[: len(_CONTAINER)] == _CONTAINER:
        return container_end(data) == len(data)
    if not _key_kind(data):
        return False
    found = _fields(data, 0)
    return bool(found) and len(found[0]) >= 2


def is_token(text: str) -> bool:
    """A signed token: header and body decode to JSON objects, the header names its algorithm."""
    head, body, _ = text.split(".")
    try:
        header, claims = json.loads(_decoded(head) or b""), json.loads(_decoded(body) or b"")
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(claims, dict)


def _kind_of(data: bytes | _View | None) -> str | None:
    if data is None or len(data) < 16:
        return None
    return "der" if is_key_der(data) else "ssh" if is_ssh_blob(data) else None


def _length(data: bytes | _View) -> int | None:
    """Bytes of the encoding that ``data`` begins with, by its own lengths."""
    if data[:1] == b"\x30" and len(data) > 1:
        n = data[1] & 0x7F if data[1] & 0x80 else 0
        return 2 + n + (int.from_bytes(data[2 : 2 + n], "big") if n else data[1]) if n <= 4 else None
    if data[: len(_CONTAINER)] == _CONTAINER:
        return container_end(data)
    kind = _key_kind(data)
    if not kind:
        return None
    found = _fields(data, 0, _FIELDS.get(kind, 3 if kind.startswith(b"ecdsa-") else None))
    return found[1] if found else None


class _View:
    """Bytes encoded in ``plain`` from a place on, decoded where they are looked at only."""

    def __init__(self, plain: str, place: int, hexes: bool, size: int | None = None):
        self._plain, self._place, self._hexes = plain, place, hexes
        left = len(plain) - place
        self._size = (left // 2 if hexes else left * 3 // 4) if size is None else size

    def __len__(self) -> int:
        return self._size

    def first(self, size: int) -> _View:
        return _View(self._plain, self._place, self._hexes, size)

    def __getitem__(self, at: int | slice) -> int | bytes:
        if isinstance(at, int):
            return self[at : at + 1][0]
        a, b, _ = at.indices(self._size)
        if a >= b:
            return b""
        if self._hexes:
            return bytes.fromhex(self._plain[self._place + 2 * a : self._place + 2 * b])
        group = a // 3
        text = self._plain[self._place + 4 * group : self._place + 4 * -(-b // 3)].replace("-", "+").replace("_", "/")
        return binascii.a2b_base64(text + "=" * (-len(text) % 4))[a - 3 * group : b - 3 * group]


class _Block:
    """A stretch of encoding over line breaks, as one string, and its lines."""

    def __init__(self, text: str, start: int, hexes: bool):
        self.end = (_HEX_LINES if hexes else _LINES).match(text, start).end()
        at, self._starts, lines = start, [], []
        for gap in _GAP.finditer(text, start, self.end):
            self._starts.append(at)
            lines.append(text[at : gap.start()])
            at = gap.end()
        self._starts.append(at)
        lines.append(text[at : self.end])
        self.plain = "".join(lines)
        self._upto = [0]
        for line in lines:
            self._upto.append(self._upto[-1] + len(line))

    def place(self, at: int) -> int:
        """Where a place of the text is in the one string."""
        line = bisect.bisect_right(self._starts, at) - 1
        return self._upto[line] + at - self._starts[line]

    def line_end(self, place: int) -> int | None:
        """The place in the text, if a line ends there."""
        line = bisect.bisect_left(self._upto, place)
        if line == 0 or line == len(self._upto) or self._upto[line] != place:
            return None
        return self._starts[line - 1] + place - self._upto[line - 1]


def _wrapped(text: str, hexes: bool) -> list[tuple[str, int, int]]:
    """Keys in base64 or hex that runs over real or escaped line breaks. The
    encoding's own length says where it ends, which must be the end of a line.

    A stretch is put together once, for all the places in it where an encoding may
    begin; of each only the bytes that say kind and lengths are decoded."""
    found, past, block = [], 0, None
    for m in (_HEX_START if hexes else _START).finditer(text):
        a = m.start()
        if a < past:
            continue
        if block is None or a >= block.end:
            block = _Block(text, a, hexes)
        place = block.place(a)
        view = _View(block.plain, place, hexes)
        size = _length(view)
        if size is None or size > len(view):
            continue
        end = block.line_end(place + (2 * size if hexes else -(-4 * size // 3)))
        kind = _kind_of(view.first(size)) if end is not None else None
        if kind:
            past = end if hexes else _PAD.match(text, end).end()
            found.append((kind, a, past))
    return found


def _armoured(text: str) -> list[tuple[str, int, int]]:
    """Private key blocks whose body, headers apart, decodes to a key. A body that
    its headers call encrypted parses as nothing; it must fill the cipher's blocks."""
    found, begins = [], list(_BEGIN.finditer(text))
    for m, after in zip(begins, [*(n.start() for n in begins[1:]), len(text)]):
        close = f"-----END {m[1]}-----"
        at = text.find(close, m.end(), after)
        if at < 0:
            continue
        body = _ESCAPED.sub(lambda e: chr(int(e[1], 16)) if e[1] else {"n": "\n", "r": "\r", "t": "\t", "/": "/"}[e[2]], text[m.end() : at])
        body = body.replace("\r\n", "\n").replace("\r", "\n")
        headers = _HEADERS.match(body)
        data = _decoded(re.sub(r"\s+", "", body[headers.end() if headers else 0 :]))
        if not data:
            continue
        cipher = _CIPHER.search(headers[1]) if headers and "ENCRYPTED" in headers[1] else None
        filled = cipher and len(data) >= 16 and len(data) % (len(cipher[1]) // 2) == 0
        if filled or is_key_der(data) or is_ssh_blob(data):
            found.append(("armour", m.start(), at + len(close)))
    return found


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then in the order of ``KINDS``."""
    if not text:
        return []
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        # a short value is dropped after matching: what it used up stays used up
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    if "-----BEGIN " in text:
        found += _armoured(text)
    past = 0
    for m in _TOKEN.finditer(text) if "." in text else ():
        if m.start() >= past and is_token(m[1]):
            past = m.end(1)
            found.append(("token", *m.span(1)))
    for m in _BLOB.finditer(text):  # a hex run of 24 or more lies in such a run
        for h in _HEX.finditer(text, *m.span()):
            found.append(("hex", *h.span()))
        for h in [*_HEX.finditer(text, *m.span()), *_ANY_HEX.finditer(text, *m.span())]:
            kind = _kind_of(bytes.fromhex(h[0])) if len(h[0]) % 2 == 0 else None
            if kind:
                found.append((kind, *h.span()))
        kind = _kind_of(_decoded(m[0]))
        if kind:
            found.append((kind, *m.span()))
    found += _wrapped(text, False) + _wrapped(text, True)
    return sorted(set(found), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def redact(text: str | None, spans: list[tuple[str, int, int]], mask: str = "[SECRET]") -> str | None:
    """The text with every span, overlapping ones together, replaced by a mask."""
    if not spans:
        return text
    parts, at, end = [], 0, -1
    for _, a, b in spans:
        if a >= end:
            parts += [text[at:a], mask]
        end = max(end, b)
        at = end
    return "".join([*parts, text[at:]])


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans array of (kind, start, end), redacted text) of every row.

    A null text is an empty one and stays null in ``redacted``; a null key stays
    null; repeated rows are scanned each; an empty table gives no rows; other
    columns are left out. One narrow pass over whole texts, no shuffle.
    """
    kind = docs.schema[key].dataType.simpleString()

    def make():
        def work(batch):
            texts = batch.column(1).to_pylist()
            found = [scan(t) for t in texts]
            return {
                "key": batch.column(0),
                "spans": [[dict(zip(("kind", "start", "end"), s)) for s in spans] for spans in found],
                "redacted": [redact(t, s) for t, s in zip(texts, found)],
            }

        return work

    schema = f"key {kind}, spans array<struct<kind: string, start: int, end: int>>, redacted string"
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return map_batches(rows, schema, make).withColumnRenamed("key", key)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the digest of the base spans and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    n = [F.size(F.filter("spans", _is(k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select(key, *n,
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def _is(kind: str):
    return lambda s: s["kind"] == kind
