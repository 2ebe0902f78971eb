"""Finds secrets in texts: patterns first, then decoding what could be a key or a signed token and reading its structure."""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: In the order in which spans that begin together are listed.
KINDS = ("assign", "access", "hex", "key", "jwt")

_ASSIGN = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
#: Where base64 of a key may begin, with a sequence (0x30) of some length or with OpenSSH's mark. The letter of an escaped line feed may stand before it.
_BEGIN = re.compile(r"(?:(?<![A-Za-z0-9+/_-])|(?<=\\[nrt]))(?:M|b3BlbnNzaC1rZXktdjE)(?=(?:[A-Za-z0-9+/_-]|\\+/){24})")
#: Base64 of either alphabet in lines, slashes escaped or not. Between lines there are line feeds, escaped (once or more) or not, with indentation, quotes and commas of literals.
_GAP = r"""(?:[\x20\t"',]|\\+["'t])*(?:\r?\n|\r|\\+[rn])(?:[\x20\t\r\n"',]|\\+[rnt"'])*"""
_RUN = r"(?:[A-Za-z0-9+/_-]++|\\+/)++"
_BODY = re.compile(rf"{_RUN}(?:{_GAP}{_RUN})*+")
_BETWEEN = re.compile(rf"{_GAP}|\\+(?=/)")
_GOES_ON = re.compile(r"[A-Za-z0-9+/_-]|\\+/")
_PADDING = re.compile(r"(?:=|\\+u003[dD]){0,2}")
_LONG_HEX = re.compile(r"(?<![0-9A-Fa-f])(?:30|6[Ff]70656[Ee]7373682[Dd]6[Bb]65792[Dd]7631)[0-9A-Fa-f]{46,}(?![0-9A-Fa-f])")
_SIGNED = re.compile(r"(?<![A-Za-z0-9_-])(e[wy][A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
#: Tags of the values that a private key is made of: integer, bit string, octet string, null, object identifier, sequence, set, a public key beside the private one; explicit fields from 0xA0 on.
_INTEGER, _OCTETS, _OBJECT, _SEQUENCE, _CONSTRUCTED = 0x02, 0x04, 0x06, 0x30, 0x20
_TAGS = {0x02, 0x03, 0x04, 0x05, 0x06, 0x30, 0x31, 0x81}
#: Identifiers of encryption by password begin so (PKCS#5, PKCS#12). A digest's encoding is a sequence and octets too, with other identifiers.
_BY_PASSWORD = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
_OPENSSH = b"openssh-key-v1\0"
_DEPTH = 16
#: Elements of a key, and keys in a file of OpenSSH, at most: real ones have some twenty, and one. So a place where no key begins is left after few headers, however long it says it is.
_ELEMENTS, _KEYS = 512, 64


#: n bytes, or as many as there are, from a place on.
Read = Callable[[int, int], bytes]


def _elements(read: Read, at: int, end: int, left: list[int], depth: int = 0) -> list[tuple[int, int, int]] | None:
    """Tag, start and end of the content of every element between two places, if the lengths of all of them, nested ones too, come out even. Only headers are read."""
    out = []
    while at < end:
        left[0] -= 1
        head = read(at, min(6, end - at))
        if left[0] < 0 or len(head) < 2:
            return None
        tag, n = head[0], head[1]
        at += 2
        if n > 0x84 or n == 0x80:
            return None
        if n > 0x80:
            size = n - 0x80
            if 2 + size > len(head):
                return None
            n, at = int.from_bytes(head[2 : 2 + size], "big"), at + size
        if at + n > end or not (tag in _TAGS or 0xA0 <= tag <= 0xA3):
            return None
        if tag & _CONSTRUCTED and (depth >= _DEPTH or _elements(read, at, at + n, left, depth + 1) is None):
            return None
        out.append((tag, at, at + n))
        at += n
    return out


def _is_private_key(read: Read, size: int) -> bool:
    left = [_ELEMENTS]
    outer = _elements(read, 0, size, left)
    if not outer or len(outer) != 1 or outer[0][0] != _SEQUENCE:
        return False
    fields = _elements(read, *outer[0][1:], [_ELEMENTS])
    if not fields or len(fields) < 2:
        return False
    tags = [t for t, _, _ in fields]
    if tags == [_SEQUENCE, _OCTETS]:
        how = _elements(read, *fields[0][1:], [_ELEMENTS])
        if [t for t, _, _ in how] != [_OBJECT, _SEQUENCE]:
            return False
        _, start, end = how[0]
        return read(start, min(16, end - start)).startswith(_BY_PASSWORD)
    _, start, end = fields[0]
    if tags[0] != _INTEGER or end - start != 1 or read(start, 1) not in (b"\0", b"\1"):
        return False
    return tags[1:3] == [_SEQUENCE, _OCTETS] or tags[1] == _OCTETS or (len(tags) >= 6 and all(t == _INTEGER for t in tags[:6]))


def is_private_key(data: bytes) -> bool:
    """One sequence that fills the data: a small version, then an algorithm and octets, or octets, or at least five more integers; or an encryption by password and octets.

    A key has _ELEMENTS elements at most, those inside others included.
    """
    return _is_private_key(lambda at, n: data[at : at + n], len(data))


def _openssh_size(read: Read) -> int:
    """Bytes of the OpenSSH private key that begins where read(place, n) counts from; 0 if there is none. Of a key that is not encrypted the inner marks have to agree too."""

    def string(at: int) -> tuple[int, int]:
        """Place and length of what a 32-bit length stands before; it has to be there to its end."""
        head = read(at, 4)
        n = int.from_bytes(head, "big")
        if len(head) < 4 or (n and not read(at + 3 + n, 1)):
            raise ValueError(at)
        return at + 4, n

    if read(0, len(_OPENSSH)) != _OPENSSH:
        return 0
    try:
        at, names = len(_OPENSSH), []
        for _ in range(3):  # cipher, derivation of its key, options of that
            at, n = string(at)
            names.append(read(at, n) if n <= 64 else b"")
            at += n
        keys, kinds = int.from_bytes(read(at, 4), "big"), []
        at += 4
        if keys > _KEYS:
            return 0
        for _ in range(keys):
            start, n = string(at)
            kind, size = string(start)
            if not size or size > 64 or size + 4 > n:
                return 0
            kinds.append(read(kind, size))
            at = start + n
        start, n = string(at)
        if not kinds or not names[0] or not names[1] or not n or n % 8:
            return 0
        if names[0] == b"none":
            kind, size = string(start + 8)
            if read(start, 4) != read(start + 4, 4) or size != len(kinds[0]) or read(kind, size) != kinds[0]:
                return 0
        return start + n
    except ValueError:
        return 0


_PLAIN = str.maketrans("-_", "+/")


def _decoded(text: str) -> bytes:
    plain = text.rstrip("=").translate(_PLAIN)
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


def _sequence_size(data: bytes) -> int:
    """Bytes of the element that data begins with, header included; 0 if that is no sequence."""
    if len(data) < 6 or data[0] != _SEQUENCE:
        return 0
    if data[1] < 0x80:
        return 2 + data[1]
    more = data[1] - 0x80
    return 2 + more + int.from_bytes(data[2 : 2 + more], "big") if 1 <= more <= 4 else 0


class _Body:
    """The base64 text from a place on, without what stands between its lines."""

    def __init__(self, text: str, at: int) -> None:
        self.text, self.end = text, _BODY.match(text, at).end()
        self.starts, self.firsts, parts, n = [], [], [], 0  # of each piece: place in the text, number of its first symbol
        for gap in (*_BETWEEN.finditer(text, at, self.end), None):
            to = gap.start() if gap else self.end
            if to > at:
                self.starts.append(at)
                self.firsts.append(n)
                parts.append(text[at:to])
                n += to - at
            at = gap.end() if gap else to
        self.symbols = "".join(parts).translate(_PLAIN)

    def number(self, place: int) -> int:
        """Of the symbol at a place of the text."""
        k = bisect_right(self.starts, place) - 1
        return self.firsts[k] + place - self.starts[k]

    def after(self, number: int) -> int:
        """The place after a symbol."""
        k = bisect_right(self.firsts, number) - 1
        return self.starts[k] + number - self.firsts[k] + 1

    def read(self, first: int, at: int, n: int) -> bytes:
        """n bytes, or as many as there are, from byte `at` on of what begins at symbol `first`."""
        lo, hi = at // 3, -(-(at + n) // 3)
        return _decoded(self.symbols[first + 4 * lo : first + 4 * hi])[at - 3 * lo :][:n]


def _key_size(body: _Body, first: int) -> int:
    """Bytes of the private key that begins at a symbol; 0 if there is none."""
    head = body.read(first, 0, 16)
    size = _sequence_size(head)
    if not size:
        return _openssh_size(lambda at, n: body.read(first, at, n))
    inner = 2 if head[1] < 0x80 else 2 + head[1] - 0x80
    if head[inner] not in (_INTEGER, _SEQUENCE) or first - (-4 * size // 3) > len(body.symbols):
        return 0
    return size if _is_private_key(lambda at, n: body.read(first, at, n), size) else 0


def _keys(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of private keys in base64. The encoding tells where one ends; what follows may be other text, from a new line on."""
    body, done = None, 0
    for m in _BEGIN.finditer(text):
        if m.start() < done:
            continue
        if body is None or m.start() >= body.end:
            body = _Body(text, m.start())
        first = body.number(m.start())
        size = _key_size(body, first)
        if not size:
            continue
        end = body.after(first - (-4 * size // 3) - 1)
        if not _GOES_ON.match(text, end):
            done = _PADDING.match(text, end).end()
            yield m.start(), done


def _is_key(data: bytes) -> bool:
    return is_private_key(data) or _openssh_size(lambda at, n: data[at : at + n]) == len(data)


def is_signed_token(header: str, payload: str) -> bool:
    """A JSON header that names its algorithm, and a JSON payload."""
    try:
        first, second = json.loads(_decoded(header)), json.loads(_decoded(payload))
    except (ValueError, RecursionError):
        return False
    return isinstance(first, dict) and isinstance(first.get("alg"), str) and isinstance(second, dict)


def spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, in order of start, then kind. Spans of different kinds may overlap."""
    out = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    out += [(start, end, "key") for start, end in _keys(text)]
    out += [(m.start(), m.end(), "key") for m in _LONG_HEX.finditer(text) if len(m[0]) % 2 == 0 and _is_key(bytes.fromhex(m[0]))]
    out += [(m.start(), m.end(), "jwt") for m in _SIGNED.finditer(text) if is_signed_token(m[1], m[2])]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _listed(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def masked(text: str, found: list[tuple[int, int, str]], mark: str) -> str:
    """text with every maximal covered run replaced by the mark."""
    out, at = [], 0
    for start, end, _ in found:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for value in batch.column("text"):
            found = spans(value.as_py() or "")
            base = [s for s in found if s[2] in KINDS[:3]]
            counts = [sum(kind == k for _, _, kind in base) for k in KINDS[:3]]
            rows.append((*counts, hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(found)))
        columns = list(zip(*rows)) if rows else [()] * 5
        types = [pa.int64()] * 3 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types))], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
        )


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end, comma-joined, in code points).

    The base kinds go by pattern alone. A `key` is base64 or hex that decodes to a private key's encoding, all nested lengths included: PKCS#1, SEC1, DSA, PKCS#8, encrypted
    PKCS#8 and OpenSSH, in lines or not, indented, with escaped line feeds or in string literals. Not taken are keys whose text has no such structure or another one: PEM bodies
    encrypted the old way (Proc-Type), PKCS#12, PGP, PuTTY, JWK, and lines with other marks before them (comments, quoted mail). A `jwt` is a signed token whose
    header and payload decode to JSON objects, with an algorithm in the header. A null or empty text has no spans; nothing else of a row matters; an empty
    table gives no rows.
    """
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scanned, schema)


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """docs, all columns, with every run of text that spans cover replaced by the mark, and n_chars (if there) counted anew. A null text stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if (t := v.as_py()) is None else masked(t, spans(t), mark) for v in batch.column("text")]
            columns = {name: batch.column(name) for name in batch.schema.names}
            columns["text"] = pa.array(texts, batch.schema.field("text").type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" not in docs.columns:
        return out
    counted = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", F.when(F.col("text").isNotNull(), counted).otherwise(F.col("n_chars")))
