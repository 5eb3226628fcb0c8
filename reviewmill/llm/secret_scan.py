"""Secret scan with structural confirmation.

Assignments, access keys and long hex runs are reported as they stand.  Runs of base64 and hex letters are
candidates for encoded keys, also when wrapped over lines of one length: each is decoded, and reported only if the
bytes have a key's structure - ASN.1 lengths that nest exactly with the fields of a private or public key, down to the
key inside a wrapped one, the length-prefixed fields of an SSH key or of its private format, or a signed token whose
header parses and names an algorithm.  Of a key encrypted by a pass phrase the envelope is confirmed.

Kinds: assign, access, hex; pem, der, ssh, jwt.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from reviewmill.llm.shared import sliced

# The base patterns, and the fewest characters that count.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
FEWEST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ["assign", "access", "hex", "pem", "der", "ssh", "jwt"]

LONG_HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs, so the same as HEX with the short ones dropped
ENCODED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
ENCODED_HEX = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){32,}(?![0-9A-Fa-f])")
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
# Lines of base64 below one another, and the first of them.
WRAPPED = re.compile(r"[A-Za-z0-9+/_-]++(?:\r?\n[\x20\t]*+[A-Za-z0-9+/_-]++)++={0,2}")
LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
FEWEST_IN_LINE = 40
# Label, header lines and body; line breaks may be written out as backslash and letter.
ARMOR = re.compile(
    r"-----BEGIN ([A-Z0-9 ]{0,40})-----(?:\s|\\[nr])*+"
    r"((?:[A-Za-z][A-Za-z0-9-]*+:[^\n\\]*+(?:\n|\\n)(?:\s|\\[nr])*+)*+)([A-Za-z0-9+/=\s\\]*+)-----END \1-----"
)
# Headers of a body that is encrypted as a whole: cipher and start vector.
ENCRYPTED = re.compile(r"Proc-Type:\s*4,ENCRYPTED\b.*DEK-Info:\s*[A-Z0-9-]+,(?:[0-9A-Fa-f]{16}){1,2}\b", re.S)
# Object identifiers of RSA keys, and the heads of those of encryption by a pass phrase.
RSA = bytes.fromhex("2a864886f70d010101")
BY_PASS_PHRASE = bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01")


def decoded(run: str) -> bytes | None:
    """Bytes of base64 text in either alphabet, padded or not; None if no whole bytes come out."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except binascii.Error:
        return None


def element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the ASN.1 element at ``at``, if its length is in shortest form and fits."""
    if at + 2 > end:
        return None
    tag, length, start = data[at], data[at + 1], at + 2
    if length & 0x80:
        size = length & 0x7F
        if not 1 <= size <= 4 or start + size > end:
            return None
        length = int.from_bytes(data[start : start + size], "big")
        if length < 0x80 or data[start] == 0:
            return None
        start += size
    return (tag, start, start + length) if start + length <= end else None


def elements(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill the range without a gap."""
    found = []
    while at < end:
        one = element(data, at, end)
        if one is None:
            return None
        found.append(one)
        at = one[2]
    return found


def fields_of(data: bytes) -> tuple[list[int], list[bytes]]:
    """Tags and contents of the elements in a sequence that fills the data; none if there is no such sequence."""
    outer = element(data, 0, len(data))
    if outer is None or outer[0] != 0x30 or outer[2] != len(data):
        return [], []
    found = elements(data, outer[1], outer[2]) or []
    return [tag for tag, _, _ in found], [data[start:end] for _, start, end in found]


def is_integers_key(tags: list[int], parts: list[bytes]) -> bool:
    """PKCS#1, public (2 integers) or private (9), or a DSA private key (6): private ones begin with a version."""
    if set(tags) != {0x02} or max(map(len, parts)) < 32:
        return False
    return len(parts) == 2 or (len(parts) in (6, 9) and parts[0] == b"\0")


def is_curve_key(tags: list[int], parts: list[bytes]) -> bool:
    """SEC1: version 1 and the secret number."""
    return tags[:2] == [0x02, 0x04] and parts[0] == b"\x01" and len(parts[1]) >= 16


def is_bare_key(data: bytes) -> bool:
    """What a wrapped private key holds: a PKCS#1 or SEC1 key, one integer, or one string of bytes."""
    one = element(data, 0, len(data))
    if one is None or one[2] != len(data):
        return False
    if one[0] in (0x02, 0x04):
        return one[2] - one[1] >= 16
    tags, parts = fields_of(data)
    return bool(tags) and (is_integers_key(tags, parts) or is_curve_key(tags, parts))


def is_der_key(data: bytes) -> bool:
    """PKCS#1, SEC1, DSA, PKCS#8 (plain or encrypted) or a public key record: a sequence that fills the data, with a key's
    fields, and inside a wrapped private key again a key."""
    tags, parts = fields_of(data)
    if len(tags) < 2:
        return False
    if is_integers_key(tags, parts) or is_curve_key(tags, parts):
        return True
    wrapped = tags[:3] == [0x02, 0x30, 0x04]
    if not wrapped and tags not in ([0x30, 0x03], [0x30, 0x04]):
        return False
    algorithm, content = (parts[1], parts[2]) if wrapped else (parts[0], parts[1])
    inner = elements(algorithm, 0, len(algorithm))
    if not inner or inner[0][0] != 0x06:
        return False
    name = algorithm[inner[0][1] : inner[0][2]]
    if wrapped:
        return is_bare_key(content)
    if tags[1] == 0x04:  # encrypted, in whole cipher blocks
        return name.startswith(BY_PASS_PHRASE) and len(inner) == 2 and len(content) >= 32 and len(content) % 8 == 0
    return content[:1] == b"\0" and (name != RSA or is_integers_key(*fields_of(content[1:])))


def length_prefixed(data: bytes) -> list[bytes] | None:
    """The fields, each behind its length in four bytes, that fill the data."""
    at, fields = 0, []
    while at + 4 <= len(data):
        length = int.from_bytes(data[at : at + 4], "big")
        fields.append(data[at + 4 : at + 4 + length])
        at += 4 + length
    return fields if at == len(data) else None


def is_ssh_public(data: bytes) -> bool:
    """Length-prefixed fields that fill the data and begin with a key type."""
    fields = length_prefixed(data)
    return fields is not None and len(fields) > 1 and bool(re.match(rb"(ssh-|ecdsa-sha2-|sk-)[a-z0-9@.-]+$", fields[0]))


def is_ssh_private(data: bytes) -> bool:
    """The private format behind its name: cipher, key derivation and its options, the number of keys, the public keys,
    and the private part in whole blocks; not encrypted, it begins with one number twice."""
    at, head = 0, []
    for _ in range(3):
        end = at + 4 + int.from_bytes(data[at : at + 4], "big")
        head.append(data[at + 4 : end])
        at = end
    keys = int.from_bytes(data[at : at + 4], "big")
    rest = length_prefixed(data[at + 4 :])
    if at + 4 > len(data) or not rest or keys < 1 or len(rest) != keys + 1 or not re.fullmatch(rb"[a-z0-9@.-]+", head[0]):
        return False
    private = rest[-1]
    opens = head[0] != b"none" or (private[:4] == private[4:8] and head[1] == b"none")
    return all(map(is_ssh_public, rest[:-1])) and len(private) >= 16 and len(private) % 8 == 0 and opens


def is_ssh_key(data: bytes) -> bool:
    name = b"openssh-key-v1\0"
    return is_ssh_private(data[len(name) :]) if data.startswith(name) else is_ssh_public(data)


def key_kind(data: bytes | None) -> str | None:
    if not data:
        return None
    return "der" if is_der_key(data) else "ssh" if is_ssh_key(data) else None


def is_token(run: str) -> bool:
    """Header and claims of a signed token are JSON objects, and the header names an algorithm."""
    parsed = []
    for part in run.split(".")[:2]:
        try:
            parsed.append(json.loads(decoded(part) or b""))
        except (ValueError, RecursionError):
            return False
    return all(isinstance(part, dict) for part in parsed) and isinstance(parsed[0].get("alg"), str)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    spans = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= FEWEST["assign"]]
    spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= FEWEST["access"]]
    return spans + [(m.start(), m.end(), "hex") for m in LONG_HEX.finditer(text)]


def wrapped_keys(text: str, start: int, end: int) -> Iterator[tuple[int, int, str]]:
    """Keys in the lines of base64 from start to end: lines of one length, with or without a shorter one after them.
    A line of that length that doesn't belong to the key, directly above or below it, hides it."""
    lines = [(m.start(), m.end()) for m in LINE.finditer(text, start, end)]
    first = 0
    while first < len(lines):
        size, last = lines[first][1] - lines[first][0], first + 1
        while last < len(lines) and lines[last][1] - lines[last][0] == size:
            last += 1
        ends = [last]
        if last < len(lines) and lines[last][1] - lines[last][0] < size:
            ends.append(last + 1)
        for after in ends:
            if size >= FEWEST_IN_LINE and after - first > 1:
                kind = key_kind(decoded("".join(text[a:b] for a, b in lines[first:after])))
                if kind:
                    yield lines[first][0], lines[after - 1][1], kind
        first = last


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    spans = []
    if "-----BEGIN " in text:
        for m in ARMOR.finditer(text):
            data = decoded(re.sub(r"\\[nr]|\s", "", m[3]))
            locked = data and len(data) % 8 == 0 and ENCRYPTED.search(m[2])
            if key_kind(data) or locked:
                spans.append((m.start(), m.end(), "pem"))
    armoured = list(spans)
    if "eyJ" in text:
        spans += [(m.start(), m.end(), "jwt") for m in TOKEN.finditer(text) if is_token(m[0])]
    read = 0
    for m in ENCODED.finditer(text):
        kind = key_kind(decoded(m[0]))
        if kind:
            spans.append((m.start(), m.end(), kind))
        if m.start() >= read and text[m.end() : m.end() + 1] in ("\r", "\n"):
            block = WRAPPED.match(text, m.start())
            if block:
                read = block.end()
                before = bisect_right(armoured, block.start(), key=lambda span: span[0])
                if not before or armoured[before - 1][1] < block.end():
                    spans += wrapped_keys(text, block.start(), block.end())
    for m in ENCODED_HEX.finditer(text):
        kind = key_kind(bytes.fromhex(m[0]))
        if kind:
            spans.append((m.start(), m.end(), kind))
    return spans


def listed(spans: list[tuple[int, int, str]]) -> str:
    """kind:start:end by start, then kind."""
    ordered = sorted(set(spans), key=lambda span: (span[0], KINDS.index(span[2]), span[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered)


SCHEMA = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): counts of base spans, the SHA-256
    of their list, and the list of all spans.  Positions are code points of the whole text, ends exclusive.

    A null or empty text has no spans; ids are passed through, null and repeated ones too.  A map over the
    rows: nothing is shuffled, and a lost task is simply run again.
    """

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 500):
            rows = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                kinds = [kind for _, _, kind in base]
                digest = hashlib.sha256(listed(base).encode()).hexdigest()
                every = listed(base + confirmed_spans(text or ""))
                rows.append((*(kinds.count(kind) for kind in KINDS[:3]), digest, every))
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64())]
                + [pa.array(column, pa.int64()) for column in columns[:3]]
                + [pa.array(column, pa.string()) for column in columns[3:]],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(scanned, SCHEMA)
