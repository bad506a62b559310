"""Secrets confirmed by their structure (operator 7).

Plain patterns give the base spans: assignments, access key ids, hex strings. The
method adds what decodes to a key or a signed token: base64 and hex candidates
are decoded and read as

* DER: nested tags and lengths that fill each other exactly, with the members of
  a private key (PKCS#1, PKCS#8, encrypted PKCS#8, EC, DSA);
* an OpenSSH key: its magic and nested lengths up to the last byte;
* a signed token: three parts whose first two decode to JSON objects, the first
  naming its algorithm.

Keys in a PEM frame may have escaped line ends and header lines; an encrypted one of the
older form is told by its cipher header and whole cipher blocks. Without a frame, lines of
base64 that follow each other are one candidate, and a key may begin inside a run of base64
letters (behind a path, say), at a place whose decoded head gives the length that is left.
Hex may stand behind 0x.

Whatever does not parse is not reported, so random base64 or a public key is not.

A first pass by automaton over the Arrow column finds the texts that hold any
candidate; only those are opened. Texts are never cut. Null texts count as
empty, null ids and repeated rows are scanned like others.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from recordmill.llm.shared import pick, slices

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "der_key", "ssh_key", "signed_token")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*)PRIVATE KEY-----((?:[^-]|-(?!-))+)-----END \1PRIVATE KEY-----")
_LINE_END = re.compile(r"\\r\\n|\\[nr]|\r\n|[\n\r]")
_HEADER = re.compile(r"[A-Za-z0-9-]+: ")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
_LINES = re.compile(r"(?<![A-Za-z0-9+/])(?:[A-Za-z0-9+/]{40,}+(?:\r?\n|\\n)[\x20\t]*)+[A-Za-z0-9+/]+={0,2}")
_ANY_HEX = re.compile(r"(?<![0-9A-Za-z])(?:0[xX])?([0-9A-Fa-f]{64,})(?![0-9A-Za-z])")
#: Where a DER sequence of two or three bytes of length, or an OpenSSH key, begins in base64.
_INSIDE = re.compile(r"(?=(MI[E-P]|b3BlbnNzaC1rZXktdjEA))")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])e[A-Za-z0-9_-]{9,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*")
#: A text that matches none of these holds no candidate.
_FIRST = r"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-fA-F]{32}|[A-Za-z0-9+/_-]{40}|PRIVATE KEY-----|e[A-Za-z0-9_-]{9,}\.[A-Za-z0-9_-]{2,}\."
_RESULT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
_MAGIC = b"openssh-key-v1\0"


def decoded(text: str) -> bytes | None:
    """Bytes of base64 in either alphabet, padded or not; None if it can't be."""
    plain = "".join(text.split()).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def members(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and values of DER that fill ``data`` exactly; None if they don't."""
    found, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, length, at = data[at], data[at + 1], at + 2
        if length >= 0x80:
            size = length & 0x7F
            if not 1 <= size <= 4 or at + size > len(data) or data[at] == 0:
                return None
            length, at = int.from_bytes(data[at : at + size], "big"), at + size
            if length < 0x80:
                return None
        if at + length > len(data):
            return None
        found.append((tag, data[at : at + length]))
        at += length
    return found


def _algorithm(value: bytes) -> bool:
    inner = members(value)
    return bool(inner) and inner[0][0] == 0x06 and len(inner[0][1]) >= 3


def private_der(data: bytes) -> bool:
    """Is this one DER value that holds a private key?"""
    outer = members(data)
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    inner = members(outer[0][1])
    if not inner:
        return False
    tags = [t for t, _ in inner]
    if tags[:2] == [0x30, 0x04] and len(tags) == 2:  # encrypted PKCS#8
        return _algorithm(inner[0][1]) and len(inner[1][1]) >= 16
    if tags[0] != 0x02 or inner[0][1] not in (b"\0", b"\1"):
        return False
    if all(t == 0x02 for t in tags):  # PKCS#1: nine numbers; DSA: six
        return len(tags) in (6, 9)
    if tags[1] == 0x30 and len(tags) >= 3 and tags[2] == 0x04:  # PKCS#8
        return _algorithm(inner[1][1]) and len(inner[2][1]) >= 16
    return tags[1] == 0x04 and len(inner[1][1]) >= 16 and all(t in (0xA0, 0xA1) for t in tags[2:])  # EC


def private_ssh(data: bytes) -> bool:
    """Is this an OpenSSH key file: magic, three strings, a count, its public keys, one private part?"""
    if not data.startswith(_MAGIC):
        return False
    at, strings = len(_MAGIC), 3
    while strings:
        if at + 4 > len(data):
            return False
        length = int.from_bytes(data[at : at + 4], "big")
        at, strings = at + 4 + length, strings - 1
    if at + 4 > len(data):
        return False
    count, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    for _ in range(count + 1):
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    return count > 0 and at == len(data)


def _object(part: str) -> dict | None:
    raw = decoded(part)
    try:
        value = json.loads(raw) if raw else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def signed_token(text: str) -> bool:
    head, body, _ = text.split(".")
    first = _object(head)
    return first is not None and isinstance(first.get("alg"), str) and _object(body) is not None


def _key_kind(data: bytes | None) -> str | None:
    if not data:
        return None
    return "der_key" if private_der(data) else "ssh_key" if private_ssh(data) else None


def _framed(body: str) -> str | None:
    """Kind of the key between the marks of a PEM block."""
    lines = [line.strip() for line in _LINE_END.split(body)]
    heads = [line for line in lines if _HEADER.match(line)]
    data = decoded("".join(line for line in lines if not _HEADER.match(line)))
    if any(h.startswith("Proc-Type: 4,ENCRYPTED") for h in heads) and any(h.startswith("DEK-Info: ") for h in heads):
        return "der_key" if data and len(data) % 8 == 0 else None
    return _key_kind(data)


def _begun_inside(run: str) -> tuple[int, str] | None:
    """Place and kind of a key that ends with this run of base64 but begins inside it."""
    for m in _INSIDE.finditer(run):
        at, left = m.start(), len(run.rstrip("=")) - m.start()
        if m[1][0] == "M":
            head = decoded(run[at : at + 8])
            size = head[1] & 0x7F if head and head[1] > 0x80 else 0
            if not 1 <= size <= 3 or 2 + size + int.from_bytes(head[2 : 2 + size], "big") != left * 3 // 4:
                continue
        if kind := _key_kind(decoded(run[at:])):
            return at, kind
    return None


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    return found + [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]


def added_spans(text: str) -> list[tuple[int, int, str]]:
    found, blocks = [], []

    def outside(m: re.Match) -> bool:
        return not any(a <= m.start() < b for a, b in blocks)

    for m in _PEM.finditer(text):
        if kind := _framed(m[2]):
            found.append((m.start(), m.end(), kind))
            blocks.append(m.span())
    for m in _LINES.finditer(text):
        if outside(m) and (kind := _key_kind(decoded("".join(_LINE_END.split(m[0]))))):
            found.append((m.start(), m.end(), kind))
            blocks.append(m.span())
    for m in _BASE64.finditer(text):
        if not outside(m):
            continue
        if kind := _key_kind(decoded(m[0])):
            found.append((m.start(), m.end(), kind))
        elif inside := _begun_inside(m[0]):
            found.append((m.start() + inside[0], m.end(), inside[1]))
    for m in _ANY_HEX.finditer(text):
        if len(m[1]) % 2 == 0 and (kind := _key_kind(bytes.fromhex(m[1]))):
            found.append((m.start(1), m.end(1), kind))
    return found + [(m.start(), m.end(), "signed_token") for m in _TOKEN.finditer(text) if signed_token(m[0])]


def listed(spans: list[tuple[int, int, str]]) -> str:
    order = sorted(set(spans), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in order)


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    nothing = hashlib.sha256(b"").hexdigest()
    for batch in slices(batches):
        n, texts = batch.num_rows, batch.column(1)
        counts = {kind: np.zeros(n, np.int64) for kind in KINDS[:3]}
        digest, spans = [nothing] * n, [""] * n
        for i in np.flatnonzero(pc.match_substring_regex(texts, _FIRST).to_numpy(zero_copy_only=False)):
            text = texts[int(i)].as_py()
            base = base_spans(text)
            for _, _, kind in base:
                counts[kind][i] += 1
            digest[i] = hashlib.sha256(listed(base).encode()).hexdigest()
            spans[i] = listed(base + added_spans(text))
        columns = [*map(pa.array, counts.values()), pa.array(digest, pa.string()), pa.array(spans, pa.string())]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [x.split()[0] for x in _RESULT.split(", ")])


def secret_scan(docs: DataFrame) -> DataFrame:
    """Counts per base kind, the digest of the base spans and all spans ``kind:start:end`` of every document."""
    return pick(docs, "doc_id", "text").mapInArrow(_scan, _RESULT)
