"""Secret scans with structural confirmation.

The base kinds are patterns: assignments, access keys and long hexadecimal runs. Beside
them, runs that may be base64 or hexadecimal are decoded and reported only if their
structure holds: an ASN.1 key whose nested lengths fill their parents exactly, an OpenSSH
key whose length-prefixed fields do, an armoured block around one of these, or a signed
token whose header and payload are JSON objects and whose header names an algorithm.

Spans are ``kind:start:end`` in code points, end exclusive, ordered by start and then by kind
in the order of :data:`KINDS`. Null text counts as empty and has no spans; null ids pass
through; repeated rows get equal results; an empty table gives an empty one. Other columns
are not looked at.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlayer.llm.frames import plain_documents, ready
from lendlayer.llm.textkit import LOWER, column_texts

KINDS = ("assign", "access", "hex", "armour", "der", "ssh", "token")

# Fixed patterns of the base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_ASSIGNED, MIN_ACCESS = 8, 16

#: A line break in plain text, in a string literal (any depth of escaping) or in quoted mail, where marks follow it.
BREAK = r"(?:(?:\r?\n|\r)[\x20\t>|]*|(?:\\{1,8}[nr])+)"
ARMOUR = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]*)PRIVATE KEY-----")
ARMOURED = re.compile(r"(?:[A-Za-z0-9+/=\s:,>|\"'-]|\\{1,8}[nrt/u]|\\{1,8}(?=[\r\n\"']))*+")
#: Three or more parts with dots between, from the start of a part on.
DOTTED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]++){2,}+")
MIN_HEADER, MIN_PAYLOAD = 8, 4
# the letter of a literal \n is no part of a run
ENCODED = re.compile(r"(?!(?<=\\)[nr])[A-Za-z0-9+/_-]{40,}={0,2}")
HEX_ANY = re.compile(r"(?:[0-9A-Fa-f]{2}){32,}")
#: Encoded lines that follow each other: whole lines of one length, then a last one that may be shorter.
WRAPPED = re.compile(rf"(?:(?<![A-Za-z0-9+/_=-])|(?<=\\[nr]))(?!(?<=\\)[nr])([A-Za-z0-9+/_-]{{32,}})((?:{BREAK}[A-Za-z0-9+/_-]+)*={{0,2}})(?![A-Za-z0-9+/_=-])")
_BREAK = re.compile(BREAK)

#: A row is looked at closely if it has one of these words, a run this long, or a run as long as the
#: shortest signed token with two dots in it.
HINTS = re.compile(rb"password|passwd|secret|token|api_?key|akia|-----begin")
RUN, TOKEN_RUN = 32, MIN_HEADER + MIN_PAYLOAD + 3
_RUN = np.zeros(256, dtype=bool)
_RUN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-.")] = True


def decode_base64(run: str) -> bytes | None:
    """The bytes of a base64 run in either alphabet; None if it is not one."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _asn1(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, value start, value end) of the element at ``at``, if it fits before ``end``."""
    if at + 2 > end:
        return None
    tag, n, at = data[at], data[at + 1], at + 2
    if n & 0x80:
        k = n & 0x7F
        if not 1 <= k <= 4 or at + k > end or data[at] == 0:
            return None
        n, at = int.from_bytes(data[at : at + k], "big"), at + k
        if n < 0x80:
            return None  # a short length in long form is not DER
    return (tag, at, at + n) if at + n <= end else None


def _children(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """Elements that fill start..end exactly."""
    out = []
    while start < end:
        element = _asn1(data, start, end)
        if element is None:
            return None
        out.append(element)
        start = element[2]
    return out


def is_der_key(data: bytes) -> bool:
    """A whole ASN.1 sequence of a private or public key, every nested length exact.

    Private keys begin with a small version number and go on with numbers (PKCS#1), an
    algorithm and wrapped bytes (PKCS#8) or wrapped bytes (elliptic curves); public keys are
    an algorithm and a bit string, encrypted private keys an algorithm and bytes.
    """
    top = _asn1(data, 0, len(data))
    if top is None or top[0] != 0x30 or top[2] != len(data):
        return False
    parts = _children(data, top[1], top[2])
    if not parts or len(parts) < 2:
        return False
    for tag, start, end in parts:
        if tag & 0x20 and _children(data, start, end) is None:
            return False
    tags = [p[0] for p in parts]
    algorithm = lambda p: p[0] == 0x30 and (_children(data, p[1], p[2]) or [(0, 0, 0)])[0][0] == 0x06
    if tags[0] == 0x02 and parts[0][2] - parts[0][1] == 1 and data[parts[0][1]] <= 2:
        if len(parts) >= 6 and all(t == 0x02 for t in tags):
            return True
        if len(parts) >= 3 and algorithm(parts[1]) and tags[2] == 0x04:
            return True
        return tags[1] == 0x04 and parts[1][2] - parts[1][1] >= 16
    # a public key's bits or an encrypted private key's bytes
    return len(parts) == 2 and algorithm(parts[0]) and (tags[1] == 0x03 or tags[1] == 0x04 and parts[1][2] - parts[1][1] >= 16)


def is_ssh_key(data: bytes) -> bool:
    """An OpenSSH private key file or public key blob: length-prefixed fields that fit exactly."""
    magic = b"openssh-key-v1\0"
    private = data.startswith(magic)
    at, fields = len(magic) if private else 0, []
    while at + 4 <= len(data):
        n = int.from_bytes(data[at : at + 4], "big")
        if private and len(fields) == 3:  # the number of keys stands between the fields
            if not 1 <= n <= 64:
                return False
            fields.append(b"")
            at += 4
            continue
        if at + 4 + n > len(data):
            return False
        fields.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    if at != len(data):
        return False
    if private:
        return len(fields) >= 6
    return len(fields) >= 2 and re.fullmatch(rb"(ssh|ecdsa|sk)-[a-z0-9@.-]{3,60}", fields[0]) is not None


def is_signed_token(run: str) -> bool:
    """header.payload.signature whose first two parts are JSON objects, the header with an algorithm."""
    parts = run.split(".")
    try:
        header, payload = (json.loads(decode_base64(p) or b"") for p in parts[:2])
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(payload, dict) and isinstance(header.get("alg"), str)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= MIN_ASSIGNED]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _armoured(body: str) -> bytes | None:
    """The bytes between an armoured block's lines, in plain, escaped or quoted text."""
    lines = re.split(r"\r\n|\r|\n|(?:\\+[nr])+", body)
    lines = [re.sub(r"\\+u003[dD]", "=", line).translate(_MARKS) for line in lines if ":" not in line]
    return decode_base64("".join(line for line in lines if line != "+"))  # a lone plus joins string literals


_MARKS = {ord(c): None for c in " \t\v\f,>|\"'\\"}


def _kind_of(data: bytes | None) -> int | None:
    if not data:
        return None
    return 4 if is_der_key(data) else 5 if is_ssh_key(data) else None


def _ends(line: str, more: int) -> list[int]:
    """How many further lines of ``more`` a key that begins with ``line`` may have: its first length says it."""
    out = set()
    for data, chars in ((decode_base64(line[:32]), lambda n: -(-4 * n // 3)), (bytes.fromhex(line[:32]) if re.fullmatch(r"[0-9A-Fa-f]{32}", line[:32]) else None, lambda n: 2 * n)):
        if not data:
            continue
        if data[0] == 0x30 and (k := data[1] - 0x80 if data[1] > 0x80 else 0) <= 4:
            total = 2 + k + (int.from_bytes(data[2 : 2 + k], "big") if k else data[1])
            out.add((chars(total) - 1) // len(line))
        elif data.startswith(b"openssh-key-v1") or data[:3] == bytes(3) and data[4:].startswith((b"ssh-", b"ecdsa-", b"sk-")):
            out.update((more, more - 1))  # a line of plain letters may follow the last one
    return sorted(n for n in out if 0 < n <= more)[::-1]


def _wrapped(text: str) -> list[tuple[int, int, int]]:
    """Keys whose base64 or hexadecimal form is broken into lines of one length and a last one."""
    out = []
    for m in WRAPPED.finditer(text):
        edges = [(m.start(), m.end(1))]
        at = m.end(1)
        for gap in _BREAK.finditer(text, at, m.end()):
            edges[-1] = (edges[-1][0], gap.start())
            edges.append((gap.end(), m.end()))
        first = reach = 0
        while first < len(edges) - 1:
            wide, last = edges[first][1] - edges[first][0], max(first, reach)
            while wide >= RUN and last + 1 < len(edges) and edges[last][1] - edges[last][0] == wide and edges[last + 1][1] - edges[last + 1][0] <= wide:
                last += 1
            reach, found = (last if wide >= RUN else 0), first + 1
            if last < len(edges) and (wide < RUN or edges[first + 1][1] - edges[first + 1][0] > wide):
                first, reach = first + 1, 0
                continue
            for end in _ends(text[edges[first][0] : edges[first][1]], last - first):
                run = "".join(text[a:b] for a, b in edges[first : first + end + 1]).rstrip("=")
                is_hex = len(run) % 2 == 0 and re.fullmatch(r"[0-9A-Fa-f]+", run) is not None
                kind = (_kind_of(bytes.fromhex(run)) if is_hex else None) or _kind_of(decode_base64(run))
                if kind is not None:
                    out.append((edges[first][0], kind, edges[first + end][1]))
                    found = first + end + 1
                    break
            first = found
    return out


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of candidates whose decoded structure holds."""
    out = []
    begin = None
    for m in ARMOUR.finditer(text):  # an end belongs to the beginning right before it
        if m.group(1) == "BEGIN":
            begin = m
        elif begin is not None:
            body = text[begin.end() : m.start()]
            if begin.group(2) == m.group(2) and ARMOURED.fullmatch(body) and _kind_of(_armoured(body)) is not None:
                out.append((begin.start(), 3, m.end()))
            begin = None
    inside = [(a, b) for a, _, b in out]
    free = lambda x, y: not any(a <= x and y <= b for a, b in inside)
    wrapped = [(a, k, b) for a, k, b in _wrapped(text) if free(a, b)]
    out += wrapped
    inside += [(a, b) for a, _, b in wrapped]
    for m in ENCODED.finditer(text):
        kind = _kind_of(decode_base64(m.group())) if free(m.start(), m.end()) else None
        if kind is not None:
            out.append((m.start(), kind, m.end()))
    for m in HEX_ANY.finditer(text):
        kind = _kind_of(bytes.fromhex(m.group())) if free(m.start(), m.end()) else None
        if kind is not None:
            out.append((m.start(), kind, m.end()))
    out += [(a, 6, b) for m in DOTTED.finditer(text) for a, b in _signed(m.group(), m.start())]
    return sorted(set(out))


def _signed(run: str, at: int) -> list[tuple[int, int]]:
    """Signed tokens among the parts of a dotted run that starts at ``at``."""
    parts, starts = run.split("."), [at]
    for p in parts:
        starts.append(starts[-1] + len(p) + 1)
    out, i = [], 0
    while i + 2 < len(parts):
        header, payload, signature = parts[i : i + 3]
        if len(header) >= MIN_HEADER and len(payload) >= MIN_PAYLOAD and is_signed_token(f"{header}.{payload}.{signature}"):
            out.append((starts[i], starts[i + 3] - 1))
            i += 3
        else:
            i += 1
    return out


def find_secrets(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and all spans in order."""
    base = base_spans(text)
    return base, sorted(base + confirmed_spans(text))


def _rows_to_read(texts) -> np.ndarray:
    """Rows of a slice that have a hint, a long run, or a run that may hold a signed token (any span needs one of these)."""
    data = texts.data
    inside = np.concatenate([[False], _RUN[data], [False]])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = turns[::2], turns[1::2]
    dots = np.concatenate([[0], np.cumsum(data == ord("."))])
    some = (ends - starts >= RUN) | (ends - starts >= TOKEN_RUN) & (dots[ends] - dots[starts] >= 2)
    at = [starts[some]]
    at.append(np.array([m.start() for m in HINTS.finditer(LOWER[data].tobytes())], dtype=np.int64))
    # a run across the border of two rows is cut by neither test; both rows are read
    found = np.concatenate(at)
    rows = np.searchsorted(texts.offsets, found, side="right") - 1
    over = np.searchsorted(texts.offsets, np.concatenate([ends[some] - 1, at[1]]), side="right") - 1
    spans = [np.arange(a, b + 1) for a, b in zip(rows.tolist(), over.tolist())]
    return np.unique(np.concatenate(spans)) if spans else np.empty(0, np.int64)


def _line(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, found: array of (kind, start, end, base) in order, for every document."""
    ready(docs.sparkSession)

    def scan(text: pa.Array) -> pa.Array:
        out: list[list[dict]] = []
        for texts in column_texts(text):
            rows: list[list[dict]] = [[] for _ in range(len(texts))]
            for i in _rows_to_read(texts).tolist():
                base, every = find_secrets(texts.raw(i).decode("utf-8", "replace"))
                known = set(base)
                rows[i] = [{"kind": KINDS[k], "start": a, "end": b, "base": (a, k, b) in known} for a, k, b in every]
            out.extend(rows)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
        return pa.array(out, kind)

    plain = plain_documents(docs, id_col, text_col)
    return plain.select("doc_id", F.arrow_udf(scan, "array<struct<kind: string, start: bigint, end: bigint, base: boolean>>")(F.col("text")).alias("found"))


def secret_digest(found: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, all spans as text."""
    written = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("found", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("found", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(k) for k in KINDS[:3]], F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(F.col("found")).alias("spans")
    )
