"""Secret scans with structural confirmation.

Base spans come from three patterns. Candidates for more (armoured keys, dotted
tokens, long base64 and hex runs) are reported only once their structure holds:
they are decoded, DER lengths must nest to the last byte, key containers must
parse, and a signed token's header must be a JSON object that names its
algorithm.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import tidy

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "pem", "jwt", "der")

# The base patterns. (?a: ) keeps "either case" to ASCII letters.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ASSIGN_LEAST, _ACCESS_LEAST, _HEX_LEAST = 12, 18, 16
# A run is found whole or not at all, so its least length can be part of the pattern.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{%d,}" % (_ACCESS_LEAST - 4))
_HEX = re.compile(r"[0-9a-f]{%d,}" % _HEX_LEAST)

#: A line break as such, or escaped as in JSON, once or more often.
_GAP = r"(?:\s|\\+[nrt])"
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----" + _GAP + r"*((?:[A-Za-z][A-Za-z0-9-]*:(?:(?!\\+[nr])[^\n])*(?:\n|(?:\\+[nr])+))*)((?:[A-Za-z0-9+/=]|" + _GAP + r")*?)-----END \1-----")
_GAPS = re.compile(_GAP + "+")
#: Runs of segments between dots; a signed token's header begins with an encoded {, then a quote or white space.
_DOTTED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]*+)++")
_HEADER = re.compile(r"ey[A-Za-z0-9_-]|ew[ko0]")
#: Where base64 (either alphabet) or hex of a DER sequence, an OpenSSH container or PEM may
#: begin, in a run too: each is told by its first bytes.
_START = re.compile(r"M[B-I]|b3BlbnNzaC1rZXktdjEA|LS0tLS1CRUdJTi|30(?=[0-9A-Fa-f]{2})")
_B64, _XDIGITS = r"[A-Za-z0-9+/_-]", r"[0-9A-Fa-f]"
#: Runs that line breaks may part, as such or escaped; blanks before the next line too.
_BREAK = r"(?:(?:\r?\n|(?:\\+r)?\\+n)[\x20\t]*)"
_RUN64 = re.compile(f"{_B64}+(?:{_BREAK}{_B64}+)*(?:{_BREAK}?={{1,2}})?")
_RUN16 = re.compile(f"{_XDIGITS}+(?:{_BREAK}{_XDIGITS}+)*")
_BREAKS = re.compile(_BREAK)
_HEAD64, _HEAD16 = re.compile(_B64 + "{16}"), re.compile(_XDIGITS + "{24}")
_PEM_END = re.compile(r"-----END [A-Z0-9 ]+-----\s*")
#: Characters that the smallest key container takes.
_LEAST = 40


def der_items(data: bytes, at: int = 0, end: int | None = None) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the items in data[at:end], or None unless they fill it exactly."""
    end, out = len(data) if end is None else end, []
    while at < end:
        if at + 2 > end:
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > end or data[at] == 0:
                return None
            size = int.from_bytes(data[at : at + width], "big")
            if size < 0x80:  # DER takes the short form here
                return None
            at += width
        if at + size > end:
            return None
        out.append((tag, at, at + size))
        at += size
    return out


# Object identifiers (their DER bodies) of key algorithms, and of what encrypts keys.
_RSA = {bytes.fromhex("2a864886f70d01010%s" % k) for k in "17a"}
_EC = bytes.fromhex("2a8648ce3d0201")
_CURVES = {bytes.fromhex("2b65%s" % k) for k in ("6e", "6f", "70", "71")}
_NUMBER_KEYS = {bytes.fromhex("2a8648ce380401"), bytes.fromhex("2a864886f70d010301"), bytes.fromhex("2a8648ce3e0201")}
_ENCRYPTS = tuple(map(bytes.fromhex, ("2a864886f70d0105", "2a864886f70d010c01")))


def _is_inner_key(oid: bytes, key: bytes) -> bool:
    """Whether the octets inside PKCS#8 are a key of the algorithm that it names."""
    items = der_items(key)
    if not items or len(items) != 1:
        return False
    tag, a, b = items[0]
    if oid in _CURVES:
        return tag == 0x04 and 32 <= b - a <= 57
    if oid in _NUMBER_KEYS:
        return tag == 0x02 and b - a >= 16
    if oid == _EC:
        own = der_items(key, a, b) if tag == 0x30 else None
        return bool(own) and [t for t, *_ in own[:2]] == [0x02, 0x04] and key[own[0][1] : own[0][2]] == b"\1" and 16 <= own[1][2] - own[1][1] <= 72
    own = der_items(key, a, b) if oid in _RSA and tag == 0x30 else None
    return bool(own) and len(own) == 9 and is_private_der(key)


def is_private_der(data: bytes) -> bool:
    """Whether these bytes are a private key in DER: PKCS#1, SEC 1, PKCS#8, encrypted PKCS#8 or DSA."""
    top = der_items(data)
    if not top or len(top) != 1 or top[0][0] != 0x30:
        return False
    items = der_items(data, *top[0][1:])
    if not items or len(items) < 2:
        return False
    tags = [t for t, _, _ in items]
    body = [data[a:b] for _, a, b in items]
    nested = all(der_items(data, a, b) is not None for t, a, b in items if t & 0x20)
    if not nested:
        return False
    if tags[:2] == [0x30, 0x04] and len(tags) == 2:  # encrypted PKCS#8: algorithm, data
        inner = der_items(body[0])
        return bool(inner) and inner[0][0] == 0x06 and body[0][inner[0][1] : inner[0][2]].startswith(_ENCRYPTS) and len(body[1]) >= 16 and len(body[1]) % 8 == 0
    if tags[0] != 0x02 or body[0] not in (b"\0", b"\1"):
        return False
    if tags[1:3] == [0x30, 0x04]:  # PKCS#8: version, algorithm, key
        inner = der_items(body[1])
        return bool(inner) and inner[0][0] == 0x06 and _is_inner_key(body[1][inner[0][1] : inner[0][2]], body[2])
    if body[0] == b"\1" and tags[1] == 0x04:  # SEC 1: version, scalar, curve
        return 16 <= len(body[1]) <= 72 and all(t in (0xA0, 0xA1) for t in tags[2:])
    # PKCS#1 has nine integers, DSA six.
    return len(tags) in (6, 9) and set(tags) == {0x02} and len(body[1]) >= 32


def is_private_container(data: bytes) -> bool:
    """DER, or the container of OpenSSH, whose lengths must fit its bytes."""
    if not data.startswith(b"openssh-key-v1\0"):
        return is_private_der(data)
    at = 15
    for _ in range(3):  # cipher, key derivation, its options
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    if at + 4 > len(data):
        return False
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if not 1 <= keys <= 16:
        return False
    for _ in range(keys + 1):  # public keys, private part
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    return at == len(data)


def unbase64(text: str) -> bytes | None:
    """Bytes of base64 in either alphabet, padded or not; None if it isn't."""
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except binascii.Error:
        return None


def is_signed_token(text: str) -> bool:
    """Whether header and claims are JSON objects, and the header names an algorithm."""
    head, claims, _ = text.split(".")
    for part, needs in ((head, "alg"), (claims, None)):
        try:
            value = json.loads(unbase64(part) or b"")
        except (ValueError, RecursionError):
            return False
        if not isinstance(value, dict) or needs and not isinstance(value.get(needs), str):
            return False
    return True


def _ends_object(part: str, start: int) -> bool:
    """Whether base64 that begins at ``start`` can end a JSON object, by its last characters."""
    last = (unbase64(part[start + max(0, (len(part) - start - 1) // 4 * 4 - 4) :]) or b"").rstrip()
    return not last or last.endswith(b"}")


def token_spans(text: str) -> list[tuple[int, int]]:
    """Signed tokens: three segments of a dotted run, the first from its header on.

    The leftmost start in a segment whose structure is right is the token's. Only
    a long segment that ends like a header and is full of starts takes longer
    than its length calls for.
    """
    found = []
    for run in _DOTTED.finditer(text):
        at, parts, free = run.start(), run[0].split("."), 0
        starts = [at]
        for part in parts:
            starts.append(starts[-1] + len(part) + 1)
        for k in range(len(parts) - 2):
            if k < free or not parts[k + 1]:
                continue
            ends = {r for r in range(4) if _ends_object(parts[k], r)}  # alike for starts four apart
            for m in _HEADER.finditer(parts[k]) if ends else ():
                if m.start() % 4 in ends and is_signed_token(".".join((parts[k][m.start() :], *parts[k + 1 : k + 3]))):
                    found.append((starts[k] + m.start(), starts[k + 3] - 1))
                    free = k + 3
                    break
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= _ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    return found + [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]


def confirmed_spans(text: str) -> list[tuple[str, int, int]]:
    """What the method adds: spans whose structure was confirmed, in no kind overlapping."""
    found = []
    if "-----BEGIN " in text:
        for m in _PEM.finditer(text):
            data = unbase64(_GAPS.sub("", m[3]))
            # A key encrypted under its armour has headers and an opaque body.
            if data and (is_private_container(data) or "ENCRYPTED" in m[2] and len(data) % 8 == 0):
                found.append(("pem", m.start(), m.end()))
    armoured = [(a, b) for _, a, b in found]
    if "eyJ" in text:
        found += [("jwt", a, b) for a, b in token_spans(text)]
    at = 0
    for m in _START.finditer(text):
        if m.start() < at:
            continue
        end = _key_from(text, m.start())
        if end is not None:
            at = end
            if not any(a < end and m.start() < b for a, b in armoured):
                found.append(("der", m.start(), end))
    return found


def _whole(data: bytes) -> int | None:
    """Bytes that the container at the start of ``data`` takes by its own lengths."""
    if data.startswith(b"openssh-key-v1\0"):
        at, left, keys = 15, 3, None
        while left:
            if at + 4 > len(data):
                return None
            at += 4 + int.from_bytes(data[at : at + 4], "big")
            left -= 1
            if not left and keys is None:
                keys = int.from_bytes(data[at : at + 4], "big")
                if not 1 <= keys <= 16:
                    return None
                at, left = at + 4, keys + 1
        return at if at <= len(data) else None
    if len(data) < 2 or data[0] != 0x30:
        return None
    width = data[1] & 0x7F if data[1] & 0x80 else 0
    if width > 4 or data[1] == 0x80:
        return None
    size = 2 + width + (int.from_bytes(data[2 : 2 + width], "big") if width else data[1])
    return size if size <= len(data) else None


def _hopeless(head: bytes, left: int) -> bool:
    """Whether no key starts with these bytes, which ``left`` characters at most encode."""
    if len(head) < 8 or head[0] != 0x30:
        return False
    width = head[1] & 0x7F if head[1] & 0x80 else 0
    size = int.from_bytes(head[2 : 2 + width], "big") if width else head[1]
    return width > 4 or head[2 + width] not in (0x02, 0x30) or size > left


def _key_from(text: str, start: int) -> int | None:
    """Where the key ends whose base64 or hex starts here; None if none does.

    Its own lengths say how far it goes, so that breaks before its end belong to
    it and what follows does not; a run that goes on is no key.
    """
    hexed = text.startswith("30", start)
    # Most starts in long runs end here, so a run isn't decoded again and again.
    if head := (_HEAD16 if hexed else _HEAD64).match(text, start):
        if _hopeless(bytes.fromhex(head[0]) if hexed else unbase64(head[0]) or b"", len(text) - start):
            return None
    run = (_RUN16 if hexed else _RUN64).match(text, start)
    if run is None or run.end() - start < _LEAST:
        return None
    marks = [(m.start(), m.end()) for m in _BREAKS.finditer(text, start, run.end())]
    # The key may end with any line: the whole run, or what stands before a break.
    raw = _BREAKS.sub("", run[0])
    if hexed:
        need = _whole(bytes.fromhex(raw[: len(raw) // 2 * 2]))
        wanted = None if need is None else 2 * need
        confirmed = need is not None and is_private_der(bytes.fromhex(raw[:wanted]))
    else:
        body = raw.rstrip("=")
        data = unbase64(body[: len(body) // 4 * 4]) if len(body) % 4 == 1 else unbase64(body)
        if data is None:
            return None
        if data.startswith(b"-----BEGIN"):
            inner = data.decode("latin-1")
            if not any(k == "pem" for k, _, _ in confirmed_spans(inner)):
                return None
            need = max(m.end() for m in _PEM_END.finditer(inner))  # certificates may stand beside the key
            confirmed = True
        else:
            need = _whole(data)
            confirmed = need is not None and is_private_container(data[:need])
        wanted = None if need is None else -(-need * 4 // 3)
    if not confirmed:
        return None
    at, left = start, wanted
    for a, b in [*marks, (run.end(), run.end())]:
        if left <= a - at:
            end = at + left
            break
        left, at = left - (a - at), b
    else:
        return None
    pad = re.compile(f"{_BREAK}?={{1,2}}").match(text, end) if not hexed else None
    end = pad.end() if pad else end
    if end < run.end() and not _BREAKS.match(text, end):
        return None
    return end


def spans(text: str) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) by start, then kind; code points, end exclusive."""
    return sorted([*base_spans(text), *confirmed_spans(text)], key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def redact(text: str, found: list[tuple[str, int, int]]) -> str:
    """The text with each stretch covered by spans replaced by <secret>."""
    out, at = [], 0
    for _, a, b in found:
        if a >= at:
            out += [text[at:a], "<secret>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def _texts(column: pa.Array) -> Iterator[str | None]:
    return (x.as_py() for x in column)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, spans array<struct<kind, start, end>>): the secrets of each whole text.

    Null and empty texts have none. Rows are kept as they are, repeated ones and
    those with a null id too. Other columns are left out. An empty table gives
    an empty one.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    item = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans(t or "")] for t in _texts(batch.column("text"))]
            yield pa.record_batch([batch.column("id"), pa.array(found, pa.list_(item))], ["id", "spans"])

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(tidy(run), f"id {kind}, spans array<struct<kind: string, start: int, end: int>>").withColumnRenamed("id", id_col)


def digests(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, n_assign, n_access, n_hex, base_sha256, spans): counts and joined spans."""

    def joined(s):
        return F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def of(kind: str):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda x: x["kind"].isin(*KINDS[:3]))
    return scanned.select(id_col, of("assign"), of("access"), of("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every secret in ``text_col`` replaced by <secret>; all else as it was.

    Null texts stay null, texts without secrets are unchanged to the byte.
    """
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t and redact(t, spans(t)) for t in _texts(batch.column(text_col))]
            k = batch.schema.get_field_index(text_col)
            yield batch.set_column(k, batch.schema.field(k), pa.array(texts, batch.schema.field(k).type))

    return docs.mapInArrow(tidy(run), schema)


def sha256_of(found: list[tuple[str, int, int]]) -> str:
    """The digest that digests() gives for these base spans (for tests)."""
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in found).encode()).hexdigest()
