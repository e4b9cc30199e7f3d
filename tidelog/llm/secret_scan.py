"""Secret scans: base patterns, and candidates that are reported only after their structure has been decoded."""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import map_batches, with_free_names

#: The base patterns and least lengths of the contract; kinds are listed in reporting order.
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX_RUN = re.compile(r"[0-9a-f]{24,}")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "der", "openssh", "jwt")

#: Candidates for the structural check.
JWT = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{10,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")
BASE64_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
#: Between a key's lines: a line end, also one written out as \\n, with the quote marks, blanks and signs of the text around it.
LINE_END = re.compile(r"""["']?[\x20\t]*+(?:[+\\,][\x20\t]*+)?(?:\r?\n|(?:\\{1,2}r)?\\{1,2}n)[\x20\t>"'|#*]*+(?!-----)""")
BASE64_RUN = re.compile(rf"[A-Za-z0-9+/_-]{{32,}}(?:{LINE_END.pattern}[A-Za-z0-9+/_-]+)*={{0,2}}")
HEX_ANY = re.compile(r"[0-9a-fA-F]{48,}")
#: Where a key may begin within a run: the SEQUENCE tag and a length, or the magic.
BASE64_BEGIN = re.compile(r"(?=M[A-I]|b3BlbnNzaC1rZXktdjEA)")
HEX_BEGIN = re.compile(r"(?=30[0-8]|6f70656e7373682d6b65792d763100)", re.IGNORECASE)
#: Cheap test that picks the texts worth a closer look: whatever any pattern above matches, this one does.
HINT = "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]|AKIA|[0-9a-f]{24}|[A-Za-z0-9+/_-]{32}|[A-Za-z0-9_-]{10}\\.[A-Za-z0-9_-]{2,}\\."


def der_length(data: bytes, at: int) -> tuple[int, int] | None:
    """Length of a DER value whose length octets begin at `at`, and where its content begins."""
    if at >= len(data):
        return None
    first = data[at]
    if first < 0x80:
        return first, at + 1
    n = first & 0x7F
    if not 1 <= n <= 4 or at + 1 + n > len(data):
        return None
    return int.from_bytes(data[at + 1 : at + 1 + n], "big"), at + 1 + n


def der_size(data: bytes) -> int | None:
    """Bytes of the SEQUENCE that data begins with, header included, whether or not they are all there."""
    if data[:1] != b"\x30" or not (outer := der_length(data, 1)) or outer[0] < 12:
        return None
    return outer[0] + outer[1]


def der_key(read: Callable[[int, int], bytes], end: int) -> bool:
    """Whether `end` bytes are a key: a SEQUENCE that its nested lengths fill and that begins as PKCS#1, PKCS#8, SEC1 or SPKI keys do.

    read(at, n) gives n of the bytes; only the elements' headers are read, and only while they may still be a key's.
    """
    if end < 16:
        return False
    at, tags = der_length(read(0, 6), 1)[1], []
    while at < end:
        head = read(at, min(7, end - at))
        if not (inner := der_length(head, 1)) or at + inner[1] + inner[0] > end or len(tags) == 8 and {t for t, _, _ in tags} != {0x02}:
            return False
        tags.append((head[0], inner[0], head[inner[1] : inner[1] + 1] if inner[0] else b""))
        at += inner[1] + inner[0]
    kinds = [t for t, _, _ in tags]
    integers = len(kinds) >= 8 and all(k == 0x02 for k in kinds[:8])  # PKCS#1 private key
    wrapped = kinds[:3] == [0x02, 0x30, 0x04] and tags[1][2] == b"\x06"  # PKCS#8
    curve = kinds[:2] == [0x02, 0x04] and tags[0][1:] == (1, b"\x01")  # SEC1
    public = kinds == [0x30, 0x03] and tags[0][2] == b"\x06"
    return integers or wrapped or curve or public


MAGIC = b"openssh-key-v1\0"


def openssh_key(data: bytes) -> int | None:
    """Bytes of the key that data begins with: the magic, three length-prefixed fields, a key count and, if they fit, the keys; else all of data."""
    if not data.startswith(MAGIC):
        return None

    def field(at: int) -> int | None:
        return at + 4 + int.from_bytes(data[at : at + 4], "big") if at + 4 <= len(data) else None

    at: int | None = len(MAGIC)
    for _ in range(3):
        if (at := field(at)) is None or at > len(data):
            return None
    n = int.from_bytes(data[at : at + 4], "big")
    if at + 4 > len(data) or not 1 <= n <= 16:
        return None
    at += 4
    for _ in range(n + 1):  # the public keys and the private section
        if (at := field(at)) is None or at > len(data):
            return len(data)
    return at


def is_token_header(segment: str) -> bool:
    """Base64url JSON of an object with a text member alg, as signed tokens have."""
    try:
        head = json.loads(base64.urlsafe_b64decode(segment + "=" * (-len(segment) % 4)))
    except (ValueError, binascii.Error, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str)


def der_begins(head: bytes) -> bool:
    """Whether head, a value's first bytes, begins as keys do: version 0 and an INTEGER or SEQUENCE, version 1 and an OCTET STRING, or an algorithm."""
    at = der_length(head, 1)[1]
    if head[at : at + 1] == b"\x30":
        return bool(inner := der_length(head, at + 1)) and head[inner[1] : inner[1] + 1] == b"\x06"
    return head[at : at + 4] in (b"\x02\x01\x00\x02", b"\x02\x01\x00\x30", b"\x02\x01\x01\x04")


def key_in(decoded: Callable[[int, int, int], bytes], at: int, left: int, strict: bool) -> tuple[str, int] | None:
    """Kind and bytes of the key that begins at place `at` of a run; decoded(at, skip, n) gives n bytes, `skip` bytes from there; `left` exist.

    strict: at a place that begins no line, the first values must be a key's before any more is decoded.
    """
    head = decoded(at, 0, min(left, 15))
    if (size := der_size(head)) is not None:
        if size > left or strict and not der_begins(head):
            return None
        return ("der", size) if der_key(lambda place, n: decoded(at, place, n), size) else None
    if head != MAGIC:
        return None
    found = openssh_key(decoded(at, 0, left))
    return ("openssh", found) if found else None


def base64_keys(text: str, start: int, end: int) -> Iterator[tuple[int, int, str]]:
    """Spans of the keys in the base64 run text[start:end], wherever in a line they begin; a key ends where its own lengths say."""
    lines, at = [], start
    while m := BASE64_LINE.match(text, at, end):
        lines.append(m.span())
        if not (m := LINE_END.match(text, m.end(), end)):
            break
        at = m.end()
    begins = np.cumsum([0, *(e - s for s, e in lines)]).tolist()  # places in run
    run = "".join(text[s:e] for s, e in lines).replace("-", "+").replace("_", "/")

    def decoded(at: int, skip: int, size: int) -> bytes:
        part = run[at + skip // 3 * 4 : at + -(-4 * (skip + size) // 3)]
        part = part[: len(part) - (len(part) % 4 == 1)]
        return base64.b64decode(part + "=" * (-len(part) % 4))[skip % 3 :]

    done, edges = 0, set(begins)
    for m in BASE64_BEGIN.finditer(run):
        at = m.start()
        if at < done or not (found := key_in(decoded, at, 3 * (len(run) - at) // 4, at not in edges)):
            continue
        kind, size = found
        done = min(at + -(-4 * size // 3), len(run))
        first, last = bisect_right(begins, at) - 1, bisect_left(begins, done) - 1
        stop = lines[last][0] + done - begins[last]
        while stop < end and text[stop] == "=":
            stop += 1
        yield lines[first][0] + at - begins[first], stop, kind


def hex_keys(run: str, start: int) -> Iterator[tuple[int, int, str]]:
    """Spans of the keys in a run of hex digits that begins at start, at odd places too."""

    def decoded(at: int, skip: int, size: int) -> bytes:
        return bytes.fromhex(run[at + 2 * skip : at + 2 * (skip + size)])

    done = 0
    for m in HEX_BEGIN.finditer(run):
        at = m.start()
        if at >= done and (found := key_in(decoded, at, (len(run) - at) // 2, at > 0)):
            done = at + 2 * found[1]
            yield start + at, start + done, found[0]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= LEAST["assign"]]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    return out + [(m.start(), m.end(), "hex") for m in HEX_RUN.finditer(text)]


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    """Candidates whose decoded bytes parse as a key, and tokens whose header decodes."""
    out = []
    for m in BASE64_RUN.finditer(text):
        out += base64_keys(text, m.start(), m.end())
    for m in HEX_ANY.finditer(text):
        out += hex_keys(m[0], m.start())
    return out + [(m.start(), m.end(), "jwt") for m in JWT.finditer(text) if is_token_header(m[1])]


def find_spans(text: str) -> list[tuple[int, int, str]]:
    """All spans (start, end, kind) in code points, by start and then kind as listed in KINDS."""
    return sorted({*base_spans(text), *confirmed_spans(text)}, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and spans: array of (kind, start, end) in code points, end exclusive, by start and then kind.

    One output row per input row, repeated rows included. A null or empty text has no spans; a null doc_id stays
    null; other columns are ignored. Texts are scanned whole, in one pass without a shuffle.
    """

    def scan(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        text = b.column("text")
        spans: list[list[dict]] = [[] for _ in range(b.num_rows)]
        for i in pc.indices_nonzero(pc.fill_null(pc.match_substring_regex(text, HINT), False)).to_pylist():
            spans[i] = [{"kind": k, "start": s, "end": e} for s, e, k in find_spans(text[i].as_py())]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(spans, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))], names=["doc_id", "spans"])

    df = with_free_names(docs, ["doc_id", "text"])
    return map_batches(df, scan, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, spans array<struct<kind string, start bigint, end bigint>>")


def redact_secrets(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """docs with every reported span of text replaced by mask (overlapping spans by one mask) and n_chars, if present, brought up to date.

    Rows, their number, repeated ones included, and their other columns, whatever their names, stay; a null text stays
    null, an empty one empty, an empty table empty. Texts are scanned whole.
    """
    names, schema = docs.columns, docs.schema

    def redact(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        text = b.column("text")
        out = text.to_pylist()
        for i in pc.indices_nonzero(pc.fill_null(pc.match_substring_regex(text, HINT), False)).to_pylist():
            end, parts = 0, []
            for s, e, _ in find_spans(out[i]):
                if s >= end:
                    parts += [out[i][end:s], mask]
                end = max(end, e)
            out[i] = "".join([*parts, out[i][end:]])
        yield b.set_column(b.schema.get_field_index("text"), "text", pa.array(out, pa.string()))

    done = docs.mapInArrow(lambda bs: (y for b in bs if b.num_rows for y in redact(b)), schema)
    return done.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in names else done
