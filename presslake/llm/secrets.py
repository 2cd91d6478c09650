"""Secret scan: patterns, then structural confirmation of what they hide."""

from __future__ import annotations

import base64
import binascii
import bisect
import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.llm.common import map_rows, read, slices

# The base patterns, and the order of kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_MIN = 8
# `+` with a least length of the whole run is the same as a least count: the run starts and ends alike.
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ["assign", "access", "hex", "jwt", "pem", "der", "sshkey"]
BASE_KINDS = KINDS[:3]

# Candidates of the structural kinds.
_JWT = re.compile(r"(?<![A-Za-z0-9_-])ey[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*(?![A-Za-z0-9_-])")
_PEM_MARK = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,30}PRIVATE KEY)-----")
_DEK = re.compile(r"^DEK-Info:[ \t]*([A-Za-z0-9-]+)(?:,[ \t]*[0-9A-Fa-f]+)?$")
_B64 = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40,}={0,2}(?![A-Za-z0-9+/=])")
_HEX_ANY = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{2}){32,}(?![0-9A-Za-z])|(?<![0-9A-Za-z])(?:[0-9A-F]{2}){32,}(?![0-9A-Za-z])")
_SSH_MAGIC = b"openssh-key-v1\x00"
# Wrapped base64, either alphabet: where a key may start, its pieces, what may stand between them (white space, escaped
# line ends, quoting marks, the seam of two string literals), and its padding.
_HEAD = re.compile(r"""M(?:(?<![A-Za-z0-9+/]M)|(?<=\\[nrt]M))(?=[A-P\s\\"'])|"""
                   r"""b(?:(?<![A-Za-z0-9+/]b)|(?<=\\[nrt]b))(?=3(?:B[l\s\\"']|[\s\\"'])|[\s\\"'])""")
_PIECE = re.compile(r"[A-Za-z0-9+/_-]+")
_SEAM = re.compile(r"""(?:\s|\\+(?:[nrt]|(?=[\s/]))|(?<=\n)[>#*|]+|["'][ \t]*(?:[+,.&][ \t]*)?\\?\r?\n\s*["'])+""")
_PAD = re.compile(r"(?:(?:\s|\\+[nrt])*(?:=|\\+u003[dD])){0,2}(?![A-Za-z0-9+/=])")
# A sequence that starts with the integer 0 or 1, by the size of its length; the magic of an OpenSSH key.
_DER_HEAD = re.compile(rb"M(?:[A-H].CAQ[A-H]|I(?:[E-H].AgE[AB]|[I-L]..[AQgw]IBA|[M-P]....CAQ[A-H]|[Q-T].{5}AgE[AB]))")
_SSH_HEAD = b"b3BlbnNzaC1rZXktdjE"
_STANDARD = bytes.maketrans(b"-_", b"+/")


def _b64(text: str, url: bool = False) -> bytes | None:
    text = text.rstrip("=")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), altchars=b"-_" if url else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def _tlv(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, where its content starts and ends) of the DER element at ``at``; None if its length does not fit."""
    if at + 2 > end:
        return None
    tag, n = data[at], data[at + 1]
    at += 2
    if n >= 0x80:
        size = n & 0x7F
        if not 1 <= size <= 4 or at + size > end:
            return None
        n = int.from_bytes(data[at:at + size], "big")
        if n < 0x80 or data[at] == 0:  # DER: the shortest form
            return None
        at += size
    return (tag, at, at + n) if at + n <= end else None


def _children(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements between; None if their lengths do not fit, or for more of them than any key has."""
    out = []
    while start < end:
        x = _tlv(data, start, end)
        if x is None or len(out) == 16:
            return None
        out.append(x)
        start = x[2]
    return out


def _is_algorithm(data: bytes, start: int, end: int) -> bool:
    """Whether an object identifier and at most one element of parameters stand there."""
    parts = _children(data, start, end)
    if not parts or len(parts) > 2 or parts[0][0] != 0x06:
        return False
    oid = data[parts[0][1]:parts[0][2]]
    if not oid or oid[-1] >= 0x80 or any(b == 0x80 and (k == 0 or oid[k - 1] < 0x80) for k, b in enumerate(oid)):
        return False
    return len(parts) == 1 or parts[1][0] != 0x30 or _children(data, *parts[1][1:]) is not None


def is_der_key(data: bytes) -> bool:
    """Whether the bytes are a DER private key: one sequence whose nested lengths all
    fit and whose fields are those of PKCS#8 (of any algorithm), PKCS#1, DSA or SEC 1."""
    top = _tlv(data, 0, len(data))
    if top is None or top[0] != 0x30 or top[2] != len(data):
        return False
    parts = _children(data, top[1], top[2])
    if not parts or parts[0][0] != 0x02:
        return False
    tags, version = [p[0] for p in parts], data[parts[0][1]:parts[0][2]]
    if tags[:3] == [0x02, 0x30, 0x04] and version in (b"\0", b"\1"):  # PKCS#8: version, algorithm, octets
        return parts[2][2] > parts[2][1] and _is_algorithm(data, *parts[1][1:])
    if tags == [0x02] * 6 and version == b"\0":  # DSA: version, p, q, g, public, private
        return parts[1][2] - parts[1][1] >= 32
    if len(tags) >= 9 and set(tags[:9]) == {0x02} and version in (b"\0", b"\1"):  # PKCS#1: nine integers
        return parts[1][2] - parts[1][1] >= 32
    if tags[:2] == [0x02, 0x04] and version == b"\1":  # SEC 1: version, octets, tagged fields
        return 16 <= parts[1][2] - parts[1][1] <= 72 and all(t in (0xA0, 0xA1) for t in tags[2:])
    return False


def is_ssh_key(data: bytes) -> bool:
    """Whether the bytes are an OpenSSH private key: the magic, then three
    length-prefixed names, a key count and the public part, all within the data."""
    if data[:len(_SSH_MAGIC)] != _SSH_MAGIC:
        return False
    at = len(_SSH_MAGIC)
    for k in range(5):
        if at + 4 > len(data):
            return False
        n = int.from_bytes(data[at:at + 4], "big")
        at += 4
        if k == 3:  # the number of keys, not a length
            if not 1 <= n <= 16:
                return False
        else:
            at += n
        if at > len(data):
            return False
    return True


def is_jwt(token: str) -> bool:
    """Whether a dotted token's first part decodes to a JSON object with an
    algorithm and its second to JSON, and its signature decodes."""
    head, body, sign = token.split(".")
    raw = [_b64(x, url=True) for x in (head, body, sign)]
    if any(x is None for x in raw):
        return False
    try:
        header, claims = json.loads(raw[0]), json.loads(raw[1])
    except (ValueError, RecursionError):
        return False
    if not isinstance(header, dict) or not isinstance(header.get("alg"), str) or not isinstance(claims, dict):
        return False
    return bool(raw[2]) or header["alg"].lower() == "none"


def _key_bytes(data: bytes | None) -> str | None:
    if data is None:
        return None
    return "der" if is_der_key(data) else "sshkey" if is_ssh_key(data) else None


def _line(x: str) -> str:
    """A line of armour without indentation, quoting marks and the ends of string literals."""
    x = x.strip(" \t\r\\")
    if x[-1:] in ("+", ",", ".", ";", "&") and x[:-1].rstrip()[-1:] in ('"', "'"):
        x = x[:-1].rstrip()
    if x[:1] in ("+", ".", "&") and x[1:].lstrip()[:1] in ('"', "'"):
        x = x[1:]
    return x.rstrip("\"' \t\\").lstrip(" \t>#*|\"'")


def _is_armoured(label: str, body: str) -> bool:
    """Whether what stands between the marks is a key: header lines, if any, then base64.
    Line ends may be real or escaped. A body that its headers call encrypted need only
    be whole blocks of the cipher."""
    body = re.sub(r"\\+u00([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), body)
    lines = [_line(x) for x in re.sub(r"\\+[nrt]|\r", "\n", re.sub(r"\\+/", "/", body)).split("\n")]
    first = max((k + 1 for k, x in enumerate(lines) if ":" in x), default=0)
    starts = [first]
    if first and "" in lines[first:]:  # or after the lines that continue a header
        starts.append(lines.index("", first))
    for k in starts:
        data = _b64("".join("".join(lines[k:]).split()).translate({45: "+", 95: "/"}))
        if not data:
            continue
        if _key_bytes(data) or (label.startswith("ENCRYPTED") and data[0] == 0x30 and _tlv(data, 0, len(data)) is not None):
            return True
        cipher = next((m[1] for x in lines[:first] if (m := _DEK.match(x))), None)
        if cipher and len(data) >= 16 and (len(data) % 8 == 0 or not cipher.upper().endswith(("CBC", "ECB"))):
            return True
    return False


class _Run:
    """Base64 characters from a place of a text on, read as far as asked, across seams."""

    def __init__(self, text: str, at: int):
        self.text, self.end, self.chars = text, at, bytearray()
        self.places, self.counts = [], []  # of each piece: where it starts, in the text and in ``chars``

    def reaches(self, n: int) -> bool:
        while len(self.chars) < n:
            at = self.end
            if self.places and (seam := _SEAM.match(self.text, at)):
                at = seam.end()
            elif self.places:
                return False
            piece = _PIECE.match(self.text, at)
            if piece is None:
                return False
            self.places.append(at)
            self.counts.append(len(self.chars))
            self.chars += piece[0].encode().translate(_STANDARD)
            self.end = piece.end()
        return True

    def index(self, at: int) -> int:
        k = bisect.bisect_right(self.places, at) - 1
        return self.counts[k] + at - self.places[k]

    def after(self, n: int) -> int:
        """The text's place behind the first ``n`` characters."""
        k = bisect.bisect_left(self.counts, n) - 1
        return self.places[k] + n - self.counts[k]


class _Bytes:
    """``n`` bytes that a run holds from character ``first`` on; only what is read is decoded."""

    def __init__(self, run: _Run, first: int, n: int):
        self.run, self.first, self.n, self.need = run, first, n, -(-4 * n // 3)

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, at):
        if isinstance(at, int):
            return self[at:at + 1][0]
        a, b, _ = at.indices(self.n)
        cut = self.run.chars[self.first + a // 3 * 4:self.first + min(self.need, -(-b // 3) * 4)]
        return base64.b64decode(cut + b"=" * (-len(cut) % 4))[a % 3:a % 3 + b - a] if b > a else b""


def _ssh_size(data: _Bytes) -> int | None:
    """Bytes of an OpenSSH key by its own lengths: names, keys, private part, tag of the cipher."""
    if not is_ssh_key(data):
        return None
    at, left, cipher = len(_SSH_MAGIC), 3, b""
    for part in ("names", "keys", "private"):
        for _ in range(left):
            if at + 4 > len(data):
                return None
            size = int.from_bytes(data[at:at + 4], "big")
            cipher = cipher or data[at + 4:at + 4 + min(size, 64)]
            at += 4 + size
        if part == "names":
            left = int.from_bytes(data[at:at + 4], "big")
            at += 4
        else:
            left = 1
    at += 16 if b"gcm" in cipher or b"poly1305" in cipher else 0
    return at if at <= len(data) else None


def _head(text: str, at: int) -> bytes:
    """The first characters of a run, as many as the longest head has, however much stands between them."""
    chars = ""
    while len(chars) < len(_SSH_HEAD):
        piece = _PIECE.match(text, at, at + len(_SSH_HEAD) - len(chars))
        if piece is None:
            break
        chars += piece[0]
        seam = _SEAM.match(text, piece.end())
        at = seam.end() if seam else piece.end()
    return chars.encode().translate(_STANDARD)


def _wrapped(text: str) -> list[tuple[str, int, int]]:
    """Keys in base64 of either alphabet, on one line or several. Their own lengths say where
    they end, so words around them do not matter; only lengths are read on the way."""
    out, run = [], None
    for m in _HEAD.finditer(text):
        at = m.start()
        look = _head(text, at)
        ssh = look.startswith(_SSH_HEAD)
        if not ssh and not _DER_HEAD.match(look):
            continue
        if run is None or at >= run.end:
            run = _Run(text, at)
            run.reaches(1)
        first = run.index(at)
        if ssh:
            while run.reaches(len(run.chars) + 1):
                pass
            size = _ssh_size(_Bytes(run, first, (len(run.chars) - first) * 3 // 4))
        else:
            if not run.reaches(first + 12):
                continue
            top = _Bytes(run, first, 9)
            size = 2 + top[1] if top[1] < 0x80 else 2 + top[1] % 128 + int.from_bytes(top[2:2 + top[1] % 128], "big")
        if size is None or size < 30:
            continue
        data = _Bytes(run, first, size)
        if not run.reaches(first + data.need) or not (ssh or is_der_key(data)):
            continue
        end = _PAD.match(text, run.after(first + data.need))
        if end:
            out.append(("sshkey" if ssh else "der", at, end.end()))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_MIN]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return out


def confirmed_spans(text: str) -> list[tuple[str, int, int]]:
    """Candidates that decode to a key or a signed token; nothing else is reported."""
    out, taken = [], []
    if "-----BEGIN " in text:
        begin = None
        for m in _PEM_MARK.finditer(text):
            if m[1] == "END" and begin and begin[2] == m[2] and _is_armoured(m[2], text[begin.end():m.start()]):
                out.append(("pem", begin.start(), m.end()))
                taken.append(out[-1][1:])
            begin = m if m[1] == "BEGIN" else None
    for kind, a, b in _wrapped(text):
        if not any(x <= a < y for x, y in taken):
            out.append((kind, a, b))
            taken.append((a, b))
    if "ey" in text:
        out += [("jwt", *m.span()) for m in _JWT.finditer(text) if is_jwt(m[0])]
    for pattern, decode in ((_B64, _b64), (_HEX_ANY, bytes.fromhex)):
        for m in pattern.finditer(text):
            if any(a <= m.start() < b for a, b in taken):
                continue
            kind = _key_bytes(decode(m[0]))
            if kind:
                out.append((kind, *m.span()))
    return out


def _ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan_text(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of a text, by start, then kind; none for NULL."""
    return _ordered(base_spans(text) + confirmed_spans(text)) if text else []


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, spans)`` for every row: ``spans`` lists (kind, start, end) in code points,
    end exclusive. NULL and empty texts have none; repeated rows and NULL ids stay
    rows of their own; no rows give none; other columns are not read."""
    def run(batch: pa.RecordBatch):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for part in slices(batch):
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in scan_text(t)]
                     for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, kind)], ["id", "spans"])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_rows(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, "
                               "spans array<struct<kind:string,start:bigint,end:bigint>>")


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each run of overlapping spans replaced by ``[kind]`` of its first."""
    out, at, i = [], 0, 0
    while i < len(spans):
        kind, start, end = spans[i]
        while i + 1 < len(spans) and spans[i + 1][1] < end:
            i += 1
            end = max(end, spans[i][2])
        out += [text[at:start], f"[{kind}]"]
        at = end
        i += 1
    return "".join(out) + text[at:]


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets replaced in ``text`` by their kind in brackets, and ``n_chars``
    that of the new text where the text changed. Every row stays."""
    names = docs.columns
    at, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batch: pa.RecordBatch):
        for part in slices(batch):
            texts = part.column(at).to_pylist()
            new = [redacted(t, s) if t and (s := scan_text(t)) else t for t in texts]
            columns = list(part.columns)
            columns[at] = pa.array(new, pa.string())
            if chars is not None:
                columns[chars] = pa.array([len(b) if b != a else n for a, b, n in
                                           zip(texts, new, part.column(chars).to_pylist())], part.schema.types[chars])
            yield pa.RecordBatch.from_arrays(columns, names)
    return docs.mapInArrow(lambda batches: (out for b in batches for out in run(b)), docs.schema)


def _joined(spans: list[dict]) -> str:
    return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: counts and digest of the base spans, and all spans, of every document."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = batch.column(1).to_pylist()
        base = [[s for s in x if s["kind"] in BASE_KINDS] for x in spans]
        counts = [pa.array([sum(s["kind"] == k for s in x) for x in base], pa.int64()) for k in BASE_KINDS]
        digest = [hashlib.sha256(_joined(x).encode()).hexdigest() for x in base]
        return pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(digest, pa.string()),
                                           pa.array(map(_joined, spans), pa.string())],
                                          ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
    return map_rows(scan_secrets(read(spark, sf_dir, "documents")), run,
                    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
