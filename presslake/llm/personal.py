"""Personal data: patterns propose spans, checksums confirm them, nearby words move their score.

A proposal starts with its kind's score, which says how often such a shape is what it
looks like once its checksum holds. Words of the kind within ``NEAR`` characters raise it,
words of other numbers (orders, parts, prices) lower it; what reaches ``REPORTED``
is reported. The four base kinds are always reported, whatever their score.
"""

from __future__ import annotations

import bisect
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.llm.common import map_rows, read, slices
from presslake.llm.secrets import redacted

# The base kinds, in this order, and the shapes they match. The patterns are spelled so that a run of
# their characters is walked once: possessive where nothing could be given back, never from inside a run of digits.
BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "iban", "card_short", "ssn", "nir", "dni", "tax_id", "phone_local"]
LOCAL_PART = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = range(16, 20), range(8, 16)

# Characters of an IBAN by country.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24,
    "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29,
    "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24,
    "XK": 20}
_IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=[\x20-]?[A-Z0-9])")
_IBAN_REST = re.compile(r"(?:[\x20-]?[A-Z0-9]){0,30}")
_SSN = re.compile(r"(?<![\w-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![\w-])")
_DNI = re.compile(r"(?<![A-Za-z0-9])(?:[XYZ]-?[0-9]{7}|[0-9]{8})-?[A-HJ-NP-TV-Z](?![A-Za-z0-9])")
_LOCAL = re.compile(r"(?<![\w+.,/-])\(?[0-9]{2,5}\)?(?:[\x20./-]?[0-9]{2,5}){1,5}(?![\w-]|[.,][0-9])")
#: Check letters of the Spanish numbers, by remainder.
DNI_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"

#: Where a proposal starts, after its checksum if it has one.
START = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.7, "iban": 0.8, "card_short": 0.4, "ssn": 0.3, "nir": 0.45,
         "dni": 0.35, "tax_id": 0.3, "phone_local": 0.2}
REPORTED, RAISE, LOWER, NEAR = 0.5, 0.35, 0.3, 40
#: Words that raise a kind's score, in the corpus's four languages.
WORDS = {
    "email": {"email", "mail", "courriel", "correo", "contact", "kontakt", "contacto"},
    "ip": {"ip", "host", "server", "address", "adresse", "login"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "carte", "karte", "kreditkarte", "tarjeta", "cvv", "cvc"},
    "phone": {"phone", "tel", "telephone", "mobile", "cell", "call", "fax", "whatsapp", "téléphone", "portable", "appeler",
              "telefon", "handy", "mobil", "anruf", "teléfono", "telefono", "móvil", "movil", "llamar"},
    "iban": {"iban", "account", "bank", "bic", "swift", "compte", "banque", "konto", "cuenta", "banco"},
    "ssn": {"ssn", "social", "security", "taxpayer"},
    "nir": {"nir", "sécurité", "securite", "sociale", "insee", "vitale"},
    "dni": {"dni", "nie", "nif", "documento", "identidad", "identificación"},
    "tax_id": {"steuer", "steuernummer", "steueridentifikationsnummer", "idnr", "tin"},
}
WORDS["card_short"], WORDS["phone_local"] = WORDS["card"], WORDS["phone"]
#: Words that say a number is another thing.
OTHER = {"order", "invoice", "isbn", "issn", "sku", "part", "serial", "version", "price", "total", "page", "commande", "facture",
         "prix", "bestellung", "rechnung", "preis", "seite", "pedido", "factura", "precio"}
_WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    """Whether a number's last digit is its check digit: every second digit from the right is doubled."""
    doubled = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    return (sum(map(int, digits[-1::-2])) + sum(doubled[int(d)] for d in digits[-2::-2])) % 10 == 0


def mod97(iban: str) -> bool:
    """Whether letters and digits, the first four moved to the end, A to Z as 10 to 35, leave 1 modulo 97."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def nir(digits: str) -> bool:
    """French number: sex, year, month, place, order, and a key that completes them to 97."""
    return digits[0] in "12" and (1 <= int(digits[3:5]) <= 12 or 20 <= int(digits[3:5]) <= 42) and \
        int(digits[13:]) == 97 - int(digits[:13]) % 97


def dni(number: str) -> bool:
    """Spanish number: its letter is that of the remainder modulo 23; X, Y, Z stand for 0, 1, 2."""
    return DNI_LETTERS[int(number[:-1].translate(str.maketrans("XYZ", "012"))) % 23] == number[-1]


def tax_id(digits: str) -> bool:
    """German number: eleven digits, the last by the recursive rule modulo 11 and 10, one digit repeated in the first ten."""
    if digits[0] == "0" or len(set(digits[:10])) not in (8, 9):
        return False
    product = 10
    for d in digits[:10]:
        product = (product + int(d)) % 10 or 10
        product = product * 2 % 11
    return (11 - product) % 10 == int(digits[10])


def _number(match: str) -> str:
    return "".join(c for c in match if "0" <= c <= "9")


def _emails(text: str) -> list[tuple[str, int, int]]:
    out, free = [], 0
    for m in _AT.finditer(text):
        # nothing of a local part stands before the @ before this one, or inside the match before
        low = max(free, text.rfind("@", free, m.start()) + 1)
        start = low + len(text[low:m.start()].rstrip(LOCAL_PART))
        if start < m.start():
            out.append(("email", start, m.end()))
            free = m.end()
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base kinds' matches that pass their checks, leftmost first, none overlapping within a kind."""
    out = _emails(text) if "@" in text else []
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0] and len(d := _number(m[0])) in CARD_DIGITS and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if len(_number(m[0])) in PHONE_DIGITS]
    return out


def _ibans(text: str) -> list[tuple[str, int, int]]:
    out = []
    for m in _IBAN_HEAD.finditer(text):
        size = IBAN_LENGTH.get(m[0][:2])
        if size is None or (out and m.start() < out[-1][2]):
            continue
        at, chars = m.end(), m[0]
        rest = _IBAN_REST.match(text, at)[0]
        for k, c in enumerate(rest):
            if len(chars) == size:
                break
            if c not in " -":
                chars += c
                end = at + k + 1
        after = text[end:end + 1]
        if len(chars) == size and not (after.isascii() and after.isalnum()) and mod97(chars):
            out.append(("iban", m.start(), end))
    return out


def proposed_spans(text: str) -> list[tuple[str, int, int]]:
    """What the method adds to the base kinds, before words are looked at: shapes whose checksum holds."""
    out = _ibans(text)
    for m in _DIGITS.finditer(text):
        size = m.end() - m.start()
        if not 11 <= size <= 30 or re.match(r"\w", text[m.start() - 1:m.start()]) or re.match(r"\w", text[m.end():m.end() + 1]):
            continue
        d = _number(m[0])
        if len(d) in (13, 14, 15) and d[0] in "3456" and luhn(d):
            out.append(("card_short", *m.span()))
        elif len(d) == 15 and nir(d):
            out.append(("nir", *m.span()))
        elif len(d) == 11 and tax_id(d):
            out.append(("tax_id", *m.span()))
    if "-" in text:
        out += [("ssn", *m.span()) for m in _SSN.finditer(text)]
    out += [("dni", *m.span()) for m in _DNI.finditer(text) if dni(m[0].replace("-", ""))]
    out += [("phone_local", *m.span()) for m in _LOCAL.finditer(text) if 7 <= len(_number(m[0])) <= 12]
    return out


def score(text: str, kind: str, start: int, end: int) -> float:
    """The proposal's score after the words near it: those cut by the window's ends count as they stand."""
    near = {w.lower() for w in _WORD.findall(text[max(0, start - NEAR):start])}
    if kind != "phone_local":  # whose words must come first: its shape says least
        near |= {w.lower() for w in _WORD.findall(text[end:end + NEAR])}
    return round(min(1.0, max(0.0, START[kind] + RAISE * bool(near & WORDS[kind]) - LOWER * bool(near & OTHER))), 2)


def scan_text(text: str | None) -> list[tuple[str, int, int, float]]:
    """All spans of a text with their scores, by kind as listed, then start; none for NULL.

    Of the added kinds, one that overlaps a base span or a better one of its own is left out.
    """
    if not text:
        return []
    out = [(*s, score(text, *s)) for s in base_spans(text)]
    if re.search("[0-9]{2}", text):
        more = [x for s in proposed_spans(text) if (x := (*s, score(text, *s)))[3] >= REPORTED]
        out += [s for s in more if s[0] == "iban"]  # confirmed by itself, whatever its digits look like
        starts, ends = _covered([s[1:3] for s in out])
        for s in sorted((s for s in more if s[0] != "iban"), key=lambda s: (-s[3], KINDS.index(s[0]), s[1])):
            k = bisect.bisect_left(ends, s[1] + 1)
            if k == len(ends) or starts[k] >= s[2]:
                out.append(s)
                starts.insert(k, s[1])
                ends.insert(k, s[2])
    return sorted(out, key=lambda s: (KINDS.index(s[0]), s[1]))


def _covered(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Where the runs of overlapping spans start and end."""
    starts, ends = [], []
    for a, b in sorted(spans):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def scan_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, spans)`` for every row: ``spans`` lists (kind, start, end, score) in code points, end exclusive.

    NULL and empty texts have none; very long texts are scanned whole, in time in proportion to their
    length; repeated rows and NULL ids stay rows of their own; no rows give none; other columns are not read.
    """
    def run(batch: pa.RecordBatch):
        for part in slices(batch):
            found = [[dict(zip(("kind", "start", "end", "score"), s)) for s in scan_text(t)] for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, _SPAN)], ["id", "spans"])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_rows(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, "
                               "spans array<struct<kind:string,start:bigint,end:bigint,score:double>>")


def redact_personal_data(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data replaced in its text by the kind in brackets. Every row and every other
    column stays as it is; NULL and empty texts stay; overlapping spans give way to the first one's kind; no rows give none."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                texts = part.column(at).to_pylist()
                new = [redacted(t, sorted((s[:3] for s in scan_text(t)), key=lambda s: s[1:])) if t else t for t in texts]
                columns = list(part.columns)
                columns[at] = pa.array(new, pa.string())
                yield pa.RecordBatch.from_arrays(columns, part.schema.names)
    return docs.mapInArrow(run, docs.schema)


def _joined(spans: list[dict]) -> str:
    return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: counts and digest of the base spans, and all spans, of every document."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = batch.column(1).to_pylist()
        base = [[s for s in x if s["kind"] in BASE_KINDS] for x in spans]
        counts = [pa.array([sum(s["kind"] == k for s in x) for x in base], pa.int64()) for k in BASE_KINDS]
        digest = [hashlib.sha256(_joined(x).encode()).hexdigest() for x in base]
        return pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(digest, pa.string()),
                                           pa.array(map(_joined, spans), pa.string())],
                                          ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])
    return map_rows(scan_personal_data(read(spark, sf_dir, "documents")), run,
                    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
