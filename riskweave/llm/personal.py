"""Personal data: patterns propose spans, checksums confirm them, nearby words weigh them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from riskweave.llm.text import slices

# In the order in which spans of one start are listed. The first four always
# stay once their own tests hold, whatever their score.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "local_phone")

# The patterns. Starts inside a run of digits are left out by
# look-behind, so that a long run that fails is not tried again at each digit.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+.-])(?:\([0-9]{2,5}\)|[0-9]{2,5})[\x20./-][0-9](?:[\x20.-]?[0-9]){4,9}(?![0-9.-])")

# Lengths of account numbers by country.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "ES": 24, "FI": 18,
    "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18,
    "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24,
    "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VG": 24, "XK": 20,
}

# What a match of the pattern weighs, what a checksum adds and what a context
# word nearby adds, in hundredths.
PATTERN = {"email": 80, "ip": 60, "card": 40, "phone": 60, "iban": 30, "ssn": 20, "local_phone": 20}
CHECKSUM = 40
CONTEXT = 40
# Context words speak for spans that start or end so many code points away.
BEFORE, AFTER = 48, 24

# Context words in the four languages of the data, lower case.
WORDS = {
    "email": ("email", "e-mail", "mail", "correo", "courriel"),
    "ip": ("ip", "address", "host", "server", "adresse"),
    "card": ("card", "credit", "visa", "mastercard", "karte", "kreditkarte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "telephone", "mobile", "call", "fax", "telefon", "handy", "téléphone", "teléfono", "móvil"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security"),
    "local_phone": ("phone", "tel", "telephone", "mobile", "call", "fax", "telefon", "handy", "téléphone", "teléfono", "móvil"),
}
NEAR = {k: re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, w)) + r")(?!\w)", re.IGNORECASE) for k, w in WORDS.items()}

SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])


def luhn(digits: str) -> bool:
    """Every second digit from the right doubled, its own digits summed: a multiple of ten."""
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def mod_97(account: str) -> bool:
    """The first four characters last, letters as 10 to 35: one more than a multiple of 97."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at sign back over the local part and on over the domain: linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def _small(part: str) -> bool:
    return len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255


def proposals(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, has a checksum) of every match whose tests hold, of a kind without overlaps."""
    for start, end in _emails(text):
        yield "email", start, end, False
    for m in IP.finditer(text):
        if all(map(_small, m.groups())):
            yield "ip", *m.span(), False
    for m in CARD.finditer(text):
        if 14 <= len(m[0]) <= 37 and 14 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
            yield "card", *m.span(), True
    for m in PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            yield "phone", *m.span(), False
    for m in IBAN.finditer(text):
        # The pattern also takes in capitals that follow: the country says where the number ends.
        account, end = "", m.start()
        while end < m.end() and len(account) < IBAN_LENGTH.get(text[m.start() : m.start() + 2], 0):
            account += text[end].strip()
            end += 1
        whole = end == m.end() or text[end] == " "
        if whole and len(account) == IBAN_LENGTH.get(account[:2]) and mod_97(account):
            yield "iban", m.start(), end, True
    for m in SSN.finditer(text):
        if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000":
            yield "ssn", *m.span(), False
    for m in LOCAL_PHONE.finditer(text):
        if 7 <= len(_digits(m[0])) <= 12:
            yield "local_phone", *m.span(), False


def find_spans(text: str | None, threshold: float = 0.6) -> list[tuple[str, int, int, float]]:
    """Spans by start, then kind: all of the four base kinds, others that reach the threshold.

    The score is the pattern's weight, more with a checksum, more with a context
    word of the kind nearby. A span of another kind that overlaps a base span is
    that datum seen twice and goes.
    """
    found, taken = [], []
    for kind, start, end, checked in proposals(text or ""):
        near = NEAR[kind].search(text[max(0, start - BEFORE) : start]) or NEAR[kind].search(text[end : end + AFTER])
        score = min(100, PATTERN[kind] + CHECKSUM * checked + CONTEXT * bool(near)) / 100
        if kind in BASE:
            taken.append((start, end))
            found.append((start, KINDS.index(kind), end, score))
        elif score >= threshold:
            found.append((start, KINDS.index(kind), end, score))
    taken.sort()
    kept, at = [], 0
    for start, kind, end, score in sorted(found):
        if KINDS[kind] not in BASE:
            while at < len(taken) and taken[at][1] <= start:
                at += 1
            if any(a < end for a, b in taken[at : at + len(BASE)] if b > start):
                continue
        kept.append((KINDS[kind], start, end, score))
    return kept


def find_personal_data(
    docs: DataFrame, threshold: float = 0.6, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row ``doc_id``, ``text`` and ``found``, an array of (kind, start, end, score).

    Offsets are code points, the end is exclusive. Rows are independent: equal
    rows get equal results, a null or empty text has no spans, a null id stays
    null, an empty table gives no rows. Texts are scanned whole, in time linear
    in their length. Columns of other names are not looked at.
    """
    named = docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"cast(`{text_col}` as string) as text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            spans = [
                [dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in find_spans(text, threshold)]
                for text in batch["text"].to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text"], pa.array(spans, pa.list_(SPAN))], names=["doc_id", "text", "found"]
            )

    spans = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"
    return named.mapInArrow(scan, f"doc_id bigint, text string, found {spans}")
