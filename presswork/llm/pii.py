"""Personal data: patterns propose spans, checksums confirm them, context weighs them.

All patterns run in time linear in the text: an e-mail is found from its ``@`` outwards,
and no pattern can start again inside the run it has just failed on. Offsets are code
points, ends are exclusive.

Base kinds (email, ip, card, phone) are reported whenever their own test passes. Further
kinds (iban, ssn, tel) are reported when their score, after words close to the span have
raised or lowered it, reaches ``min_score`` and no base span overlaps them.

Defined cases: null and empty texts have no spans; whole texts of any length are read;
every row is treated by itself, so null or repeated ids and empty tables need no care;
other columns pass through.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm.common import table

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "tel")
SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"
MIN_SCORE = 0.5
CONTEXT_CHARS = 48

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
#: A look-behind after the first digit keeps to the start of a run of digits.
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"[A-Z](?<![A-Za-z0-9][A-Z])[A-Z][0-9]{2}(?: ?[A-Z0-9]){11,30}")
SSN = re.compile(r"[0-9](?<![0-9-][0-9])[0-9]{2}-[0-9]{2}-[0-9]{4}(?![0-9-])")
TEL = re.compile(r"\(?[0-9](?<![0-9+][0-9])[0-9]{2}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
NOT_DIGITS = re.compile("[^0-9]+")

# Lengths of account numbers by country, from the public registry.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20,
    "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21,
    "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SA": 24,
    "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26,
}

#: Score of a confirmed span before its context is looked at.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.4, "tel": 0.4}
FOR = {
    "email": ("mail", "contact", "write", "e-mail", "correo", "schreib"),
    "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "mastercard", "credit", "tarjeta", "karte", "carte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "teléfono", "téléphone"),
    "iban": ("iban", "bank", "account", "konto", "cuenta", "compte"),
    "ssn": ("ssn", "social", "security"),
    "tel": ("phone", "tel", "call", "mobile", "fax", "telefon", "teléfono", "téléphone"),
}
AGAINST = {
    "ip": ("version", "release", "section"),
    "card": ("isbn", "tracking", "serial", "order"),
    "ssn": ("part", "serial", "order", "isbn"),
    "tel": ("isbn", "serial", "order"),
}


def _any_word(words: tuple[str, ...]) -> re.Pattern:
    return re.compile(r"\b(?:" + "|".join(map(re.escape, words)) + r")\b", re.IGNORECASE)


FOR_WORDS = {kind: _any_word(words) for kind, words in FOR.items()}
AGAINST_WORDS = {kind: _any_word(words) for kind, words in AGAINST.items()}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) << (i & 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def mod97(iban: str) -> bool:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    at, floor = text.find("@"), 0
    while at >= 0:
        before = text[floor:at]
        local = len(before) - len(before.rstrip(LOCAL))
        floor = at + 1
        if local and (m := DOMAIN.match(text, at + 1)):
            yield at - local, m.end()
            floor = m.end()
        at = text.find("@", floor)


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(digits := NOT_DIGITS.sub("", m[0])) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 10 <= len(NOT_DIGITS.sub("", m[0])) <= 15:
            yield m.span()


def ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in IBAN.finditer(text):
        length, taken, end = IBAN_LENGTHS.get(m[0][:2], 0), [], m.start()
        for c in m[0]:
            if len(taken) == length:
                break
            end += 1
            if c != " ":
                taken.append(c)
        rest = text[end : end + 1]
        if length and len(taken) == length and not rest.isalnum() and mod97("".join(taken)):
            yield m.start(), end


def ssns(text: str) -> Iterator[tuple[int, int]]:
    for m in SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


def tels(text: str) -> Iterator[tuple[int, int]]:
    return (m.span() for m in TEL.finditer(text))


FINDERS = {"email": emails, "ip": ips, "card": cards, "phone": phones, "iban": ibans, "ssn": ssns, "tel": tels}


def score(kind: str, text: str, start: int, end: int) -> float:
    """Prior of the kind, raised or lowered by words close to the span."""
    near = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]
    value = PRIOR[kind] + 0.3 * bool(FOR_WORDS[kind].search(near))
    if kind in AGAINST_WORDS and AGAINST_WORDS[kind].search(near):
        value -= 0.3
    return round(min(1.0, max(0.0, value)), 2)


def find(text: str, min_score: float = MIN_SCORE) -> list[tuple[str, int, int, float]]:
    """Spans ``(kind, start, end, score)`` of one text by start, then kind."""
    found, taken = [], []
    kinds = KINDS if any(d in text for d in "0123456789") else ("email",)
    for kind in kinds:
        base = kind in BASE_KINDS
        for start, end in FINDERS[kind](text):
            value = score(kind, text, start, end)
            if base or value >= min_score:
                (found if base else taken).append((kind, start, end, value))
    found.sort(key=lambda x: x[1])
    if taken:
        # Base spans may overlap each other, so compare with the furthest end so far.
        ordered, i, reach, kept = sorted(taken, key=lambda x: (x[1], KINDS.index(x[0]))), 0, -1, []
        for span in ordered:
            while i < len(found) and found[i][1] < span[2]:
                reach = max(reach, found[i][2])
                i += 1
            if reach <= span[1]:
                kept.append(span)
                reach = max(reach, span[2])
        found += kept
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def spans(text: Column, min_score: float = MIN_SCORE) -> Column:
    """Array of spans of a text column, with scores."""

    @F.arrow_udf(SPAN)
    def of(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        names = ("kind", "start", "end", "score")
        rows = [[dict(zip(names, s, strict=True)) for s in find(t or "", min_score)] for t in texts.to_pylist()]
        return pa.array(rows, type=kind)

    return of(text)


def hide(text: str, found: list[tuple[str, int, int, float]]) -> str:
    """``text`` with each span replaced by its kind; overlapping spans become one."""
    parts, at, i = [], 0, 0
    while i < len(found):
        kind, start, end, _ = found[i]
        i += 1
        while i < len(found) and found[i][1] < end:
            end = max(end, found[i][2])
            i += 1
        parts += [text[at:start], f"<{kind.upper()}>"]
        at = end
    return "".join(parts) + text[at:]


def redacted(text: Column, min_score: float = MIN_SCORE) -> Column:
    """The text with personal data replaced by ``<KIND>``; null stays null."""

    @F.arrow_udf("string")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([t if not t else hide(t, find(t, min_score)) for t in texts.to_pylist()], type=pa.string())

    return of(text)


def find_pii(docs: DataFrame, min_score: float = MIN_SCORE, text: str = "text") -> DataFrame:
    """``docs`` with a column ``spans`` (replaced if there is one)."""
    return docs.withColumn("spans", spans(F.col(text), min_score))


def redact_pii(docs: DataFrame, min_score: float = MIN_SCORE, text: str = "text") -> DataFrame:
    """``docs`` with personal data replaced in ``text``."""
    return docs.withColumn(text, redacted(F.col(text), min_score))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    spelled = lambda found: F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return docs.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(spelled(base).cast("binary"), 256).alias("base_sha256"),
        spelled(F.col("spans")).alias("spans"),
    )


def spelled_digest(found: list[tuple[str, int, int]]) -> str:
    """Digest of base spans as ``op8_pii`` returns it."""
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in found).encode()).hexdigest()


QUERIES = {"op8_pii": op8_pii}
ORACLES: dict[str, str] = {}
