"""Personal data: patterns propose spans, checksums confirm them, context words move the score.

Base kinds are email, ip, card and phone; iban, national_id and secret (keys and tokens) are added
by the method. Base spans stay whatever their score; an added kind without a checksum counts only
with a context word.
Offsets are code points, ends exclusive. A null text counts as empty and has no spans.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "national_id", "secret")

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_SECRET = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+={0,2}(?![A-Za-z0-9_-])")
_WORD = re.compile(r"[^\W\d_]+")

#: Words that raise a kind's score when they stand within ``REACH`` code points of a span.
CONTEXT = {
    "email": {"email", "mail", "contact", "address", "write", "correo", "courriel"},
    "ip": {"ip", "host", "server", "address", "login", "client"},
    "card": {"card", "credit", "visa", "mastercard", "payment", "tarjeta", "carte", "karte"},
    "phone": {"phone", "tel", "call", "mobile", "fax", "telefon", "teléfono"},
    "iban": {"iban", "account", "bank", "transfer", "konto", "cuenta", "compte"},
    "national_id": {"ssn", "social", "security", "id", "tax"},
    "secret": {"token", "secret", "key", "apikey", "password", "passwd", "bearer", "credential", "authorization"},
}
#: Words that lower a score: the digits are likely something else.
AGAINST = {"example", "sample", "version", "order", "isbn", "build", "test"}
REACH = 40
START = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "national_id": 0.3, "secret": 0.3}
STEP = 0.2
#: An added kind without a checksum counts only at this score, that is, with a context word.
LEAST, UNCHECKED = 0.5, ("national_id", "secret")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    rest = 0
    for c in turned:
        n = int(c, 36)
        rest = (rest * (100 if n > 9 else 10) + n) % 97
    return rest == 1


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Accounts in one piece or in groups of four; groups at the end that the checksum does not cover
    (a word in capitals that follows) are left out."""
    for m in _IBAN.finditer(text):
        ends = [m.end(), *(m.start() + i for i in range(len(m[0]) - 1, 0, -1) if m[0][i] == " ")]
        for end in ends:
            bare = text[m.start() : end].replace(" ", "")
            if len(bare) >= 15 and mod97(bare):
                yield m.start(), end
                break


def is_random(s: str) -> bool:
    """Whether a run of characters looks drawn rather than written: letters and at least two digits,
    and over 3 bits for each character."""
    if sum(map(str.isdigit, s)) < 2 or not any(map(str.isalpha, s)):
        return False
    counts = [s.count(c) for c in set(s)]
    return -sum(n / len(s) * math.log2(n / len(s)) for n in counts) > 3


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, in time linear in the text: a match holds one @, and
    of the starts before it the first of the run of local characters is the leftmost."""
    free, last, at = 0, -1, text.find("@")
    while at >= 0:
        if at >= free:
            before = text[max(free, last + 1) : at]
            own = len(before) - len(before.rstrip(_LOCAL))
            if own and (m := _DOMAIN.match(text, at + 1)):
                yield at - own, m.end()
                free = m.end()
        last, at = at, text.find("@", at + 1)


def _ip_ok(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in s.split("."))


def spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score), kinds in the order of ``KINDS``, then by start."""
    if not text:
        return []
    found = [("email", a, b) for a, b in emails(text)]
    if any(d in text for d in "0123456789"):
        found += [("ip", *m.span()) for m in _IP.finditer(text) if _ip_ok(m[0])]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= sum(map(m[0].count, "0123456789")) <= 15]
        found += [("iban", a, b) for a, b in ibans(text)]
        if "-" in text:
            found += [("national_id", *m.span()) for m in _NATIONAL.finditer(text)]
        found += [("secret", *m.span()) for m in _SECRET.finditer(text) if is_random(m[0])]
    out = []
    for kind, a, b in found:
        near = {w.lower() for w in _WORD.findall(text[max(0, a - REACH) : a])} | {
            w.lower() for w in _WORD.findall(text[b : b + REACH])
        }
        score = START[kind] + STEP * bool(near & CONTEXT[kind]) - STEP * bool(near & AGAINST)
        if kind not in UNCHECKED or score >= LEAST - 1e-9:
            out.append((kind, a, b, round(min(1.0, max(0.0, score)), 3)))
    return out


def redact(text: str | None) -> str | None:
    """The text with every span replaced by its kind in angle brackets. Of spans that overlap
    the one that starts first counts, at equal starts the longer; the overlap's rest goes too."""
    found = sorted(spans(text), key=lambda s: (s[1], -s[2]))
    if not found:
        return text
    out, at = [], 0
    for kind, a, b, _ in found:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id and ``found``, an array of (kind, start, end, score, value).

    A null or empty text gives an empty array; a null id stays null; repeated rows stay
    repeated; an empty table gives no rows; other columns are ignored, whatever their names.
    Matching is linear in the text but for the bounded patterns, so very long texts and words
    are no special case.
    """

    def run(frames):
        for f in frames:
            found = [[(k, a, b, s, t[a:b]) for k, a, b, s in spans(t)] for t in f["_t"]]
            yield pd.DataFrame({"_id": f["_id"], "found": found})

    kind = docs.schema[id_col].dataType.simpleString()
    item = "array<struct<kind:string,start:int,end:int,score:double,value:string>>"
    own = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_t"))
    return own.mapInPandas(run, f"_id {kind}, found {item}").withColumnRenamed("_id", id_col)


def redact_documents(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with the spans of every text replaced. Columns, order and types stay;
    ``chars_col``, if there is one, becomes the new text's length. Null texts stay null."""
    replace = F.pandas_udf(lambda s: s.map(redact), "string")
    new = {text_col: replace(F.col(text_col).cast("string"))}
    out = docs.withColumns(new)
    if chars_col in docs.columns:
        length = F.length(text_col).cast(docs.schema[chars_col].dataType)
        out = out.withColumn(chars_col, F.coalesce(length, F.col(chars_col)))
    return out.select(*docs.columns)


def joined(spans_: list[tuple[str, int, int, float]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b, *_ in spans_ if k in kinds)


def op1_pii(spark, sf_dir):
    """Counts, digest, span list and the spans' scores of every document, from what ``detect`` finds."""
    from .common import table

    found = detect(table(spark, sf_dir, "documents"))

    def listed(kinds):
        own = F.filter("found", lambda x: x["kind"].isin(*kinds))
        return F.array_join(F.transform(own, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in BASE],
        F.sha2(listed(BASE).cast("binary"), 256).alias("base_sha256"),
        listed(KINDS).alias("spans"),
        F.array_join(F.transform("found", lambda x: x["score"].cast("string")), ",").alias("scores"),
    )
