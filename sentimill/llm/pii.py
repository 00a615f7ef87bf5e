"""Personal data by anchor expansion.

Method: one Aho-Corasick pass over a text finds anchors (at-signs, schemes, digits, plus signs and
identifier cues); a local parser for the anchor's kind expands it to the left and right and validates
it.  Parsers are deterministic and linear: none looks at a stretch of text twice.

Base kinds, leftmost and not overlapping within a kind, are given by the patterns of the contract:
email, ip, card, phone.  The method adds
* ``email``: addresses with letters outside ASCII,
* ``account``: IBANs (checksum 97), social security and account numbers that follow their cue,
* ``secret``: access keys and values assigned to password, token and similar words,
* ``url``: addresses that carry user information, and ``tel:`` numbers.
Places are code points, the end exclusive.

Null and empty texts have no spans.  A null doc_id is kept, repeated rows give repeated results, an empty table
gives none, other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentimill.llm.common import map_batches

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "account", "secret", "url")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_WIDE_DOMAIN = re.compile(r"[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile("[0-9]+")
_IBAN = re.compile(r"[\s:#]*([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
_SSN = re.compile(r"[\s:#]*([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])")
_ACCOUNT = re.compile(r"(?: ?(?:number|no\.?|nr\.?|num\.?))?[\s:#]{1,3}([0-9](?:[ -]?[0-9]){5,17})(?![0-9])", re.I)
_KEY = re.compile(r"[A-Z0-9]{16}(?![A-Za-z0-9])")
_VALUE = re.compile(r"\s?[=:]\s?[\"']?([A-Za-z0-9+/_=.-]{8,})")
_TEL = re.compile(r"(\+?[0-9][0-9().-]{5,20}[0-9])")
_AUTHORITY = re.compile(r"[^\s/?#@<>\"']+@[^\s/?#@<>\"']+")

#: Fixed cues of each kind of parser, in lower case.
IBAN_CUES = ("iban",)
SSN_CUES = ("ssn", "social security")
ACCOUNT_CUES = ("account", "acct", "konto", "cuenta", "compte")
KEY_CUES = ("akia", "asia")
SECRET_CUES = ("password", "passwd", "secret", "token", "api_key", "apikey")


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    for d in digits[-2::-2]:
        total += sum(divmod(2 * int(d), 10))
    return total % 10 == 0


def _mod97(iban: str) -> bool:
    code = iban.replace(" ", "")
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _ssn_ok(value: str) -> bool:
    area, group, serial = value.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


class Finder:
    """All spans of a text: (kind, start, end, whether it is a base span)."""

    def __init__(self) -> None:
        import ahocorasick

        anchors = ahocorasick.Automaton()
        for digit in "0123456789":
            anchors.add_word(digit, ("digit", 1))
        anchors.add_word("@", ("at", 1))
        anchors.add_word("+", ("plus", 1))
        anchors.add_word("://", ("scheme", 3))
        for parser, cues in (
            ("iban", IBAN_CUES), ("ssn", SSN_CUES), ("account", ACCOUNT_CUES), ("key", KEY_CUES),
            ("secret", SECRET_CUES), ("tel", ("tel:",)),
        ):
            for cue in cues:
                for form in {cue, cue.upper(), cue.capitalize()}:
                    anchors.add_word(form, (parser, len(form)))
        anchors.make_automaton()
        self._anchors = anchors

    def __call__(self, text: str) -> list[tuple[str, int, int, bool]]:
        found: list[tuple[str, int, int, bool]] = []
        email_end = wide_end = ip_end = card_end = phone_end = run_end = key_end = 0
        for last, (parser, size) in self._anchors.iter(text):
            at = last + 1 - size
            if parser == "digit":
                if at < run_end:
                    continue
                run_end = _DIGITS.match(text, at).end()
                if at >= ip_end and (m := _IP.match(text, at)):
                    ip_end = m.end()
                    if all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m.group().split("."))):
                        found.append(("ip", at, ip_end, True))
                if at >= card_end and (m := _CARD.match(text, at)):
                    card_end = m.end()
                    digits = m.group().replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and _luhn(digits):
                        found.append(("card", at, card_end, True))
            elif parser == "at":
                start = at
                while start > email_end and text[start - 1] in _LOCAL:
                    start -= 1
                if start < at and (m := _DOMAIN.match(text, at + 1)):
                    email_end = m.end()
                    found.append(("email", start, email_end, True))
                elif at >= email_end and (m := _WIDE_DOMAIN.match(text, at + 1)):
                    start = at
                    floor = max(email_end, wide_end)
                    while start > floor and (text[start - 1] in _LOCAL or text[start - 1].isalpha()):
                        start -= 1
                    if start < at:
                        wide_end = m.end()
                        found.append(("email", start, wide_end, False))
            elif parser == "plus":
                if at >= phone_end and (m := _PHONE.match(text, at)):
                    phone_end = m.end()
                    if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                        found.append(("phone", at, phone_end, True))
            elif parser == "key":
                if text[at : last + 1].isupper() and (m := _KEY.match(text, last + 1)) and at >= key_end:
                    if not (at and text[at - 1].isalnum()):
                        key_end = m.end()
                        found.append(("secret", at, key_end, False))
            elif parser == "secret":
                if (m := _VALUE.match(text, last + 1)) and m.start(1) >= key_end:
                    if any(c.isdigit() for c in m.group(1)):
                        key_end = m.end(1)
                        found.append(("secret", m.start(1), key_end, False))
            elif parser == "iban":
                if (m := _IBAN.match(text, last + 1)) and _mod97(m.group(1)):
                    found.append(("account", *m.span(1), False))
            elif parser == "ssn":
                if (m := _SSN.match(text, last + 1)) and _ssn_ok(m.group(1)):
                    found.append(("account", *m.span(1), False))
            elif parser == "account":
                if m := _ACCOUNT.match(text, last + 1):
                    found.append(("account", *m.span(1), False))
            elif parser == "tel":
                if m := _TEL.match(text, last + 1):
                    found.append(("url", at, m.end(), False))
            elif m := _AUTHORITY.match(text, last + 1):
                start = at
                while start and (text[start - 1].isalnum() or text[start - 1] in "+.-"):
                    start -= 1
                if start < at:
                    found.append(("url", start, m.end(), False))
        order = {kind: i for i, kind in enumerate(KINDS)}
        return sorted(found, key=lambda s: (order[s[0]], s[1], s[2]))



def mask(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    """The text with each stretch covered by spans replaced by the name of its first span's kind."""
    parts, at = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            parts += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def find(docs: DataFrame) -> DataFrame:
    """doc_id and spans, an array of (kind, start, end, base), of every document."""

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
        for frame in frames:
            rows = [
                [{"kind": k, "start": a, "end": b, "base": base} for k, a, b, base in finder(text or "")]
                for text in frame.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [frame.column("doc_id"), pa.array(rows, pa.list_(span))], names=["doc_id", "spans"]
            )

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(
        columns, batches, "doc_id long, spans array<struct<kind string, start long, end long, base boolean>>"
    )


def masked(docs: DataFrame) -> DataFrame:
    """The documents with personal data replaced by ``<kind>``; n_chars, where present, follows the text."""
    names = docs.columns
    schema = docs.schema

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        for frame in frames:
            at = frame.schema.get_field_index("text")
            texts = [t and mask(t, finder(t)) for t in frame.column(at).to_pylist()]
            columns = list(frame.columns)
            columns[at] = pa.array(texts, frame.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=frame.schema)

    out = map_batches(docs, batches, schema)
    if "n_chars" in names:
        kind = schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return out.select(*names)


def _text(spans: Column) -> Column:
    parts = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(parts, ",")


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base spans, their hash and all spans as text."""
    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id",
        *[_count(base, kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(_text(base).cast("binary"), 256).alias("base_sha256"),
        _text(F.col("spans")).alias("spans"),
    )
