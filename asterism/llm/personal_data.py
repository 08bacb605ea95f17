"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby
adjust their score.

Four base kinds (``email``, ``ip``, ``card``, ``phone``) are fixed by their pattern and
check alone: a match that passes is always reported, whatever its score. The further
kinds are reported from a score of ``threshold`` on:

* ``iban``: country, its length and the remainder modulo 97;
* ``ssn``, ``national_phone``: a pattern only, so a word nearby must speak for it;
* ``routing``: nine digits with the checksum of bank routing numbers, and such a word.

A further span that lies over a base span, or over a further one with a higher score
(ties: the earlier, then the kind listed first), is dropped; an IBAN is kept beside the
cards it holds. All patterns run in time proportional to the text: each starts only where
a match can start, and a failed one isn't tried again inside.

Null texts count as empty and give no spans. Repeated rows give repeated rows, null ids
stay null, an empty table gives an empty one, and no other column is read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asterism.llm.common import map_rows

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "national_phone", "routing")
THRESHOLD = 0.5
# code points before and after a span in which words count
BEFORE, AFTER = 40, 20
RAISE, LOWER = 0.4, 0.3

# Lengths of IBANs by country, as registered.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29,
    "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29,
    "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28,
    "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20,
    "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22,
    "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25,
    "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25,
    "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}

# words, in lower case, that speak for a kind when they stand near a span
FOR = {
    "email": {"email", "mail", "contact", "courriel", "correo"},
    "ip": {"ip", "address", "host", "server", "adresse"},
    "card": {"card", "credit", "debit", "visa", "mastercard", "amex", "carte", "karte", "tarjeta"},
    "phone": {"phone", "tel", "telephone", "mobile", "call", "fax", "telefon", "téléphone", "teléfono"},
    "iban": {"iban", "account", "bank", "konto", "compte", "cuenta"},
    "ssn": {"ssn", "social", "security"},
    "routing": {"routing", "aba", "rtn", "transit"},
}
FOR["national_phone"] = FOR["phone"]
# words that speak against any kind
AGAINST = {"example", "sample", "test", "dummy", "version", "isbn", "invoice", "order", "tracking", "serial"}

BASE_SCORE = {
    "email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.7,
    "iban": 0.9, "ssn": 0.4, "national_phone": 0.2, "routing": 0.2,
}

SPANS = "array<struct<kind:string,`start`:int,`end`:int,score:double,base:boolean>>"


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float
    base: bool


# -- checks -----------------------------------------------------------------------------


def passes_luhn(digits: str) -> bool:
    """Whether the Luhn sum of a string of digits is a multiple of ten."""
    doubled = "0246813579"
    return (sum(map(int, digits[-1::-2])) + sum(int(doubled[int(d)]) for d in digits[-2::-2])) % 10 == 0


def passes_mod97(iban: str) -> bool:
    """Whether an IBAN without separators has the remainder 1."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def passes_routing(digits: str) -> bool:
    """Whether nine digits, weighed 3, 7, 1, add up to a multiple of ten; all zero doesn't count."""
    return digits != "000000000" and sum(w * int(d) for w, d in zip((3, 7, 1) * 3, digits)) % 10 == 0


# -- proposals: (start, end) in order, never overlapping ---------------------------------

_DIGIT = re.compile("[0-9]")
_LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# from the at sign on; what stands before it is looked for backwards
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# a match can start only where digits start: if it fails there, it fails at the later ones too
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ -]?[A-Z0-9]){11,28}")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_NATIONAL_PHONE = re.compile(r"(?<![0-9A-Za-z+.(-])\(?[0-9]{2,5}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])")
_ROUTING = re.compile(r"(?<![0-9A-Za-z.-])[0-9]{9}(?![0-9A-Za-z-])")
_SEPARATORS = str.maketrans("", "", " ().-+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for m in _DOMAIN.finditer(text):
        at = start = m.start()
        while start > done and text[start - 1] in _LOCAL_PART:
            start -= 1
        if start < at:
            done = m.end()
            yield start, done


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        # leading zeros count for nothing
        if all(len(part := p.lstrip("0")) < 4 and int(part or 0) <= 255 for p in m.groups()):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if 12 <= len(digits := m[0].translate(_SEPARATORS)) <= 19 and passes_luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(m[0].translate(_SEPARATORS)) <= 15:
            yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while m := _IBAN.search(text, at):
        at = m.start() + 1
        wanted = IBAN_LENGTHS.get(m[0][:2], 0)
        # the pattern may run on into the next words: cut at the country's length
        places = [i for i, c in enumerate(m[0]) if c not in " -"][:wanted]
        if not wanted or len(places) < wanted:
            continue
        end = m.start() + places[-1] + 1
        if not text[end : end + 1].isalnum() and passes_mod97("".join(m[0][i] for i in places)):
            at = end
            yield m.start(), end


def _found(pattern: re.Pattern, check: Callable[[str], bool] = lambda _: True):
    def propose(text: str) -> Iterator[tuple[int, int]]:
        return (m.span() for m in pattern.finditer(text) if check(m[0]))

    return propose


# each with a character that a text must hold for it
_PROPOSE: dict[str, tuple[str, Callable[[str], Iterator[tuple[int, int]]]]] = {
    "email": ("@", _emails),
    "ip": (".", _ips),
    "card": ("", _cards),
    "phone": ("+", _phones),
    "iban": ("", _ibans),
    "ssn": ("-", _found(_SSN)),
    "national_phone": ("", _found(_NATIONAL_PHONE, lambda x: 9 <= len(x.translate(_SEPARATORS)) <= 13)),
    "routing": ("", _found(_ROUTING, passes_routing)),
}


# -- spans of a text ---------------------------------------------------------------------

_WORD = re.compile(r"[^\W\d_]+")


def score_of(kind: str, text: str, start: int, end: int) -> float:
    """The kind's own score, more if a word nearby speaks for it, less if one speaks against it."""
    near = f"{text[max(0, start - BEFORE) : start]} {text[end : end + AFTER]}".lower()
    words = set(_WORD.findall(near))
    score = BASE_SCORE[kind] + RAISE * bool(words & FOR[kind]) - LOWER * bool(words & AGAINST)
    return round(min(1.0, max(0.0, score)), 2)


def spans_of(text: str | None, threshold: float = THRESHOLD) -> list[Span]:
    """All spans of a text by start, then kind as listed in ``KINDS``."""
    if not text:
        return []
    has_digit = _DIGIT.search(text) is not None
    base: list[Span] = []
    more: list[Span] = []
    for kind, (needed, propose) in _PROPOSE.items():
        if needed not in text or not (has_digit or kind == "email"):
            continue
        is_base = kind in BASE_KINDS
        for start, end in propose(text):
            score = score_of(kind, text, start, end)
            if is_base:
                base.append(Span(kind, start, end, score, True))
            elif score >= threshold:
                more.append(Span(kind, start, end, score, False))
    kept = base + _without_overlaps(base, more) if more else base
    return sorted(kept, key=lambda s: (s.start, KINDS.index(s.kind)))


def _without_overlaps(base: list[Span], more: list[Span]) -> list[Span]:
    """Of ``more``, those that lie over no base span and over no better one of ``more``."""
    blocked = {
        kind: _Covered((s.start, s.end) for s in base if not (kind == "iban" and s.kind == "card"))
        for kind in {s.kind for s in more}
    }
    taken = _Covered(())
    kept = []
    for span in sorted(more, key=lambda s: (-s.score, s.start, KINDS.index(s.kind))):
        if not blocked[span.kind].meets(span.start, span.end) and not taken.meets(span.start, span.end):
            taken.add(span.start, span.end)
            kept.append(span)
    return kept


class _Covered:
    """Places that spans cover. Spans of several kinds may overlap: they are joined first."""

    def __init__(self, spans) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def meets(self, start: int, end: int) -> bool:
        i = bisect_left(self.starts, end)
        return i > 0 and self.ends[i - 1] > start

    def add(self, start: int, end: int) -> None:
        """Add a span that meets none."""
        i = bisect_left(self.starts, start)
        self.starts.insert(i, start)
        self.ends.insert(i, end)


# -- tables ------------------------------------------------------------------------------


def find_personal_data(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, spans) of every row of ``docs`` (doc_id, text).

    ``spans`` holds kind, start and end (code points, end exclusive), score and whether
    the kind is a base one, by start and then kind as listed in ``KINDS``.
    """

    def per_batch(columns: dict[str, list]) -> dict[str, list]:
        spans = [[s._asdict() for s in spans_of(text, threshold)] for text in columns["text"]]
        return {"doc_id": columns["doc_id"], "spans": spans}

    return map_rows(docs.select("doc_id", "text"), per_batch, f"doc_id long, spans {SPANS}")


def mask(text: str | None, threshold: float = THRESHOLD) -> str | None:
    """The text with each run of overlapping spans put as the kind of its first one in brackets."""
    if not text:
        return text
    parts, done = [], 0
    for span in spans_of(text, threshold):
        if span.start >= done:
            parts += [text[done : span.start], f"[{span.kind.upper()}]"]
        done = max(done, span.end)
    return "".join([*parts, text[done:]])


def masked_documents(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with all its columns, the spans of ``text`` masked; null stays null."""

    @F.pandas_udf("string")
    def masked(texts):
        return texts.map(lambda text: mask(text, threshold), na_action="ignore")

    return docs.withColumn("text", masked("text"))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _is(kind: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == kind


def span_digests(found: DataFrame) -> DataFrame:
    """(doc_id, counts of the base kinds, digest of the base spans, all spans as text)."""
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.filter("spans", _is(kind))).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )
