"""Personal data in texts: patterns propose, checksums confirm, context scores.

Patterns propose spans. A validator confirms or drops each: octets of addresses,
Luhn sums of card numbers, digit counts of phones, mod-97 of bank accounts. Words
near a span then raise or lower its score. Work is one pass over the documents in
Arrow batches, without any exchange.

Kinds ``email ip card phone`` form the base: every confirmed span of them is kept
whatever its score. The kinds added by this operator are kept from ``MIN_SCORE`` on:

* ``iban``   country code, check digits and 11-30 characters passing mod 97; ends at the end
  of a group, at the country's length if that passes
* ``ssn``    three digits, two, four, joined by hyphens, with area and group in use
* ``secret`` an assignment of 16 or more key characters to a name that holds token,
  secret, password, passwd, api_key or access_key, such as GITHUB_TOKEN or api-key

Defined results: NULL and empty texts have no spans; texts are read whole, whatever
their length; repeated rows give repeated results; other columns pass untouched,
whatever their names. Positions count code points.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meldstone.llm.common import bounded_task, free_name, share_package

#: Kinds in the order in which spans of equal start are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn", "secret")
KINDS = BASE_KINDS + ADDED_KINDS

#: Score from which a span of an added kind is reported.
MIN_SCORE = 0.5
#: Code points to either side of a span in which context words count.
CONTEXT = 40

# What may stand before an @, and what must stand behind it.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# The leftmost match begins where a run of digits does, so no other digit is tried.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
#: Characters of an account number at least, and by country.
LEAST_IBAN = 15
IBAN_BY_COUNTRY = {
    pair[:2]: int(pair[2:])
    for pair in (
        "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 "
        "FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 "
        "LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 "
        "SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"
    ).split()
}
SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
# A name is taken whole, once, so that long runs of its characters cost linear time.
SECRET = re.compile(
    r"(?<![A-Za-z0-9_-])(?=[A-Za-z0-9_-]*?(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key))"
    r"[A-Za-z0-9_-]++[\"']?\s{0,4}[=:]\s{0,4}[\"']?([A-Za-z0-9+/_\-]{16,})"
)

#: Score of a confirmed span, words that raise it, words that lower it.
CONTEXT_WORDS = {
    "email": (0.9, ("mail", "contact", "write"), ("example",)),
    "ip": (0.7, ("ip", "address", "host", "server"), ("version", "release")),
    "card": (0.8, ("card", "visa", "credit", "payment", "pay"), ("order", "serial")),
    "phone": (0.8, ("phone", "tel", "call", "mobile", "fax"), ("isbn",)),
    "iban": (0.8, ("iban", "account", "bank", "konto", "compte", "cuenta"), ("serial",)),
    "ssn": (0.4, ("ssn", "social", "security", "taxpayer"), ("order", "part", "serial")),
    "secret": (0.7, ("key", "login", "auth"), ("placeholder", "your")),
}
RAISE, LOWER = 0.15, 0.3


class Span(NamedTuple):
    start: int
    kind: int
    end: int
    score: float

    def label(self) -> str:
        return f"{KINDS[self.kind]}:{self.start}:{self.end}"


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # An address holds one @, so each one is looked at once, with the run before it and behind it.
    at, done = text.find("@"), 0
    while at >= 0:
        before = text[done:at]
        start = done + len(before.rstrip(LOCAL))
        match = DOMAIN.match(text, at + 1) if start < at else None
        done = at + 1
        if match:
            done = match.end()
            yield start, done
        at = text.find("@", done)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for match in IP.finditer(text):
        parts = [part.lstrip("0") for part in match[0].split(".")]
        if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
            yield match.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for match in CARD.finditer(text):
        digits = match[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield match.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for match in PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in match[0]) <= 15:
            yield match.span()


def _account_end(match: re.Match) -> int | None:
    """End of the account number at the start of a match, which may run on into words behind it."""
    groups, ends = match[0].split(" "), {}
    for k in range(1, len(groups) + 1):
        account = "".join(groups[:k])
        if len(account) >= LEAST_IBAN and mod97(account):
            ends[len(account)] = match.start() + len(" ".join(groups[:k]))
    # Where several pass, the longest leaves nothing of the number behind.
    return ends.get(IBAN_BY_COUNTRY.get(match[0][:2])) or max(ends.values(), default=None)


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    match = IBAN.search(text)
    while match:
        end = _account_end(match)
        if end:
            yield match.start(), end
        # A number may begin inside of what another start ran over.
        match = IBAN.search(text, end or match.start() + 1)


def _ssns(text: str) -> Iterator[tuple[int, int]]:
    for match in SSN.finditer(text):
        area, group, serial = match.groups()
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield match.span()


def _secrets(text: str) -> Iterator[tuple[int, int]]:
    for match in SECRET.finditer(text):
        if any(c.isdigit() for c in match[1]):
            yield match.span(1)


_FINDERS = (_emails, _ips, _cards, _phones, _ibans, _ssns, _secrets)


def _score(text: str, kind: int, start: int, end: int) -> float:
    score, raising, lowering = CONTEXT_WORDS[KINDS[kind]]
    near = set(re.findall(r"\w+", text[max(0, start - CONTEXT) : start].lower()))
    near |= set(re.findall(r"\w+", text[end : end + CONTEXT].lower()))
    score += RAISE * any(w in near for w in raising) - LOWER * any(w in near for w in lowering)
    return round(min(1.0, max(0.0, score)), 2)


def find_spans(text: str | None) -> list[Span]:
    """Confirmed spans of a text by start, then kind."""
    if not text:
        return []
    spans = []
    for kind, finder in enumerate(_FINDERS):
        for start, end in finder(text):
            score = _score(text, kind, start, end)
            if kind < len(BASE_KINDS) or score >= MIN_SCORE:
                spans.append(Span(start, kind, end, score))
    return sorted(spans)


def redacted(text: str | None, spans: list[Span]) -> str | None:
    """Text with each run of overlapping spans replaced by <KIND> of its first."""
    if not spans:
        return text
    parts, done, i = [], 0, 0
    while i < len(spans):
        first, end = spans[i], spans[i].end
        while i + 1 < len(spans) and spans[i + 1].start < end:
            i += 1
            end = max(end, spans[i].end)
        parts += [text[done : first.start], f"<{KINDS[first.kind].upper()}>"]
        done, i = end, i + 1
    return "".join([*parts, text[done:]])


FOUND = (
    "spans array<struct<kind:string,start:bigint,end:bigint,score:double>>, "
    "redacted string, span_text string, base_sha256 string"
)


def _find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        rows = []
        for text in texts:
            found = find_spans(text)
            base = ",".join(s.label() for s in found if s.kind < len(BASE_KINDS))
            rows.append(
                (
                    [{"kind": KINDS[s.kind], "start": s.start, "end": s.end, "score": s.score} for s in found],
                    redacted(text, found),
                    ",".join(s.label() for s in found),
                    hashlib.sha256(base.encode()).hexdigest(),
                )
            )
        yield pd.DataFrame(rows, columns=["spans", "redacted", "span_text", "base_sha256"])


def find_pii(docs: DataFrame, text: str = "text", result: str = "pii") -> DataFrame:
    """``docs`` with ``result``: spans, the redacted text and digests of the span list."""
    share_package(docs.sparkSession)
    return docs.withColumn(result, F.pandas_udf(bounded_task("pii", _find), FOUND)(F.col(text)))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every reported span replaced in ``text``; n_chars follows if present."""
    columns, found = docs.columns, free_name(docs, "found")
    done = find_pii(docs, text, found).withColumn(text, F.col(f"{found}.redacted"))
    if "n_chars" in columns:
        changed = F.size(f"{found}.spans") > 0
        done = done.withColumn("n_chars", F.when(changed, F.length(text)).otherwise(F.col("n_chars")))
    return done.select(*[F.col(f"`{c}`") for c in columns])


def pii_report(docs: DataFrame) -> DataFrame:
    """Per document: counts of base kinds, digest of the base spans, all spans as text."""
    found = find_pii(docs.select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("pii.spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.col("pii.base_sha256").alias("base_sha256"),
        F.col("pii.span_text").alias("spans"),
        F.round(F.array_max(F.col("pii.spans.score")), 2).alias("max_score"),
    )
