"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust the score.

Every pattern runs in time linear in the text: a run of digits, of address characters or of phone
characters is entered once, whatever follows it.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pieces, sliced, strings, table

#: Fixed values of the query's contract: the base kinds, in the order they are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
#: Kinds the method adds: bank accounts (mod 97), national phone numbers that context words confirm, assigned secrets
#: (length and entropy), national identity numbers (mod 23) and bank routing numbers (weights 3, 7, 1).
ADDED_KINDS = ("iban", "local_phone", "secret", "national_id", "routing")
KINDS = BASE_KINDS + ADDED_KINDS

#: Code points on either side of a span that are searched for context words.
WINDOW = 48
#: Added spans need this score.
MIN_SCORE = 0.5

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+().-])(?:\([0-9]{2,5}\) ?|[0-9]{2,5}[ .-])[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])")
_SECRET = re.compile(
    r"(?<![A-Za-z])(?:token|secret|passwords?|passwd|pwd|credentials?|api[_-]?key|access[_-]?key|auth[_-]?key|private[_-]?key|key)"
    r"[\"']?\s{0,3}[:=]\s{0,3}[\"']?([A-Za-z0-9+/_.=-]{16,}+)",
    re.IGNORECASE,
)
_NATIONAL = re.compile(r"(?<![A-Za-z0-9])[0-9]{8}-?[A-Z](?![A-Za-z0-9])")
_ROUTING = re.compile(r"(?<![0-9A-Za-z.+-])[0-9]{9}(?![0-9A-Za-z-])")
_DIGIT = re.compile(r"[0-9]")
#: Check letters of the identity number by remainder, weights of the routing number.
_MOD23, _WEIGHTS = "TRWAGMYFPDXBNJZSQVHLCKE", (3, 7, 1)
#: An assigned value of at least 16 characters is a secret from so many bits of entropy a character on.
MIN_ENTROPY = 2.75

#: Words that raise the score of a kind when they stand near a span, and words that lower it.
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact", "write", "correo", "courriel"),
    "ip": ("ip", "address", "server", "host", "login", "adresse"),
    "card": ("card", "visa", "mastercard", "credit", "debit", "payment", "tarjeta", "karte", "carte"),
    "phone": ("phone", "tel", "call", "mobile", "cell", "fax", "telefon", "téléphone", "teléfono"),
    "iban": ("iban", "account", "bank", "transfer", "konto", "compte", "cuenta"),
    "local_phone": ("phone", "tel", "call", "mobile", "cell", "fax", "telefon", "téléphone", "teléfono"),
    "secret": ("token", "secret", "password", "key", "credential", "login"),
    "national_id": ("dni", "nif", "id", "identity", "identidad", "documento"),
    "routing": ("routing", "aba", "rtn", "bank"),
}
AGAINST = ("version", "isbn", "order", "invoice", "example", "page", "section")
#: Score by pattern alone, and after a validator has confirmed the span.
START = {"email": 0.8, "ip": 0.5, "card": 0.4, "phone": 0.6, "iban": 0.3, "local_phone": 0.3, "secret": 0.3, "national_id": 0.3, "routing": 0.0}
CONFIRMED = 0.3
_WORD = re.compile(r"[^\W\d_][\w-]*")


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """The check of ISO 13616: country and check digits to the end, letters as 10..35, remainder 1."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the run of address characters before an at sign, a dotted domain behind it."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = len(text[floor:at].rstrip(_LOCAL)) + floor
        found = _DOMAIN.match(text, at + 1) if start < at else None
        floor = found.end() if found else at + 1
        if found:
            yield start, floor
        at = text.find("@", floor)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            yield m.span()


def accounts(text: str) -> Iterator[tuple[int, int]]:
    """Bank accounts. A match may run on into capitals that follow, so shorter ends are tried, longest first."""
    for m in _IBAN.finditer(text):
        ends = [m.end(), *(m.start() + i for i in range(len(m[0]) - 1, 14, -1) if m[0][i] == " ")]
        for end in ends:
            plain = text[m.start() : end].replace(" ", "")
            if 15 <= len(plain) <= 34 and mod97(plain):
                yield m.start(), end
                break


def entropy(value: str) -> float:
    """Bits a character, by the value's own frequencies."""
    n = len(value)
    return -sum(c / n * log2(c / n) for c in Counter(value).values())


def secrets(text: str) -> Iterator[tuple[int, int]]:
    """Values assigned to a name such as token or password; words and repeated signs have no digit or too little entropy."""
    for m in _SECRET.finditer(text):
        value = m[1].rstrip(".=")
        if len(value) >= 16 and _DIGIT.search(value) and entropy(value) >= MIN_ENTROPY:
            yield m.start(1), m.start(1) + len(value)


def national_ids(text: str) -> Iterator[tuple[int, int]]:
    for m in _NATIONAL.finditer(text):
        if _MOD23[int(m[0][:8]) % 23] == m[0][-1]:
            yield m.span()


def routing_numbers(text: str) -> Iterator[tuple[int, int]]:
    for m in _ROUTING.finditer(text):
        if sum(int(d) * _WEIGHTS[i % 3] for i, d in enumerate(m[0])) % 10 == 0 and m[0] != "0" * 9:
            yield m.span()


def local_phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _LOCAL_PHONE.finditer(text):
        if 7 <= len(_digits(m[0])) <= 11:
            yield m.span()


_FINDERS = {
    "email": emails, "ip": addresses, "card": cards, "phone": phones, "iban": accounts, "local_phone": local_phones,
    "secret": secrets, "national_id": national_ids, "routing": routing_numbers,
}
_CHECKED = {"ip", "card", "iban", "secret", "national_id", "routing"}


def _score(kind: str, text: str, start: int, end: int) -> float:
    near = {w.lower() for w in _WORD.findall(text[max(0, start - WINDOW) : start] + " " + text[end : end + WINDOW])}
    score = START[kind] + CONFIRMED * (kind in _CHECKED)
    score += 0.3 * any(w in near for w in CONTEXT[kind]) - 0.3 * any(w in near for w in AGAINST)
    return round(min(1.0, max(0.0, score)), 2)


class _Taken:
    """The stretches that base spans cover, merged, for overlap tests by bisection."""

    def __init__(self, found: list[Span]) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for x in sorted(found, key=lambda x: x.start):
            if self.ends and x.start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], x.end)
            else:
                self.starts.append(x.start)
                self.ends.append(x.end)

    def meets(self, start: int, end: int) -> bool:
        i = bisect_right(self.ends, start)
        return i < len(self.starts) and self.starts[i] < end


def spans(text: str) -> list[Span]:
    """All spans by kind as listed, then start. Base spans stay whatever their score; an added one needs
    ``MIN_SCORE`` and may not overlap a base span."""
    found: list[Span] = []
    has_digit = _DIGIT.search(text) is not None
    for kind in BASE_KINDS:
        if kind == "email" or has_digit:
            found += [Span(kind, s, e, _score(kind, text, s, e)) for s, e in _FINDERS[kind](text)]
    if has_digit:
        taken = _Taken(found)
        for kind in ADDED_KINDS:
            for s, e in _FINDERS[kind](text):
                score = _score(kind, text, s, e)
                if score >= MIN_SCORE and not taken.meets(s, e):
                    found.append(Span(kind, s, e, score))
    return found


_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
)


def find_pii(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and an array ``spans`` of (kind, start, end, score) in code points, one row per input row.

    No shuffle. A null text counts as empty; repeated rows and null keys are kept; an empty table gives an empty one; a
    text of any length is searched whole, in time linear in it; other columns are not read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            found = [[vars(x) for x in spans(t)] for t in strings(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _SPANS)], ["key", "spans"])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(key, text).mapInArrow(
        work, f"key {kind}, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>"
    )
    return out.withColumnRenamed("key", key)


def redact(text: str) -> str:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans the first counts."""
    out, at = [], 0
    for x in sorted(spans(text), key=lambda x: (x.start, -x.end)):
        if x.start >= at:
            out += [text[at : x.start], f"<{x.kind.upper()}>"]
        at = max(at, x.end)
    return "".join(out) + text[at:]


def redact_docs(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced in ``text`` and ``n_chars`` brought in line; null texts stay null.

    Columns, order and number of rows are those of ``docs``. A row without personal data is unchanged.
    """

    @F.arrow_udf("string")
    def redacted(texts: pa.Array) -> pa.Array:
        out = [pa.array([None if t is None else redact(t) for t in x.to_pylist()], texts.type) for x in pieces(texts)]
        return pa.concat_arrays(out) if out else pa.array([], texts.type)

    after = redacted("text")
    fresh = {"text": after}
    if "n_chars" in docs.columns:
        same = F.col("text").isNull() | (F.col("text") == after)
        fresh["n_chars"] = F.when(same, F.col("n_chars")).otherwise(F.char_length(after).cast(docs.schema["n_chars"].dataType))
    return docs.select(*[fresh.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def _joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def _is_kind(kind: str) -> Callable[[Column], Column]:
    return lambda x: x["kind"] == kind


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the base spans, and all spans, of every document."""
    found = find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE_KINDS))
    counts = [
        F.size(F.filter("spans", _is_kind(kind))).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS
    ]
    scores = F.array_join(F.transform("spans", lambda x: x["score"].cast("string")), ",")
    return found.select(
        "doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"), scores.alias("scores")
    )
