"""Personal data: patterns propose, checksums confirm, nearby words adjust the score.

Base kinds are e-mail addresses, IPv4 addresses, payment cards (Luhn) and phone
numbers. Two further kinds are added where the evidence is strong enough: bank
account numbers (IBAN, mod-97) and identity numbers, whose pattern alone is weak
and needs a word such as "ssn" close by.

Every pattern is found in time linear in the text: addresses are grown from
their ``@``, IPs from runs of digits and dots, so long unbroken runs of letters
or digits cost no more than prose.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from abode.llm.batches import map_batches

KINDS = ("email", "ip", "card", "phone", "iban", "identity")
BASE = 4
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
IDENTITY = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
# Words that speak for a kind within WINDOW characters before a span or after it.
CONTEXT = {
    "email": ("mail", "e-mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile"),
    "iban": ("iban", "account", "bank", "konto"),
    "identity": ("ssn", "social", "security", "identity"),
}
AGAINST = ("example", "sample", "version", "isbn", "serial")
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "identity": 0.3}
WINDOW, RAISE, LOWER, LEAST = 40, 0.25, 0.2, 0.5
WORD = re.compile(r"[a-z][a-z-]*")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Whether a compact IBAN's check digits hold: letters count as 10 to 35, the first four go last."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            yield start, done
        at = text.find("@", at + 1)


def addresses(text: str):
    for m in DOTTED.finditer(text):
        parts = m.group().split(".")
        if len(parts) < 4:
            continue
        start, i = m.start(), 0
        while i + 3 < len(parts):
            four = parts[i : i + 4]
            long = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield start, start + long
            start += long + 1
            i += 4


def cards(text: str):
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str):
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                yield m.span()


def ibans(text: str):
    for m in IBAN.finditer(text):
        if 15 <= len(compact := m.group().replace(" ", "")) <= 34 and mod97(compact):
            yield m.span()


def identities(text: str):
    for m in IDENTITY.finditer(text):
        if m.group()[:3] not in ("000", "666") and m.group()[0] != "9":
            yield m.span()


FINDERS = (emails, addresses, cards, phones, ibans, identities)


def score(text: str, kind: str, start: int, end: int) -> float:
    near = WORD.findall((text[max(0, start - WINDOW) : start] + " " + text[end : end + WINDOW]).lower())
    value = PRIOR[kind] + RAISE * any(w in CONTEXT[kind] for w in near) - LOWER * any(w in AGAINST for w in near)
    return round(min(1.0, max(0.0, value)), 3)


def find(text: str) -> list[tuple[int, int, int, float]]:
    """Spans ``(start, kind, end, score)`` in code points, by start and then kind.

    Base kinds stay whatever their score; an added one must reach ``LEAST`` and
    overlap no base span.
    """
    out = [(s, k, e, score(text, KINDS[k], s, e)) for k in range(BASE) for s, e in FINDERS[k](text)]
    taken = sorted((s, e) for s, _, e, _ in out)
    starts = [s for s, _ in taken]
    reach = list(accumulate((e for _, e in taken), max))  # how far spans up to there go
    for k in range(BASE, len(KINDS)):
        for s, e in FINDERS[k](text):
            value = score(text, KINDS[k], s, e)
            before = bisect_left(starts, e)
            if value >= LEAST and not (before and reach[before - 1] > s):
                out.append((s, k, e, value))
    return sorted(out)


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the identifier and ``found``, an array of ``(start, end, kind, score)``.

    Positions are code points, the end exclusive. A null text counts as empty
    and has no spans; repeated rows each get their own; an empty table gives no
    rows; other columns aren't read.
    """
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("score", pa.float64())])
    schema = pa.schema([(id_col, to_arrow_type(df.schema[id_col].dataType)), ("found", pa.list_(span))])

    def work(batch: pa.RecordBatch) -> dict:
        rows = [[{"start": s, "end": e, "kind": KINDS[k], "score": v} for s, k, e, v in find(t or "")] for t in batch.column(1).to_pylist()]
        return {id_col: batch.column(0), "found": rows}

    return map_batches(df.select(id_col, text_col), work, schema)


def mask_pii(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with each span of ``text_col`` replaced by its kind in brackets."""

    @F.pandas_udf("string")
    def mask(texts):
        return texts.map(masked, na_action="ignore")

    return df.withColumn(text_col, mask(F.col(text_col)))


def masked(text: str) -> str:
    out, done = [], 0
    for s, k, e, _ in find(text):
        if s >= done:
            out += [text[done:s], f"[{KINDS[k]}]"]
        done = max(done, e)
    return "".join(out) + text[done:]


def pii_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts by base kind, the digest of the base spans, and all spans as text."""
    names = [f"n_{k}" for k in KINDS[:BASE]]
    schema = pa.schema(
        [(id_col, to_arrow_type(df.schema[id_col].dataType)), *[(n, pa.int64()) for n in names], ("base_sha256", pa.string()), ("spans", pa.string()), ("scores", pa.list_(pa.float64()))]
    )

    def work(batch: pa.RecordBatch) -> dict:
        found = [find(t or "") for t in batch.column(1).to_pylist()]
        shown = lambda rows: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in rows)
        out = {id_col: batch.column(0)}
        out |= {n: [sum(k == i for _, k, _, _ in rows) for rows in found] for i, n in enumerate(names)}
        out["base_sha256"] = [hashlib.sha256(shown([r for r in rows if r[1] < BASE]).encode()).hexdigest() for rows in found]
        return out | {"spans": [shown(rows) for rows in found], "scores": [[v for *_, v in rows] for rows in found]}

    return map_batches(df.select(id_col, text_col), work, schema)
