"""Personal data: patterns propose spans, checksums confirm them, and words nearby adjust their score (operator 5).

Four base kinds (email, ip, card, phone) follow fixed patterns, leftmost and non-overlapping; a match that fails its check is
dropped and not retried.  They always stay.  The method adds bank account numbers (mod-97), cards written with other
separators or 13 digits (Luhn) and phone numbers without a plus sign; these need a score of ``LEAST``, which the checksum and
context words before the span raise, and which words that speak against them lower.  An added span never overlaps a base one
or an earlier added one.

Patterns start only where a run of their signs starts, so a long run of digits or letters is read once.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cartwheel.llm import text as T

KINDS = ("email", "ip", "card", "phone", "iban", "othercard", "localphone")
#: fixed patterns of the base kinds; an email is found from its sign outwards
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: proposals of the added kinds
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
OTHER_CARD = re.compile(r"(?<![0-9./])[0-9]{4}(?:[./][0-9]{4}){3}(?![0-9./])|(?<![0-9])[0-9]{13}(?![0-9])")
LOCAL_PHONE = re.compile(r"(?<![0-9+.-])\(?[0-9]{2,4}\)?[\x20./-][0-9]{2,4}(?:[\x20.-][0-9]{2,4}){1,3}(?![0-9.-])")
#: words within ``REACH`` signs before a span
REACH, LEAST = 40, 0.6
FOR = {"iban": re.compile(r"(?i)\b(iban|account|konto|compte|cuenta|bank)\b"),
       "othercard": re.compile(r"(?i)\b(card|visa|mastercard|amex|karte|carte|tarjeta)\b"),
       "localphone": re.compile(r"(?i)\b(tel|phone|call|mobile|fax|telefon|telephone|téléphone|teléfono|whatsapp)\b")}
AGAINST = re.compile(r"(?i)\b(isbn|order|invoice|version|page|serial|bestellung|pedido|commande)\b")
_ANY = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    compact = account.replace(" ", "")
    turned = compact[4:] + compact[:4]
    return 15 <= len(compact) <= 34 and int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str):
    """Matches of ``[local]+@label(.label)+``: the run of local signs before each sign, then the domain."""
    done = at = 0
    while (sign := text.find("@", at)) >= 0:
        start = sign
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, sign + 1) if start < sign else None
        if found:
            yield start, found.end()
            done = found.end()
        at = max(done, sign + 1)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds, by start, then kind as listed."""
    if not _ANY.search(text):
        return []
    out = [(a, b, "email") for a, b in emails(text)]
    out += [(m.start(), m.end(), "ip") for m in IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = _digits(m.group()) if m.end() - m.start() <= 37 else ""
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), "card"))
    out += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def score(text: str, start: int, kind: str, checked: bool | None) -> float:
    """0.4 for the pattern, 0.4 for a passed checksum (nothing passes a failed one), 0.3 for or against by context."""
    if checked is False:
        return 0.0
    near = text[max(0, start - REACH):start]
    return 0.4 + 0.4 * bool(checked) + 0.3 * bool(FOR[kind].search(near)) - 0.3 * bool(AGAINST.search(near))


def added_spans(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, score) of the added kinds that reach LEAST and overlap nothing."""
    if not _ANY.search(text):
        return []
    proposals = []
    for kind, pattern, check in (("iban", IBAN, lambda t: mod97(t)), ("othercard", OTHER_CARD, lambda t: luhn(_digits(t))),
                                 ("localphone", LOCAL_PHONE, lambda t: None if 9 <= len(_digits(t)) <= 12 else False)):
        for m in pattern.finditer(text):
            worth = score(text, m.start(), kind, check(m.group()))
            if worth >= LEAST:
                proposals.append((m.start(), m.end(), kind, worth))
    proposals.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    out, base, i, free = [], sorted(taken), 0, 0
    reach = 0
    for start, end, kind, worth in proposals:
        while i < len(base) and base[i][0] < end:
            reach = max(reach, base[i][1])
            i += 1
        if start >= max(free, reach):
            out.append((start, end, kind, worth))
            free = end
    return out


def listed(spans: list[tuple]) -> str:
    order = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{s[2]}:{s[0]}:{s[1]}" for s in order)


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("base", pa.bool_()),
                             ("score", pa.float64())]))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: id, base (its base spans as text), spans (all spans as text), found (all spans with their scores).

    Offsets count code points, the end is exclusive.  A null text counts as empty.  Repeated rows each get a row; other
    columns are not read; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        base, spans, found = [], [], []
        for text in part.column("text").to_pylist():
            own = base_spans(text or "")
            more = added_spans(text or "", own)
            base.append(listed(own))
            spans.append(listed([*own, *more]))
            every = [(*s, True, 1.0) for s in own] + [(a, b, k, False, w) for a, b, k, w in more]
            found.append([dict(zip(("start", "end", "kind", "base", "score"), s)) for s in sorted(every)])
        return pa.RecordBatch.from_arrays([part.column("id"), pa.array(base, pa.string()), pa.array(spans, pa.string()),
                                           pa.array(found, _SPANS)], ["id", "base", "spans", "found"])
    schema = (f"id {dict(rows.dtypes)['id']}, base string, spans string, "
              "found array<struct<start: int, end: int, kind: string, base: boolean, score: double>>")
    return T.mapped(rows, T.per_slice(work, "text"), schema).withColumnRenamed("id", id_col)


def redacted(text: str | None, found: list) -> str | None:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first."""
    if text is None:
        return None
    out, at = [], 0
    for s in found:
        if s["start"] >= at:
            out += [text[at:s["start"]], f"[{s['kind']}]"]
            at = s["end"]
    return "".join([*out, text[at:]])
