"""Personal-data spans by anchor expansion.

An Aho-Corasick automaton walks every text once and reports anchors: at-signs,
``://``, plus signs, digits and account cues ("IBAN", "account", ...). At each
anchor a local parser expands to the boundaries of the item and validates it; text
away from anchors is never parsed. Parsers of one kind run left to right and skip
anchors inside the previous match, so spans of a kind never overlap. A match that
fails its check (address part over 255, Luhn, digit count) is dropped and its
characters are not tried again for that kind.

An account is first read as an IBAN: its country says how long it is (of a country that is
not listed, the longest run of whole groups counts) and mod 97 must hold, whatever
capitals follow. Any other account ends before a letter that begins a word.

Results for odd input: null or empty text has no spans; repeated rows are scanned
row by row; a null id passes through; other columns are ignored by :func:`find_pii`
and kept by :func:`redact`. Work is one narrow pass, without a shuffle, over whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, ship

#: Order of kinds in results. The first four have the fixed grammar of the contract.
KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE_KINDS = KINDS[:4]
ACCOUNT_CUES = ("iban", "account", "acct", "routing", "passport", "ssn")

SPAN_TYPE = "array<struct<kind:int,start:int,end:int>>"
_SPAN_ARROW = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_ADDRESS = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL_REST = re.compile(r"[^\s<>\"'`|\\^{}\[\]]+")
_SCHEME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+.-")
_CUE_LINK = re.compile(r"(?:[\x20\t]*(?:number|no\.?|nr\.?|id|#|:|=))*[\x20\t]*", re.I)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:[\x20-]?[A-Z0-9]){11,30}")
_ACCOUNT = re.compile(r"[A-Z]{0,2}[0-9](?:[\x20-]?[0-9]|-?[A-Z]{1,33}(?![A-Za-z])|\x20[A-Z]{1,33}(?=[0-9])){0,33}")
_IBAN_LENGTHS = """
    AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18
    FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21
    LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24
    SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30"""
_IBAN_LENGTH = {x[:2]: int(x[2:]) for x in _IBAN_LENGTHS.split()}

_AT, _PLUS, _DIGIT, _SLASHES, _CUE = range(5)
_automaton = None


def automaton() -> ahocorasick.Automaton:
    global _automaton
    if _automaton is None:
        a = ahocorasick.Automaton()
        a.add_word("@", _AT)
        a.add_word("+", _PLUS)
        a.add_word("://", _SLASHES)
        for d in "0123456789":
            a.add_word(d, _DIGIT)
        for cue in ACCOUNT_CUES:
            for form in (cue, cue.title(), cue.upper()):
                a.add_word(form, _CUE)
        a.make_automaton()
        _automaton = a
    return _automaton


def _luhn(digits: str) -> bool:
    odd = sum(int(d) for d in digits[-1::-2])
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def _iban(code: str) -> bool:
    turned = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _iban_end(text: str, start: int) -> int:
    """End of the IBAN that begins at ``start``, or ``start``."""
    if m := _IBAN.match(text, start):
        at = [i for i in range(start, m.end()) if text[i] not in " -"]
        code = "".join(text[i] for i in at)
        if size := _IBAN_LENGTH.get(code[:2]):
            sizes = [size] if size <= len(code) else []
        else:  # whole groups, the longest first
            sizes = [n for n in range(len(code), 14, -1) if not text[at[n - 1] + 1 : at[n - 1] + 2].isalnum()]
        for n in sizes:
            if _iban(code[:n]):
                return at[n - 1] + 1
    return start


def _account_end(text: str, start: int) -> int:
    """End of the account that begins at ``start``, or ``start``."""
    if (end := _iban_end(text, start)) > start:
        return end
    if m := _ACCOUNT.match(text, start):
        code = m[0].replace(" ", "").replace("-", "")
        if sum(c in "0123456789" for c in code) >= 6 and (not code[:2].isalpha() or len(code) < 15):
            return m.end()
    return start


def spans_of(text: str) -> list[tuple[int, int, int]]:
    """All spans of one text as (index in KINDS, start, end), by kind, then start; code points, end exclusive."""
    found: list[tuple[int, int, int]] = []
    email_end = ip_end = card_end = phone_end = url_end = account_end = 0
    for last, anchor in automaton().iter(text):
        if anchor == _DIGIT:
            if last >= card_end and (m := _CARD.match(text, last)):
                card_end = m.end()
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and _luhn(digits):
                    found.append((2, last, card_end))
            if last >= ip_end:
                if m := _ADDRESS.match(text, last):
                    ip_end = m.end()
                    if all(len(d := p.lstrip("0")) <= 3 and int(d or "0") <= 255 for p in m[0].split(".")):
                        found.append((1, last, ip_end))
                else:  # the rest of this run of digits cannot start an address either
                    ip_end = _DIGITS.match(text, last).end()
        elif anchor == _AT:
            start = last
            while start > email_end and text[start - 1] in _LOCAL:
                start -= 1
            if start < last and last >= email_end and (m := _DOMAIN.match(text, last + 1)):
                email_end = m.end()
                found.append((0, start, email_end))
        elif anchor == _PLUS:
            if last >= phone_end and (m := _PHONE.match(text, last)):
                phone_end = m.end()
                if 8 <= sum(c in "0123456789" for c in m[0]) <= 15:
                    found.append((3, last, phone_end))
        elif anchor == _SLASHES:
            colon = last - 2
            start = colon
            while start > url_end and text[start - 1] in _SCHEME:
                start -= 1
            while start < colon and not ("a" <= text[start].lower() <= "z"):
                start += 1
            if start < colon and (m := _URL_REST.match(text, last + 1)):
                end = m.start() + len(m[0].rstrip(".,;:!?)"))
                if end > m.start():
                    url_end = end
                    found.append((4, start, end))
        else:
            start = _CUE_LINK.match(text, last + 1).end()
            if start - 2 > last and text[start - 2 : start] == "NO" and _iban_end(text, start - 2) > start:
                start -= 2  # Norway, not "number"
            if start >= account_end and (end := _account_end(text, start)) > start:
                account_end = end
                found.append((5, start, end))
    found.sort()
    return found


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id and spans, an array of (kind index in KINDS, start, end)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in spans_of(t.as_py())] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPAN_ARROW)], ["doc_id", "spans"])

    return id_and_text(docs, id_col, text_col).mapInArrow(scan, f"doc_id long, spans {SPAN_TYPE}")


def redacted(text: str) -> str:
    """``text`` with every span replaced by its kind in brackets; of spans that overlap, one mark for their union."""
    out, at = [], 0
    merged: list[list] = []
    for kind, start, end in sorted(spans_of(text), key=lambda s: (s[1], -s[2])):
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([kind, start, end])
    for kind, start, end in merged:
        out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with all spans in ``text_col`` masked; other columns as they are, a null text stays null."""
    ship(docs.sparkSession)
    at = docs.columns.index(text_col)

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else redacted(t) for t in (x.as_py() for x in batch.column(at))]
            columns = [pa.array(texts, batch.schema.field(at).type) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string")).mapInArrow(mask, docs.schema)


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, hash of their spans, and all spans as one string."""
    names = F.array(*[F.lit(k) for k in KINDS])
    label = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
    base = F.filter("spans", lambda s: s["kind"] < len(BASE_KINDS))
    count = lambda i: F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("long")
    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{k}") for i, k in enumerate(BASE_KINDS)],
        F.sha2(F.concat_ws(",", F.transform(base, label)), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform("spans", label)).alias("spans"),
    )
