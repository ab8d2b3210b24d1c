import hashlib
import random
import re

import pytest

from crashlake.llm import pii

from .conftest import ODD_TEXTS

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else None,
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def base_spans(text):
    return [(pii.KINDS[k], s, e) for k, s, e in pii.spans_of(text) if pii.KINDS[k] in PATTERNS]


def test_random_texts_match_the_whole_text_patterns():
    rng = random.Random(7)
    bits = ["@", "@@", "a@b.co", "x@y", "@b.c", ".", "..", "1.2.3.4", "256.1.1.1", "0001.2.3.4", "1.2.3.4.5.6.7.8", "+1 ", "+", "-", " ",
            "4111111111111111", "4111 1111-1111 1111", "5500000000000004", "00", "7", "é", "\n", "(", ")", "+49 (0) 30 123-456", "%", "a.b+c"]
    for _ in range(20000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 12)))
        assert base_spans(text) == brute(text), text


def test_known_items():
    text = "Mail bob@ex.org. See https://a.b/c?d=1, IBAN: GB82 WEST 1234 5698 7654 32 card 4111 1111 1111 1111 at 10.0.0.255 +1 (555) 010-9999!"
    found = {pii.KINDS[k]: text[s:e] for k, s, e in pii.spans_of(text)}
    assert found["email"] == "bob@ex.org" and found["url"] == "https://a.b/c?d=1"
    assert found["account"].replace(" ", "") == "GB82WEST12345698765432" or "account" not in found
    assert found["card"] == "4111 1111 1111 1111" and found["ip"] == "10.0.0.255"
    masked = pii.redacted(text)
    assert "bob@" not in masked and "4111" not in masked and "[EMAIL]" in masked


def test_address_parts_of_very_many_zeros():
    zeros = "0" * 5000
    for text, ok in ((f"{zeros}.1.2.3", True), (f"1.{zeros}255.{zeros}.3", True), (f"{zeros}256.1.2.3", False)):
        assert base_spans(text) == ([("ip", 0, len(text))] if ok else [])


def accounts(text):
    return [text[s:e] for k, s, e in pii.spans_of(text) if pii.KINDS[k] == "account"]


@pytest.mark.parametrize("iban", ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947", "MT84MALT011000012345MTLCAST001S"])
@pytest.mark.parametrize("after", ["", ".", " The money", " A", " BIC COBADEFFXXX", " COBADEFFXXX", " 12 May", "-X", "\nTo"])
def test_iban_ends_where_its_country_says(iban, after):
    assert accounts(f"IBAN: {iban}{after}") == [iban]
    assert pii.redacted(f"my IBAN {iban}{after}") == f"my IBAN [ACCOUNT]{after}"
    wrong = iban[:2] + f"{(int(iban[2:4]) + 1) % 97:02d}" + iban[4:]
    if iban[:2] != "NO":  # without its check it may be "no" and a number
        assert not accounts(f"IBAN: {wrong}{after}")


def test_iban_of_a_country_without_known_length():
    body = "12345678901234"
    iban = next(f"ZZ{k:02d}{body}" for k in range(2, 99) if pii._iban(f"ZZ{k:02d}{body}"))
    grouped = " ".join(iban[i : i + 4] for i in range(0, len(iban), 4))
    for code in (iban, grouped):
        for after in ("", " The money", " BIC COBADEFFXXX"):
            assert accounts(f"iban {code}{after}") == [code]


def test_other_accounts_end_before_a_word():
    for code in ("12345678", "1234-5678-90", "12 3456 78", "AB1234567", "123456 X78", "12-AB-345678", "1234567C"):
        for after in (" Please pay", " P", " PLEASE", "-Please", ", then", "", " Éa"):
            assert accounts(f"account {code}{after}") == [code], (code, after)
    assert accounts("account 12345678Please") == ["12345678"] and not accounts("account 12345 Please")
    assert pii.redacted("account 12345678 Please") == "account [ACCOUNT] Please"
    assert len(accounts("account " + "1" * 9000)) == 1 and not accounts("account 1" + "A" * 9000)


def test_known_iban_is_found_beside_other_items():
    text = "Mail bob@ex.org, IBAN: GB82 WEST 1234 5698 7654 32 card 4111 1111 1111 1111 at 10.0.0.255"
    assert accounts(text) == ["GB82 WEST 1234 5698 7654 32"]


def test_query_digest_and_odd_rows(docs_of):
    texts = [*ODD_TEXTS, "a@b.cd 1.2.3.4", "a@b.cd 1.2.3.4", "+1 555 010 9999 " * 3000]
    got = {r["doc_id"]: r for r in pii.digest(pii.find_pii(docs_of(texts))).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        spans = brute(t or "")
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert got[i]["spans"].startswith(joined)
        for k in PATTERNS:
            assert got[i][f"n_{k}"] == sum(s[0] == k for s in spans)


def test_redact_keeps_rows_columns_and_nulls(docs_of):
    docs = docs_of([None, "", "x a@b.cd y", (None, "+1 555 010 9999"), (3, "x a@b.cd y")][:3] + [(None, "+1 555 010 9999")])
    out = pii.redact(docs)
    assert out.columns == docs.columns
    assert sorted(out.select("doc_id", "text").collect(), key=str) == sorted(
        [(0, None), (1, ""), (2, "x [EMAIL] y"), (None, "[PHONE]")], key=str
    )


def test_empty_table(docs_of):
    assert pii.find_pii(docs_of([(0, "a")]).where("false")).count() == 0
