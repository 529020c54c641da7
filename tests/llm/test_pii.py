from __future__ import annotations

import hashlib
import random
import re
import time

from paygrain.llm import pii as P

from .conftest import SF


def brute(text):
    """The contract, read literally."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def base(text):
    return [(x.kind, x.start, x.end) for x in P.spans(text) if x.kind in P.BASE_KINDS]


def test_base_spans_by_brute_force():
    rnd = random.Random(4)
    parts = ["a@b.c", "@", ".", "-", " ", "+", "1", "12", "255", "256", "4111111111111111", "4111 1111-1111 1111", "(", ")", "x", "é", "١", "0001", "@a.b@c.d", "+1 (555) 010-9999"]
    for _ in range(6000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        assert base(text) == brute(text), repr(text)


def test_long_runs_take_linear_time():
    started = time.perf_counter()
    for text in ("1" * 300_000, "a" * 300_000, "1." * 150_000, "+1" * 150_000, "a@" * 150_000, "1-" * 150_000, "AA11" * 75_000, "0123 456 7890 " * 20_000):
        P.spans(text)
    assert time.perf_counter() - started < 60


def test_validators():
    assert P.mod97("GB82WEST12345698765432") and not P.mod97("GB83WEST12345698765432")
    assert P.luhn("4111111111111111") and not P.luhn("4111111111111112")
    text = "Transfer to bank account GB82 WEST 1234 5698 7654 32 today"
    assert [(x.kind, text[x.start : x.end]) for x in P.spans(text)] == [("iban", "GB82 WEST 1234 5698 7654 32")]
    assert not P.spans(text.replace("GB82", "GB83"))


def test_context_decides_added_phones():
    assert [x.kind for x in P.spans("please call (555) 010-9999 now")] == ["local_phone"]
    assert not P.spans("see order (555) 010-9999 now")


def test_scores_lie_between_zero_and_one():
    near, far = P.spans("my email a@b.org")[0], P.spans("version a@b.org")[0]
    assert 0 <= far.score < near.score <= 1


def test_redaction():
    text = "a@b.org or 10.0.0.1, +1 555 010 9999"
    assert P.redact(text) == "<EMAIL> or <IP>, <PHONE>"
    assert P.redact("") == "" and P.redact("clean") == "clean"


def test_messy(messy, none):
    found = P.find_pii(messy)
    assert found.count() == messy.count() and P.find_pii(none).count() == 0
    clean = P.redact_docs(messy)
    assert clean.columns == messy.columns and clean.count() == messy.count()
    before = {r["doc_id"]: r for r in messy.where("doc_id is not null").collect()}
    for r in clean.where("doc_id is not null").collect():
        old = before[r["doc_id"]]["text"]
        assert r["text"] == (None if old is None else P.redact(old))
        assert r["text"] is None or r["n_chars"] == len(r["text"])


def test_query(spark, documents):
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    for r in P.op3_pii(spark, SF).collect():
        want = brute(texts[r["doc_id"]])
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in P.BASE_KINDS] == [sum(x[0] == k for x in want) for k in P.BASE_KINDS]


def found(text):
    return [(x.kind, text[x.start : x.end]) for x in P.spans(text)]


def test_assigned_secrets():
    value = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    for text in (f'token = "{value}" x', f"TOKEN: '{value.upper()}'", f"api_key={value}", f'"secret": "{value}"', f"password = {value}."):
        assert [k for k, _ in found(text)] == ["secret"] and found(text)[0][1].lower() == value
    assert P.redact(f'a token = "{value}" b') == 'a token = "<SECRET>" b'
    for text in (f"commit {value}", 'token = "aaaaaaaaaaaaaaaaaaaaaaa1"', "token = internationalization", "tokens: 12", f"notatoken = {value}", "key = 1"):
        assert not found(text), text


def test_checked_national_numbers():
    assert found("DNI 12345678Z del titular") == [("national_id", "12345678Z")]
    assert not found("DNI 12345678A del titular")
    assert found("bank routing number 021000021") == [("routing", "021000021")]
    assert not found("bank routing number 021000022") and not found("part 021000021")


def test_planted_documents(spark):
    """Every document with an assigned hexadecimal token is found, and nothing but values of that form counts as one."""
    texts = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    planted = [t for t in texts if re.search(r'(?i)token = "[0-9a-f]{40}"', t)]
    assert planted
    for t in texts:
        values = [v for k, v in found(t) if k == "secret"]
        assert values == re.findall(r'(?i)token = "([0-9a-f]{40})"', t)


def test_ten_megabytes_in_linear_time():
    started = time.perf_counter()
    for text in ("token = " * 300_000, "key=" + "a1" * 1_000_000, "12345678Z " * 200_000, "x" * 10_000_000, "021000021 " * 200_000):
        P.spans(text)
    assert time.perf_counter() - started < 120
