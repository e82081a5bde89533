import hashlib
import random
import re
import string
import time

from paperloom.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(s):
    return [int(c) for c in s if c in "0123456789"]


def brute(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = digits(m[0])
        total = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d)))
        if 16 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


def base(text):
    return [s[:3] for s in pii.spans(text) if s[0] in pii.BASE]


def test_random_texts_equal_plain_patterns():
    rng = random.Random(5)
    for alphabet in ("a1.@-", "0123456789. ", "+01 ()-.", "ab@.%_+-é", "4111 1-"):
        for _ in range(1500):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
            assert base(text) == brute(text), text


def test_known_spans():
    assert base("card 4111 1111 1111 1111, 4111 1111 1111 1112") == [("card", 5, 24)]
    assert [s[0] for s in pii.spans("iban GB82WEST12345698765432 GB82WEST12345698765433")] == ["iban"]
    assert [s[0] for s in pii.spans("my ssn 123-45-6789")] == ["national_id"]
    assert pii.spans("lot 123-45-6789") == []
    near, far = pii.spans("phone +1 555 010 9999")[0][3], pii.spans("+1 555 010 9999")[0][3]
    assert near > far
    assert base("é" * 3 + "a@b.co") == [("email", 0 + 3, 9)]
    assert pii.redact("x a@b.co y") == "x <EMAIL> y" and pii.redact(None) is None
    assert pii.redact("a@1.2.3.4") == "<EMAIL>"


def test_spaced_accounts_and_secrets():
    found = lambda t: [(k, t[a:b]) for k, a, b, _ in pii.spans(t) if k not in pii.BASE]
    assert found("pay DE89 3704 0044 0532 0130 00 NOW") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert found("GB82 WEST 1234 5698 7654 32, DE89 3704 0044 0532 0130 01") == [("iban", "GB82 WEST 1234 5698 7654 32")]
    token = "f33e61083db5dbdf4bd2369d2f80176e57f7fda2"
    assert found(f'token = "{token}"') == found(f"api_key token={token}") == [("secret", token)]
    for n in (200, 201, 2_000, 1_000_000):  # no upper length
        long = "".join(random.Random(n).choices(string.ascii_letters + string.digits, k=n))
        assert found(f"password {long}.") == [("secret", long)]
    assert found(f"commit {token}") == found("secret " + "a" * 40) == found("key word-after-word-after-word-after") == found("key " + "9a" * 150) == []
    assert pii.redact(f'my token = "{token}".') == 'my token = "<SECRET>".'


def test_odd_rows(spark):
    rows = [(1, None), (1, None), (None, "a@b.co"), (2, ""), (3, "x" * 400_000 + " +1 555 010 9999")]
    df = spark.createDataFrame([(*r, "f", 1, 0.5) for r in rows], "doc_id long, text string, found string, _t int, score double")
    got = sorted((str(r.doc_id), [f.kind for f in r.found]) for r in pii.detect(df).collect())
    assert got == [("1", []), ("1", []), ("2", []), ("3", ["phone"]), ("None", ["email"])]
    assert pii.detect(df.limit(0)).count() == 0 and pii.redact_documents(df.limit(0)).count() == 0


def test_long_text_is_linear():
    assert base("a" * 300_000 + "@" * 3 + "1" * 300_000) == []
    for unit in ("AB12 ", "AB12 3456 ", "ab1-", "token 1a", "+1 ", "1."):
        began = time.perf_counter()
        pii.spans(unit * (300_000 // len(unit)))
        assert time.perf_counter() - began < 20, unit


def test_query_equals_brute_force(spark, data):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = pii.op1_pii(spark, data).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in want) for k in pii.BASE)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert len(r.scores.split(",")) == len(r.spans.split(","))
        assert [s for s in r.spans.split(",") if s.split(":")[0] in pii.BASE] == joined.split(",") or not want


def test_redaction_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, "a@b.co", 6, "x"), (2, None, 0, "y")], "doc_id long, text string, n_chars long, found string")
    got = {r.doc_id: r for r in pii.redact_documents(df).collect()}
    assert (got[1].text, got[1].n_chars, got[1].found, got[2].text) == ("<EMAIL>", 7, "x", None)
