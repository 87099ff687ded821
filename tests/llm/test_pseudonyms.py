import datetime
import re

import pytest

from panelspark.llm import pseudonyms as ps


def one(spark, texts, key="k"):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r for r in sorted(ps.pseudonymise(df, key=key).collect(), key=lambda r: r["doc_id"])]


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if k % 2 == 0 else 2 * x - 9 * (x > 4) for k, x in enumerate(d)) % 10 == 0


def test_kinds_keep_their_format_and_validity(spark):
    texts = ["card 4111 1111 1111 1111 end", "4111111111111111$$$", "call +1 (386) 555-3733 or (386) 555-3733!!",
             "on 2024-02-29, 29/02/2024 and 29.02.2024.", "ssn 123-45-6789", "ip 10.255.0.1### x", "to Jo.b42@mail.example.com now"]
    out = one(spark, texts)
    for t, r in zip(texts, out):
        assert r["text"] != t and re.sub(r"\d", "0", r["text"]) == re.sub(r"\d", "0", t) or "@" in t or "10.255" in t
        assert r["n_found"] >= 1
    card = out[0]["text"][5:24]
    assert luhn(card) and card.replace(" ", "") == re.search(r"\d{16}", out[1]["text"]).group()
    a, b = re.findall(r"\(\d{3}\) \d{3}-\d{4}", out[2]["text"])
    assert a == b and out[2]["text"].startswith("call +1 ")
    iso, uk, de = re.findall(r"[\d/.-]{10}", out[3]["text"])
    assert datetime.date.fromisoformat(iso).strftime("%d/%m/%Y %d.%m.%Y") == f"{uk} {de}"
    assert all(int(x) < 256 for x in re.search(r"[\d.]+", out[5]["text"][3:]).group().split("."))
    assert re.fullmatch(r"to [A-Z][a-z]\.[a-z]\d\d@mail\.example\.com now", out[6]["text"])


def test_invalid_values_and_odd_rows_stay(spark, odd_docs, no_docs):
    same = ["", "4111111111111112", "2023-02-29", "31.02.2024", "300.1.1.1", "000-12-3456", "1.2.3.4.5", "v1.2.3", "a@b", "12345"]
    assert [r["text"] for r in one(spark, same)] == same
    got = ps.pseudonymise(odd_docs, "k").collect()
    assert len(got) == odd_docs.count() and ps.pseudonymise(no_docs, "k").collect() == []
    for r in got:
        if r["doc_id"] == 8:
            assert r["text"] is None and r["n_found"] == 0
        if r["doc_id"] == 14:
            assert r["n_card"] == r["n_date"] == r["n_mail"] == 1 and "<|endoftext|>" in r["text"]


def test_permutations_are_one_to_one(spark):
    dates = [(datetime.date(1990, 1, 1) + datetime.timedelta(k)).isoformat() for k in range(800)]
    out = [r["text"] for r in one(spark, dates)]
    assert len(set(out)) == 800 and out == [r["text"] for r in one(spark, dates)]
    assert out != [r["text"] for r in one(spark, dates, key="other")]
    phones = [f"212-555-{k:04d}" for k in range(600)]
    assert len({r["text"] for r in one(spark, phones)}) == 600


def test_no_python_in_the_plan(spark, odd_docs):
    plan = ps.pseudonymise(odd_docs, "k")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("n", [40_000])
def test_long_unbroken_text_is_linear(spark, n):
    assert one(spark, ["a" * n, "1" * n, "1." * n, "@" * n])[0]["text"] == "a" * n


def feistel(x, y, a, b, key, kind, turns=8):
    """The permutation written anew, value by value."""
    import hashlib
    for i in range(turns):
        h = hashlib.sha256(f"{key}|{kind}|{i}|{y}".encode()).hexdigest()
        x, y = y, (x + int(h[:14], 16)) % (a if i % 2 == 0 else b)
    return x, y


def test_phones_are_validated_and_permuted_among_valid_ones(spark):
    texts = ["call 000-000-0000 or 212-155-0000", "call +1 (212) 555-0187 now", "call 212-555-0187 now", "ring +49 301 555 0187",
             "ring +49 001 555 0187", "card 3782 822463 10005 here", "card 3782 822463 10006 here"]
    got = [r["text"] for r in one(spark, texts)]
    assert got[0] == texts[0] and got[4] == texts[4] and got[6] == texts[6]
    x, y = feistel(12, 355 * 10_000 + 187, 800, 8_000_000, "k", "phone")
    area, exchange, line = x + 200, y // 10_000 + 200, y % 10_000
    assert got[1] == f"call +1 ({area:03d}) {exchange:03d}-{line:04d} now" and got[2] == f"call {area:03d}-{exchange:03d}-{line:04d} now"
    x, y = feistel(2, 15550187, 9, 10 ** 9, "k", "phone abroad")
    made = f"{x + 1}{y:09d}"
    assert got[3] == f"ring +49 {made[:3]} {made[3:6]} {made[6:]}"
    digits = [int(c) for c in got[5] if c.isdigit()]
    assert got[5] != texts[5] and sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(digits[::-1])) % 10 == 0


def test_a_key_is_required(odd_docs):
    with pytest.raises(ValueError):
        ps.pseudonymise(odd_docs, "")
