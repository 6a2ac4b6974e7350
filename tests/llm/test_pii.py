import random
import re

import pytest

from umpire.llm import pii

RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base(text):
    out = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text):
            digits = re.sub(r"[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(len(p) < 20 and int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                  "card": 14 <= len(digits) <= 19 and pii.luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], list(RULES).index(s[2])))


def found(text):
    return [s for s in pii.find(text) if s[2] in pii.BASE]


@pytest.mark.parametrize("text", [
    "a@b.c@d.e f..g@h-.i- x@y @z.z é.ü@m.de a@b..c a%+@1.2.3", "1.2.3.4.5.6.7.8 999.1.1.1 1.2.3.256 01.02.03.004.",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 41111111111111111111 4111111111111111", "+1 (743) 555-3824 +12 +1+2 3 4 5 6 7 8 9 0 ++44 20 7946 0958. +",
    "12.34.56.78.90+1.2.3.4 5@6.7", "1٣.2.3.4 ٣٣.1.2.3.4", "7" * 5000 + "." + "1.2.3"])
def test_base_kinds_by_hand(text):
    assert found(text) == base(text)


def test_base_kinds_on_random_texts():
    rng = random.Random(5)
    for _ in range(4000):
        text = "".join(rng.choices("@.+-( )01234569 ab%é\n", k=rng.randint(0, 60)))
        assert found(text) == base(text), text
    for _ in range(300):
        number = "".join(rng.choices("0123456789", k=rng.randint(12, 20)))
        text = "x " + rng.choice([" ", "-", ""]).join(re.findall("..?.?.?", number)) + rng.choice([" 1", ".", " a"])
        assert found(text) == base(text), text


def test_table_matches_expressions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r["found"] for r in pii.personal_data(docs).collect()}
    for r in docs.collect():
        mine = [(s["start"], s["end"], s["kind"]) for s in got[r["doc_id"]] if s["kind"] in pii.BASE]
        assert mine == base(r["text"])


def test_added_kinds_and_redaction():
    text = 'see https://a.example/x?y=1, IBAN: DE89 3704 0044 0532 0130 00 and token = "0a1b2c3d4e5f6071" IBAN: DE00 3704 0044 0532 0130 00 token = short'
    spans = pii.find(text)
    assert [(s[2], text[s[0]:s[1]]) for s in spans if s[2] not in pii.BASE] == [
        ("url", "https://a.example/x?y=1,"), ("iban", "DE89 3704 0044 0532 0130 00"), ("secret", "0a1b2c3d4e5f6071")]
    assert "0a1b2c3d4e5f6071" not in pii.redact(text, spans) and pii.redact(None, []) is None
    assert pii.redact("ab", [(0, 1, "x"), (0, 2, "y")]) == "<x>"


def test_digest(spark):
    import hashlib
    docs = spark.createDataFrame([(1, "é a@b.co 1.2.3.4", 1), (None, None, 2), (3, "", 3)], "doc_id long, text string, found int")
    rows = {r["doc_id"]: r for r in pii.digest(pii.personal_data(docs)).collect()}
    assert rows[1]["spans"] == "email:2:8,ip:9:16" and rows[1]["n_email"] == 1 and rows[1]["n_ip"] == 1
    assert rows[1]["base_sha256"] == hashlib.sha256(b"email:2:8,ip:9:16").hexdigest()
    assert rows[None]["spans"] == "" and rows[3]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert pii.digest(pii.personal_data(docs.limit(0))).count() == 0


def test_leading_zeros_of_any_length():
    long = "0" * 30
    for text, n in ((f"{long}1.2.3.{long}255", 1), (f"1.2.3.{long}256", 0), (f"{long}.0.{long}.0", 1), ("0" * 19 + "1.2.3.4", 1)):
        assert [s for s in found(text) if s[2] == "ip"] == [(0, len(text), "ip")] * n
