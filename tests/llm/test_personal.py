"""Personal data against the contract's patterns in plain Python."""

import hashlib
import re

from corpus_fixture import SCHEMA, corpus, empty  # noqa: F401

from tissueframe.llm import personal

# The patterns as the contract gives them.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def good(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def base_spans(text):
    found = [(m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text or "") if good(kind, m.group())]
    return [(kind, s, e) for s, _, kind, e in sorted(found)]


TEXTS = [
    None, "", "nothing here", "a@b.c@d.e a@b.c_d@e.f x@y z@w..v .@a.b %+-@-.- a@b.c. ä@ö.de über.x@y.z", "mail\U0001f600 q@r.st \U0001f600 10.0.0.1",
    "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.1 00001.0.0.0 1.2.3 999999999999999999999999999999.1.1.1 1..2.3.4.5",
    "4111111111111111 4111 1111-1111 1111 4111111111111112 4111  1111 37828224631000 5 00000000000000 4111-1111-1111-1111-",
    "+1 (815) 555-3905 +49 30 123456 +1 +2 (( ) +12345678901234567 +1 (815) 555-3905 ext 4 +44.20.7946.0958.", "+" * 40 + "1234567890",
    "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432, not GB82WEST12345698765433 xDE89370400440532013000",
    "my SSN is 123-45-6789, order 123-45-6789, and 123-45-6789 alone; SSN 000-12-3456 ssn 900-12-3456 ssn 123-00-4567 ssn: 123-45-67890",
    "phone: 555-3905 or 030 1234567; tel 2024-01-15 tel. (030) 123 45 67, call 12345; order 5551234 Tel:5551234",
    "card 4111111111111111 version 10.0.0.1 host 10.0.0.1", "1 2" * 3000, "9" * 30000, "a." * 20000 + "@", "(1" * 5000, "AB12" * 4000,
]


def result(spark, texts):
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)
    return {r.doc_id: r for r in personal.find_personal(docs.withColumnsRenamed({"lang": "hits", "source": "start", "n_chars": "score"})).collect()}


def test_base_spans_equal_the_contract(spark, corpus):
    texts = TEXTS + [r[1] for r in corpus[0]]
    got = result(spark, texts)
    for i, text in enumerate(texts):
        base = base_spans(text)
        assert [s for s in got[i].spans.split(",") if s.split(":")[0] in PLAIN] == [f"{k}:{s}:{e}" for k, s, e in base]
        assert got[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in PLAIN] == [sum(b[0] == k for b in base) for k in PLAIN]
        assert len(got[i].spans.split(",")) == len(got[i].scores.split(","))


def added(row, text):
    """Added spans with their score."""
    spans = zip(row.spans.split(","), map(int, row.scores.split(",")))
    return [(k, text[int(s) : int(e)], n) for k, s, e, n in ((*s.split(":"), n) for s, n in spans) if k in ("iban", "ssn", "local")]


ADDED = [
    (TEXTS[9], [("iban", "DE89 3704 0044 0532 0130 00", 100), ("iban", "GB82WEST12345698765432", 90)]),
    ("my SSN is 123-45-6789", [("ssn", "123-45-6789", 70)]),
    ("a note of no more than a few words on many things. 123-45-6789", []),
    ("SSN 000-12-3456 ssn: 123-45-67890 ssn 900-12-3456", []),
    ("phone: 555-3905", [("local", "555-3905", 65)]),
    ("call (030) 123 45 67!", [("local", "(030) 123 45 67", 65)]),
    ("tel 2024-01-15, call 12345, tel in order 5551234", []),
    ("phone +1 (815) 555-3905", []),
    ("telling 5551234", []),
    ("ssn or phone 123-45-6789", [("ssn", "123-45-6789", 70)]),
]


def test_added_spans(spark):
    got = result(spark, [t for t, _ in ADDED])
    for i, (text, expected) in enumerate(ADDED):
        assert (added(got[i], text) if got[i].spans else []) == expected


def test_scores(spark):
    got = result(spark, ["visa 4111111111111111", "4111111111111111", "version 10.0.0.1", "server 10.0.0.1", "ISBN 10.0.0.1 host", "\n" * 50 + "10.0.0.1"])
    assert [got[i].scores for i in range(6)] == ["100", "75", "25", "90", "60", "55"]
    assert [got[i].n_sure for i in range(6)] == [1, 1, 0, 1, 1, 0]


def test_checksums(spark):
    from pyspark.sql import functions as F

    numbers = ["4111111111111111", "4111111111111112", "0", "79927398713", "79927398710", "12345678901234567897"]
    frame = spark.createDataFrame([(n,) for n in numbers], "d string").select("d", personal.luhn(F.col("d")).alias("ok"))
    assert [r.ok for r in frame.collect()] == [luhn(n) for n in numbers]
    accounts = ["DE89370400440532013000", "GB82WEST12345698765432", "GB82WEST12345698765433", "MT84MALT011000012345MTLCAST001S"]
    frame = spark.createDataFrame([(n,) for n in accounts], "d string").select(personal.mod97(F.col("d")).alias("ok"))
    assert [r.ok for r in frame.collect()] == [int("".join(str(int(c, 36)) for c in a[4:] + a[:4])) % 97 == 1 for a in accounts]


def test_empty_and_repeated(spark, empty):
    assert personal.find_personal(empty).count() == 0
    docs = spark.createDataFrame([(1, "a@b.cd", None, None, None)] * 2 + [(None, None, None, None, None)], SCHEMA)
    assert sorted(r.spans for r in personal.find_personal(docs).collect()) == ["", "email:0:6", "email:0:6"]
