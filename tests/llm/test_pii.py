"""Personal data: base spans against a plain regex scan, revealing terms."""

import hashlib
import re

from ratelake.llm import pii
from ratelake.llm.queries import op3_pii
from tests.llm.util import SF, frame, spark_rows

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (2 if i % 2 else 1)
        s += x - 9 if x > 9 else x
    return s % 10 == 0


def valid(kind, v):
    d = re.sub("[^0-9]", "", v)
    if kind == "ip":
        return all(int(p) <= 255 for p in v.split("."))
    if kind == "card":
        return 13 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 9 <= len(d) <= 15
    return True


def literal(text):
    return [
        (k, m.start(), m.end())
        for k, p in PLAIN.items()
        for m in re.finditer(p, text or "")
        if valid(k, m.group())
    ]


TEXTS = [
    None,
    "",
    "a@b.c_d@e.f x@y x@y.z. 1.2.3.4.5.6.7.8 256.1.1.1 007.1.1.255 00000000000000000001.2.3.4 99999999999999999999.1.1.1",
    "call +1 (366) 555-9807, +123 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 +1 (3",
    "5425 2334 3010 9903 5425-2334-3010-9903 5425  2334 3010 9903 4111111111111111 4111111111111112 1",
    "é 😀 ü a.b+c%d@ex-ample.co.uk 😀 10.0.0.1",
    "z" * 2000 + "@" + "9" * 2000 + " " + "1" * 3000 + ".1" * 300,
    "@@@@ .. + +1 a@b..c a@-.- 1.1.1.1@2.2",
]


def test_base_spans(spark):
    docs = frame(spark, [(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id int, text string, base string")
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.base] for r in pii.find_personal_data(docs).collect()}
    assert got == {i: literal(t) for i, t in enumerate(TEXTS)}


def test_revealing_terms_and_sanitise(spark):
    rows = [(i, f"Contact {'vwxyz'[i] * 4} Zanzibar {'abcde'[i] * 4} today, text mail bob@corp.example.com the end") for i in range(5)]
    rows += [(100 + i, f"the end of contact today other {'y' * i}") for i in range(60)]
    rows += [(200 + i, "copied unique1 wombat jane@corp.example.com") for i in range(9)]  # one text: one piece of evidence
    near = "this one long text about zebras goes on and on"
    rows += [(400 + i, f"{near} {'z' * (i + 3)} amy@corp.example.com") for i in range(8)]  # near copies: the same contexts
    rows += [(300, None), (301, ""), (301, "Zanzibar again")]
    docs = frame(spark, rows, "doc_id int, text string")
    got = {}
    for r in pii.find_personal_data(docs).collect():
        got.setdefault(r.doc_id, []).append([(s.start, s.end, s.value) for s in r.terms])
    for i in range(5):
        assert (13, 21, "Zanzibar") in got[i][0]
        assert not any(v in ("the", "end", "today", "bob", "corp") for _, _, v in got[i][0])
    assert got[400] == [[]] and got[200] == [[]] and got[100] == [[]] and got[300] == [[]]
    assert sorted(got[301]) == [[], [(0, 8, "Zanzibar")]]
    clean = {(r.doc_id, r.text) for r in pii.sanitise(docs).collect()}
    assert not any(t and ("bob@" in t or "Zanzibar" in t) for _, t in clean)
    assert (100, "the end of contact today other ") in clean


def test_query(spark):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = spark_rows(op3_pii(spark, SF))
    assert len(rows) == len(text)
    for r in rows:
        want = literal(text[r["doc_id"]])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(x[0] == k for x in want) for k in PLAIN]
        assert r["spans"].startswith(joined)


def test_empty_table(spark):
    assert pii.find_personal_data(frame(spark, [], "doc_id int, text string")).count() == 0


def test_terms_in_fixed_company(spark):
    """A name beside one address in texts of their own is found, whatever their number; near copies stay one text."""
    word = lambda i, j: "".join("abcdefghij"[int(c)] for c in str(10000 + 97 * i + j))
    own = lambda i: " ".join(word(i, j) for j in range(12))
    rows = [(i, f"{own(i)} John Smith john@corp.example.com {own(i + 40)}") for i in range(30)]
    long = " ".join(word(200, j) for j in range(60))
    rows += [(100 + i, f"{long} Wendy Brown wendy@other.example.com {word(300, i)}") for i in range(30)]
    rows += [(200 + i, own(400 + i)) for i in range(100)]
    docs = frame(spark, rows, "doc_id int, text string")
    got = {r.doc_id: {s.value for s in r.terms} for r in pii.find_personal_data(docs).collect()}
    assert all(got[i] == {"John", "Smith"} for i in range(30))
    assert all(not got[i] for i in range(100, 300) if i in got)


def test_many_matches_and_long_chains(spark):
    """Mail chains of thousands of parts and texts of very many matches end, in time."""
    texts = ["a@b" + ".b" * 200_000, "12 a " * 100_000, "1.2.3.4 x@y.z +1 (366) 555-9807 " * 4_000, "a@b.c," * 50_000]
    docs = frame(spark, list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.base] for r in pii.base_spans(docs).collect()}
    assert got == {i: literal(t) for i, t in enumerate(texts)}


def test_sanitise_at_the_spans_only(spark):
    texts = {
        1: ("call 1.2.3.4 or 21.2.3.4 or 256.2.3.4", "call [IP] or [IP] or 256.2.3.4"),
        2: ("é😀 1.2.3.4@x.org 😀 +1 (366) 555-9807!", "é😀 [EMAIL] 😀 [PHONE]!"),
        3: ("", ""),
        4: (None, None),
        5: ("nothing here", "nothing here"),
        6: ("a@b.c" * 3, None),
        7: ("x@y.z1.1.1.1 10.0.0.1 5425-2334-3010-9903", None),
    }
    docs = frame(spark, [(i, t) for i, (t, _) in texts.items()], "doc_id int, text string")
    for r in pii.sanitise(docs).collect():
        text, want = texts[r.doc_id]
        if want is None and text:
            # every character outside of the spans stays, every span goes
            covered = set().union(*(range(a, b) for _, a, b in literal(text)))
            rest = "".join(c for i, c in enumerate(text) if i not in covered)
            assert re.sub(r"\[(EMAIL|IP|CARD|PHONE)\]", "", r.text) == rest
        else:
            assert r.text == want
