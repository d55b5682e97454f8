"""Personal data against the patterns as given, and the terms that disclose it."""

import random
import re

from pyspark.sql import functions as F

from tallyline.llm import disclosure as D

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(x) <= 255 for x in m.group().split(".")),
                "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 8 <= len(digits) <= 15,
            }[kind]()
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans(spark):
    rng = random.Random(5)
    letters = "0123456789.@+- ()aé_%x"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    texts += [None, "", "a@b.c_x@d.e.f 4111111111111111 1.2.3.4.5.6.7.8", "4111 1111-1111 1111", "😀+1 (234) 567-8901 é", "1" * 50_000, "a." * 20_000 + "@x.y", "4 " * 20_000]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id bigint, text string, base string").repartition(4)
    rows = D.spans(df).select("carried.doc_id", F.transform("base", lambda s: F.struct(s["kind"], s["start"], s["end"])).alias("found")).collect()
    assert {r[0]: [tuple(x) for x in r[1]] for r in rows} == {i: brute(t) for i, t in enumerate(texts)}


def test_disclosing_terms_are_generalised_or_removed(spark):
    mail = "jo@firm.example"
    texts = [f"Call Wolpertinger about {c * 4} at {mail} {c * 5}" for c in "bcdefg"]
    texts += ["Nobody but Wolpertinger knows", "Call me about nothing"] + [f"call about common words {i}" for i in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = {r.doc_id: r.text for r in D.sanitised(df).collect()}
    assert out[0] == "Call [NEAR EMAIL] about bbbb at [EMAIL] bbbbb"
    assert out[6] == "Nobody but [NEAR EMAIL] knows" and out[7] == texts[7]


def test_copies_are_one_piece_of_evidence(spark):
    df = spark.createDataFrame([(i, "Unusualword near jo@firm.example here") for i in range(2000)], "doc_id bigint, text string")
    assert {r.text for r in D.sanitised(df).collect()} == {"Unusualword near [EMAIL] here"}


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert D.spans(none).count() == 0 and D.sanitised(none).columns == ["doc_id", "text"]
