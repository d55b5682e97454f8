"""Which terms disclose an entity: by its own information, over whole documents."""

from tallyline.llm import disclosure as D

MAIL = "jo@firm.example"


def own(i):
    """Words of one document only."""
    return " ".join(f"q{'abcdefghij'[k]}{j}x{i}" for k in range(10) for j in range(4))


def out(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    return {r.doc_id: r.text for r in D.sanitised(df).collect()}


def test_small_tables_signatures_and_far_words(spark):
    far = " and so on with one more word" * 8
    texts = [f"{own(i)} by Grimwald in room B-113{far} yours, the office {MAIL} ends" for i in range(12)]
    texts += [f"Paper {i} of the office ends here{far} yours" for i in range(80)] + ["Grimwald wrote this", "seen in B-113 again"]
    got = out(spark, texts)
    assert all("Grimwald" not in t and "B-113" not in t for t in got.values())
    assert got[20] == texts[20] and got[0].count("office") == 1


def test_frequent_entities_need_more_documents(spark):
    texts = [f"{own(i)} {'Grimwald' if i < 25 else 'somebody'} {'Chance' if i in (1, 2, 9) else ''} writes from {MAIL}" for i in range(40)]
    texts += [f"Number {i}y somebody writes from home" for i in range(80)]
    got = out(spark, texts)
    assert "Grimwald" not in got[0] and "Chance" in got[1] and "somebody" in got[30] and got[50] == texts[50]


def test_copies_are_one_document(spark):
    edited = [f"Rareword is near {MAIL} in this long text of {own(0)} {own(1)} {own(2)} with edit{i}" for i in range(9)]
    texts = [f"Rareword is near {MAIL}"] * 50 + edited + [f"Other text {i}" for i in range(300)] + [f"{i} {MAIL}" for i in range(3)]
    got = out(spark, texts)
    assert "Rareword" in got[0] and own(1) in got[50]
