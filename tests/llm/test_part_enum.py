"""The n-gram Jaccard join against brute force."""

import random

import numpy as np
import pytest

from tallyline.llm import part_enum as J


def brute(docs, words=3, part=90, of=100):
    def shingles(text):
        w = (text or "").encode().lower().split()
        if not w:
            return frozenset()
        return frozenset([tuple(w)] if len(w) < words else [tuple(w[i : i + words]) for i in range(len(w) - words + 1)])

    sets = [(i, shingles(t)) for i, t in docs]
    top = {i: i for i, _ in docs}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and of * len(a & b) >= part * len(a | b):
                x, y = sorted((find(i), find(j)))
                top[y] = x
    return {(i, len(s), find(i)) for i, s in sets}


def family(rng, n, size, edits, first):
    words = [f"w{rng.randrange(10**6)}" for _ in range(size)]
    out = []
    for k in range(n):
        own = list(words)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(size)] = f"x{rng.randrange(10**6)}"
        out.append((first + k, " ".join(own)))
    return out


def rows():
    rng = random.Random(4)
    docs = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "two words"), (7, "Two  Words"), (8, "é É"), (9, "É é")]
    docs += family(rng, 60, 40, 2, 100) + family(rng, 60, 150, 8, 200) + family(rng, 40, 300, 10, 300) + family(rng, 30, 12, 1, 400)
    docs += [(1000 + i, " ".join(f"v{rng.randrange(10**5)}" for _ in range(rng.randint(1, 60)))) for i in range(60)]
    return docs


@pytest.mark.parametrize("words,part", [(3, 90), (5, 80)])
def test_components_are_those_of_all_links(spark, words, part, monkeypatch):
    docs = rows()
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id bigint, text string, label string").repartition(3)
    got = {tuple(r) for r in J.joined(df, words=words, similarity=(part, 100)).collect()}
    assert got == brute(docs, words, part)


def test_large_groups_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(J, "SMALL", 2)
    monkeypatch.setattr(J, "BLOCK", 8)
    monkeypatch.setattr(J, "PIVOTS", 1)
    docs = rows()
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert {tuple(r) for r in J.joined(df).collect()} == brute(docs)


def test_groups_move_in_proportion_while_few_are_outside_the_commonest_component(spark):
    rows = [(1, k, 7 if k >= 6 else k) for k in range(200)] + [(2, k, k % 2) for k in range(8)] + [(3, k, k) for k in range(40)]
    dealt = J._dealt(spark.createDataFrame(rows, "signature bigint, key bigint, label bigint"), 8).collect()
    count = {s: sum(r.signature == s for r in dealt) for s in (1, 2, 3)}
    assert count[1] == 194 + 6 * (1 + -(-194 // 8)) and count[2] == 8  # 200 rows went to 25 pairs of blocks each
    met = set()
    for place in {(r.signature, r.low, r.high) for r in dealt}:
        here = [r for r in dealt if (r.signature, r.low, r.high) == place]
        met |= {(place[0], *sorted((a.key, b.key))) for a in here if a.block == a.low for b in here if b.block == b.high}
    for s, k, label in rows:
        assert all((s, k, other) in met for s2, other, m in rows if s2 == s and k < other and m != label)


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(1)
    for part in (80, 90):
        bands = J.Bands(part, 100)
        for size in (5, 9, 10, 11, 50, 200, 900):
            for _ in range(20):
                a = np.unique(rng.integers(0, 2**63, size, np.uint64))
                most = size * (100 - part) // (100 + part)
                b = np.unique(np.concatenate([a[most:], rng.integers(0, 2**63, most, np.uint64)]))
                shared = len(np.intersect1d(a, b))
                if shared * 100 >= part * (len(a) + len(b) - shared) and shared < max(len(a), len(b)):
                    ways = 2 if part >= 85 else 3
                    assert len(np.intersect1d(J.signatures(a, bands, ways), J.signatures(b, bands, ways)))


def test_parities_lose_no_link():
    rng = np.random.default_rng(2)
    for size in (1, 2, 17, 127, 128, 129, 500, 2000):
        for _ in range(30):
            a = np.unique(rng.integers(0, 2**63, size, np.uint64))
            gone, more = rng.integers(0, size // 4 + 1, 2)
            b = np.unique(np.concatenate([a[gone:], rng.integers(0, 2**63, more, np.uint64)]))
            shared = len(np.intersect1d(a, b))
            for part in (80, 90):
                if shared * 100 >= part * (len(a) + len(b) - shared):
                    assert J.may_link(J.parities(a), J.parities(b), len(a) + len(b), (part, 100))
    far = [J.parities(rng.integers(0, 2**63, 300, np.uint64)) for _ in range(2)]
    assert not J.may_link(*far, 600, (80, 100))


def test_other_texts_under_the_id_of_a_linked_one(spark):
    words = [f"w{i}" for i in range(60)]
    near = words[:59] + ["x"]
    docs = [(4, " ".join(words)), (4, "quite another text of some words"), (4, " ".join(words)), (8, " ".join(near)), (9, "quite another text of some words")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    assert {(r.doc_id, r.component_id) for r in J.joined(df).collect()} == {(4, 4), (8, 4), (9, 4)}


def test_empty_table_and_repeated_ids(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert J.joined(none).count() == 0 and J.deduplicated(none).count() == 0
    text = "a b c d e f g h"
    df = spark.createDataFrame([(5, text, "p"), (5, text, "q"), (3, text, "r"), (None, text, "s"), (9, None, "t"), (9, "", "u")], "doc_id bigint, text string, id string")
    assert sorted(r.id for r in J.deduplicated(df).collect()) == ["r", "s", "t", "u"]
