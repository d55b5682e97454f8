"""The corpus operators on odd input: nulls, empty and long texts, repeated rows, empty tables, clashing columns."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import curriculum, html_paths, merkle, packing, site_bayes, suffix_dedup, token_fst, topk

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, row bigint, key bigint, n bigint, size bigint"


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(2)
    words = ["Tree", "house.", "été", "the", "of", "on***", "THE", "\n", "and"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 80))), "en", f"s{i % 4}" if i % 5 else None) for i in range(40)]
    rows += [(50, None, None, None), (51, "", "de", "s1"), (None, "no id here", "en", "s1"), (7, rows[7][1], "en", "s3"), (60, "long text. " * 30_000, "en", "s2")]
    return spark.createDataFrame([(*r, 0, "x", 1, 2, 3, 4) for r in rows], DOCS).repartition(3)


def test_fingerprints(docs):
    rows = merkle.edited_pairs(docs).collect()
    assert len(rows) == 45
    given = sorted(((-(2**63) if r.doc_id is None else r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (-r[0], r[1]))
    following = given[1:] + given[:1]
    want = []
    for (i, t), (_, u) in zip(given, following):
        n = len(t) // 3
        want.append((i, len(t), hashlib.sha256((t[: len(t) - n] + u[:n]).encode()).hexdigest(), merkle.fingerprint(t)))
    got = [(-(2**63) if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint) for r in rows]
    assert sorted(got) == sorted(want)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert merkle.edited_pairs(docs.limit(0)).count() == 0


def test_differences_locate_the_edit():
    lines = [f"This is line {i} of the text. It has a second sentence.\n" for i in range(200)]
    a, b = merkle.fingerprint("".join(lines)), merkle.fingerprint("".join([*lines[:100], "Something new!\n", *lines[101:]]))
    at = len("".join(lines[:100]))
    assert merkle.differences(a, a) == [] and merkle.differences(a, b) == [(at, at + len("This is line 100 of the text. "))]
    assert 0.98 < merkle.likeness(a, b) < 1 == merkle.likeness(a, a)


def test_pages(spark):
    page = ('<html><body><header>Site</header><div id="cookieNotice">We use cookies, ok?</div><ul class=menu><li>Home<li>About</ul>'
            '<div class="post"><h1>A &amp; B</h1><p>First  <b>bold</b>\n text,<br>more of it.<p>Second&nbsp;one, too. <script>x("</p>")</script></div>'
            '<form><input><label>Mail</label></form><div class="comments"><p>nice!</p></div><footer>(c)</footer></body>')  # fmt: skip
    df = spark.createDataFrame([(1, "u", page, "a"), (2, "u", None, "b"), (3, "u", "", "c"), (3, "u", "<<p>a<b></p", "d"), (None, "u", "<p>x", "e")], "page_id bigint, url string, html string, text string")
    got = {(r.page_id, r.text) for r in html_paths.extract(df).collect()}
    assert got == {(1, "A & B\nFirst bold text, more of it.\nSecond one, too."), (2, ""), (3, ""), (3, "<\na"), (None, "x")} or (3, "<a") in got
    assert html_paths.extract(df.limit(0)).count() == 0


def test_token_counts_are_the_library_s(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(token_fst.vocabulary_path())
    for chunk in (7, 1 << 16):
        rows = docs.filter("doc_id IS NULL OR doc_id <> 60") if chunk == 7 else docs
        got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in token_fst.token_counts(rows, chunk=chunk).collect())
        want = sorted((r.doc_id or -1, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in rows.collect())
        assert got == want


def test_transducer_on_odd_words():
    from tokenizers import Tokenizer

    rng, path = random.Random(1), token_fst.vocabulary_path()
    library = Tokenizer.from_file(path)
    letters = "abcdeé ñ'sStTreΣΔ0123１²!?#<|>́   \x1c\x85İßſK😀日本語เธﾊﾞ\n\t"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)] + ["<|endoftext|>a <|endoftext|>b's", "a" * 300]
    maps = [token_fst.chunk_maps(path, [t[i : i + 7] for i in range(0, max(1, len(t)), 7)]) for t in texts]
    assert token_fst.compose(path, maps) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_top_k(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4) / 8], 0) for i in range(200)]
    rows += [(300, None, 0), (301, [1.0, None, 0.0, 0.0], 0), (302, [float("nan"), 0.0, 0.0, 0.0], 0), (303, [float("inf"), 0.0, 0.0, 0.0], 0), (None, [1.0, 0.0, 0.0, 0.0], 0), (400, [1.0, 2.0], 0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, id int")
    vectors = {i: np.floor(64 * np.array(v)).astype(int) for i, v, _ in rows[:200]}
    want = set()
    for q in range(0, 200, 20):
        best = sorted(((-int(vectors[q] @ v), i) for i, v in vectors.items() if i != q))[:7]
        want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    assert {tuple(r) for r in topk.top_k(df, F.col("id") % 20 == 0, 7).collect()} == want
    assert topk.top_k(df.limit(0), F.col("id") % 20 == 0, 7).count() == 0


@pytest.mark.parametrize("group", [50_000, 2])
def test_repeated_passages(spark, group):
    rng = random.Random(3)
    base = ["".join(rng.choice("ab ") for _ in range(400)) for _ in range(6)]
    rows = [(i, None if i % 40 == 0 else rng.choice(base)[rng.randint(0, 100) :][: rng.randint(0, 300)] + rng.choice(["", "é" * 60, "abc" * 80]) + rng.choice(base)[: rng.randint(0, 350)]) for i in range(120)]
    rows.append((119, rows[-1][1]))
    seen, want = set(), []
    for i, t in sorted(rows, key=lambda r: r[0]):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                gone[p : p + 100] = b"\x01" * 100
            seen.add(data[p : p + 100])
        runs = sum(gone[p] and not (p and gone[p - 1]) for p in range(len(data)))
        want.append((i, len(data), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(data, gone) if not g)).hexdigest()))
    df = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id bigint, text string, key string").repartition(4)
    assert sorted(tuple(r)[:5] for r in suffix_dedup.removed(df, group=group).collect()) == sorted(want)
    assert suffix_dedup.removed(df.limit(0)).count() == 0


def test_mixing(docs):
    rows = curriculum.mixed(docs).collect()
    assert len(rows) == 45 and all(r.taken <= 3 * r.size for r in rows)
    by = {}
    for r in rows:
        by.setdefault((r.source_size, r.target), []).append(r.taken)
    assert all(abs(sum(t) - target) <= 1 for (_, target), t in by.items() if len(by) == 5)
    assert curriculum.mixed(docs.limit(0)).count() == 0


def test_packing(docs):
    rows = packing.pack(docs, size=64).collect()
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64
    total = sum(r.length for r in rows)
    assert len({r.doc_id for r in rows}) == 44 and len(by) <= 1.05 * total / 64 + 1
    assert packing.pack(docs.limit(0)).count() == 0


def test_plans_hold_the_histogram():
    lengths = np.clip(np.random.default_rng(0).lognormal(6.6, 1.0, 30_000).astype(int) % 2048 + 1, 1, 2048)
    lengths[:10_000] = 777
    histogram = {int(n): int(c) for n, c in zip(*np.unique(lengths, return_counts=True))}
    held = {}
    plan = packing.plan(histogram)
    for content, times in plan:
        assert sum(n * c for n, c in content) <= 2048
        for n, c in content:
            held[n] = held.get(n, 0) + c * times
    assert held == histogram
    assert sum(t for _, t in plan) < sum(t for _, t in packing.best_fit(histogram, 2048))


def test_quality(spark, docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, None), (999, 1), (None, 0)], "doc_id bigint, quality int")
    assert site_bayes.classified(docs, labels).count() == 45
    assert site_bayes.kept(docs, labels.limit(0)).count() == 45
    assert site_bayes.kept(docs.limit(0), labels).columns == docs.columns


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    test = labels.filter("doc_id % 2 = 1")
    found = site_bayes.classified(spark.read.parquet(f"{folder}/documents.parquet"), labels.filter("doc_id % 2 = 0"))
    right = found.join(test, "doc_id").agg(F.avg((F.col("keep") == (F.col("quality") == 1)).cast("double"))).first()[0]
    assert right > 0.97
