"""Phrases against a plain version that counts them one by one."""

import random
import re
from collections import Counter

import pytest

from tallyline.llm import setm as S
from tallyline.llm import word_blocks

DDL = "doc_id bigint, text string, lang string, group string, block string, words string, f string"


def plain(rows, support=10, longest=3, top=2000):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = lang or "und"
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(w[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        rows = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in candidates.items()):
                continue
            score, _, x, y = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), x, y))
        for rank, (score, a, phrase, x, y) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, x, y, totals[lang], -score))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    words = ["New", "new", "York", "city", "of", "the", "été", "É", "x y", "a\x00b"] + [f"w{i}" for i in range(12)]
    rows = []
    for _ in range(150):
        text = "".join(rng.choice(["new york city", "United States of", *words]) + rng.choice([" ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "; ! ", " "]) for _ in range(rng.randint(0, 40)))
        rows.append((text, rng.choice(["en", "de", None])))
    return rows + [(None, "en"), ("", None), (" . ", "fr"), ("only a few words", "fr")] + [("the same line twice. " * 3, "es")] * 5 + [("aa aa aa aa " * 40, "zz")]


@pytest.mark.parametrize("seed, options", [(1, {}), (2, {"support": 3}), (3, {"support": 4, "longest": 4}), (4, {"top": 5})])
def test_matches_plain_version(spark, monkeypatch, seed, options):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, *r, "x", "y", "z", "w") for i, r in enumerate(rows)], DDL).repartition(3)
    if seed == 2:  # many blocks
        small = word_blocks.blocks
        monkeypatch.setattr(S, "blocks", lambda d, f: small(d, f, 100))
    phrases, totals = S.frequent_phrases(docs, support=options.get("support", 10), words=options.get("longest", 3))
    out = S.collocations(phrases, totals, options.get("top", 2000))
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, out.collect())) == plain(rows, **options)


def test_products_beyond_64_bits(spark):
    big = 3_000_000_000_000
    phrases = spark.createDataFrame([("en", ["a"], big + 7), ("en", ["b"], big + 1), ("en", ["a", "b"], big)], "lang string, words array<string>, f bigint")
    row = S.collocations(phrases, spark.createDataFrame([("en", 9 * big)], "lang string, n bigint")).first()
    assert row.score == 1_000_000 * big * big // ((big + 7) * (big + 1))


def test_empty_table(spark):
    phrases, totals = S.frequent_phrases(spark.createDataFrame([], DDL))
    assert S.collocations(phrases, totals).count() == 0


def test_answers_are_rows_and_batches_are_small(spark, monkeypatch):
    """No table that is written gathers the answers of a block in one value, and Python gets about one block at a time."""
    rows, seen, small, write = corpus(6), [], word_blocks.blocks, S.Workspace.write
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(limit)

    def spy(self, df, name):
        seen.append((name, df._jdf.queryExecution().optimizedPlan().toString(), spark.conf.get(limit)))
        return write(self, df, name)

    monkeypatch.setattr(S.Workspace, "write", spy)
    monkeypatch.setattr(S, "blocks", lambda d, f: small(d, f, 100))
    monkeypatch.setattr(S, "PART", 50)
    docs = spark.createDataFrame([(i, *r, "x", "y", "z", "w") for i, r in enumerate(rows)], DDL).repartition(3)
    phrases, totals = S.frequent_phrases(docs, support=3, words=4)
    assert sorted(map(tuple, S.collocations(phrases, totals).collect())) == plain(rows, support=3, longest=4)
    assert {"blocks", "occurrences", "groups-2", "groups-3", "groups-4"} <= {name for name, _, _ in seen}
    assert not [name for name, plan, _ in seen if "collect_list" in plan]
    assert {size for _, _, size in seen} == {"8m"} and spark.conf.get(limit) == before


def test_a_task_holds_few_blocks_of_many_groups(spark):
    texts = spark.createDataFrame([(i, f"g{i % 30}", "a b c") for i in range(60)], "id bigint, group string, text string").coalesce(1)
    out = word_blocks.blocks(texts, bytes.split, 10).collect()
    assert len(out) > 30 and sorted((i, r.group) for r in out for i in r.ids) == sorted((i, f"g{i % 30}") for i in range(60))
    assert sum(sum(r.counts) for r in out) == 180
