"""Repeated passages by doubling windows against a plain version: nulls, ties, repeated rows, long texts, clashing columns."""

import hashlib
import random
import re

import numpy as np
import pytest

from tallyline.llm import doubling_dedup as D
from tallyline.llm import word_blocks

DDL = "doc_id bigint, text string, block string, row string, words string, id string"


def plain(rows, length):
    """Every window against every other; ``rows`` are (id, text)."""
    low = -(2**63)
    texts = [(low if i is None else i, i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for key, _, w in texts:
        for p in range(len(w) - length + 1):
            s = tuple(w[p : p + length])
            first[s] = min(first.get(s, key), key)
    out = []
    for key, i, w in texts:
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            if first[tuple(w[p : p + length])] < key:
                gone[p : p + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def odd_rows(seed, count=60, length=6):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "é", "c d", "x" * 40, " ", "\x00", "."]
    passages = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(length - 2, 4 * length))) for _ in range(8)]
    rows = []
    for i in range(count):
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 5))]
        rows.append((i, rng.choice([" ", "\n", "  \t"]).join(parts)))
    rows += [(None, rows[3][1]), (None, passages[0]), (5, passages[1]), (7, rows[7][1]), (900, None), (901, ""), (902, " \n "), (903, rows[3][1]), (-4, passages[2])]
    return rows


@pytest.mark.parametrize("seed, length", [(1, 6), (2, 2), (3, 10)])
def test_matches_plain_version(spark, seed, length):
    rows = odd_rows(seed, length=length)
    docs = spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], DDL).repartition(4)
    out = D.repeated_passages(docs, length=length)
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept_sha256", "longest", "removed"]
    got = out.collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == plain(rows, length)
    assert all(sum(b - a for a, b in r.removed) == r.n_removed and (r.longest >= length) == (r.n_removed > 0) for r in got)


def test_whole_copies_long_texts_and_doubled_lengths(spark):
    rng = random.Random(9)
    text = " ".join(rng.choice("abcdefgh") + str(rng.randint(0, 50)) for _ in range(60_000))
    edited = " ".join(f"new{i}" if i % 900 == 450 else w for i, w in enumerate(text.split(" ")))
    rows = [(3, text), (1, text), (2, edited), (4, "one line of its own")]
    docs = spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], DDL).repartition(2)
    got = {r.doc_id: r for r in D.repeated_passages(docs).collect()}
    assert sorted((i, r.n_words, r.n_removed, r.kept_sha256) for i, r in got.items()) == plain(rows, 50)
    assert (got[1].longest, got[4].longest) == (0, 0)
    assert got[2].longest == 800 and got[3].longest == 51_200


def test_small_blocks_and_empty_table(spark, monkeypatch):
    rows = odd_rows(4)
    docs = spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], DDL).coalesce(1)
    small = word_blocks.blocks
    monkeypatch.setattr(D, "blocks", lambda d, f: small(d, f, 50))
    got = D.repeated_passages(docs, length=6).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == plain(rows, 6)
    assert D.repeated_passages(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        D.repeated_passages(docs, length=7)


def test_leftmost_least_and_groups():
    rng = np.random.default_rng(5)
    values = rng.integers(0, 6, 200).astype(np.uint64)
    for width in (1, 2, 7, 26):
        assert D.leftmost_least(values, width).tolist() == [p + int(values[p : p + width].argmin()) for p in range(200 - width + 1)]
    key, check = rng.integers(0, 5, 300).astype(np.uint64), rng.integers(0, 3, 300).astype(np.uint64)
    order, starts = D.grouped(key, check)
    assert len(starts) == len(set(zip(key.tolist(), check.tolist())))


def test_blocks_stay_where_they_are(spark, monkeypatch):
    plans, step = [], D._step

    def seen(rows, *more):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return step(rows, *more)

    monkeypatch.setattr(D, "_step", seen)
    before = {t.name for t in spark.catalog.listTables()}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with many blocks
    try:
        docs = spark.createDataFrame([(i, "a b c d e f g h i j k l") for i in range(6)], "doc_id bigint, text string").repartition(3)
        assert sorted(r.n_removed for r in D.repeated_passages(docs, length=4).collect()) == [0] + 5 * [12]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    for plan in plans[1:3]:
        lines = plan.split("\n")
        indent = [len(line) - len(line.lstrip(" :+-")) for line in lines]
        scan = next(i for i, line in enumerate(lines) if "codes#" in line and "FileScan parquet" in line)
        depth, above = indent[scan], []
        for at in range(scan - 1, -1, -1):
            if indent[at] < depth:
                depth = indent[at]
                above.append(lines[at])
        assert not any("Exchange" in line for line in above), plan
    assert {t.name for t in spark.catalog.listTables()} == before


def test_what_is_left_stays_where_it_is(spark, monkeypatch):
    plans, step = [], D._step

    def seen(rows, *more):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return step(rows, *more)

    monkeypatch.setattr(D, "_step", seen)
    before = {t.name for t in spark.catalog.listTables()}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with many blocks
    try:
        text = " ".join(f"w{i}" for i in range(40))
        docs = spark.createDataFrame([(i, text) for i in range(6)], "doc_id bigint, text string").repartition(3)
        assert sorted((r.n_removed, r.longest) for r in D.repeated_passages(docs, length=4).collect()) == [(0, 0)] + 5 * [(40, 32)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(plans) == 6
    for plan in plans[3:]:
        # the answers are gathered by block; the words beside them come from a scan and a sort, without an exchange
        lines = plan.split("\n")
        scan = next(i for i, line in enumerate(lines) if "codes#" in line and "FileScan parquet" in line)
        join = max(i for i, line in enumerate(lines[:scan]) if "SortMergeJoin" in line)
        assert not any("Exchange" in line for line in lines[join:scan]), plan
    assert {t.name for t in spark.catalog.listTables()} == before
