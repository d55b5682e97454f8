"""Disk of the corpus operators: tables that nothing reads any more go, and texts without a partner are not moved."""

import os
import random

from tallyline.llm import common, part_enum

DDL = "doc_id bigint, text string"


def rows(n=60):
    rng = random.Random(3)
    base = [" ".join(f"w{rng.randrange(10**5)}" for _ in range(120)) for _ in range(n)]
    near = [t.replace(t.split(" ", 1)[0], "other", 1) for t in base[: n // 3]]
    return list(enumerate(base + near + base[:5]))


def folder_of(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_dir", lambda _: str(tmp_path))
    return lambda: sorted(f"{d}/{x}" for d in os.listdir(tmp_path) for x in os.listdir(tmp_path / d) if not x.startswith((".", "_")))


def test_a_join_leaves_its_result_alone(spark, tmp_path, monkeypatch):
    left = folder_of(spark, tmp_path, monkeypatch)
    out = part_enum.joined(spark.createDataFrame(rows(), DDL))
    assert [x.split("/")[1] for x in left()] == ["joined"]
    found = {r.doc_id: r.component_id for r in out.collect()}
    assert found == {i: i % 60 if i < 80 else i - 80 for i in range(85)}


def test_deduplication_leaves_the_rows_and_what_goes(spark, tmp_path, monkeypatch):
    left = folder_of(spark, tmp_path, monkeypatch)
    out = part_enum.deduplicated(spark.createDataFrame(rows(), DDL))
    assert [x.split("/")[1] for x in left()] == ["gone", "numbered"]
    assert sorted(r.doc_id for r in out.collect()) == list(range(60))


def test_a_sieve_keeps_every_partner_and_moves_few_others(spark):
    ids = [-(2**63), -5, 0, 7, 2**62, *range(10_000, 13_000, 3)]
    among = spark.createDataFrame([(i,) for i in ids], "id bigint")
    rows = spark.createDataFrame([(i,) for i in [None, *ids, *range(20_000, 60_000)]], "id bigint")
    out = common.sieved(rows, "id", among).collect()
    assert len(out) == len(ids) + 40_001
    assert all(r.maybe for r in out if r.id in set(ids))
    assert sum(r.maybe for r in out if r.id is None or r.id >= 20_000) < 4_000
    assert not any(r.maybe for r in common.sieved(rows, "id", among.limit(0)).collect())


def test_texts_are_sieved_before_they_are_shuffled(spark):
    docs = spark.createDataFrame(rows(), DDL)
    kept = common.sieved(docs, "doc_id", spark.createDataFrame([(1,), (2,)], DDL.split(",")[0])).filter("maybe")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_doubling_leaves_no_level_behind(spark, tmp_path, monkeypatch):
    from tallyline.llm import doubling_dedup

    left = folder_of(spark, tmp_path, monkeypatch)
    rng = random.Random(5)
    long = " ".join(f"w{rng.randrange(10**5)}" for _ in range(900))
    out = doubling_dedup.repeated_passages(spark.createDataFrame([(0, "a b " + long), (1, "c " + long), (2, "d e f")], DDL))
    assert not [x for x in left() if "level" in x or "answers" in x or "masks" in x]
    assert [(r.doc_id, r.n_removed, r.longest) for r in out.orderBy("doc_id").collect()] == [(0, 0, 0), (1, 900, 800), (2, 0, 0)]
