"""Every use of a document has its own place in training."""

from collections import defaultdict

import corpus_pipeline as P
from tallyline.llm import curriculum
from tallyline.llm.common import stored

DDL = "doc_id bigint, text string, source string, position bigint"


def docs(spark):
    rows = [(i, "a b c d", "a", i) for i in range(5)] + [(10 + i, "a b c d", "b", i) for i in range(200)] + [(300, None, "b", 0)]
    return stored(spark.createDataFrame(rows, DDL).repartition(3), "test")


def test_uses_are_spread_over_the_demand(spark):
    rows = [r for r in curriculum.mixed(docs(spark)).collect() if r.source_size == 20]
    assert len(rows) == 5 and all(r.taken == 12 and len(r.positions) == 3 and r.position == r.positions[0] for r in rows)
    # the source's goal is 60 words of a weight that falls from 1.5 to 0.5
    want = sorted(1.5 - (2.25 - 2 * 4 * k / 60) ** 0.5 for k in range(15))
    assert all(abs(a - b) < 1e-9 for a, b in zip(sorted(p for r in rows for p in r.positions), want))


def test_shares_are_the_integrals_of_the_schedules(spark):
    """A source whose weight falls to 0 halfway has half the share that it would have at its first weight throughout."""
    rows = spark.createDataFrame([(i, "a b c d", s, i) for s, low in (("a", 0), ("b", 500)) for i in range(low, low + 100)], DDL)
    falling, level = ((0.0, 1.0), (0.5, 1.0), (0.5, 0.0), (1.0, 0.0)), ((0.0, 1.0), (1.0, 1.0))
    out = curriculum.mixed(rows, weights=(2.0,), schedules=(falling, level)).collect()
    assert {r.source_size for r in out} == {400}
    by_source = {s: [r for r in out if (r.doc_id < 500) == (s == "a")] for s in "ab"}
    assert abs(by_source["a"][0].target - 800 / 3) < 1e-6 and abs(by_source["b"][0].target - 1600 / 3) < 1e-6
    assert max(p for r in by_source["a"] for p in r.positions) <= 0.5 < max(p for r in by_source["b"] for p in r.positions)


def test_the_pipeline_mixes_all_uses(spark):
    out = P.mixing(spark, docs(spark), "")
    assert out.columns == ["doc_id", "text", "source", "position"]
    order = [r.doc_id for r in out.collect()]
    assert len(order) > 200 and all(order.count(i) == 3 for i in range(5))
    at = [k for k, i in enumerate(order) if i < 5]
    assert {order[k] for k in at[:5]} == {order[k] for k in at[5:10]} == set(range(5))
    assert at[5] > len(order) * 0.2 and at[-1] > len(order) * 0.8


def test_the_query_places_every_use(spark, tmp_path, monkeypatch):
    """The mixed order holds all uses with their words, and the query's rows are made of them, in the order of first uses."""
    rows = [(i, "a b c d", "a", i) for i in range(5)] + [(10 + i, "a b c d", "b", i) for i in range(200)] + [(300, None, "b", 0), (301, "x", None, 0)] + [(7, "a b", "a", 0)] * 2
    spark.createDataFrame(rows, DDL).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    kept = {}

    def keep(df, name):
        kept[name] = stored(df, name)
        return kept[name]

    monkeypatch.setattr(curriculum, "stored", keep)
    out = curriculum.op7_curriculum_mix(spark, str(tmp_path))
    assert out.columns == ["doc_id", "size", "source_size", "target", "taken", "position"]
    got = out.collect()
    uses, plan = kept["order"].collect(), {r.mix_row: r for r in kept["mix"].collect()}
    assert len(plan) == len(got) == len(rows) and sum(r.use is not None for r in uses) > len(rows) / 2
    times, words = defaultdict(list), defaultdict(int)
    for r in sorted(uses, key=lambda r: (r.mix_row, r.use or 0)):
        times[r.mix_row] += [] if r.use is None else [r.at]
        words[r.mix_row] += r.words
    assert all(times[k] == r.positions and words[k] == r.taken and (r.positions[:1] or [None])[0] == r.position for k, r in plan.items())
    assert max(map(len, times.values())) == 3
    place = lambda t: (t is None, t or 0.0)
    sorted_rows = curriculum.mixed_order(kept["mix"]).collect()
    assert [place(r.at) for r in sorted_rows] == sorted(place(r.at) for r in uses)
    assert [place(r.position) for r in got] == sorted(place(r.position) for r in got)
    want = [(r.doc_id, r.size, r.source_size, r.target, r.taken, None if r.position is None else round(r.position, 6)) for r in plan.values()]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)
