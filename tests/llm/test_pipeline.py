"""The pipeline on the smallest tables, stage by stage, against plain versions of what each stage must do."""

from collections import Counter

from test_disclosure import brute as personal
from test_part_enum import brute as components

import corpus_pipeline as P
from tallyline.llm.common import stored, table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    bad = {r.doc_id for r in table(spark, SF, "labels").filter("quality = 0").collect()}
    columns, outputs = docs.columns, []
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, SF), "test")
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns
        outputs.append(docs.collect())
    good, single, clean, mixed, packed = outputs
    everything = {r.doc_id for r in table(spark, SF, "documents").collect()}
    gone = everything - {r.doc_id for r in good}
    assert len(gone & bad) >= 0.9 * len(bad) and len(gone - bad) <= 0.2 * len(everything)
    kept = {c for i, _, c in components([(r.doc_id, r.text) for r in sorted(good)], 5, 80)}
    assert {r.doc_id for r in single} == kept
    assert {r.doc_id for r in clean} == kept and not any(personal(r.text) for r in clean)
    assert all(r.n_chars == len(r.text) for r in clean)
    uses = Counter(r.doc_id for r in mixed)
    assert set(uses) <= kept and max(uses.values()) <= 3
    places = {}
    for r in packed:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for rows in places.values():
        end = 0
        for offset, length in sorted(rows):
            assert offset == end
            end += length
        assert end <= 2048
    assert Counter(r.doc_id for r in packed if r.piece == 0) == uses


def test_a_run_leaves_only_the_last_stage_and_what_packing_reads(spark, tmp_path):
    """Tables that a finished stage needed are deleted, so disk does not add up over the stages."""
    context = spark.sparkContext
    before = context.getCheckpointDir()
    context.setCheckpointDir(str(tmp_path))
    try:
        rows = P.run(spark, SF).count()
        names = sorted(p.name.rsplit("-", 1)[0] for p in next(tmp_path.iterdir()).iterdir())
        kept = [p.name for p in next(tmp_path.iterdir()).glob("pipeline-*/*")]
    finally:
        context._jsc.sc().setCheckpointDir(before)
    assert rows > 0 and kept == ["mixing-to-target-weights"]
    assert not {"sets", "contents", "numbered", "groups", "labels", "mix", "sizes", "quality", "personal", "terms"} & set(names)
