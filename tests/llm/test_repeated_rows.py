"""Rows that repeat an id, have none, or have columns of any name are deduplicated like others."""

from tallyline.llm import part_enum as J

DDL = "doc_id bigint, text string, gone string, position bigint"
TEXT = " ".join(f"w{i}" for i in range(60))
NEAR = " ".join([*(f"w{i}" for i in range(59)), "x"])
OTHER = " ".join(f"v{i}" for i in range(60))


def test_one_row_of_each_group_stays(spark):
    rows = [(4, TEXT, "a", 0), (4, TEXT, "b", 1), (4, NEAR, "c", 2), (4, OTHER, "d", 3), (9, OTHER, "e", 4), (2, NEAR + " y", "f", 5), (7, "one more text", "g", 6), (7, "one more text", "h", 7)]
    out = J.deduplicated(spark.createDataFrame(rows, DDL).coalesce(1))
    assert out.columns == ["doc_id", "text", "gone", "position"]
    assert sorted(r.gone for r in out.collect()) == ["d", "f", "g"]


def test_rows_without_an_id(spark):
    rows = [(None, TEXT, "a", 0), (None, TEXT, "b", 1), (None, NEAR, "c", 2), (None, OTHER, "d", 3), (5, OTHER, "e", 4), (None, None, "f", 5), (None, " ", "g", 6)]
    out = J.deduplicated(spark.createDataFrame(rows, DDL).coalesce(1))
    assert sorted(r.gone for r in out.collect()) == ["a", "d", "e", "f", "g"]
