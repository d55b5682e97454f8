"""The current view reads each of its inputs once."""

import re

from tallyline.plans.registry import QUERIES
from tallyline.plans import all_queries  # noqa: F401

SF = "/root/testdata/sf0.001"


def test_one_scan_per_input_and_one_outer_join(spark):
    for name in ("asset_current", "observed_tags_policies"):
        df = QUERIES[name](spark, SF)
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString()
        text = text[: text.index("== Initial Plan ==")]
        assert len(re.findall(r"FileScan parquet .*events.parquet", text)) == 1, name
        assert len(re.findall(r"FileScan parquet .*customer.parquet", text)) == 1, name
        assert len(re.findall(r"FullOuter", text)) == 1, name
