"""The fourteen scoring scenarios and the parts they do not reach."""

import pytest

from tallyline.functions.exprs import glob_to_regex
from tallyline.operators.scoring import score_clusters, signal_summary
from tallyline.params import ExclusionRules, Thresholds
from tallyline.schemas import SCORES
from tallyline.sources.live import decode_live_clusters

WS = 9999999999999999
NOW = "2026-06-04 12:00:00"
RULES = ExclusionRules(ids=["by-id"], name_patterns=["prod-etl-*"], creators=["service-bot@example.com"])
RATES = [  # node, photon, dollars per hour
    ("m5.large", False, 0.16), ("r5d.2xlarge", False, 0.80), ("r5d.2xlarge", True, 3.80), ("r5d.24xlarge", False, 9.60),
    ("r5d.24xlarge", True, 45.60), ("i3.4xlarge", False, 1.00), ("rd-fleet.2xlarge", False, 0.80), ("rd-fleet.2xlarge", True, 3.80),
]
# id, name, creator, node, workers, photon, signal, projected, z
CASES = [
    ("normal", "dev", "a@x", "m5.large", 2, False, "OK", 11.52, -2.1609153447),
    ("budget", "blowup", "b@x", "r5d.24xlarge", 12, True, "CRITICAL", 14227.2, 4.9579109043),
    ("zwarn", "train", "c@x", "r5d.2xlarge", 10, True, "WARNING", 1003.2, 2.3059501699),
    ("zcrit", "huge", "c@x", "r5d.2xlarge", 30, True, "CRITICAL", 2827.2, 3.3420421016),
    ("unknown", "weird", "d@x", "unobtanium.huge", 1, False, "UNKNOWN", None, None),
    ("by-name", "prod-etl-shared", "e@x", "r5d.2xlarge", 4, True, "EXCLUDED", None, None),
    ("fleet", "sandbox", "e@x", "rd-fleet.2xlarge", 2, True, "OK", 273.6, 1.0066671857),
    ("fallback", "cheap", "f@x", "i3.4xlarge", 2, True, "OK", 72.0, -0.3283338810),
    ("photon", "small", "g@x", "r5d.2xlarge", 2, True, "OK", 273.6, 1.0066671857),
    ("plainwarn", "etl", "h@x", "r5d.24xlarge", 4, False, "WARNING", 1152.0, 2.4442548413),
    ("plaincrit", "eng", "i@x", "r5d.24xlarge", 11, False, "CRITICAL", 2764.8, 3.3197235786),
    ("plainbudget", "runaway", "j@x", "r5d.24xlarge", 22, False, "CRITICAL", 5299.2, 3.9703111447),
    ("by-id", "always", "k@x", "r5d.2xlarge", 2, True, "EXCLUDED", None, None),
    ("by-creator", "job", "service-bot@example.com", "r5d.2xlarge", 2, True, "EXCLUDED", None, None),
]
LIVE = (
    "workspace_id bigint, cluster_id string, cluster_name string, creator string, cluster_source string, node_type string, "
    "driver_node_type string, num_workers int, photon boolean"
)


def rates(make, rows=RATES):
    return make(
        [(WS, n, p, d / 0.55, d, "FAST" if p else "PLAIN") for n, p, d in rows],
        "workspace_id bigint, node_type string, photon boolean, dbu_per_hour double, dollars_per_hour double, sku_name string",
    )


def baseline(make, mean_log=4.605, std_log=1.0):
    return make(
        [(WS, 200.0, 350.0, mean_log, std_log)],
        "workspace_id bigint, mean_daily_dollars double, stddev_daily_dollars double, mean_log_daily_dollars double, "
        "stddev_log_daily_dollars double",
    )


def live(make, cases=CASES):
    return make([(WS, c[0], c[1], c[2], "UI", c[3], c[3], c[4], c[5]) for c in cases], LIVE)


@pytest.fixture(scope="module")
def scores(make):
    return score_clusters(live(make), rates(make), baseline(make), RULES, Thresholds(), NOW).cache()


@pytest.mark.parametrize("case", CASES, ids=[c[0] for c in CASES])
def test_scenario(scores, case):
    row = scores.filter(scores.cluster_id == case[0]).first()
    assert row.signal == case[6]
    assert row.projected_daily_dollars == (None if case[7] is None else pytest.approx(case[7], abs=1e-9))
    assert row.z_score == (None if case[8] is None else pytest.approx(case[8], abs=1e-9))


def test_reasons(scores):
    reason = {r.cluster_id: r.reason for r in scores.collect()}
    assert reason["normal"] == "within thresholds"
    assert reason["budget"] == "projected_daily $14,227 > budget $5,000; log-z=5.0 > critical 3.0"
    assert reason["zwarn"] == "log-z=2.3 > warning 2.0"
    assert reason["unknown"] == "Missing pricing for driver=unobtanium.huge worker=unobtanium.huge photon=False"
    assert reason["by-id"] == "cluster_id by-id in exclusions"
    assert reason["by-name"] == "cluster_name matches pattern 'prod-etl-*'"
    assert reason["by-creator"] == "creator service-bot@example.com in exclusions"


def test_record_ids_unique_and_stable(scores, make):
    again = score_clusters(live(make), rates(make), baseline(make), RULES, Thresholds(), NOW)
    ids = {r.cluster_id: r.record_id for r in scores.collect()}
    assert len(set(ids.values())) == len(CASES)
    assert ids == {r.cluster_id: r.record_id for r in again.collect()}
    assert [f"{n} {t}" for n, t in scores.dtypes] == SCORES.split(", ")


def test_sku_follows_own_flag_when_rate_falls_back(scores):
    row = scores.filter("cluster_id = 'fallback'").first()
    assert row.photon and row.sku_name == "FAST" and row.dollars_per_hour == pytest.approx(3.0)


def test_summary(scores):
    assert {r.signal: r.clusters for r in signal_summary(scores).collect()} == {
        "CRITICAL": 4, "EXCLUDED": 3, "OK": 4, "UNKNOWN": 1, "WARNING": 2
    }


def test_no_spread_gives_no_z_and_budget_still_fires(make):
    out = score_clusters(live(make), rates(make), baseline(make, std_log=0.0), RULES, Thresholds(), NOW)
    rows = {r.cluster_id: r for r in out.collect()}
    assert rows["zcrit"].z_score is None and rows["zcrit"].signal == "OK"
    assert rows["budget"].z_score is None and rows["budget"].signal == "CRITICAL"


def test_thresholds_are_strict(make):
    case = ("edge", "n", "c", "m5.large", 2, False)
    at = score_clusters(live(make, [case]), rates(make), baseline(make), RULES, Thresholds(budget=11.52), NOW).first()
    assert at.projected_daily_dollars == 11.52 and at.signal == "OK"


def test_workspace_without_baseline_keeps_its_row(make):
    base = baseline(make)
    other = base.withColumn("workspace_id", base.workspace_id + 1)
    row = score_clusters(live(make, CASES[:1]), rates(make), other, RULES, Thresholds(), NOW).first()
    assert row.z_score is None and row.signal == "OK" and row.baseline_mean == 0.0


@pytest.mark.parametrize(
    "payload, workers, photon, driver",
    [
        ('{"executors":[{"node_id":"1"},{"node_id":"2"}],"num_workers":9,"node_type_id":"n"}', 2, False, "n"),
        ('{"executors":[],"num_workers":9,"node_type_id":"n","driver_node_type_id":"d"}', 9, False, "d"),
        ('{"num_workers":0,"autoscale":{"min_workers":4},"runtime_engine":"PHOTON"}', 0, True, None),
        ('{"autoscale":{"min_workers":4},"spark_version":"15.4.x-PHOTON-scala"}', 4, True, None),
        ('{"autoscale":{},"runtime_engine":"STANDARD"}', 0, False, None),
    ],
)
def test_live_decode(make, payload, workers, photon, driver):
    row = decode_live_clusters(make([(1, payload)], "workspace_id bigint, payload string")).first()
    assert (row.num_workers, row.photon, row.driver_node_type) == (workers, photon, driver)


@pytest.mark.parametrize(
    "pattern, hit, miss",
    [("a*", "abc\nd", "ba"), ("a?c", "abc", "ac"), ("[ab]x", "bx", "cx"), ("[!ab]x", "cx", "ax"), ("a.b", "a.b", "axb"),
     ("a[b", "a[b", "ab"), ("$^{}", "$^{}", "x"), ("x[^a]", "x^", "xb"), ("a]", "a]", "a")],
)
def test_glob(spark, pattern, hit, miss):
    from pyspark.sql import functions as F

    regex = glob_to_regex(pattern)
    row = spark.range(1).select(F.lit(hit).rlike(regex).alias("hit"), F.lit(miss).rlike(regex).alias("miss")).first()
    assert row.hit and not row.miss
