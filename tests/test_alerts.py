"""Fresh alerts, suppression, routing, messages, the audit contract."""

import json

import pytest
from pyspark.errors import SparkRuntimeException
from test_scoring import CASES, NOW, RULES, WS, baseline, live, rates

from tallyline.operators import alerts as A
from tallyline.operators import quality as Q
from tallyline.operators.scoring import score_clusters
from tallyline.params import Routing, Thresholds
from tallyline.schemas import EVENT_LOG, SCORES, conform_schema


def score_rows(make, rows):
    """(record, cluster, time, signal) to full score rows."""
    short = make([(r, WS, c, t, s) for r, c, t, s in rows], "record_id string, workspace_id bigint, cluster_id string, snapshot_ts timestamp, signal string")
    return conform_schema(short, SCORES)


def log_rows(make, rows):
    short = make(
        [(t, "message_sent", d, WS, a, s) for t, d, a, s in rows],
        "event_ts timestamp, event_type string, detector_name string, workspace_id bigint, asset_id string, severity string",
    )
    return conform_schema(short, EVENT_LOG)


def ids(df):
    return sorted(r.cluster_id for r in df.collect())


def test_fixture_has_six_alerts_and_five_sends(make):
    scores = score_clusters(live(make), rates(make), baseline(make), RULES, Thresholds(), NOW)
    prior = score_rows(make, [(None, "old-w", "2026-06-04 11:50:00", "WARNING"), (None, "old-c", "2026-06-04 11:45:00", "CRITICAL"),
                              (None, "old-ok", "2026-06-04 11:55:00", "OK")])
    alerts = A.alerts_latest(scores.unionByName(prior), NOW)
    assert alerts.count() == 6
    log = log_rows(make, [("2026-06-04 11:00:00", "cluster_cost", "zwarn", "WARNING"), ("2026-06-04 07:00:00", "cluster_cost", "zcrit", "CRITICAL")])
    sends = A.suppress_alerts(alerts, log, NOW)
    assert sends.count() == 5 and "zwarn" not in ids(sends) and "zcrit" in ids(sends)


def test_newer_ok_resolves_and_age_is_inclusive(make):
    rows = [
        ("1", "resolved", "2026-06-04 11:40:00", "CRITICAL"), ("2", "resolved", "2026-06-04 11:55:00", "OK"),
        ("3", "edge", "2026-06-04 11:30:00", "WARNING"), ("4", "stale", "2026-06-04 11:29:59", "CRITICAL"),
        ("5", "no-fallback", "2026-06-04 11:50:00", "WARNING"), (None, "no-fallback", "2026-06-04 11:59:00", "WARNING"),
    ]
    assert ids(A.alerts_latest(score_rows(make, rows), NOW)) == ["edge"]


def test_equal_times_have_one_winner(make):
    rows = [("b", "c", "2026-06-04 11:50:00", "WARNING"), ("a", "c", "2026-06-04 11:50:00", "CRITICAL")]
    assert [r.record_id for r in A.alerts_latest(score_rows(make, rows), NOW).collect()] == ["b"]


@pytest.mark.parametrize(
    "signal, detector, severity, sent, kept",
    [
        ("WARNING", "cluster_cost", "WARNING", "2026-06-03 12:00:00", False),  # exactly 24 h is not strictly older
        ("WARNING", "cluster_cost", "WARNING", "2026-06-03 11:59:59", True),
        ("CRITICAL", "cluster_cost", "CRITICAL", "2026-06-04 08:00:00", False),
        ("CRITICAL", "cluster_cost", "CRITICAL", "2026-06-04 07:59:59", True),
        ("CRITICAL", "cluster_cost", "WARNING", "2026-06-04 11:59:00", True),  # tiers are independent
        ("WARNING", "another", "WARNING", "2026-06-04 11:59:00", True),
    ],
)
def test_suppression(make, signal, detector, severity, sent, kept):
    alerts = A.alerts_latest(score_rows(make, [("1", "c", "2026-06-04 11:50:00", signal)]), NOW)
    out = A.suppress_alerts(alerts, log_rows(make, [(sent, detector, "c", severity)]), NOW)
    assert (out.count() == 1) is kept


@pytest.mark.parametrize(
    "mode, owner, tee, expected",
    [
        ("channel_only", "U1", False, [("#c", "channel_only")]),
        ("dm_with_fallback", "U1", True, [("U1", "dm"), ("#c", "tee_channel")]),
        ("dm_with_fallback", "U1", False, [("U1", "dm")]),
        ("dm_with_fallback", None, True, [("#c", "fallback_channel")]),
        ("dm_with_fallback", "", True, [("#c", "fallback_channel")]),
    ],
)
def test_routing(make, mode, owner, tee, expected):
    out = A.route_alerts(make([("a", owner)], "cluster_id string, creator_user_id string"), Routing(mode, "#c", tee))
    assert [(r.recipient, r.routing) for r in out.orderBy("target_no").collect()] == expected


def test_unknown_routing_mode(make):
    with pytest.raises(ValueError):
        A.route_alerts(make([("a", "U")], "cluster_id string, creator_user_id string"), Routing("shout", "#c"))


def test_owner_lookup(make):
    alerts = make([("1", " a@x "), ("2", "nobody"), ("3", None), ("4", ""), ("5", "b@x")], "cluster_id string, creator string")
    people = make([("a@x", "U2"), ("a@x", "U1"), ("nobody", "U9")], "email string, user_id string")
    assert {r.cluster_id: r.creator_user_id for r in A.lookup_owner(alerts, people).collect()} == {
        "1": "U1", "2": None, "3": None, "4": None, "5": None
    }


@pytest.fixture(scope="module")
def logged(make):
    scores = score_clusters(live(make), rates(make), baseline(make), RULES, Thresholds(), NOW)
    people = make([(c[2], f"U00000{i:02d}") for i, c in enumerate(CASES) if c[2] != "c@x"], "email string, user_id string").dropDuplicates(["email"])
    mean = baseline(make).selectExpr("workspace_id", "timestamp'2026-06-04' as computed_at", "1L as n_cluster_days", "mean_daily_dollars")
    alerts = A.render_plain_text(A.lookup_owner(A.alerts_latest(scores, NOW), people), mean)
    routed = A.render_alert_json(A.route_alerts(alerts, Routing("dm_with_fallback", "#ops", True)), "host.example.com")
    return A.event_log_rows(routed, NOW).cache(), scores


def test_event_log_rows(logged):
    log, scores = logged
    rows = {(r.asset_id, r.routing): r for r in log.collect()}
    assert rows[("budget", "dm")].plain == "CRITICAL: cluster blowup projected at $14,227/day (7,014% above average)"
    assert rows[("zwarn", "fallback_channel")].recipient == "#ops"
    assert set(rows[("budget", "dm")].asDict()) == {f.split()[0] for f in EVENT_LOG.split(", ")}
    details = json.loads(rows[("budget", "dm")].details_json)
    assert details["projected_daily_dollars"] == pytest.approx(14227.2) and set(details) == {
        "projected_daily_dollars", "z_score", "dollars_per_hour"
    }
    assert Q.check_join_back(log, scores).count() == 0


def test_card_shape(logged):
    for row in logged[0].collect():
        card = json.loads(row.blocks)
        assert [part["type"] for part in card] == ["header", "section", "section", "actions", "context"]
        assert card[3]["elements"][0]["url"].endswith(row.asset_id)


def test_unknown_mean_shows_question_mark(make):
    alerts = make([(1, "WARNING", "c", 10.0), (1, "WARNING", "d", None)], "workspace_id bigint, signal string, cluster_name string, projected_daily_dollars double")
    none = make([], "workspace_id bigint, computed_at timestamp, n_cluster_days bigint, mean_daily_dollars double")
    texts = {r.cluster_name: (r.formatted_dollars, r.formatted_percent) for r in A.render_plain_text(alerts, none).collect()}
    assert texts == {"c": ("$10", "?"), "d": ("?", "?")}


def test_contract(logged, make):
    log = logged[0]
    valid, rejected = Q.check_event_log(log)
    assert valid.count() == log.count() and rejected.count() == 0
    broken = log.limit(1).selectExpr("* except (record_id, blocks, event_type)", "null as record_id", "null as blocks", "'x' as event_type")
    broken = conform_schema(broken, EVENT_LOG)
    assert Q.check_event_log(broken)[1].first().violations == ["record_id_required", "event_type_recognized"]
    failed = conform_schema(log.limit(1).selectExpr("* except (message_ts, event_type)", "'message_failed' as event_type"), EVENT_LOG)
    assert Q.check_event_log(failed)[1].count() == 0
    assert Q.require_event_log(log).count() == log.count()
    with pytest.raises(SparkRuntimeException, match="contract broken"):
        Q.require_event_log(broken).collect()


def test_heartbeat(make):
    rows = [("1", "c", "2026-06-04 11:29:59", "OK")]
    assert Q.check_heartbeat(score_rows(make, rows), NOW).first().stale
    assert not Q.check_heartbeat(score_rows(make, [("1", "c", "2026-06-04 11:30:00", "OK")]), NOW).first().stale
