"""Policy definitions, overrides, terms and the catalogue."""

import json

from pyspark.sql import functions as F

from tallyline.functions.exprs import json_object, parse_policy
from tallyline.operators import policy as Y
from tallyline.schemas import POLICY, POLICY_TERM

POLICIES = (
    "workspace_id string, policy_id string, name string, description string, definition string, policy_family_id string, "
    "policy_family_definition_overrides string"
)


def test_parse_and_rebuild(make):
    texts = ['{"b": {"type": "x", "a": 1}, "a": "5", "n": 5, "z": null, "q\\"k": true}', "[1]", "nope", None, '"s"', "{}"]
    rows = make(list(enumerate(texts)), "i int, t string").select("i", parse_policy(F.col("t")).alias("m"))
    out = [r for r in rows.select("m", json_object(F.col("m")).alias("j")).orderBy("i").collect()]
    assert out[0].m == {"b": '{"a":1,"type":"x"}', "a": '"5"', "n": "5", "z": "null", 'q"k': "true"}
    assert json.loads(out[0].j) == json.loads(texts[0]) and list(json.loads(out[0].j)) == sorted(json.loads(texts[0]))
    assert all(r.m == {} and r.j == "{}" for r in out[1:])


def test_terms_keep_the_whole_rule(make):
    definition = {"node": {"type": "range", "maxValue": 5, "hidden": True}, "spark": {"type": "fixed", "value": "x", "isOptional": 1}, "flat": 7,
                  "text": "t", "off": {"hidden": False, "isOptional": 0}}
    rows = make([("1", "p", "n", None, json.dumps(definition), None, None)], POLICIES)
    families = make([], "policy_family_id string, definition string")
    terms = {r.definition_path: r for r in Y.flatten_policy_terms(Y.merge_policy(rows, families)).collect()}
    assert {p: (t.rule_type, t.hidden, t.is_optional) for p, t in terms.items()} == {
        "node": ("range", True, False), "spark": ("fixed", False, True), "flat": ("UNKNOWN", False, False), "text": ("UNKNOWN", False, False),
        "off": ("UNKNOWN", False, False),
    }
    assert json.loads(terms["node"].rule_json) == definition["node"] and json.loads(terms["flat"].rule_json) == {"value": 7}
    assert json.loads(terms["text"].rule_json) == {"value": "t"}


def test_family_override_replaces_the_whole_rule(make):
    family = make([("f", '{"auto": {"type": "range", "maxValue": 20}, "zone": {"type": "fixed"}}')], "policy_family_id string, definition string")
    rows = make([("1", "p", "n", None, '{"ignored": 1}', "f", '{"auto": {"maxValue": 5}}'), ("1", "q", "n", None, '{"own": 1}', "", None)], POLICIES)
    rules = {r.policy_id: {k: json.loads(v) for k, v in r.rules.items()} for r in Y.merge_policy(rows, family).collect()}
    assert rules == {"p": {"auto": {"maxValue": 5}, "zone": {"type": "fixed"}}, "q": {"own": 1}}


def test_catalogue_adds_attached_policies(make):
    inventory = make(
        [("1", "job", "b", [("BUDGET_POLICY", "x", "second"), ("COMPUTE_POLICY", "p", None)]), ("1", "job", "a", [("BUDGET_POLICY", "x", "first")]),
         ("1", "cluster", "c", [("COMPUTE_POLICY", "gone", "old name")])],
        "workspace_id string, asset_type string, asset_id string, policies array<struct<policy_type:string,policy_id:string,policy_name:string>>",
    )
    rows = make([("1", "p", "Listed", "d", '{"a": 1}', None, None)], POLICIES)
    families = make([], "policy_family_id string, definition string")
    policies, terms = Y.policy_snapshot(rows, families, inventory, "r", "2024-01-31")
    out = {(r.policy_type, r.policy_id): (r.policy_name, r.definition_json) for r in policies.collect()}
    assert out == {
        ("COMPUTE_POLICY", "p"): ("Listed", '{"a":1}'), ("BUDGET_POLICY", "x"): ("first", None), ("COMPUTE_POLICY", "gone"): (None, None)
    }
    assert [c for c in policies.columns] == [f.split()[0] for f in POLICY.split(", ")]
    assert [c for c in terms.columns] == [f.split()[0] for f in POLICY_TERM.split(", ")] and terms.count() == 1
