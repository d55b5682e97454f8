"""Column expressions: tags, policies, text formats, JSON."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline.params import ExclusionRules, Thresholds
from tallyline.schemas import POLICIES

EMPTY_TAGS = "cast(map() as map<string,string>)"


def filled(c: Column) -> Column:
    """NULL for the empty string, the value otherwise."""
    return F.when(c != "", c)


# Fixed value: the characters Unicode counts as white space.
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated a single time.

    An expression repeated in a formula, or named inside a lambda, is evaluated
    at every mention; the variable of a one-element transform is not.
    """
    return F.transform(F.array(value), use)[0]


def last_per_key(items: Column, key: Callable[[Column], Column], empty: Column) -> Column:
    """Keep the last element of every key.  Lists without a repeated key pass through."""

    def unique(found: Column) -> Column:
        folded = F.aggregate(
            found, empty, lambda kept, item: F.concat(F.filter(kept, lambda o: key(o) != key(item)), F.array(item))
        )
        return F.when(F.size(F.array_distinct(F.transform(found, key))) == F.size(found), found).otherwise(folded)

    return once(items, unique)


# --- tags -------------------------------------------------------------------

ENTRIES = "array<struct<key:string,value:string>>"


def _map_of(entries: Column) -> Column:
    """Entries as a map in which a later entry replaces an earlier one; never NULL."""
    unique = last_per_key(entries, lambda e: e["key"], F.array().cast(ENTRIES))
    return F.coalesce(F.map_from_entries(unique), F.expr(EMPTY_TAGS))


def _clean_entries(entries: Column) -> Column:
    """Trim both sides, then drop blank keys and NULL values."""
    trimmed = F.transform(entries, lambda e: F.struct(strip(e["key"]).alias("key"), strip(e["value"]).alias("value")))
    return F.filter(trimmed, lambda e: (e["key"] != "") & e["value"].isNotNull())


def normalize_tags(tags: Column) -> Column:
    """Trim keys and values, drop blank keys and NULL values, keep blank values; never NULL."""
    return _map_of(_clean_entries(F.map_entries(tags)))


def tags_from_pairs(pairs: Column) -> Column:
    """``array<map<string,string>>`` of ``{key, value}`` objects to a normalised map.

    A pair without a ``value`` member keeps its key with a blank value; an
    explicit null value drops the pair, and with it an earlier pair of the very
    same key.
    """
    entries = F.transform(
        F.filter(pairs, lambda p: filled(p["key"]).isNotNull()),
        lambda p: F.struct(
            p["key"].alias("key"),
            F.when(F.map_contains_key(p, "value"), p["value"]).otherwise(F.lit("")).alias("value"),
        ),
    )
    return _map_of(_clean_entries(last_per_key(entries, lambda e: e["key"], F.array().cast(ENTRIES))))


def merge_tags(base: Column, override: Column) -> Column:
    """Union of two tag maps in which ``override`` wins."""
    both = F.concat(*[F.coalesce(F.map_entries(m), F.array().cast(ENTRIES)) for m in (base, override)])
    return _map_of(_clean_entries(both))


def _absent(required: Column, present: Column, fold: Callable[[Column], Column]) -> Column:
    """The elements of ``required`` that are not in ``present``; ``present`` is evaluated once."""
    start = F.struct(present.alias("present"), F.array().cast("array<string>").alias("absent"))
    return F.aggregate(
        required,
        start,
        lambda acc, r: F.struct(
            acc["present"].alias("present"),
            F.when(F.array_contains(acc["present"], fold(r)), acc["absent"])
            .otherwise(F.concat(acc["absent"], F.array(r)))
            .alias("absent"),
        ),
        lambda acc: acc["absent"],
    )


def observed_tag_keys(tags: Column) -> Column:
    """Lower-case keys that carry a non-blank value."""
    present = F.map_filter(tags, lambda k, v: v.isNotNull() & (F.trim(v) != ""))
    return F.transform(F.map_keys(present), F.lower)


def missing_tags(tags: Column, required: Column) -> Column:
    return _absent(required, observed_tag_keys(tags), F.lower)


# --- policies ---------------------------------------------------------------


def policy_struct(kind: str, policy_id: Column, name: Column | None = None) -> Column:
    """One policy attachment, or NULL when there is no id."""
    ident = filled(policy_id.cast("string"))
    label = F.lit(None).cast("string") if name is None else name
    return F.when(
        ident.isNotNull(),
        F.struct(F.lit(kind).alias("policy_type"), ident.alias("policy_id"), label.alias("policy_name")),
    )


def normalize_policies(policies: Column) -> Column:
    """Upper-case types, drop incomplete entries, one entry per (type, id) with the last winning, sorted."""
    clean = F.transform(
        policies,
        lambda p: F.struct(
            F.upper(strip(p["policy_type"])).alias("policy_type"),
            strip(p["policy_id"]).alias("policy_id"),
            p["policy_name"].alias("policy_name"),
        ),
    )
    whole = F.filter(clean, lambda p: (p["policy_type"] != "") & (p["policy_id"] != ""))
    none = F.array().cast(POLICIES)
    # Joined text compares by hash; a struct key would be compared pairwise.
    unique = last_per_key(whole, lambda p: F.concat_ws("\n", p["policy_type"], p["policy_id"]), none)
    return F.coalesce(F.sort_array(unique), none)


def missing_policies(policies: Column, required: Column) -> Column:
    return _absent(required, F.transform(policies, lambda p: p["policy_type"]), F.upper)


def parse_policy(definition: Column) -> Column:
    """A JSON object as ``map<path, rule JSON text>``; anything else is the empty map.

    Going through VARIANT keeps the JSON type of every rule (``5`` and ``"5"``
    stay different) and writes nested members in key order.
    """
    parsed = F.try_parse_json(definition).try_cast("map<string,variant>")
    return F.coalesce(F.transform_values(parsed, lambda _, rule: F.to_json(rule)), F.expr(EMPTY_TAGS))


def overlay(base: Column, override: Column) -> Column:
    """Map union by key in which ``override`` replaces whole values."""
    return _map_of(F.concat(F.map_entries(base), F.map_entries(override)))


def json_object(rules: Column) -> Column:
    """``map<path, JSON text>`` back to one JSON object, members in key order."""
    def member(entry: Column) -> Column:
        boxed = F.to_json(F.array(entry["key"]))  # ["key"], quoted and escaped
        return F.concat(F.substring(boxed, F.lit(2), F.length(boxed) - 2), F.lit(":"), entry["value"])

    members = F.transform(F.sort_array(F.map_entries(rules)), member)
    return F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))


# --- exclusion rules --------------------------------------------------------


def _bracket(body: str) -> str:
    """The inside of a glob's brackets as a regular expression.  Ranges the wrong way round hold nothing."""
    negated = body.startswith("!")
    items, i = [], 1 if negated else 0
    while i < len(body):
        if i + 2 < len(body) and body[i + 1] == "-":
            if body[i] <= body[i + 2]:
                items.append(f"{re.escape(body[i])}-{re.escape(body[i + 2])}")
            i += 3
        else:
            items.append("\\" + body[i] if not body[i].isalnum() and body[i] != "_" else body[i])
            i += 1
    if not items:
        return "." if negated else "(?!)"
    return f"[{'^' if negated else ''}{''.join(items)}]"


def glob_to_regex(pattern: str) -> str:
    """Translate a shell glob to an anchored regular expression.

    In brackets a leading ``!`` negates, a ``]`` right after it (or after the
    opening) is an ordinary character, and brackets never closed are too.
    """
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "[":
            first = i + 2 if pattern[i + 1 : i + 2] == "!" else i + 1
            close = pattern.find("]", first + 1 if pattern[first : first + 1] == "]" else first)
            if close > 0:
                out.append(_bracket(pattern[i + 1 : close]))
                i = close + 1
                continue
        out.append({"*": ".*", "?": "."}.get(ch) or (ch if ch.isalnum() or ch in "_-/ " else "\\" + ch))
        i += 1
    return r"(?s)\A" + "".join(out) + r"\z"


def exclusion_reason(rules: ExclusionRules, cluster_id: Column, cluster_name: Column, creator: Column) -> Column:
    """Why a cluster is excluded, or NULL: id first, then the first matching name glob, then the creator."""
    tests = []
    if rules.ids:
        tests.append(
            F.when(cluster_id.isin(list(rules.ids)), F.concat(F.lit("cluster_id "), cluster_id, F.lit(" in exclusions")))
        )
    for pattern in rules.name_patterns:
        hit = (cluster_name != "") & cluster_name.rlike(glob_to_regex(pattern))
        tests.append(F.when(hit, F.lit(f"cluster_name matches pattern '{pattern}'")))
    if rules.creators:
        tests.append(
            F.when(creator.isin(list(rules.creators)), F.concat(F.lit("creator "), creator, F.lit(" in exclusions")))
        )
    return F.coalesce(*tests) if tests else F.lit(None).cast("string")


def matches_rules(rules: ExclusionRules, cluster_name: Column, creator: Column) -> Column:
    """True where a name glob or a creator rule applies."""
    tests: Sequence[Column] = [cluster_name.rlike(glob_to_regex(p)) for p in rules.name_patterns]
    tests = [*tests, creator.isin(list(rules.creators))] if rules.creators else list(tests)
    hit = F.lit(False)
    for test in tests:
        hit = hit | F.coalesce(test, F.lit(False))
    return hit


# --- signals and text -------------------------------------------------------


def tier_signal(projected: Column, z: Column, limits: Thresholds) -> Column:
    """Budget beats z; both comparisons are strict; an unknown z never fires."""
    return (
        F.when(projected > limits.budget, "CRITICAL")
        .when(z > limits.z_critical, "CRITICAL")
        .when(z > limits.z_warning, "WARNING")
        .otherwise("OK")
    )


def dollars_text(amount: Column) -> Column:
    """``$1,234``, or ``?`` when unknown."""
    return F.coalesce(F.concat(F.lit("$"), F.format_number(amount, 0)), F.lit("?"))


def percent_above_text(amount: Column, mean: Column) -> Column:
    """Whole percent by which ``amount`` exceeds ``mean``; ``?`` when either is missing or zero."""
    share = F.when((mean > 0) & (amount != 0), (amount - mean) / F.when(mean > 0, mean) * 100.0)
    return F.coalesce(F.concat(F.format_number(share, 0), F.lit("%")), F.lit("?"))


def plain_number(c: Column, places: int) -> Column:
    """Fixed decimals, rounded half-even on the stored value, no thousands separators."""
    return F.regexp_replace(F.format_number(c, places), ",", "")


def weekday_only(day: Column) -> Column:
    """Monday to Friday."""
    return F.weekday(day) < 5


def sha_hex(*parts: Column) -> Column:
    """A stable identifier of its parts."""
    return F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)
