"""Personal data and the terms that give it away.

Base entities (mail and IP addresses, card and phone numbers) are found by
pattern and checked (ranges, digit counts, Luhn).  Information-theoretic
sanitisation then looks at the words of their documents over the whole corpus:
a term's disclosure of an entity is the pointwise mutual information between
"the document has the term" and "the document has the entity".  Terms that
point to one entity in at least half of their documents, with at least the
share ``information`` of what the entity itself tells (the logarithm of how
rare it is), and in at least ``support`` documents, are spans as well, wherever
they stand.  So that no chance meeting with a frequent entity counts, these
documents together must give as many bits as it takes to name a pair of
documents.  Equal texts are one document here.  Edited copies are one piece of
evidence: documents divided by the largest group of copies must reach ``support``.

``spans`` gives all spans, ``sanitised`` the text with base entities replaced
by their kind, disclosing terms generalised to the kind of their entity, or
removed where they point to it in nine of ten documents.

Null text counts as empty.  Rows with equal ids stay apart.  Offsets are code
points, end exclusive.  Everything is DataFrame functions; texts stay in their
rows, positions come from the lengths of the gaps between matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.exprs import once
from tallyline.llm.common import stored, table, whole

KINDS = ("email", "ip", "card", "phone")
#: What a text must have for a pattern to be worth trying; each is implied by an accepted match.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}
#: The contract's patterns, written so that Java neither backtracks into runs nor recurses.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:(?<![0-9])|\G)[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SUPPORT, SHARE, INFORMATION, REMOVE = 3, 0.5, 0.75, 0.9
BANDS, ROWS = 4, 4
RUN = 256

#: A possible term: words, names with marks, numbers and codes; two signs where a script needs no more.
TERM = r"[\p{L}\p{N}][\p{L}\p{M}\p{N}'’-]{2,}+|[\p{IsHan}\p{IsHangul}]{2}"

SPAN = "struct<kind:string,start:bigint,end:bigint,value:string>"


def running(lengths: Column) -> Column:
    """Sums of all elements before each, in two levels, so that long arrays stay cheap.  ``lengths`` must be a stored or bound value."""
    add = lambda s, x: s + x
    zero = F.lit(0).cast("bigint")
    number = F.greatest(F.lit(1), F.ceil(F.size(lengths) / RUN)).cast("int")
    sums = F.transform(F.sequence(F.lit(0), number - 1), lambda b: F.aggregate(F.slice(lengths, b * RUN + 1, RUN), zero, add))
    before = F.aggregate(sums, F.array(zero), lambda out, x: F.concat(out, F.array(F.element_at(out, -1) + x)))

    def each(before: Column) -> Column:
        return F.transform(
            lengths,
            lambda _, i: F.element_at(before, (F.floor(i / RUN) + 1).cast("int"))
            + F.aggregate(F.slice(lengths, (F.floor(i / RUN) * RUN + 1).cast("int"), F.pmod(i, F.lit(RUN))), zero, add),
        )

    return once(before, each)


def matches(text: Column, pattern: str) -> Column:
    """``(start, value)`` of every match, left to right."""
    size = lambda s: F.char_length(s).cast("bigint")
    whole_pattern = F.lit(rf"(?s)\G(.*?)({pattern})")  # without \G the search after the last match would start anew at every place
    gaps, values = F.regexp_extract_all(text, whole_pattern, F.lit(1)), F.regexp_extract_all(text, whole_pattern, F.lit(2))

    def place(m: Column) -> Column:
        lengths = F.zip_with(m["gaps"], m["values"], lambda g, v: size(g) + size(v))
        starts = once(lengths, lambda n: F.zip_with(running(n), m["gaps"], lambda b, g: b + size(g)))
        return F.zip_with(starts, m["values"], lambda s, v: F.struct(s.alias("start"), v.alias("value")))

    return once(F.struct(gaps.alias("gaps"), values.alias("values")), place)


def _valid(kind: str, value: Column) -> Column:
    if kind in ("phone", "card"):
        return once(F.regexp_replace(value, "[^0-9]", ""), _right_length if kind == "phone" else _luhn)
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])$"))
    raise ValueError(kind)


def _right_length(digits: Column) -> Column:
    return F.char_length(digits).between(8, 15)


def _luhn(digits: Column) -> Column:
    n = F.char_length(digits)

    def weighed(d: Column, i: Column) -> Column:
        twice = d.cast("int") * F.when(F.pmod(n - i, F.lit(2)) == 0, 2).otherwise(1)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.transform(F.split(digits, "(?!^)(?!$)"), weighed), F.lit(0), lambda s, x: s + x)
    return F.when(n.between(16, 19), total % 10 == 0).otherwise(False)


def found(text: Column, kind: str) -> Column:
    """The accepted spans of one kind."""
    end = lambda m: m["start"] + F.char_length(m["value"])
    spans = F.transform(matches(text, PATTERNS[kind]), lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), end(m).alias("end"), m["value"].alias("value")))
    likely = F.instr(text, HINTS[kind]) > 0 if kind == "email" else text.rlike(HINTS[kind])
    return F.when(likely, F.filter(spans, lambda s: _valid(kind, s["value"]))).otherwise(F.array().cast(f"array<{SPAN}>"))


def base_spans(docs: DataFrame, text_col: str) -> DataFrame:
    """``(row, text, base, carried)``: a number for every row, its whole text, its base spans, and its own columns."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), whole(text_col).alias("text"), F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_col)).alias("carried")
    )
    return rows.withColumn("base", F.concat(*(found(F.col("text"), k) for k in KINDS)))


def _terms(piece: Column) -> Column:
    """Matches of ``TERM``, lower case."""
    return F.regexp_extract_all(F.lower(piece), F.lit(TERM), F.lit(0))


def entities(rows: DataFrame) -> DataFrame:
    """``(row, kind, entity)`` of every base span, once a row."""
    value = F.when(F.col("s.kind").isin("card", "phone"), F.regexp_replace("s.value", "[^0-9]", "")).otherwise(F.lower("s.value"))
    return rows.select("row", F.explode("base").alias("s")).select("row", F.col("s.kind").alias("kind"), value.alias("entity")).distinct()


def _beside(text: Column) -> Column:
    """The distinct terms of a text outside its addresses and phone numbers."""
    for kind in ("email", "ip", "phone"):
        text = F.regexp_replace(text, PATTERNS[kind], " ")
    return F.array_distinct(_terms(text))


def sketch(terms: Column) -> Column:
    """Bands of least hashes: edited copies agree on most bands, different texts hardly on any."""
    least = lambda t, seed: F.array_min(F.transform(t, lambda x: F.xxhash64(x, F.lit(seed))))
    return once(terms, lambda t: F.array(*(F.xxhash64(*(least(t, ROWS * b + i) for i in range(ROWS))) for b in range(BANDS))))


def disclosing_terms(rows: DataFrame, support: int = SUPPORT, share: float = SHARE, information: float = INFORMATION) -> DataFrame:
    """``(term, kind, share)`` of the terms beyond the thresholds, each with the entity it points to most."""
    firsts = stored(rows.groupBy(F.sha2("text", 256).alias("same")).agg(F.min("row").alias("row")).select("row"), "firsts")
    held = stored(entities(rows).join(firsts, "row", "left_semi"), "entities")
    # an entity in fewer documents than the support has no term
    often = held.groupBy("kind", "entity").agg(F.count("*").alias("with_entity")).filter(F.col("with_entity") >= support)
    held = held.join(often.select("kind", "entity"), ["kind", "entity"], "left_semi")
    near = rows.filter(F.size("base") > 0).select("row", _beside(F.col("text")).alias("terms")).join(held.select("row").distinct(), "row", "left_semi")
    near = stored(near.select("row", "terms", sketch(F.col("terms")).alias("sketch")), "beside")
    pairs = near.select("row", F.explode("terms").alias("term")).join(held, "row").groupBy("term", "kind", "entity").agg(F.count("*").alias("docs"))
    pairs = stored(pairs.filter(F.col("docs") >= support), "together")
    # documents that agree on a band are copies of each other, and the largest such group is one piece of evidence
    alike = near.select("row", F.explode("terms").alias("term"), "sketch").join(held, "row").join(pairs.drop("docs"), ["term", "kind", "entity"], "left_semi")
    alike = alike.select("term", "kind", "entity", F.posexplode("sketch").alias("number", "band")).groupBy("term", "kind", "entity", "number", "band").agg(F.count("*").alias("n"))
    alike = alike.groupBy("term", "kind", "entity").agg(F.max("n").alias("alike"))
    pairs = pairs.join(alike, ["term", "kind", "entity"]).filter(F.col("docs") >= support * F.col("alike"))
    pairs = stored(pairs.drop("alike"), "pairs")
    if pairs.isEmpty():
        return pairs.select("term", "kind", F.lit(1.0).alias("share"))
    words = rows.select("row", F.explode(F.array_distinct(_terms(F.col("text")))).alias("term")).join(pairs.select("term").distinct(), "term")
    words = words.join(firsts, "row", "left_semi").groupBy("term").agg(F.count("*").alias("with_term"))
    number = firsts.count()
    told = pairs.join(words, "term").join(often, ["kind", "entity"])
    told = told.withColumn("share", F.least(F.lit(1.0), F.col("docs") / F.col("with_term")))
    told = told.withColumn("own", F.log2(number / F.col("with_entity"))).withColumn("bits", F.log2("share") + F.col("own"))
    told = told.filter((F.col("share") >= share) & (F.col("bits") >= information * F.col("own")) & (F.col("docs") * F.col("bits") >= 2 * F.log2(F.lit(float(number)))))
    best = told.groupBy("term").agg(F.max(F.struct("share", "bits", "kind")).alias("b"))
    return best.select("term", "b.kind", "b.share")


def term_spans(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """``(row, terms)``: where disclosing terms stand outside base spans."""
    # few documents hold such a term, and only these are searched for its places
    holders = rows.select("row", F.explode(F.array_distinct(_terms(F.col("text")))).alias("term")).join(terms, "term", "left_semi")
    some = rows.join(stored(holders.select("row").distinct(), "holders"), "row", "left_semi")
    at = some.select("row", "base", F.explode(matches(F.col("text"), TERM)).alias("w"))
    at = at.select("row", "base", F.lower("w.value").alias("term"), F.col("w.start").alias("start"), (F.col("w.start") + F.char_length("w.value")).alias("end"))
    hit = at.join(terms, "term")
    free = ~F.exists("base", lambda b: (b["start"] < F.col("end")) & (F.col("start") < b["end"]))
    one = F.struct("start", "end", "kind", "share")
    return hit.filter(free).groupBy("row").agg(F.sort_array(F.collect_list(one)).alias("terms"))


NO_TERMS = "array<struct<start:bigint,end:bigint,kind:string,share:double>>"


def spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(text, carried, base, terms)`` of every row."""
    rows = stored(base_spans(docs, text_col), "personal")
    terms = stored(disclosing_terms(rows), "terms")
    if terms.isEmpty():
        return rows.withColumn("terms", F.array().cast(NO_TERMS)).drop("row")
    hits = term_spans(rows, terms).withColumnRenamed("row", "of")
    both = rows.join(hits, F.col("row") == F.col("of"), "left")
    return both.withColumn("terms", F.coalesce("terms", F.array().cast(NO_TERMS))).drop("row", "of")


def sanitised(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with spans replaced in their text; null text becomes empty.  Overlapping spans are replaced as one."""
    rows = spans(docs, text_col)
    marks = F.concat(
        F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("by"))),
        F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(s["share"] >= REMOVE, "").otherwise(F.concat(F.lit("[NEAR "), F.upper(s["kind"]), F.lit("]"))).alias("by"))),
    )
    cut = lambda a, b: F.substr("text", (a + 1).cast("int"), F.greatest(F.lit(0), b - a).cast("int"))
    begin = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(s: Column, m: Column) -> Column:
        inside = m["start"] < s["at"]
        out = F.when(inside, s["out"]).otherwise(F.concat(s["out"], cut(s["at"], m["start"]), m["by"]))
        return F.struct(out.alias("out"), F.greatest(s["at"], m["end"]).alias("at"))

    rest = lambda s: F.concat(s["out"], cut(s["at"], F.char_length("text").cast("bigint")))
    text = F.when(F.size("base") + F.size("terms") > 0, F.aggregate(F.array_sort(marks), begin, step, rest)).otherwise(F.col("text"))
    back = [text.alias(c) if c == text_col else F.col(f"carried.`{c}`") for c in docs.columns]
    return rows.select(*back)


def _joined(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op4_disclosure(spark, sf_dir: str) -> DataFrame:
    """Personal data, and terms that disclose it, in every document."""
    rows = spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    terms = F.transform("terms", lambda s: F.struct(F.lit("term").alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    plain = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, k)) for k in KINDS]
    counts = [(F.size("base") - n).cast("bigint").alias(f"n_{k}") for n, k in zip(counts, KINDS)]
    return rows.select(
        F.col("carried.doc_id").alias("doc_id"), *counts, F.size("terms").cast("bigint").alias("n_term"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.concat(plain, terms)).alias("spans"),
    )
