"""Quality classifier by hierarchical empirical Bayes.

A document's evidence is a naive Bayes log likelihood ratio over binned text
measures (symbols per word, capitals, repeated words, vocabulary growth, word
length), learned from labelled rows.  Sites give the prior: the soft decisions
of all documents (labels where there are any) are summed per host and per path
within the host; a host's rate is shrunk toward the global one, a path's
toward its host's, each by a strength that the spread between groups itself
yields (method of moments).  Sparse sites thus stay near the global prior.
The posterior joins both; documents below ``threshold`` are rejected.

Null text counts as empty.  Null hosts and paths are groups of their own.
Labels that are null or belong to no document are ignored, of several for one
document the lowest counts.  Without labels all evidence is 0 and every
document has posterior 0.5.  Rows with equal ids are judged each on their own.
All work is grouped aggregation; only the tables of bins (at most
``sum(BINS)`` rows) reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import SPACE, stored, table, whole

SYMBOLS = "*#$%&!|"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Measures and their numbers of bins.
BINS = {"symbols": 21, "capitals": 51, "repeats": 21, "growth": 31, "length": 31}
STRENGTH = (1.0, 10_000.0)


def measures(text: Column) -> list[Column]:
    """Bin numbers of a text, in the order of ``BINS``."""
    text = whole(text)
    words = F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")
    n = F.greatest(F.size(words), F.lit(1)).cast("double")
    chars = F.char_length(text)
    count = lambda letters: (chars - F.char_length(F.translate(text, letters, ""))).cast("double")
    same = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.when(a == b, 1).otherwise(0))
    repeats = F.aggregate(same, F.lit(0), lambda s, x: s + x).cast("double")
    distinct = F.size(F.array_distinct(words)).cast("double")

    def level(x: Column, grain: float, most: int) -> Column:
        return F.least(F.floor(F.round(x * grain, 6)), F.lit(most - 1)).cast("int")

    return [
        level(count(SYMBOLS) / n, 10, BINS["symbols"]),
        level(count(CAPITALS) / F.greatest(chars, F.lit(1)), 50, BINS["capitals"]),
        level(repeats / n, 20, BINS["repeats"]),
        level(distinct / F.pow(n, F.lit(0.9)), 20, BINS["growth"]),
        level(chars / n, 2, BINS["length"]),
    ]


@dataclass
class Model:
    ratios: dict[tuple[int, int], float]  # (measure, bin): log likelihood ratio of good to bad
    unseen: list[float]  # by measure: the ratio of a bin without labelled rows
    prior: float
    paths: DataFrame | None = None  # host, path, host_rate, path_rate

    def evidence(self, bins: str) -> Column:
        total = F.lit(0.0)
        for i, none in enumerate(self.unseen):
            known = {b: r for (m, b), r in sorted(self.ratios.items()) if m == i}
            ratio = F.lit(none)
            if known:
                ratio = F.coalesce(F.create_map(*(F.lit(x) for pair in known.items() for x in pair))[F.col(bins)[i]], ratio)
            total = total + ratio
        return total


def _logistic(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def _logit(p: Column) -> Column:
    return F.log(p / (1.0 - p))


def learn_evidence(rows: DataFrame, smoothing: float = 0.5) -> Model:
    """Ratios from labelled ``(bins, quality)``."""
    labelled = rows.filter("quality IS NOT NULL").select("quality", F.posexplode("bins").alias("measure", "bin"))
    table_ = labelled.groupBy("measure", "bin").agg(F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad")).collect()
    good = sum(r["good"] for r in table_ if r["measure"] == 0)
    bad = sum(r["bad"] for r in table_ if r["measure"] == 0)
    import math

    sizes = list(BINS.values())

    def ratio(g: float, b: float, k: int) -> float:
        return math.log((g + smoothing) / (good + smoothing * k)) - math.log((b + smoothing) / (bad + smoothing * k))

    ratios = {(r["measure"], r["bin"]): ratio(r["good"], r["bad"], sizes[r["measure"]]) for r in table_}
    return Model(ratios, [ratio(0, 0, k) for k in sizes], (good + 1.0) / (good + bad + 2.0))


def _strength(groups: DataFrame, centre: Column) -> DataFrame:
    """One row: how many documents the prior of these groups is worth."""
    n, rate = F.col("n"), F.col("good") / F.col("n")
    sums = groups.agg(
        F.sum(n).alias("all"), F.count("*").alias("groups"),
        F.sum(n * (rate - centre) * (rate - centre)).alias("spread"), F.sum(n * centre * (1.0 - centre)).alias("noise"),
    )
    within = F.col("noise") / F.col("all")
    between = F.col("spread") / F.col("all") - within * F.col("groups") / F.col("all")
    low, high = STRENGTH
    value = F.when(between > 0, within / between - 1.0).otherwise(F.lit(high))
    return sums.select(F.coalesce(F.greatest(F.lit(low), F.least(F.lit(high), value)), F.lit(high)).alias("strength"))


def site_rates(rows: DataFrame, model: Model) -> DataFrame:
    """``(host, path, host_rate, path_rate)`` from all documents."""
    soft = F.coalesce(F.col("quality").cast("double"), _logistic(_logit(F.lit(model.prior)) + model.evidence("bins")))
    paths = rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(F.round(soft, 9)).alias("good"))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = hosts.agg(F.sum("good").alias("g"), F.sum("n").alias("m")).first()
    centre = ((total["g"] or 0.0) + 1.0) / ((total["m"] or 0) + 2.0)
    strength = _strength(hosts, F.lit(centre)).first()["strength"]
    hosts = hosts.select(F.col("host").alias("of"), ((F.col("good") + strength * centre) / (F.col("n") + strength)).alias("host_rate"))
    paths = paths.join(hosts, F.col("host").eqNullSafe(F.col("of"))).drop("of")
    inner = _strength(paths, F.col("host_rate")).first()["strength"]
    return paths.select("host", "path", "host_rate", ((F.col("good") + inner * F.col("host_rate")) / (F.col("n") + inner)).alias("path_rate"))


def prepared(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, host: Column, path: Column) -> DataFrame:
    """``(id, host, path, bins, quality)`` of every row, written once."""
    marks = labels.filter("quality IS NOT NULL").groupBy(F.col("doc_id").alias("of")).agg(F.min("quality").alias("quality"))
    rows = docs.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), F.array(*measures(F.col(text_col))).alias("bins"))
    return stored(rows.join(marks, F.col("id") == F.col("of"), "left").drop("of"), "quality")


def fit(rows: DataFrame) -> Model:
    model = learn_evidence(rows)
    model.paths = stored(site_rates(rows, model), "sites")
    return model


def judged(rows: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``rows`` (with host, path and bins) and their evidence, rates, posterior and decision."""
    paths = model.paths.select(F.col("host").alias("h_"), F.col("path").alias("p_"), "host_rate", "path_rate")
    both = rows.join(paths, F.col("host").eqNullSafe(F.col("h_")) & F.col("path").eqNullSafe(F.col("p_")), "left").drop("h_", "p_")
    prior = F.coalesce("path_rate", F.lit(model.prior))
    both = both.withColumn("evidence", model.evidence("bins")).withColumn("posterior", _logistic(_logit(prior) + F.col("evidence")))
    return both.withColumn("keep", F.round("posterior", 9) >= threshold)


def classified(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: Column | None = None, path: Column | None = None) -> DataFrame:
    """``(id, host_rate, path_rate, evidence, posterior, keep)`` of every row."""
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    rows = prepared(docs, labels, id_col, text_col, host, path)
    out = judged(rows, fit(rows))
    return out.select(F.col("id").alias(id_col), "host_rate", "path_rate", "evidence", "posterior", "keep")


def kept(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", hosts: Sequence[str] = ("source", "lang")) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their own columns."""
    host, path = (F.col(c) for c in hosts)
    model = fit(prepared(docs, labels, id_col, text_col, host, path))
    whole_row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(whole_row, host.alias("host"), path.alias("path"), F.array(*measures(F.col(text_col))).alias("bins"))
    return judged(rows, model).filter("keep").select("row.*")


def op10_site_bayes(spark, sf_dir: str) -> DataFrame:
    """Quality of every document by its text and its source and language."""
    out = classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", *(F.round(c, 4).alias(c) for c in ("host_rate", "path_rate", "evidence", "posterior")), "keep")


OP10_SQL = r"""
WITH texts AS (
  SELECT doc_id, source AS host, lang AS path, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
),
raw AS (
  SELECT doc_id, host, path, CAST(greatest(len(w), 1) AS DOUBLE) AS n, length(t) AS chars,
         length(t) - length(translate(t, '*#$%&!|', '')) AS symbols,
         length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS capitals,
         len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) AS repeats,
         len(list_distinct(w)) AS distinct_words
  FROM texts
),
binned AS (
  SELECT doc_id, host, path, [
    least(floor(round(symbols / n * 10, 6)), 20), least(floor(round(capitals / greatest(chars, 1) * 50, 6)), 50),
    least(floor(round(repeats / n * 20, 6)), 20), least(floor(round(distinct_words / pow(n, 0.9) * 20, 6)), 30),
    least(floor(round(chars / n * 2, 6)), 30)] AS bins
  FROM raw
),
marks AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
marked AS (SELECT b.*, m.quality FROM binned b LEFT JOIN marks m USING (doc_id)),
sizes AS (SELECT [21, 51, 21, 31, 31] AS k),
long AS (SELECT doc_id, host, path, quality, unnest([1, 2, 3, 4, 5]) AS measure, unnest(bins) AS bin FROM marked),
totals AS (SELECT coalesce(sum(quality), 0) AS good, coalesce(sum(1 - quality), 0) AS bad FROM marked WHERE quality IS NOT NULL),
tally AS (SELECT measure, bin, sum(quality) AS g, sum(1 - quality) AS b FROM long WHERE quality IS NOT NULL GROUP BY measure, bin),
scored AS (
  SELECT doc_id, any_value(host) AS host, any_value(path) AS path, any_value(quality) AS quality,
         sum(ln((coalesce(g, 0) + 0.5) / (good + 0.5 * k[l.measure])) - ln((coalesce(b, 0) + 0.5) / (bad + 0.5 * k[l.measure]))) AS evidence
  FROM long l LEFT JOIN tally y ON l.measure = y.measure AND l.bin = y.bin, totals, sizes
  GROUP BY doc_id
),
prior AS (SELECT ln(((good + 1.0) / (good + bad + 2.0)) / (1 - (good + 1.0) / (good + bad + 2.0))) AS p FROM totals),
soft AS (SELECT s.*, round(coalesce(CAST(quality AS DOUBLE), 1 / (1 + exp(-(p + evidence)))), 9) AS s FROM scored s, prior),
paths AS (SELECT host, path, count(*) AS n, sum(s) AS good FROM soft GROUP BY host, path),
hosts AS (SELECT host, sum(n) AS n, sum(good) AS good FROM paths GROUP BY host),
centre AS (SELECT (sum(good) + 1.0) / (sum(n) + 2.0) AS c FROM hosts),
host_parts AS (
  SELECT c * (1 - c) AS within, sum(n * pow(good / n - c, 2)) / sum(n) - c * (1 - c) * count(*) / sum(n) AS between_, any_value(c) AS c
  FROM hosts, centre GROUP BY c
),
host_strength AS (SELECT CASE WHEN between_ > 0 THEN greatest(1.0, least(10000.0, within / between_ - 1)) ELSE 10000.0 END AS m, c FROM host_parts),
host_rates AS (SELECT host, (good + m * c) / (n + m) AS host_rate FROM hosts, host_strength),
joined AS (SELECT p.*, host_rate FROM paths p JOIN host_rates h ON p.host IS NOT DISTINCT FROM h.host),
path_parts AS (
  SELECT sum(n * host_rate * (1 - host_rate)) / sum(n) AS within,
         sum(n * pow(good / n - host_rate, 2)) / sum(n) - sum(n * host_rate * (1 - host_rate)) / sum(n) * count(*) / sum(n) AS between_
  FROM joined
),
path_strength AS (SELECT CASE WHEN between_ > 0 THEN greatest(1.0, least(10000.0, within / between_ - 1)) ELSE 10000.0 END AS m FROM path_parts),
rates AS (SELECT host, path, host_rate, (good + m * host_rate) / (n + m) AS path_rate FROM joined, path_strength),
final AS (
  SELECT doc_id, host_rate, path_rate, evidence, 1 / (1 + exp(-(ln(path_rate / (1 - path_rate)) + evidence))) AS posterior
  FROM soft s JOIN rates r ON s.host IS NOT DISTINCT FROM r.host AND s.path IS NOT DISTINCT FROM r.path
)
SELECT doc_id, round(host_rate, 4) AS host_rate, round(path_rate, 4) AS path_rate, round(evidence, 4) AS evidence,
       round(posterior, 4) AS posterior, round(posterior, 9) >= 0.5 AS keep
FROM final
"""
