"""The corpus pipeline: quality, near duplicates, personal data, mixing, packing.

Each stage takes the documents that the one before wrote and returns what it
keeps of them, with the columns of ``documents``; the last returns the pieces
of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import curriculum, disclosure, packing, part_enum, site_bayes
from tallyline.llm.common import Workspace, scratch, stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return site_bayes.kept(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by word 5-shingles at a similarity of 0.8 or more: that of the smallest id."""
    return part_enum.deduplicated(docs, words=5, similarity=(80, 100))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without personal data and the terms that disclose it."""
    out = disclosure.sanitised(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix uses them (a part counts as a use), each at its own time in the order of training."""
    # the number is the same for every scan of the stored documents; their columns stay in one, so that no name clashes
    rows = docs.select(F.monotonically_increasing_id().alias("mix_row"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    plan = curriculum.mixed(rows.select("mix_row", "doc.doc_id", "doc.text", "doc.source"), carry=["mix_row"]).filter("taken > 0")
    plan = stored(plan.select("mix_row", "positions"), "mix")
    uses = rows.join(plan, "mix_row").select("mix_row", "doc", F.posexplode("positions").alias("mix_use", "mix_position"))
    order = ("mix_position", "mix_row", "mix_use")
    return uses.repartitionByRange(*order).sortWithinPartitions(*order).select("doc.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2,048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("personal data", personal_data),
    ("mixing to target weights", mixing),
    ("best-fit packing", packed),
]

#: Packing needs the tokenizer's ids, which SQL cannot give; the tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage is written before the tables that it needed, its own and the stage before, are deleted."""
    work = Workspace(spark, "pipeline")
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        folder = name.replace(" ", "-")
        with scratch(spark):
            docs = work.write(stage(spark, docs, sf_dir), folder)
        if last:
            work.drop(last)
        last = folder
    return STAGES[-1][1](spark, docs, sf_dir)
