"""From raw documents to packed sequences: five stages, each over all rows that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as
the next stage's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.llm import decontaminate, jaccard_join, packing, quality_rules, secret_scan
from tabprep.llm.staging import Scratch, prefiltered, ship, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.kept(docs)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, a similarity of 0.8; the smallest id stays.

    Rows with the same id and text are one document; rows that share an id only are kept or dropped
    together. A document without words or without an id is no copy of another.
    """
    scratch = Scratch(spark, "near-copies")
    found = scratch.write(jaccard_join.near_duplicates(docs, shingle=5, percent=80))
    copies = scratch.write(found.where("doc_id <> component_id").select("doc_id").distinct())
    repeated = scratch.write(found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    touched = copies.unionByName(repeated)
    rest, maybe = prefiltered(docs, "doc_id", touched, keep=False), prefiltered(docs, "doc_id", touched)
    once = maybe.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    single = maybe.join(repeated, "doc_id", "left_anti")
    kept = once.unionByName(single).join(copies, "doc_id", "left_anti")
    return rest.unionByName(kept).select(*docs.columns)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of a benchmark item."""
    rows = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return rows.where(F.size("hit_spans") == 0).select(*docs.columns)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked, and their length counted anew."""
    rows = secret_scan.secrets(docs, redact=True)
    if "n_chars" in docs.columns:
        length = F.when(F.size("secrets") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        rows = rows.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, encoded and packed into sequences of 1024 tokens."""
    return packing.packed(docs, capacity=1024, ending=2)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("n-gram Jaccard join", deduplicated),
    ("benchmark decontamination", uncontaminated),
    ("secret scans", redacted),
    ("best-fit packing", sequences),
]

#: Packing encodes texts, which SQL cannot; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is staged, and dropped once the next one is."""
    ship(spark)
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    last = len(STAGES) - 1
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == last:
            return out
        before, docs = docs, scratch.write(out)
        scratch.drop(before)
    return docs
