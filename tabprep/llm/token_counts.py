"""Token counts from an exact length histogram.

Every document is encoded once and only its length is kept. The histogram of lengths, with sums from
either end, answers totals, quantiles and truncated totals for every context limit without another
look at the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabprep.llm.staging import Scratch
from tabprep.llm.tokens import default_tokenizer, encoded_lengths

#: Lengths that share a block; running sums go over blocks first and then within each.
BLOCK = 256


def histogram(docs: DataFrame, tokenizer: str | None = None, ending: int = 0) -> DataFrame:
    """``length``, ``n_docs`` for every encoded length that occurs (null text: empty); counted before the shuffle."""
    lengths = encoded_lengths(docs, tokenizer or default_tokenizer(), ending)
    return lengths.groupBy(F.col("n_tokens").alias("length")).agg(F.count("*").alias("n_docs"))


def limits(lengths: DataFrame) -> DataFrame:
    """For every length as a context limit: what stays whole, what is cut, and the tokens kept.

    ``docs_whole`` and ``tokens_whole`` count documents of at most that length, ``docs_cut`` longer
    ones; ``tokens_truncated`` is the total when every document is cut at the limit, ``tokens_lost``
    what that drops; ``quantile`` is the share of documents of at most that length. The number of
    lengths is bounded by the longest document; sums run over blocks of lengths, then within each.
    An empty histogram gives no rows.
    """
    scratch = Scratch(lengths.sparkSession, "lengths")
    counts = scratch.write(lengths.select("length", "n_docs", (F.col("length") * F.col("n_docs")).alias("tokens"), F.floor(F.col("length") / BLOCK).cast("long").alias("block")))
    blocks = counts.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    before = W.orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    after = W.orderBy("block").rowsBetween(1, W.unboundedFollowing)
    blocks = blocks.select("block", *(F.coalesce(F.sum(c).over(w), F.lit(0)).alias(n) for n, c, w in (("d_before", "d", before), ("t_before", "t", before), ("d_after", "d", after), ("t_after", "t", after))))
    upto = W.partitionBy("block").orderBy("length").rowsBetween(W.unboundedPreceding, 0)
    above = W.partitionBy("block").orderBy("length").rowsBetween(1, W.unboundedFollowing)
    rows = counts.join(blocks, "block")
    within = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    rows = rows.select(
        "length",
        "n_docs",
        (F.col("d_before") + within("n_docs", upto)).alias("docs_whole"),
        (F.col("t_before") + within("tokens", upto)).alias("tokens_whole"),
        (F.col("d_after") + within("n_docs", above)).alias("docs_cut"),
        (F.col("t_after") + within("tokens", above)).alias("_longer"),
    )
    kept = F.col("tokens_whole") + F.col("docs_cut") * F.col("length")
    rows = rows.withColumn("tokens_truncated", kept).withColumn("tokens_lost", F.col("tokens_whole") + F.col("_longer") - kept)
    return rows.withColumn("quantile", F.col("docs_whole") / (F.col("docs_whole") + F.col("docs_cut"))).drop("_longer")


def truncated_total(limited: DataFrame, limit: int) -> int:
    """Tokens that are left when every document is cut at ``limit``, which need not occur as a length."""
    row = limited.where(F.col("length") <= limit).orderBy(F.desc("length")).first()
    if row is None:
        first = limited.orderBy("length").first()
        return limit * (first["docs_whole"] + first["docs_cut"]) if first else 0
    return row["tokens_whole"] + row["docs_cut"] * limit


def length_quantile(limited: DataFrame, share: float) -> int | None:
    """The least length that at least ``share`` of the documents do not exceed; None without documents."""
    row = limited.where(F.col("quantile") >= share).orderBy("length").first()
    return row["length"] if row else None
