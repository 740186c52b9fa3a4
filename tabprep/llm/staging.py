"""Tables written once to the cluster's shared folder and read back: lineage ends there."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.session import scratch_path
from tabprep.sources.files import FileSystem

#: A bit filter has at most this many 64-bit words: 1 MB to broadcast, whatever the input.
FILTER_WORDS = 1 << 16


class Scratch:
    """Intermediate tables of one job; ``drop`` removes one that nothing reads any more."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = scratch_path(spark, f"llm-{label}")
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def write(self, df: DataFrame, by: str | None = None) -> DataFrame:
        """``df`` as written to shared scratch; a lost executor never causes it to be computed again."""
        path = f"{self.root}/{len(self._paths)}"
        writer = df.write.partitionBy(by) if by else df.write
        writer.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self._paths[len(self._paths)] = (back, path)
        return back

    def drop(self, *tables: DataFrame) -> None:
        files = FileSystem(self.spark)
        for table, path in self._paths.values():
            if any(table is t for t in tables):
                files.delete(path)


def even_keys(spark: SparkSession, count: int) -> list[int]:
    """``count`` unlike integers, rising, that ``repartition(count, key)`` deals out to partitions of their own."""
    place = F.pmod(F.hash("key"), F.lit(count))
    keys = spark.range(64 * count).select(F.col("id").cast("int").alias("key")).groupBy(place.alias("place")).agg(F.min("key").alias("key")).collect()
    return sorted(r["key"] for r in keys) if len(keys) == count else list(range(count))


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from its folder, where they can see that folder.

    A cluster without it gets the package with the job (``--py-files``) instead.
    """
    root = str(Path(__file__).resolve().parents[2])
    seen = spark.sparkContext.environment
    if root not in seen.get("PYTHONPATH", "").split(os.pathsep):
        seen["PYTHONPATH"] = os.pathsep.join(x for x in (root, seen.get("PYTHONPATH", "")) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prefiltered(df: DataFrame, column: str, ids: DataFrame, keep: bool = True) -> DataFrame:
    """``df`` without most rows whose ``column`` is not in ``ids`` (its first column), or just those rows.

    With ``keep``, null always stays; without, what is returned is exactly what is left out with it.

    A bitmap of hashed ids, of a fixed size, is broadcast. It keeps every row that a later exact
    join needs, and lets that join shuffle little else as long as the ids are few.
    """
    bits = FILTER_WORDS * 64
    word = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    marks = ids.select(word(F.col(ids.columns[0])).alias("_at")).where("_at is not null")
    marks = marks.groupBy(F.shiftright("_at", 6).alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(_at & 63 as int))")).alias("_bits"))
    keyed = df.withColumn("_at", word(F.col(column))).withColumn("_word", F.shiftright("_at", 6))
    marked = F.coalesce(F.expr("_bits & shiftleft(1L, cast(_at & 63 as int)) <> 0"), F.lit(False))
    maybe = F.col(column).isNull() | marked
    return keyed.join(F.broadcast(marks), "_word", "left").where(maybe if keep else ~maybe).select(*df.columns)
