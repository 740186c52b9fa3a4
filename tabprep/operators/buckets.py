"""Tables in buckets of a key, of which a change rewrites only those that it touches."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import col, quoted
from ..sources.files import FileSystem
from .documents import ID, DocumentStore, DuplicateIds
from .tables import gathered, observed_rows

BUCKET = "__bucket"


class BucketStore(DocumentStore):
    """Tables and document collections partitioned by a hash of ``key``.

    Updates and deletes find the buckets that hold a matching row, by a scan of the filter's
    columns, write only these anew and point the table's partitions at the new files; all
    other buckets keep their files.  The switch of several partitions is noted before it
    begins and finished by the next change (or ``finish``) if the driver is lost midway.
    Choose so many buckets that one of them is worth a rewrite: some hundred MB.
    """

    def __init__(self, spark: SparkSession, root: str, key: str = ID, buckets: int = 64):
        super().__init__(spark, root)
        self.key = key
        self.buckets = buckets

    def bucket_of(self, key: Column) -> Column:
        """The bucket of a key; equal keys of any whole-number width have the same."""
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.buckets)).cast("int")

    # -- form of the stored rows ------------------------------------------------------

    def raw(self, name: str) -> DataFrame:
        """The table with its bucket as a column, to filter by."""
        return super().table(name)

    def table(self, name: str) -> DataFrame:
        return self.raw(name).drop(BUCKET)

    def by_key(self, name: str, *keys) -> DataFrame:
        """The rows with one of these keys; only their buckets are read."""
        wanted = [F.lit(k) for k in keys]
        return self.raw(name).where(F.col(BUCKET).isin([self._number(k) for k in keys]) & col(self.key).isin(*wanted)).drop(BUCKET)

    def _number(self, key) -> int:
        return self.spark.range(1).select(self.bucket_of(F.lit(key))).first()[0]

    def _numbered(self, df: DataFrame) -> DataFrame:
        """``df`` with buckets, dealt out so that each one is written by few tasks; a large one is split."""
        return df.withColumn(BUCKET, self.bucket_of(col(self.key))).hint("rebalance", BUCKET)

    def _write(self, df: DataFrame, path: str) -> None:
        self._numbered(df).write.partitionBy(BUCKET).parquet(path)

    def _insert(self, df: DataFrame, name: str) -> None:
        self._numbered(df).write.insertInto(quoted(name))

    def _create(self, name: str, version: str, schema) -> None:
        fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        FileSystem(self.spark).make_folder(version)
        self.spark.sql(f"CREATE TABLE {quoted(name)} ({fields}, {BUCKET} int) USING parquet PARTITIONED BY ({BUCKET}) LOCATION '{_escaped(version)}'")
        self.spark.sql(f"ALTER TABLE {quoted(name)} RECOVER PARTITIONS")

    def _publish(self, name: str, version: str, schema) -> None:
        FileSystem(self.spark).delete(self._switch(name))  # a whole rewrite leaves nothing to finish
        if self.exists(name):
            self.spark.sql(f"DROP TABLE {quoted(name)}")
        self._create(name, version, schema)

    def _destinations(self, name: str, place: str) -> list[tuple[str, str]]:
        found = [n for n in FileSystem(self.spark).names(place) if n.startswith(f"{BUCKET}=")]
        places = self.places(name)
        missing = [n for n in found if int(n.split("=")[1]) not in places]
        for n in missing:
            number = n.split("=")[1]
            self.spark.sql(f"ALTER TABLE {quoted(name)} ADD IF NOT EXISTS PARTITION ({BUCKET}={number})")
        places = self.places(name) if missing else places
        return [(f"{place}/{n}", places[int(n.split("=")[1])]) for n in found]

    def places(self, name: str) -> dict[int, str]:
        """Where each bucket's files are."""
        out = {}
        for r in self.spark.sql(f"SHOW PARTITIONS {quoted(name)}").collect():
            number = int(r[0].split("=")[1])
            about = self.spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)} PARTITION ({BUCKET}={number})").collect()
            out[number] = next(x.data_type for x in about if x.col_name == "Location")
        return out

    def _shown(self, name: str) -> set[str]:
        if not self.exists(name):
            return set()
        held = {p.rstrip("/").rsplit("/", 2)[-2] for p in self.places(name).values()}
        return held | super()._shown(name)

    # -- changing rows ----------------------------------------------------------------

    def touched(self, name: str, where: Column) -> list[int]:
        """The buckets that hold a matching row."""
        found = self.raw(name).where(F.coalesce(where, F.lit(False))).select(BUCKET).distinct()
        return sorted(r[0] for r in found.collect())

    def update(self, name: str, where: Column, assignments: dict[str, Column]) -> tuple[int, int]:
        """Set columns on matching rows; returns (matched, modified).

        The whole table is rewritten only if the key itself is set, a column is new or
        must be widened.
        """
        self.finish(name)
        table, matches = self.table(name), F.coalesce(where, F.lit(False))
        fits = self._wide_enough(table, matches, assignments).schema == table.schema
        if not fits or self.key in assignments or set(assignments) - set(table.columns):
            return super().update(name, where, assignments)
        buckets = self.touched(name, where)
        if not buckets:
            return 0, 0
        part = self.raw(name).where(F.col(BUCKET).isin(buckets)).drop(BUCKET)
        out, seen = self._changed(part, matches, assignments)
        self._replace_buckets(name, out, buckets)
        got = gathered(seen)
        return got["matched"], got["modified"]

    def delete(self, name: str, where: Column) -> int:
        """Delete matching rows; returns how many."""
        self.finish(name)
        buckets = self.touched(name, where)
        if not buckets:
            return 0
        part = self.raw(name).where(F.col(BUCKET).isin(buckets)).drop(BUCKET)
        before = part.count()
        kept, seen = observed_rows(part.filter(~F.coalesce(where, F.lit(False))))
        self._replace_buckets(name, kept, buckets)
        return before - gathered(seen)["rows"]

    def _replace_buckets(self, name: str, df: DataFrame, buckets: list[int]) -> None:
        version = self._new_version(name)
        self._write(df, version)
        FileSystem(self.spark).write_text(self._switch(name), json.dumps({"version": version, "buckets": buckets}))
        self.finish(name)

    def _switch(self, name: str) -> str:
        return f"{self.root}/{name}/switch.json"

    def finish(self, name: str) -> bool:
        """Point the partitions of a noted change at their new files; false if none is noted."""
        files = FileSystem(self.spark)
        note = files.read_text(self._switch(name))
        if note is None:
            return False
        note = json.loads(note)
        for number in note["buckets"]:
            place = f"{note['version']}/{BUCKET}={number}"
            files.make_folder(place)  # a bucket of which no row is left
            self.spark.sql(f"ALTER TABLE {quoted(name)} PARTITION ({BUCKET}={number}) SET LOCATION '{_escaped(place)}'")
        self._refresh(name)
        files.delete(self._switch(name))
        return True

    def append(self, name: str, df: DataFrame) -> int:
        if self.exists(name):
            self.finish(name)
        return super().append(name, df)

    def require_new_ids(self, name: str, batch: DataFrame, alone: bool = False) -> None:
        """As in any collection; only the buckets of the new ids are read."""
        super().require_new_ids(name, batch, alone=True)
        if alone or not self.exists(name) or self.key != ID:
            return None if alone or not self.exists(name) else super().require_new_ids(name, batch)
        ids = batch.select(col(ID).alias("id"), self.bucket_of(col(ID)).alias("bucket"))
        buckets = [r[0] for r in ids.select("bucket").distinct().collect()]
        held = self.raw(name).where(F.col(BUCKET).isin(buckets)).select(F.col(BUCKET).alias("bucket"), col(ID).alias("id"))
        found = ids.join(held, ["bucket", "id"], "left_semi").limit(3).collect()
        if found:
            raise DuplicateIds(f"{name}: {[r.id for r in found]}")


def _escaped(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")
