import pytest
from pyspark.sql import functions as F

from tabprep.operators.buckets import BUCKET, BucketStore
from tabprep.operators.documents import DuplicateIds
from tabprep.sources.files import FileSystem


@pytest.fixture
def store(spark, tmp_path):
    return BucketStore(spark, str(tmp_path), "k", 16)


def rows(store, name):
    return sorted(tuple(r) for r in store.table(name).collect())


def filled(spark, store, name, n=200):
    store.replace(name, spark.range(n).selectExpr("id as k", "id % 7 as g", "cast(id as string) as v"))
    return name


def files_of(store, name):
    fs = FileSystem(store.spark)
    return {b: sorted(n for n in fs.names(p) if n.startswith("part-")) for b, p in store.places(name).items()}


def test_only_touched_buckets_are_written(spark, store):
    name = filled(spark, store, "few")
    before = files_of(store, name)
    assert store.update(name, F.col("k").isin(3, 5), {"v": F.lit("new"), "g": F.col("g")}) == (2, 2)
    assert store.delete(name, F.col("k") == 9) == 1
    changed = {store._number(k) for k in (3, 5, 9)}
    after = files_of(store, name)
    assert {b for b in before if before[b] != after[b]} == changed
    assert rows(store, name) == [(k, k % 7, "new" if k in (3, 5) else str(k)) for k in range(200) if k != 9]
    assert store.update(name, F.col("k") == 999, {"v": F.lit("x")}) == (0, 0) and store.delete(name, F.lit(None).cast("boolean")) == 0
    assert files_of(store, name) == after


def test_a_key_is_found_in_its_bucket(spark, store):
    name = filled(spark, store, "found")
    found = store.by_key(name, 17, 4)
    assert sorted(r.k for r in found.collect()) == [4, 17]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert BUCKET in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_changes_of_form_rewrite_the_table(spark, store):
    name = filled(spark, store, "form", 20)
    assert store.update(name, F.col("k") == 3, {"w": F.lit(1.5)}) == (1, 1)
    assert store.update(name, F.col("k") == 4, {"g": F.lit(0.5)}) == (1, 1)
    assert store.update(name, F.col("k") == 5, {"k": F.lit(500)}) == (1, 1)
    assert store.table(name).dtypes == [("k", "bigint"), ("g", "double"), ("v", "string"), ("w", "double")]
    assert [r.v for r in store.by_key(name, 500).collect()] == ["5"] and store.by_key(name, 5).isEmpty()


def test_appends_widen_and_add_columns(spark, store):
    name = filled(spark, store, "more", 10)
    store.update(name, F.col("k") == 1, {"v": F.lit("one")})
    assert store.append(name, spark.createDataFrame([(1, 2.5, "z"), (77, None, "y")], "k int, g double, x string")) == 2
    assert sorted((r.k, r.g, r.v, r.x) for r in store.table(name).where("k in (1, 77)").collect() if r.x) == [(1, 2.5, None, "z"), (77, None, None, "y")]
    assert store.table(name).count() == 12
    load = spark.range(100, 110).selectExpr("id as k", "'once' as v")
    assert [store.append_once(name, load, "a-key") for _ in range(2)] == [(10, True), (10, False)]
    assert store.table(name).where("v = 'once'").count() == 10 and store.by_key(name, 105).count() == 1


@pytest.mark.parametrize("lost_at", range(1, 4))
def test_a_lost_switch_is_finished(spark, store, monkeypatch, lost_at):
    name = filled(spark, store, f"switch_{lost_at}")
    real, calls = FileSystem.make_folder, 0

    def lost(self, path):
        nonlocal calls
        calls += 1
        if calls == lost_at:
            raise RuntimeError("lost")
        return real(self, path)

    monkeypatch.setattr(FileSystem, "make_folder", lost)
    with pytest.raises(RuntimeError):
        store.update(name, F.col("k") < 40, {"v": F.lit("new")})
    monkeypatch.undo()
    assert store.finish(name) and not store.finish(name)
    assert rows(store, name) == [(k, k % 7, "new" if k < 40 else str(k)) for k in range(200)]


def test_buckets_may_become_empty_and_fill_again(spark, store):
    name = filled(spark, store, "empty", 30)
    assert store.delete(name, F.lit(True)) == 30 and rows(store, name) == []
    store.append(name, spark.range(5).selectExpr("id as k", "id as g", "'x' as v"))
    assert len(rows(store, name)) == 5
    store.replace("none", spark.createDataFrame([], "k long, v string"))
    assert store.update("none", F.lit(True), {"v": F.lit("x")}) == (0, 0) and store.table("none").columns == ["k", "v"]
    store.append("none", spark.createDataFrame([(None, "null key"), (1, "a")], "k long, v string"))
    assert store.update("none", F.col("k").isNull(), {"v": F.lit("b")}) == (1, 1) and store.delete("none", F.col("v") == "b") == 1


def test_vacuum_keeps_what_is_shown(spark, store):
    name = filled(spark, store, "old")
    for k in (1, 2, 3):
        store.update(name, F.col("k") == k, {"v": F.lit("u")})
    want = rows(store, name)
    assert len(store.versions(name)) == 4
    store.delete(name, F.col("k") == 1)
    assert store.vacuum(name, keep=1) == 0 and store.vacuum(name) == 1
    assert rows(store, name) == [r for r in want if r[0] != 1]
    assert store.drop(name) and not store.versions(name)


def test_ids_of_a_collection(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path), buckets=8)
    batch = spark.range(50).selectExpr("cast(id as string) as _id", "id as n")
    store.insert_many("bucket_ids", batch)
    for bad in (batch.where("n = 7"), batch.selectExpr("'new' as _id", "n").limit(2), batch.selectExpr("cast(null as string) as _id", "n").limit(1)):
        with pytest.raises(DuplicateIds):
            store.insert_many("bucket_ids", bad)
    assert store.insert_many("bucket_ids", spark.createDataFrame([("a", 1)], "_id string, n long")).count == 1
    assert store.update_one("bucket_ids", {"n": {"$gte": 3}}, {"$inc": {"n": 100}}, F.col("n")) == 1
    assert store.delete_many("bucket_ids", {"n": {"$lt": 3}}) == 4 and store.find_many("bucket_ids").count() == 47
