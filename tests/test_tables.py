import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tabprep.functions.docfilter import filter_column, update_columns
from tabprep.operators.clean import TableRecord
from tabprep.operators.documents import DocumentStore, DuplicateIds, as_json
from tabprep.operators.tables import LoadMismatch, LossyChange, TableExists, TableStore, run_sql, value_counts
from tabprep.plans.pipeline import run_pipeline
from tabprep.sinks.base import load_all, load_report, load_summary
from tabprep.sinks.catalog import ConnectorSink, DocumentSink, RelationalSink, TableSink
from tabprep.sinks.delimited import DelimitedSink
from tabprep.session import scratch_path
from tabprep.sources.files import FileSystem

USERS = [(1, "Alice", 25, None), (2, "Bob", 30, "x"), (3, "Charlie", 35, None)]


@pytest.fixture
def users(spark):
    return spark.createDataFrame(USERS, "id int, name string, age int, note string")


@pytest.mark.parametrize(
    "query, ids",
    [
        ({"age": {"$gte": 30}}, [2, 3]),
        ({}, [1, 2, 3]),
        (None, [1, 2, 3]),
        ({"name": "Bob"}, [2]),
        ({"age": {"$gt": 25, "$lt": 35}}, [2]),
        ({"note": None}, [1, 3]),
        ({"note": {"$ne": "x"}}, [1, 3]),
        ({"note": {"$exists": True}}, [2]),
        ({"missing": {"$exists": False}}, [1, 2, 3]),
        ({"missing": {"$ne": 1}}, [1, 2, 3]),
        ({"missing": {"$gt": 1}}, []),
        ({"age": "30"}, []),
        ({"name": {"$gt": 5}}, []),
        ({"name": {"$in": ["Bob", None, 7]}}, [2]),
        ({"name": {"$nin": ["Bob"]}}, [1, 3]),
        ({"$or": [{"age": {"$lte": 25}}, {"name": "Charlie"}], "id": {"$ne": 1}}, [3]),
        ({"$and": [{"age": 30}, {"name": "Bob"}]}, [2]),
    ],
)
def test_filters(users, query, ids):
    assert [r.id for r in users.filter(filter_column(users.schema, query)).orderBy("id").collect()] == ids


def test_unknown_operators_raise(users):
    for query in ({"age": {"$mod": [2, 0]}}, {"$nor": [{"age": 1}]}, {"$or": []}):
        with pytest.raises(ValueError):
            filter_column(users.schema, query)
    with pytest.raises(ValueError):
        update_columns(users.schema, {"$push": {"a": 1}})
    with pytest.raises(TypeError):
        update_columns(users.schema, {"$set": {"age": "old"}})


def test_nested_fields(spark):
    df = spark.createDataFrame([((1, "a"),), ((2, "b"),)], "p struct<n:int,s:string>")
    assert df.filter(filter_column(df.schema, {"p.n": {"$gte": 2}})).count() == 1


def test_filter_reaches_the_scan(spark, tmp_path):
    store = DocumentStore(spark, str(tmp_path))
    store.insert_dataframe("pushed", spark.range(100).withColumnRenamed("id", "n"), replace=True)
    plan = store.find_many("pushed", {"n": {"$gte": 90}})._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(n,90)" in plan
    store.drop_collection("pushed")


def test_document_operations(spark, users, tmp_path):
    store = DocumentStore(spark, str(tmp_path))
    assert store.create_collection("people", "id int") and not store.create_collection("people")
    got = store.insert_many("people", users)
    assert got.count == 3 and got.ids.count() == 3 and got.ids.distinct().count() == 3
    assert store.update_many("people", {"age": {"$gte": 30}}, {"$inc": {"age": 1}}) == 2
    assert store.update_many("people", {"name": "Bob"}, {"$set": {"name": "Bob"}}) == 0
    assert store.update_one("people", {"age": {"$gt": 0}}, {"$set": {"note": "first"}}, F.col("id")) == 1
    assert store.find_one("people", {"note": "first"}, "id").first().id == 1
    assert store.update_many("people", {"id": 1}, {"$unset": {"note": ""}}) == 1
    assert store.delete_one("people", {}, F.desc("id")) == 1
    assert store.delete_many("people", {"name": "Nobody"}) == 0
    assert [(r.id, r.age) for r in store.find_many("people", order_by="id", limit=5).collect()] == [(1, 25), (2, 31)]
    assert store.delete_one("people", {"name": "Nobody"}, "id") == 0
    assert store.drop_collection("people") and not store.drop_collection("people")


def test_json_keeps_nulls(users):
    assert as_json(users.where("id = 1")).first().doc == '{"id":1,"name":"Alice","age":25,"note":null}'


def test_table_store(spark, users, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert store.load("people2", users) == 3
    with pytest.raises(TableExists):
        store.load("people2", users)
    assert store.load("people2", users, "append") == 3 and store.table("people2").count() == 6
    assert store.load("people2", users, "replace") == 3
    assert store.update("people2", F.col("age") > 26, {"age": F.lit(30)}) == (2, 1)
    assert store.delete("people2", F.col("note") == "x") == 1
    assert store.append("people2", users.select("id").withColumn("extra", F.lit(1))) == 3
    assert store.table("people2").columns == ["id", "name", "age", "note", "extra"]
    with pytest.raises(LoadMismatch):
        store.verify("people2", 1, 5)
    assert store.verify("people2", 5, 5) == (5, 5)
    assert store.drop("people2") and not store.exists("people2")


def test_old_versions_go_with_vacuum_and_failed_writes_do_no_harm(spark, users, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.replace("versions", users)
    old, reader = store.location("versions"), store.table("versions")
    store.replace("versions", users)
    assert reader.count() == 3 and store.vacuum("versions") == 1
    assert not FileSystem(spark).exists(old) and store.table("versions").count() == 3
    with pytest.raises(Exception):
        store.update("versions", F.col("id") == 1, {"age": F.raise_error(F.lit("no")).cast("int")})
    assert store.table("versions").count() == 3
    store.drop("versions")


def test_value_counts_and_parameters(spark, users):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("a",)], "v string")
    assert [tuple(r) for r in value_counts(df, "v").collect()] == [("a", 2), ("b", 2), ("c", 1)]
    users.createOrReplaceTempView("users_t")
    assert run_sql(spark, "SELECT id FROM users_t WHERE age >= :a", {"a": 30}).count() == 2


def test_delimited_policy(spark, users, tmp_path):
    record = TableRecord("people.csv", users, rows=3)
    actions = [DelimitedSink(str(tmp_path), replace).load(record).action for replace in (True, True, False)]
    assert actions == ["created", "replaced", "skipped"]
    lines = spark.read.text(f"{tmp_path}/people_transformed.csv").distinct()
    assert lines.where("value = 'id|name|age|note'").count() == 1


def test_fan_out_isolates_failures(spark, users, tmp_path):
    store = TableStore(spark, str(tmp_path / "rel"))
    sinks = [
        DelimitedSink(str(tmp_path / "csv")),
        TableSink(TableStore(spark, str(tmp_path / "ana")), name_prefix="ana_"),
        RelationalSink(store, "fail", name_prefix="rel_"),
        DocumentSink(DocumentStore(spark, str(tmp_path / "doc")), name_prefix="doc_"),
    ]
    records = [TableRecord("1people.csv", users, rows=3)]
    assert all(r.status == "ok" for r in load_all(records, sinks, persist=True))
    second = load_all(records, sinks)
    assert [r.status for r in second] == ["ok", "ok", "failed", "ok"]
    assert spark.table("temp_ana_tbl_1people_transformed").count() == 3
    summary = {r.sink: r for r in load_summary(load_report(spark, second)).collect()}
    assert summary["relational"].failed == 1 and summary["relational"].total_rows == 0
    with pytest.raises(TableExists):
        load_all(records, sinks[2:3], on_error="fail")
    assert load_all([], sinks) == []


def test_connector_options(spark):
    sink = ConnectorSink(spark, "jdbc", {"url": "jdbc:x:y"}, if_exists="append", partitions=8)
    mode, options = sink.writer_options("t")
    assert mode == "append" and options["dbtable"] == "t" and options["numPartitions"] == "8"
    assert options["batchsize"] == "10000"
    with pytest.raises(ValueError):
        ConnectorSink(spark, "jdbc", {}, if_exists="merge")


def test_pipeline(spark, write_files, tmp_path):
    rows = "".join(f"{i};name {i};é{i % 5}\n" for i in range(30))
    folder = write_files({"a.csv": ("id;nm;g\n" + rows).encode(), "bad.csv": b"x;y\n1;2;3\n", "none.csv": b""})
    result = run_pipeline(spark, folder, [DelimitedSink(str(tmp_path / "out"))], stage_root=str(tmp_path / "st"))
    assert {r.name: r.status for r in result.records} == {"a.csv": "ok", "bad.csv": "empty", "none.csv": "empty"}
    (row,) = result.summary.collect()
    assert (row.created, row.total_rows) == (1, 30)


def test_whole_table_of_base_data(spark):
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    found = events.filter(filter_column(events.schema, {"event_type": {"$in": ["click"]}}))
    assert found.count() == events.where("event_type = 'click'").count()


def test_deleting_everything(spark, users, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.replace("gone", users)
    assert store.delete("gone", F.lit(True)) == 3 and store.table("gone").count() == 0
    assert store.delete("gone", F.lit(True)) == 0
    assert store.append("gone", users) == 3
    store.drop("gone")


def test_values_are_never_changed_by_a_narrow_column(spark, tmp_path):
    store = DocumentStore(spark, f"{tmp_path}/it's here")
    rows = spark.createDataFrame([("a", 1, "x"), ("b", 2**60, "y")], "_id string, n long, Location string")
    store.replace("narrow", rows.where("n = 1"))
    assert "/v-" in store.location("narrow")
    assert store.append("narrow", spark.createDataFrame([("c", 1.7)], "_id string, n double")) == 1
    assert sorted(r.n for r in store.table("narrow").collect()) == [1.0, 1.7]
    with pytest.raises(LossyChange):
        store.append("narrow", rows.where("n > 1").selectExpr("concat(_id, '!') as _id", "n + 1 as n"))
    with pytest.raises(LossyChange):
        store.append("narrow", spark.createDataFrame([("d", "many")], "_id string, n string"))
    store.replace("counts", rows.selectExpr("_id", "n + 1 as n"))
    with pytest.raises(LossyChange):
        store.update_many("counts", {"_id": "a"}, {"$inc": {"n": 0.5}})  # 2**60 + 1 is no double
    store.drop("narrow")
    store.drop("counts")


def test_fractions_widen_a_whole_column(spark, tmp_path):
    store = DocumentStore(spark, str(tmp_path))
    store.replace("wide", spark.createDataFrame([("a", 1), ("b", 2)], "_id string, n long"))
    assert store.update_many("wide", {"_id": "a"}, {"$inc": {"n": 0.5}}) == 1
    assert store.update_many("wide", {"_id": "b"}, {"$set": {"n": 7.9}}) == 1
    assert sorted(r.n for r in store.table("wide").collect()) == [1.5, 7.9]
    store.drop("wide")


def test_ids_tell_documents_apart(spark, tmp_path):
    store = DocumentStore(spark, str(tmp_path))
    keys = [(None, "x"), ("x", None), ("x", "x"), (None, None), ("x\x1fx", "y"), ("x", "x\x1fy"), ("\x1e", "x")]
    docs = spark.createDataFrame(keys, "a string, b string")
    assert store.insert_many("ids", docs, keys=["a", "b"]).ids.distinct().count() == len(keys)
    for again in (docs.limit(1), docs.union(docs).selectExpr("concat(a, 'z') as a", "b")):
        with pytest.raises(DuplicateIds):
            store.insert_many("ids", again, keys=["a", "b"])
    assert store.update_one("ids", {"b": "x"}, {"$set": {"b": "z"}}) == 1
    assert store.delete_one("ids", {}) == 1 and store.delete_one("ids", {"b": "none"}) == 0
    assert store.delete_many("ids", {}) == len(keys) - 1
    store.drop("ids")


def test_scratch_of_a_process_lies_together(spark, users):
    first, second = scratch_path(spark, "one"), scratch_path(spark, "two")
    assert first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]
    users.write.parquet(first)
    assert FileSystem(spark).exists(first)
    assert FileSystem(spark).delete(first) and not FileSystem(spark).exists(first)
