"""Rules, quarantine, quality, partitions, long numbers and aggregation on small tables with hard cases."""

import json

import pytest
from pyspark.sql import functions as F

from tabprep.operators.clean import TableRecord, clean_table
from tabprep.operators.documents import DocumentStore
from tabprep.operators.tables import LoadMismatch, TableStore
from tabprep.operators.validate import TableRefused, between, not_null, profile_quality, required_columns, row_count, split_by_rules, tagged, unique, validate, violations
from tabprep.sinks.catalog import TableSink
from tabprep.sinks.partitioned import PartitionedSink
from tabprep.sinks.quarantine import QuarantineSink

ROWS = [(1, 5.0, "a"), (2, None, "a"), (3, 50.0, None), (None, 7.0, "b"), (3, float("nan"), "c")]
SCHEMA = "id long, price double, name string"


def test_rules_tag_rows(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    checks = [not_null("id"), between("price", 0, 10), unique("id"), unique("name"), not_null("gone")]
    out = {(r.id, r.name): list(r.broken_rules) for r in tagged(df, checks).collect()}
    low, ids, names, gone = "price between 0 and 10", "id unique", "name unique", "gone not null"
    assert out == {
        (1, "a"): [names, gone], (2, "a"): [names, gone], (3, None): [low, ids, gone],
        (None, "b"): ["id not null", gone], (3, "c"): [low, ids, gone],
    }
    counted = violations(df, checks, ["id"]).groupBy("rule").count().collect()
    failed = {r.rule: (r.failed, r.passed) for r in validate(df, checks).collect()}
    assert {r.rule: r["count"] for r in counted} == {k: n for k, (n, _) in failed.items() if n}
    assert failed[gone] == (5, False)
    with pytest.raises(ValueError):
        tagged(df.withColumn("broken_rules", F.lit(1)), checks)


def test_rules_of_tables(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    none = df.limit(0)
    checks = [row_count(3, 4), row_count(1), required_columns("id", "who"), unique("id"), not_null("gone")]
    assert [(r.failed, r.passed) for r in validate(df, checks).collect()] == [(1, False), (0, True), (1, False), (2, False), (5, False)]
    assert [(r.failed, r.passed) for r in validate(none, checks).collect()] == [(3, False), (1, False), (1, False), (0, True), (0, False)]
    assert {(r.id, r.rule) for r in violations(df, checks[:3], ["id"]).collect()} == {(None, "rows at least 3 and at most 4"), (None, "has id, who")}
    with pytest.raises(TableRefused):
        split_by_rules(df, checks, str(tmp_path / "stage"))


def test_quarantine_routes_every_row_once(spark, tmp_path):
    good, bad = (TableSink(TableStore(spark, str(tmp_path / k)), name_prefix=f"q_{k}_") for k in ("good", "bad"))
    sink = QuarantineSink(spark, good, bad, [between("price", 0, 10), unique("id")])
    for rows, kept in ((ROWS, 3), ([], 0), (ROWS[:1], 1)):
        record = TableRecord("t.csv", spark.createDataFrame(rows, SCHEMA))
        result = sink.load(record)
        assert result.row_count == kept and sink.set_aside["t.csv"].row_count == len(rows) - kept
        assert good.store.table(result.target).columns == ["id", "price", "name"]
        assert bad.store.table(sink.set_aside["t.csv"].target).columns == ["id", "price", "name", "broken_rules"]
        assert sink.reports["t.csv"].count() == 2


def test_quality_of_hard_columns(spark):
    df = spark.createDataFrame(
        [(float("nan"), None, "1", [1]), (1.0, None, "x", [2]), (float("inf"), None, "2", None), (2.0, None, "3", None)],
        "f double, empty string, mixed string, nested array<int>",
    )
    found = {r.column_name: r for r in profile_quality(df).collect()}
    assert set(found) == {"f", "empty", "mixed"}
    assert (found["f"].completeness, found["f"].consistency, found["f"].quality) == (0.75, 2 / 3, 0.75 * 2 / 3)
    assert (found["empty"].quality, found["empty"].distinct_estimate, found["empty"].frequent) == (0, 0, [])
    assert found["mixed"].consistency == 0.75 and [(x.value, x.share) for x in found["mixed"].frequent] == [("1", 0.25), ("2", 0.25), ("3", 0.25)]
    assert found["f"].quartiles == [1.0, 1.0, 2.0]
    assert {r.quality for r in profile_quality(df.limit(0)).collect()} == {0.0}


def test_partitions_are_replaced_alone(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    sink = PartitionedSink(store, ["day", "kind"], name_prefix="part_")
    rows = [(1, "2024-01-01", "a"), (2, "2024-01-01", "b/c"), (3, "2024-01-02", None), (4, None, "a")]
    first = sink.load(TableRecord("t.csv", spark.createDataFrame(rows, "v long, day string, kind string")))
    assert (first.action, first.row_count) == ("created", 4)
    again = [(9, "2024-01-01", "b/c"), (8, "2024-01-02", None), (7, "2024-01-03", "new")]
    result = sink.load(TableRecord("t.csv", spark.createDataFrame(again, "v int, day string, kind string").select("kind", "v", "day")))
    assert (result.action, result.row_count) == ("replaced", 3)
    assert sorted(r.v for r in store.table(first.target).collect()) == [1, 4, 7, 8, 9]
    assert store.table(first.target).where("day = '2024-01-01' and kind = 'a'").count() == 1
    assert sink.load(TableRecord("t.csv", spark.createDataFrame([], "v long, day string, kind string"))).row_count == 0
    assert store.table(first.target).count() == 5
    with pytest.raises(ValueError):
        sink.load(TableRecord("u.csv", spark.range(3).toDF("v")))


LONG = "9" * 20


def test_long_numbers_keep_their_digits(spark):
    rows = [(f"{LONG}{k}", f"-{2**63 + k}" if k else None, str(2**53 + k), f"{k}.5" if k else LONG, f"{'7' * 40}{k}", str(k)) for k in range(5)]
    out, plan = clean_table(spark.createDataFrame(rows, "wide string, gaps string, whole string, mixed string, longest string, t string").withColumn("note", F.concat(F.lit("n"), "t")))
    kinds = dict(out.dtypes)
    assert kinds == {"WIDE": "decimal(38,0)", "GAPS": "decimal(38,0)", "WHOLE": "bigint", "MIXED": "double", "LONGEST": "string", "T": "bigint", "NOTE": "string"}
    got = sorted(out.collect(), key=lambda r: r["T"])
    assert [str(r.WIDE) for r in got] == [r[0] for r in rows] and [r.LONGEST for r in got] == [r[4] for r in rows]
    assert [int(r.GAPS) for r in got] == [0, *(-(2**63) - k for k in range(1, 5))]
    again = type(plan).from_json(plan.to_json()).apply(spark.createDataFrame(rows, "wide string, gaps string, whole string, mixed string, longest string, t string").withColumn("note", F.concat(F.lit("n"), "t")))
    assert sorted(str(r.WIDE) for r in again.collect()) == [r[0] for r in rows]


def test_aggregation_of_collections(spark, tmp_path):
    store = DocumentStore(spark, str(tmp_path))
    docs = [("1", "a", 1, 2.0), ("2", "a", None, 4.0), ("3", "b", 5, None), ("4", None, 7, 1.0)]
    store.insert_dataframe("agg_docs", spark.createDataFrame(docs, "_id string, kind string, n int, x double"))

    def run(*stages):
        return [tuple(r) for r in store.aggregate("agg_docs", json.dumps(stages)).collect()]

    by_kind = {"$group": {"_id": "$kind", "docs": {"$sum": 1}, "n": {"$sum": "$n"}, "x": {"$avg": "$x"}, "most": {"$max": "$x"}}}
    assert run(by_kind, {"$sort": {"_id": 1}}) == [(None, 1, 7, 1.0, 1.0), ("a", 2, 1, 3.0, 4.0), ("b", 1, 5, None, None)]
    assert run({"$match": {"n": {"$gt": 4}}}, {"$sort": {"n": -1}}, {"$limit": 1}) == [("4", None, 7, 1.0)]
    assert run({"$group": {"_id": None, "n": {"$min": "$n"}}}) == [(None, 1)]
    assert run({"$match": {"n": 99}}, {"$group": {"_id": None, "n": {"$sum": 1}}}) == []
    assert run({"$group": {"_id": {"k": "$kind"}, "n": {"$sum": 2}}}, {"$sort": {"n": -1}}, {"$limit": 1}) == [(("a",), 4)]
    for bad in ({"$lookup": {}}, {"$group": {"n": {"$sum": 1}}}, {"$group": {"_id": "kind"}}, {"$sort": {"n": 2}}, {"$group": {"_id": "$kind", "n": {"$push": "$n"}}}, {"$match": {}, "$limit": 1}):
        with pytest.raises(ValueError):
            run(bad)


def test_a_wrong_count_is_told(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    monkeypatch.setattr(TableStore, "replace_partitions", lambda self, name, df, by: self.replace(name, df) + 1)
    with pytest.raises(LoadMismatch):
        PartitionedSink(store, ["k"], name_prefix="wrong_").load(TableRecord("t.csv", spark.range(3).toDF("k")))
