import pytest
from conftest import MEDIUM
from pyspark.sql import functions as F

from tabprep.operators import clean, columns
from tabprep.operators.profile import profile_table, sparse_threshold
from tabprep.plans.inputs import DIRTY_ORDERS, DIRTY_ROWS, LINES_WITH_COPY, derive


@pytest.fixture(scope="module")
def dirty(spark):
    return derive(spark, MEDIUM, DIRTY_ORDERS)


def test_sparse_threshold():
    assert [sparse_threshold(n) for n in (5, 9, 10, 15, 19, 20, 99)] == [1, 1, 1, 1, 1, 2, 9]


def test_dirty_orders(dirty):
    out, plan = clean.clean_table(dirty)
    assert out.columns == ["ORDER_ID", "PRIORITY", "CUST_TXT", "STATUS", "PRICE"]
    assert dict(out.dtypes)["CUST_TXT"] == "double" and dict(out.dtypes)["ORDER_ID"] == "bigint"
    counts = {r.PRIORITY: r["count"] for r in out.groupBy("PRIORITY").count().collect()}
    assert counts == {"1-URGENT E": 1869, "2-HIGH E": 1897, "3-MEDIUM E": 1831, "4-NOT SPECIFIED E": 1878,
                      "5-LOW E": 1876, "NA": 5649}
    assert out.agg(F.sum("CUST_TXT")).first()[0] == 7496870
    assert round(out.agg(F.sum("PRICE")).first()[0], 2) == 2815190352.43
    assert [(s.rows_after, s.columns_after) for s in plan.steps] == [
        (15000, 9), (15000, 8), (15000, 8), (15000, 6), (15000, 5)]


def test_dirty_rows(spark):
    out, _ = clean.clean_table(derive(spark, MEDIUM, DIRTY_ROWS))
    assert out.columns == ["ORDER_ID", "A", "B"]
    assert out.agg(F.count("*"), F.sum("ORDER_ID")).first()[:] == (14250, 106875000)


def test_staged_equals_unstaged(spark, dirty, tmp_path):
    lazy, _ = clean.clean_table(dirty)
    staged, _ = clean.clean_table(dirty, stage_to=str(tmp_path / "stage"))
    assert lazy.dtypes == staged.dtypes
    assert lazy.exceptAll(staged).isEmpty() and staged.exceptAll(lazy).isEmpty()


def test_plan_survives_json(dirty):
    plan = clean.fit_plan(dirty)
    again = clean.CleanPlan.from_json(plan.to_json())
    assert again.apply(dirty).exceptAll(plan.apply(dirty)).isEmpty()


def test_second_run_changes_nothing(spark):
    once, _ = clean.clean_table(derive(spark, MEDIUM, DIRTY_ROWS))
    twice, _ = clean.clean_table(once)
    assert once.dtypes == twice.dtypes and once.exceptAll(twice).isEmpty()


def test_numeric_only_table_passes(spark):
    df = derive(spark, MEDIUM, "SELECT l_orderkey, l_quantity, l_extendedprice FROM lineitem")
    out, _ = clean.clean_table(df)
    assert out.count() == df.count() and len(out.columns) == 3


def test_int_equals_its_float_copy(spark):
    out = columns.drop_duplicate_columns(derive(spark, MEDIUM, LINES_WITH_COPY))
    assert "dupn" not in out.columns and "l_linenumber" in out.columns


def test_low_variety(spark):
    out = columns.drop_low_variety_columns(derive(spark, MEDIUM, LINES_WITH_COPY))
    assert "l_linestatus" not in out.columns and "l_returnflag" in out.columns


def test_many_values_in_few_bits(spark):
    """A column whose bitmap shows too few bits is counted exactly, at any minimum."""
    df = spark.range(0, 1000).select((F.col("id") % 70).alias("many"), (F.col("id") % 3).alias("three"))
    kept = columns.drop_low_variety_columns(df, min_distinct=68).columns
    assert kept == ["many"]
    assert columns.drop_low_variety_columns(df, min_distinct=3).columns == ["many", "three"]
    assert columns.drop_low_variety_columns(df, min_distinct=4).columns == ["many"]


def test_null_counts_as_value(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "s string, n int")
    assert columns.drop_low_variety_columns(df).columns == ["s", "n"]


def test_permuted_columns_are_not_duplicates(spark):
    df = spark.range(0, 100).select("id", (99 - F.col("id")).alias("back"), F.col("id").cast("string").alias("txt"))
    assert columns.drop_duplicate_columns(df).columns == ["id", "back", "txt"]


def test_confirmation_regroups_false_matches(spark):
    df = spark.createDataFrame([(1, 2, 2, 1), (3, 4, 4, 3), (5, 6, 6, 5)], "a int, b int, c int, d int")
    assert sorted(columns.confirm_duplicates(df, [["a", "b", "c", "d"]])) == ["c", "d"]


def test_empty_rows_need_all_text_missing(spark):
    rows = [(1, None, "none"), (2, "x", None), (0, "$$", "null"), (3, "y", "z"), (4, "w", "v")]
    df = spark.createDataFrame(rows, "n int, a string, b string")
    out, plan = clean.clean_table(df)
    assert sorted(r.N for r in out.collect()) == [2, 3, 4]
    strict, _ = clean.clean_table(df, clean.CleanConfig(require_zero_numeric=True))
    assert sorted(r.N for r in strict.collect()) == [1, 2, 3, 4]


def test_untyped_floats_and_booleans(spark):
    rows = [("12", "True", "a")] + [(None, None, x) for x in "bcd"] + [("7.50", "False", "e")]
    df = spark.createDataFrame(rows, "f string, t string, s string")
    out, _ = clean.clean_table(df, untyped=True)
    assert sorted(r.F for r in out.collect()) == ["12.0", "7.5", "NA", "NA", "NA"]
    typed, _ = clean.clean_table(df)
    assert sorted(r.F for r in typed.collect()) == ["12", "7.50", "NA", "NA", "NA"]


def test_string_columns_override(spark):
    df = spark.createDataFrame([("007",), ("010",), ("011",)], "z string")
    assert sorted(r.Z for r in clean.clean_table(df)[0].collect()) == [7, 10, 11]
    kept, _ = clean.clean_table(df, clean.CleanConfig(string_columns=("Z",)))
    assert sorted(r.Z for r in kept.collect()) == ["007", "010", "011"]


def test_nested_and_time_columns_pass_through(spark):
    df = spark.range(0, 5).select(
        F.array("id").alias("arr"), F.timestamp_seconds("id").alias("ts"), F.col("id").cast("string").alias("s")
    )
    out, _ = clean.clean_table(df)
    assert dict(out.dtypes) == {"ARR": "array<bigint>", "TS": "timestamp", "S": "bigint"}


def test_failures_are_isolated(spark, dirty):
    broken = dirty.withColumn("boom", F.raise_error(F.lit("broken table")))
    records = clean.clean_tables(
        [clean.TableRecord("ok.csv", dirty), clean.TableRecord("bad.csv", broken),
         clean.TableRecord("none.csv", dirty.limit(0))]
    )
    assert [r.status for r in records] == ["ok", "failed", "empty"]
    with pytest.raises(ValueError):
        clean.clean_tables([clean.TableRecord("none.csv", dirty.limit(0))])


def test_passes_shuffle_only_partial_results(dirty):
    """The cleaned output itself is a scan, a filter and a projection: no exchange."""
    out, _ = clean.clean_table(dirty)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortAggregate" not in plan


def test_profile_counts(spark):
    p = profile_table(spark.createDataFrame([("1", float("nan")), ("x", 2.0), (None, None)], "a string, b double"))
    assert p.rows == 3 and [(c.non_null, c.numeric, c.integral) for c in p.columns] == [(2, 1, 1), (1, 1, 0)]


def test_large_integers_are_told_apart(spark):
    big = 2**60
    df = spark.range(0, 3).select((F.col("id") + big).alias("a"), (big + 2 - F.col("id")).alias("b"))
    assert columns.drop_low_variety_columns(df).columns == ["a", "b"]
    assert columns.drop_duplicate_columns(df).columns == ["a", "b"]
