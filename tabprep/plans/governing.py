"""Registered queries: long ids, rules with quarantine, quality, partitions, aggregation of collections, file patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.clean import TableRecord, clean_table
from ..operators.documents import DocumentStore
from ..operators.tables import TableStore
from ..operators.validate import between, matches, not_null, one_of, profile_quality, required_columns, row_count, unique, violations
from ..session import scratch_path
from ..sinks.catalog import TableSink
from ..sinks.partitioned import PartitionedSink
from ..sinks.quarantine import QuarantineSink
from ..sources.dialect import Dialect
from ..sources.files import FileSystem, NoInputFiles, file_inventory, require_files
from ..streaming.intake import FileIntake
from .inputs import derive, table
from .intake import day_of_orders, place_files
from .loading import unique as fresh
from .pipeline import process_partition

LONG_IDS = """
SELECT '9' || lpad(CAST(o_orderkey AS VARCHAR(20)), 19, '0') AS long_id,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE '90071992547' || lpad(CAST(o_orderkey AS VARCHAR(20)), 6, '0') END AS gaps,
       '1' || lpad(CAST(o_orderkey AS VARCHAR(20)), 44, '0') AS very_long, CAST(o_custkey AS VARCHAR(20)) AS short_id,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR(20)) END AS short_gaps, o_orderpriority AS note
FROM orders
"""


def long_ids(spark, sf):
    """Whole numbers beyond 64 bits, or beyond what a float holds, keep their digits; each column's type is told."""
    out, _ = clean_table(derive(spark, sf, LONG_IDS))
    kinds = dict(out.dtypes)
    told = [F.lit(kinds[c]).alias(f"{c}_TYPE") for c in ("LONG_ID", "GAPS", "VERY_LONG", "SHORT_ID", "SHORT_GAPS")]
    return out.select(*[F.col(c).cast("string").alias(c) for c in ("LONG_ID", "GAPS", "VERY_LONG", "SHORT_ID")], "SHORT_GAPS", *told)


def row_checks():
    return [not_null("o_orderdate"), between("o_totalprice", 1000, 200000), one_of("o_orderstatus", ("F", "O")), matches("o_orderpriority", r"^[1-4]-")]


def rule_violations(spark, sf):
    checks = [unique("o_custkey"), *row_checks(), row_count(10, 20), required_columns("o_orderkey", "o_comment")]
    return violations(table(spark, sf, "orders"), checks, ["o_orderkey"])


def quarantined(spark, sf):
    """Orders that keep all rules in one table, the others with the rules they break in another."""
    good, bad = (TableSink(TableStore(spark, scratch_path(spark, k)), name_prefix=fresh(k) + "_") for k in ("good", "bad"))
    sink = QuarantineSink(spark, good, bad, row_checks())
    record = TableRecord("orders.csv", table(spark, sf, "orders"))
    kept = sink.load(record)
    aside = sink.set_aside["orders.csv"]
    rows = good.store.table(kept.target).select(F.lit("good").alias("target"), "o_orderkey", "o_totalprice", F.lit("").alias("rules"))
    return rows.unionByName(bad.store.table(aside.target).select(F.lit("bad").alias("target"), "o_orderkey", "o_totalprice", F.array_join("broken_rules", "; ").alias("rules")))


def quality(spark, sf):
    """The exact parts as they are, and whether the estimated ones are within their bounds."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", F.expr("if(o_orderkey % 4 = 0, null, if(o_orderkey % 3 = 0, 'bad', cast(o_custkey as string)))").alias("mixed"), F.lit("x").alias("constant"))
    found = profile_quality(orders)
    exact = orders.agg(*[F.count_distinct(c).alias(c) for c in orders.columns]).first().asDict()
    counts = spark.createDataFrame([*exact.items()], "column_name string, held bigint")
    near = F.abs(F.col("distinct_estimate") - F.col("held")) <= F.greatest(F.lit(1.0), F.col("held") * 0.05)
    top = F.col("frequent")[0]
    return found.join(counts, "column_name").select(
        "column_name", "row_count", "completeness", "consistency", "quality", near.alias("distinct_within"),
        top["value"].alias("commonest"), top["share"].alias("commonest_share"),
    )


def _by_status(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


def partitioned(spark, sf):
    """A table by status; a second load brings one status alone, with other prices."""
    store = TableStore(spark, scratch_path(spark, "tables"))
    sink = PartitionedSink(store, ["o_orderstatus"], name_prefix=fresh("p") + "_")
    target = sink.load(TableRecord("orders.csv", _by_status(spark, sf))).target
    held = sorted(store.table(target).where("o_orderstatus <> 'F'").inputFiles())
    again = _by_status(spark, sf).where("o_orderstatus = 'F' and o_custkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    sink.load(TableRecord("orders.csv", again))
    untouched = sorted(store.table(target).where("o_orderstatus <> 'F'").inputFiles()) == held
    return store.table(target).withColumn("untouched", F.lit(untouched))


def one_partition(spark, sf):
    """A folder of files by day; one day's files are written anew, and that day alone is processed."""
    folder, store = scratch_path(spark, "days"), TableStore(spark, scratch_path(spark, "tables"))
    sink = PartitionedSink(store, ["DAY"], name_prefix=fresh("d") + "_")
    for day in (0, 1):
        place_files(spark, day_of_orders(spark, sf, day), f"{folder}/day={day}", "orders")
        process_partition(spark, folder, {"day": str(day)}, [sink], on_error="fail")
    (target,) = sink._names.values()
    held = sorted(store.table(target).where("DAY = '0'").inputFiles())
    FileSystem(spark).delete(f"{folder}/day=1")
    place_files(spark, day_of_orders(spark, sf, 1).withColumn("o_totalprice", F.col("o_totalprice") + 1), f"{folder}/day=1", "orders")
    process_partition(spark, folder, {"day": "1"}, [sink], on_error="fail")
    untouched = sorted(store.table(target).where("DAY = '0'").inputFiles()) == held
    return store.table(target).select("O_ORDERKEY", "O_TOTALPRICE", "DAY", F.lit(untouched).alias("UNTOUCHED"))


STAGES = """[{"$match": {"value": {"$gte": 10}}},
 {"$group": {"_id": "$event_type", "n": {"$sum": 1}, "total": {"$sum": "$user_id"}, "mean": {"$avg": "$value"}, "least": {"$min": "$value"}, "most": {"$max": "$value"}}},
 {"$sort": {"n": -1, "_id": 1}}, {"$limit": 3}]"""


def aggregate_documents(spark, sf):
    store, name = DocumentStore(spark, scratch_path(spark, "docs")), fresh("events")
    store.insert_dataframe(name, table(spark, sf, "events").select("event_id", "user_id", "event_type", "value"), replace=True, keys=["event_id"])
    return store.aggregate(name, STAGES)


def excluded_files(spark, sf):
    """Listed files that match one pattern and not another, with a folder that is missing told from one without files."""
    folder = scratch_path(spark, "files")
    for stem in ("orders", "draft_orders", "other"):
        place_files(spark, day_of_orders(spark, sf, 0), folder, stem, files=1)
    told = []
    for place, pattern in ((f"{folder}/none", "*.csv"), (folder, "*.txt")):
        try:
            require_files(spark, place, pattern)
        except NoInputFiles as e:
            told.append(str(e).split(":")[0].split(" in ")[0])
    return file_inventory(spark, folder, "*.csv", exclude=["draft_*", "o?her_[0-9].csv"]).select("name", F.lit("; ".join(told)).alias("told"))


def polled(spark, sf):
    """Files that arrive while a stream with a short interval runs are taken in by its next checks."""
    source, rows = scratch_path(spark, "arriving"), {}
    intake = FileIntake(spark, source, ["o_orderkey", "o_totalprice", "o_clerk_note"], scratch_path(spark, "intake"), Dialect(";"))
    place_files(spark, day_of_orders(spark, sf, 0), source, "first", files=1)
    running = intake.start(interval="1 second")
    try:
        running.processAllAvailable()
        rows["first"] = intake.landed().count()
        place_files(spark, day_of_orders(spark, sf, 1), source, "second", files=1)
        running.processAllAvailable()
        rows["second"] = intake.landed().count()
    finally:
        running.stop()
    return spark.createDataFrame([*rows.items()], "check string, row_count bigint")


QUERIES = {
    "clean_long_ids": long_ids,
    "validate_violations": rule_violations,
    "sink_quarantine": quarantined,
    "profile_quality": quality,
    "sink_partitioned": partitioned,
    "pipeline_one_partition": one_partition,
    "doc_aggregate": aggregate_documents,
    "src_exclude_patterns": excluded_files,
    "inc_poll_interval": polled,
}

_RULES = (
    ("o_orderdate not null", "o_orderdate IS NULL"), ("o_totalprice between 1000 and 200000", "o_totalprice NOT BETWEEN 1000 AND 200000"),
    ("o_orderstatus one of 2", "o_orderstatus NOT IN ('F', 'O')"), ("o_orderpriority matches ^[1-4]-", "NOT regexp_matches(o_orderpriority, '^[1-4]-')"),
)
_RULE_LIST = "list_filter([" + ", ".join(f"CASE WHEN {broken} THEN '{name}' END" for name, broken in _RULES) + "], lambda x: x IS NOT NULL)"
_MIXED = "CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'bad' ELSE CAST(o_custkey AS VARCHAR) END"


def _quality_sql(name: str, value: str, numbers: str | None) -> str:
    """One column's exact quality; ``numbers`` tells a number among present texts."""
    kind = "count(v)" if numbers is None else f"greatest(count(*) FILTER ({numbers}), count(v) - count(*) FILTER ({numbers}))"
    return f"""SELECT '{name}' AS column_name, count(*) AS row_count, count(v) / count(*) AS completeness, {kind} / count(v) AS consistency,
        CASE WHEN count(DISTINCT v) > 1 THEN (count(v) / count(*)) * ({kind} / count(v)) ELSE 0 END AS quality, TRUE AS distinct_within,
        (SELECT x FROM (SELECT {value} AS x, count(*) AS n FROM orders WHERE {value} IS NOT NULL GROUP BY x ORDER BY n DESC, CAST(x AS VARCHAR) LIMIT 1)) AS commonest,
        (SELECT max(n) / (SELECT count(*) FROM orders) FROM (SELECT count({value}) AS n FROM orders GROUP BY {value})) AS commonest_share
        FROM (SELECT {value} AS v FROM orders)"""


ORACLES = {
    "clean_long_ids": f"""SELECT long_id AS "LONG_ID", coalesce(gaps, '0') AS "GAPS", very_long AS "VERY_LONG", short_id AS "SHORT_ID",
        coalesce(CAST(short_gaps AS DOUBLE), 0) AS "SHORT_GAPS", 'decimal(38,0)' AS "LONG_ID_TYPE", 'decimal(38,0)' AS "GAPS_TYPE",
        'string' AS "VERY_LONG_TYPE", 'bigint' AS "SHORT_ID_TYPE", 'double' AS "SHORT_GAPS_TYPE" FROM ({LONG_IDS})""",
    "validate_violations": f"""SELECT o_orderkey, rule FROM (SELECT o_orderkey, unnest({_RULE_LIST}) AS rule FROM orders)
        UNION ALL SELECT o_orderkey, 'o_custkey unique' FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 1)
        UNION ALL SELECT NULL, 'rows at least 10 and at most 20' FROM (SELECT count(*) AS n FROM orders) WHERE n NOT BETWEEN 10 AND 20
        UNION ALL SELECT NULL, 'has o_orderkey, o_comment'""",
    "sink_quarantine": f"""SELECT CASE WHEN len(r) = 0 THEN 'good' ELSE 'bad' END AS target, o_orderkey, o_totalprice, array_to_string(r, '; ') AS rules
        FROM (SELECT o_orderkey, o_totalprice, {_RULE_LIST} AS r FROM orders)""",
    "profile_quality": " UNION ALL ".join(
        _quality_sql(n, v, numbers).replace("SELECT x FROM", "SELECT CAST(x AS VARCHAR) FROM")
        for n, v, numbers in (
            ("o_orderkey", "o_orderkey", None), ("o_custkey", "o_custkey", None), ("o_totalprice", "o_totalprice", None),
            ("o_orderpriority", "o_orderpriority", "FALSE"), ("mixed", f"({_MIXED})", "v <> 'bad'"), ("constant", "'x'", "FALSE"),
        )
    ),
    "sink_partitioned": """SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
        o_orderstatus, TRUE AS untouched FROM orders WHERE o_orderstatus <> 'F' OR o_custkey % 2 = 0""",
    "pipeline_one_partition": """SELECT o_orderkey AS "O_ORDERKEY", CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice + 1 END AS "O_TOTALPRICE",
        CASE WHEN o_orderstatus = 'F' THEN '0' ELSE '1' END AS "DAY", TRUE AS "UNTOUCHED" FROM orders""",
    "doc_aggregate": """SELECT event_type AS _id, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS total, avg(value) AS mean, min(value) AS least, max(value) AS most
        FROM events WHERE value >= 10 GROUP BY event_type ORDER BY n DESC, _id LIMIT 3""",
    "src_exclude_patterns": "SELECT 'orders_0.csv' AS name, 'folder not found; no *.txt files' AS told WHERE (SELECT count(*) FROM orders) > 0",
    "inc_poll_interval": """SELECT 'first' AS "check", count(*) AS row_count FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT 'second', count(*) FROM orders""",
}
