"""Registered queries: sinks, policies and load reports, on cleaned whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.clean import TableRecord, clean_table
from ..operators.documents import DocumentStore, as_json
from ..operators.tables import TableStore
from ..session import scratch_path
from ..sinks.base import load_all, load_report, load_summary
from ..sinks.catalog import DocumentSink, RelationalSink, TableSink
from ..sinks.delimited import DelimitedSink
from ..sources.delimited import extract_parts, inferred
from ..sources.dialect import Dialect
from .cleaning import RECIPE_ORDERS_SQL, RECIPE_ROWS_SQL
from .inputs import DIRTY_ORDERS, DIRTY_ROWS, derive, table
from .pipeline import run_pipeline


def unique(label: str) -> str:
    """A table name that no other run of the query shares."""
    return f"{label}_{uuid.uuid4().hex[:10]}"


def cleaned(spark, sf, name, sql) -> TableRecord:
    df, plan = clean_table(derive(spark, sf, sql), stage_to=scratch_path(spark, "stage"))
    return TableRecord(name, df, plan=plan, rows=plan.steps[-1].rows_after)


def cleaned_orders(spark, sf, name="orders.csv"):
    return cleaned(spark, sf, name, DIRTY_ORDERS)


def csv_pipe(spark, sf):
    record = cleaned_orders(spark, sf)
    result = DelimitedSink(scratch_path(spark, "out")).load(record)
    # The text NA is a value here, not a missing field.
    (back,) = extract_parts(spark, result.target, na_tokens=())
    assert back.dialect == Dialect("|")
    return inferred(back.df)


def policy_actions(spark, sf):
    record = TableRecord("orders.csv", table(spark, sf, "orders"))
    root = scratch_path(spark, "out")
    steps = [("first", True), ("again", True), ("kept", False)]
    results = [(label, DelimitedSink(root, replace).load(record)) for label, replace in steps]
    report = load_report(spark, [r for _, r in results]).select("action", "column_count")
    # What is really there after the three loads.
    (back,) = extract_parts(spark, results[-1][1].target)
    return report.withColumn("rows_on_disk", F.lit(back.df.count()).cast("bigint"))


def temp_view(spark, sf):
    sink = TableSink(TableStore(spark, scratch_path(spark, "tables")), name_prefix=unique("v") + "_")
    result = sink.load(cleaned_orders(spark, sf))
    return spark.table(f"temp_{result.target}")


def table_replace(spark, sf):
    store = TableStore(spark, scratch_path(spark, "tables"))
    name = unique("orders")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    store.replace(name, orders.where("o_orderstatus = 'F'"))
    store.replace(name, orders.withColumn("loaded_twice", F.lit(True)))
    return store.table(name)


def verify_counts(spark, sf):
    sink = TableSink(TableStore(spark, scratch_path(spark, "tables")), name_prefix=unique("v") + "_")
    records = [cleaned_orders(spark, sf), cleaned(spark, sf, "2_rows.csv", DIRTY_ROWS)]
    results = load_all(records, [sink])
    report = load_report(spark, results)
    return report.select("source", "row_count", "column_count", "action", "status")


def relational_modes(spark, sf):
    store = TableStore(spark, scratch_path(spark, "tables"))
    record = cleaned_orders(spark, sf)
    prefix = unique("rel") + "_"
    rows = []
    for step, mode in enumerate(("fail", "fail", "append", "replace")):
        (result,) = load_all([record], [RelationalSink(store, mode, name_prefix=prefix)])
        rows.append((step, mode, result.action, result.status, result.row_count))
    return spark.createDataFrame(
        rows, "step int, mode string, action string, status string, row_count bigint"
    )


def documents(spark, sf):
    store = DocumentStore(spark, scratch_path(spark, "docs"))
    name = unique("col")
    record = cleaned_orders(spark, sf)
    store.insert_dataframe(name, record.df, replace=True, keys=["ORDER_ID"])
    docs = as_json(store.table(name))
    fields = "_id string, ORDER_ID bigint, PRIORITY string, CUST_TXT double, STATUS string, PRICE double"
    return docs.select(F.from_json("doc", fields).alias("d")).select("d.*")


def all_sinks(spark, if_exists="replace"):
    prefix = unique("f") + "_"
    return [
        DelimitedSink(scratch_path(spark, "out")),
        TableSink(TableStore(spark, scratch_path(spark, "analytic")), name_prefix=prefix + "a_"),
        RelationalSink(TableStore(spark, scratch_path(spark, "rel")), if_exists, name_prefix=prefix + "r_"),
        DocumentSink(DocumentStore(spark, scratch_path(spark, "docs")), name_prefix=prefix + "d_"),
    ]


def fanout(spark, sf):
    results = load_all([cleaned_orders(spark, sf)], all_sinks(spark))
    return load_report(spark, results).select("sink", "row_count", "column_count", "action", "status")


def _two_loads(spark, sf):
    """Two tables into all sinks, then again with a relational sink that refuses to replace."""
    records = [cleaned_orders(spark, sf), cleaned(spark, sf, "rows.csv", DIRTY_ROWS)]
    sinks = all_sinks(spark, "fail")
    sinks[0].replace = False
    return [load_all(records, sinks), load_all(records, sinks)]


def report(spark, sf):
    first, second = _two_loads(spark, sf)
    out = load_report(spark, first).withColumn("pass", F.lit(1)).unionByName(
        load_report(spark, second).withColumn("pass", F.lit(2))
    )
    return out.select(
        "pass", "sink", "source", "row_count", "column_count", "action", "status",
        F.substring_index("error", ":", 1).alias("error_kind"),
    )


def summary(spark, sf):
    first, second = _two_loads(spark, sf)
    return load_summary(load_report(spark, first + second))


def pipeline(spark, sf):
    """Files in, four targets out: the summary of a run over messy files of whole tables."""
    source = scratch_path(spark, "raw")
    for name, sql in (("orders", DIRTY_ORDERS), ("rows", DIRTY_ROWS)):
        folder = f"{source}/{name}"
        derive(spark, sf, sql).write.options(
            sep=";", header="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
        ).csv(folder)
    done = [run_pipeline(spark, f"{source}/{n}", all_sinks(spark), by_layout=True) for n in ("orders", "rows")]
    total = done[0].report.unionByName(done[1].report)
    return load_summary(total)


QUERIES = {
    "sink_csv_pipe": csv_pipe,
    "sink_policy_actions": policy_actions,
    "sink_temp_view": temp_view,
    "sink_table_replace": table_replace,
    "sink_verify_counts": verify_counts,
    "sink_relational_modes": relational_modes,
    "sink_documents": documents,
    "sink_fanout_counts": fanout,
    "sink_load_report": report,
    "sink_upload_summary": summary,
    "sink_files_to_targets": pipeline,
}

_n = "(SELECT count(*) FROM orders)"
_m = f"(SELECT count(*) FROM ({RECIPE_ROWS_SQL}) k)"
_SINKS = ("delimited", "analytic", "relational", "documents")


def _report_rows() -> str:
    out = []
    for load in (1, 2):
        for sink in _SINKS:
            for source, rows, columns in (("orders.csv", _n, 5), ("rows.csv", _m, 3)):
                action, status, error = "'created'", "'ok'", "NULL"
                if load == 2:
                    action = "'skipped'" if sink == "delimited" else "'replaced'"
                    if sink == "relational":
                        rows, columns, action, status, error = "NULL", "NULL", "NULL", "'failed'", "'TableExists'"
                out.append(
                    f"SELECT {load} AS pass, '{sink}' AS sink, '{source}' AS source, "
                    f"CAST({rows} AS BIGINT) AS row_count, CAST({columns} AS INTEGER) AS column_count, "
                    f"CAST({action} AS VARCHAR) AS action, {status} AS status, "
                    f"CAST({error} AS VARCHAR) AS error_kind"
                )
    return " UNION ALL ".join(out)


def _summary_rows() -> str:
    once = f"({_n} + {_m})"
    rows = {
        "delimited": (2, 2, 0, 2, 0, once),
        "analytic": (4, 2, 2, 0, 0, f"2 * {once}"),
        "relational": (2, 2, 0, 0, 2, once),
        "documents": (4, 2, 2, 0, 0, f"2 * {once}"),
    }
    names = ("uploaded", "created", "replaced", "skipped", "failed")
    return " UNION ALL ".join(
        f"SELECT '{s}' AS sink, "
        + ", ".join(f"CAST({v} AS BIGINT) AS {c}" for c, v in zip(names, r))
        + f", CAST({r[5]} AS BIGINT) AS total_rows"
        for s, r in rows.items()
    )


ORACLES = {
    "sink_csv_pipe": RECIPE_ORDERS_SQL,
    "sink_policy_actions": " UNION ALL ".join(
        f"SELECT '{a}' AS action, 6 AS column_count, count(*) AS rows_on_disk FROM orders"
        for a in ("created", "replaced", "skipped")
    ),
    "sink_temp_view": RECIPE_ORDERS_SQL,
    "sink_table_replace": """SELECT o_orderkey, o_orderstatus, o_totalprice, TRUE AS loaded_twice
        FROM orders""",
    "sink_verify_counts": f"""SELECT 'orders.csv' AS source, {_n} AS row_count, 5 AS column_count,
        'created' AS action, 'ok' AS status
        UNION ALL SELECT '2_rows.csv', {_m}, 3, 'created', 'ok'""",
    "sink_relational_modes": f"""SELECT 0 AS step, 'fail' AS mode, 'created' AS action, 'ok' AS status,
        {_n} AS row_count
        UNION ALL SELECT 1, 'fail', NULL, 'failed', NULL
        UNION ALL SELECT 2, 'append', 'appended', 'ok', 2 * {_n}
        UNION ALL SELECT 3, 'replace', 'replaced', 'ok', {_n}""",
    "sink_documents": f"""SELECT *, sha256(CAST("ORDER_ID" AS VARCHAR)) AS _id FROM ({RECIPE_ORDERS_SQL})""",
    "sink_fanout_counts": " UNION ALL ".join(
        f"SELECT '{s}' AS sink, {_n} AS row_count, 5 AS column_count, 'created' AS action, 'ok' AS status"
        for s in _SINKS
    ),
    "sink_load_report": _report_rows(),
    "sink_upload_summary": _summary_rows(),
    "sink_files_to_targets": " UNION ALL ".join(
        f"""SELECT '{s}' AS sink, CAST(2 AS BIGINT) AS uploaded, CAST(2 AS BIGINT) AS created,
        CAST(0 AS BIGINT) AS replaced, CAST(0 AS BIGINT) AS skipped, CAST(0 AS BIGINT) AS failed,
        CAST({_n} + {_m} AS BIGINT) AS total_rows"""
        for s in _SINKS
    ),
}
