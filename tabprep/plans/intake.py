"""Registered queries: new-file detection, cursors and the file stream."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ..operators.documents import DocumentStore
from ..operators.tables import TableStore
from ..session import scratch_path
from ..sinks.base import SKIPPED, LoadResult
from ..sinks.catalog import DocumentSink, RelationalSink, TableSink
from ..sources.delimited import union_parts
from ..sources.dialect import Dialect, detect_dialects
from ..sources.files import FileSystem
from ..streaming.intake import FileCursor, FileIntake, FileLog, batch_summary, new_files
from .cleaning import RECIPE_ORDERS_SQL
from .inputs import DIRTY_ORDERS, derive, table
from .loading import unique
from .pipeline import process_new, stream_log, stream_to_targets


def listing(df):
    """A file listing derived from document ids: one file per document."""
    name = F.concat(F.lit("doc_"), F.col("doc_id"), F.lit(".csv"))
    return df.select(name.alias("name"), F.concat(F.lit("/in/"), name).alias("path")).distinct()


def all_files(spark, sf):
    return listing(table(spark, sf, "documents"))


def labelled_files(spark, sf):
    return listing(table(spark, sf, "labels"))


def detect_new(spark, sf):
    return new_files(all_files(spark, sf), labelled_files(spark, sf)).select("path", "name")


def advance_cursor(spark, sf):
    """Three checks: everything is new; then nothing in a shorter listing; then the forgotten files."""
    store = TableStore(spark, scratch_path(spark, "cursor"))
    cursor = FileCursor(store, unique("cursor"))
    out = []
    for step, listed in enumerate((all_files(spark, sf), labelled_files(spark, sf), all_files(spark, sf))):
        path = scratch_path(spark, "pending")
        cursor.pending(listed).write.parquet(path)
        cursor.advance(listed)
        out.append(spark.read.parquet(path).select("path", F.lit(step).alias("step")))
    return out[0].unionByName(out[1]).unionByName(out[2])


def reset_cursor(spark, sf):
    store = TableStore(spark, scratch_path(spark, "cursor"))
    cursor = FileCursor(store, unique("cursor"))
    cursor.advance(all_files(spark, sf))
    cursor.reset()
    return cursor.pending(all_files(spark, sf)).select("path")


def summary(spark, sf):
    files = table(spark, sf, "documents").select(
        F.concat("lang", F.lit("_"), "source", F.lit(".csv")).alias("name")
    )
    return batch_summary(files)


DIRTY = ("order_id", "priority", "cust_txt", "sparse_5pct", "status", "status_copy", "flag", "const_col", "price")


def dirty_intake(spark, sf, **options):
    """An intake over dirty orders; files arrive in two lots, and the stream runs after each."""
    source = scratch_path(spark, "arriving")
    intake = FileIntake(spark, source, DIRTY, scratch_path(spark, "intake"), Dialect(";"), **options)
    dirty = derive(spark, sf, DIRTY_ORDERS)
    for lot in ("status = 'F'", "status <> 'F'"):
        dirty.where(lot).write.mode("append").options(
            sep=";", header="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
        ).csv(source)
        intake.run_once()
    return intake


def stream_clean(spark, sf):
    return dirty_intake(spark, sf).clean()[0]


def stream_merged(spark, sf):
    """The landed rows by decisions merged from the batches; a second plan reads no batch again and is the same."""
    intake = dirty_intake(spark, sf)
    out, plan = intake.clean(additive=True)
    again, read = intake.merged_plan()
    if read or again != plan:
        raise AssertionError(f"read again: {read}")
    return out


def stream_batches(spark, sf):
    intake = dirty_intake(spark, sf)
    per_batch = (
        spark.read.parquet(intake.landing).groupBy("batch_id").agg(F.count(F.lit(1)).alias("row_count"))
    )
    files = intake.batches().groupBy("batch_id").agg(F.count_if(F.col("name").endswith(".csv")).alias("files"))
    return per_batch.join(files, "batch_id").select("batch_id", "row_count", (F.col("files") > 0).alias("named"))


def stream_rerun(spark, sf):
    """A second run under a new name takes every file in again."""
    first = dirty_intake(spark, sf)
    again = FileIntake(
        spark, first.source, DIRTY, first.base.rsplit("/", 1)[0], Dialect(";"), run="second"
    )
    again.run_once()
    return again.landed().agg(F.count(F.lit(1)).alias("row_count"))


LOTS = ((";", "o_orderstatus = 'F'", ("o_orderkey", "o_totalprice", "o_clerk_note")), (",", "o_orderstatus <> 'F'", ("o_totalprice", "o_clerk_note", "o_orderkey")))


def arriving(spark, sf, folder, lot):
    """Part of the orders as files; each lot has its own separator and order of columns."""
    sep, which, columns = LOTS[lot]
    note = F.concat("o_orderpriority", F.lit(" "), F.col("o_orderkey").cast("string")).alias("o_clerk_note")
    orders = table(spark, sf, "orders").where(which).select("o_orderkey", "o_totalprice", note)
    orders.select(*columns).repartition(2, "o_orderkey").write.mode("append").options(sep=sep, header="true").csv(folder)


def loaded(store):
    """All tables of a store, by column name."""
    names = [t.name for t in store.spark.catalog.listTables() if store.root in _place(store, t.name)]
    out = [store.table(n).select("O_ORDERKEY", "O_TOTALPRICE") for n in names]
    return union_parts(out)


def _place(store, name):
    try:
        return store.location(name)
    except StopIteration:  # a view
        return ""


def stream_targets(spark, sf):
    """Two lots of unlike files, each streamed through extraction and cleaning into verified tables."""
    folder, work = scratch_path(spark, "arriving"), scratch_path(spark, "work")
    store = TableStore(spark, scratch_path(spark, "tables"))
    sink = TableSink(store, name_prefix=unique("t") + "_")
    for lot in range(len(LOTS)):
        arriving(spark, sf, folder, lot)
        stream_to_targets(spark, folder, work, [sink], interval=None).awaitTermination()
    return loaded(store)


def new_files_to_targets(spark, sf):
    """The same by listing: a cursor that passes on only what is new; a third check finds nothing."""
    folder = scratch_path(spark, "arriving")
    store, seen = TableStore(spark, scratch_path(spark, "tables")), TableStore(spark, scratch_path(spark, "cursor"))
    sink, cursor = TableSink(store, name_prefix=unique("n") + "_"), FileCursor(seen, unique("cursor"))
    taken = []
    for lot in range(len(LOTS)):
        arriving(spark, sf, folder, lot)
        taken.append(sum(r.rows for r in process_new(spark, folder, cursor, [sink]).records if r.status == "ok"))
    again = process_new(spark, folder, cursor, [sink])
    return loaded(store).agg(F.count(F.lit(1)).alias("row_count"), F.sum("O_ORDERKEY").alias("keys")).withColumns(
        {"first_lot": F.lit(taken[0]).cast("long"), "second_lot": F.lit(taken[1]).cast("long"), "third": F.lit(again is not None)}
    )


class _LostOnce:
    """A sink before which the driver is lost at its first load."""

    name = "lost"

    def __init__(self):
        self.lost = False

    def prepare(self, records):
        pass

    def target(self, record):
        return record.output_name

    def load(self, record):
        if not self.lost:
            self.lost = True
            raise RuntimeError("the driver is gone")
        return LoadResult(self.name, self.target(record), record.name, 0, 0, SKIPPED)


def place_files(spark, df, folder, stem, files=2, sep=";"):
    """Rows as files with names of their own: ``stem_0.csv``, ``stem_1.csv`` and so on."""
    aside, fs = scratch_path(spark, "aside"), FileSystem(spark)
    df.repartition(files, df.columns[0]).write.options(sep=sep, header="true").csv(aside)
    parts = [n for n in fs.names(aside) if n.startswith("part-")]
    for k, part in enumerate(parts):
        fs.rename(f"{aside}/{part}", f"{folder}/{stem}_{k}.csv")


def day_of_orders(spark, sf, day):
    orders = table(spark, sf, "orders").where(LOTS[day][1])
    note = F.concat("o_orderpriority", F.lit(" "), F.col("o_orderkey").cast("string")).alias("o_clerk_note")
    return orders.select("o_orderkey", "o_totalprice", note)


def stream_append(spark, sf):
    """Files of the same names arrive in a folder a day; each day's rows are appended in a stream and verified."""
    folder, work = scratch_path(spark, "days"), scratch_path(spark, "work")
    store, reports = TableStore(spark, scratch_path(spark, "tables")), []
    sink = RelationalSink(store, "append", name_prefix=unique("a") + "_")
    for day in range(len(LOTS)):
        place_files(spark, day_of_orders(spark, sf, day), f"{folder}/day={day}", "orders")
        stream_to_targets(spark, f"{folder}/*", work, [sink], interval=None, on_error="fail").awaitTermination()
        reports.append(stream_log(spark, work).latest().where("status = 'loaded'").count())
    return loaded(store)


def stream_replay(spark, sf):
    """The driver is lost between two sinks of a batch; the batch runs again, and each row is there once."""
    folder, work = scratch_path(spark, "days"), scratch_path(spark, "work")
    tables, collections = TableStore(spark, scratch_path(spark, "tables")), DocumentStore(spark, scratch_path(spark, "docs"))
    name = unique("r")
    sinks = [RelationalSink(tables, "append", name_prefix=f"{name}t_"), _LostOnce(), DocumentSink(collections, replace=False, name_prefix=f"{name}d_")]
    for day in range(len(LOTS)):
        place_files(spark, day_of_orders(spark, sf, day), f"{folder}/day={day}", "orders")
        for _ in range(2):
            try:
                stream_to_targets(spark, f"{folder}/*", work, sinks, interval=None, on_error="fail", parallelism=1).awaitTermination()
            except StreamingQueryException:
                continue
    rows = [loaded(s).select(F.lit(kind).alias("target"), "O_ORDERKEY", "O_TOTALPRICE") for kind, s in (("table", tables), ("documents", collections))]
    return union_parts(rows)


def bad_file(spark, sf):
    """A file without data and one of which nothing is left stand among good ones; each is reported, none blocks."""
    folder, work = scratch_path(spark, "arriving"), scratch_path(spark, "work")
    store = TableStore(spark, scratch_path(spark, "tables"))
    sink = TableSink(store, name_prefix=unique("b") + "_")
    orders = table(spark, sf, "orders")
    for day, name in enumerate(("first", "second")):
        place_files(spark, day_of_orders(spark, sf, day), folder, name)
        place_files(spark, orders.where("false").select("o_orderkey", "o_custkey"), folder, f"empty_{name}", files=1)
        place_files(spark, orders.select(F.lit("x").alias("a"), F.lit("y").alias("b")), folder, f"constant_{name}", files=1)
        stream_to_targets(spark, folder, work, [sink], interval=None).awaitTermination()
    log = stream_log(spark, work).latest()
    kinds = log.groupBy(F.element_at(F.split("name", "_"), 1).alias("kind"), "status").agg(F.max("tries").alias("tries"), F.count(F.lit(1)).alias("files"))
    rows = loaded(store).agg(F.count(F.lit(1)).alias("row_count"))
    return kinds.crossJoin(F.broadcast(rows))


def bad_file_by_cursor(spark, sf):
    """The same by listing: a file without data passes the cursor, and is taken in once it has some."""
    folder = scratch_path(spark, "arriving")
    store, seen = TableStore(spark, scratch_path(spark, "tables")), TableStore(spark, scratch_path(spark, "cursor"))
    sink, cursor, log = TableSink(store, name_prefix=unique("c") + "_"), FileCursor(seen, unique("cursor")), FileLog(spark, scratch_path(spark, "files"))
    out = []

    def check(step):
        result = process_new(spark, folder, cursor, [sink], log=log)
        out.append((step, 0 if result is None else sum(r.rows for r in result.records if r.status == "ok"), log.latest().where("status = 'loaded'").count()))

    place_files(spark, day_of_orders(spark, sf, 0).where("false"), folder, "orders", files=1)
    check("header only")
    check("unchanged")
    place_files(spark, day_of_orders(spark, sf, 1), folder, "others", files=1)
    check("another file")
    FileSystem(spark).delete(f"{folder}/orders_0.csv")
    place_files(spark, day_of_orders(spark, sf, 0), folder, "orders", files=1)
    check("filled")
    return spark.createDataFrame(out, "step string, row_count bigint, files bigint")


def _watched_files(spark, sf):
    """Loaded files, of which one is then written anew with other rows, one as it was, and one is moved."""
    folder = scratch_path(spark, "arriving")
    store, seen = TableStore(spark, scratch_path(spark, "tables")), TableStore(spark, scratch_path(spark, "cursor"))
    log, fs = FileLog(spark, scratch_path(spark, "files")), FileSystem(spark)
    for stem in ("edited", "same", "moved"):
        rows = day_of_orders(spark, sf, 0).withColumn("origin", F.concat(F.lit(stem), F.lit(" "), F.col("o_orderkey").cast("string")))
        place_files(spark, rows, folder, stem, files=1)
    process_new(spark, folder, FileCursor(seen, unique("cursor")), [TableSink(store, name_prefix=unique("w") + "_")], log=log)
    fs.delete(f"{folder}/edited_0.csv")
    place_files(spark, day_of_orders(spark, sf, 1).withColumn("origin", F.lit("edited")), folder, "edited", files=1)
    fs.delete(f"{folder}/same_0.csv")
    rows = day_of_orders(spark, sf, 0).withColumn("origin", F.concat(F.lit("same "), F.col("o_orderkey").cast("string")))
    place_files(spark, rows.orderBy(F.desc("o_orderkey")), folder, "same", files=1)
    fs.rename(f"{folder}/moved_0.csv", f"{folder}/arrived_0.csv")
    return log, detect_dialects(spark, folder).select("path", "name", "content")


def edited_files(spark, sf):
    log, current = _watched_files(spark, sf)
    return log.edited(current).select("name")


def renamed_files(spark, sf):
    log, current = _watched_files(spark, sf)
    return log.renamed(current).select("name", F.element_at(F.split("former", "/"), -1).alias("former"))


QUERIES = {
    "inc_stream_merged_plan": stream_merged,
    "inc_stream_append": stream_append,
    "inc_stream_replay": stream_replay,
    "inc_bad_file_does_not_block": bad_file,
    "inc_bad_file_by_cursor": bad_file_by_cursor,
    "inc_edited_files": edited_files,
    "inc_renamed_files": renamed_files,
    "inc_stream_to_targets": stream_targets,
    "inc_new_to_targets": new_files_to_targets,
    "inc_new_files": detect_new,
    "inc_cursor_advance": advance_cursor,
    "inc_reset_cursor": reset_cursor,
    "inc_batch_summary": summary,
    "inc_stream_clean_load": stream_clean,
    "inc_stream_batches": stream_batches,
    "inc_stream_rerun": stream_rerun,
}

_all = "SELECT DISTINCT '/in/doc_' || doc_id || '.csv' AS path FROM documents"
_labelled = "SELECT DISTINCT '/in/doc_' || doc_id || '.csv' AS path FROM labels"

ORACLES = {
    "inc_stream_merged_plan": RECIPE_ORDERS_SQL,
    "inc_stream_append": 'SELECT o_orderkey AS "O_ORDERKEY", o_totalprice AS "O_TOTALPRICE" FROM orders',
    "inc_stream_replay": """SELECT target, o_orderkey AS "O_ORDERKEY", o_totalprice AS "O_TOTALPRICE"
        FROM orders, (VALUES ('table'), ('documents')) t(target)""",
    "inc_bad_file_does_not_block": """SELECT kind, status, CAST(1 AS INTEGER) AS tries, files, (SELECT count(*) FROM orders) AS row_count
        FROM (VALUES ('first', 'loaded', 2), ('second', 'loaded', 2), ('empty', 'empty', 2), ('constant', 'empty', 2)) t(kind, status, files)""",
    "inc_bad_file_by_cursor": """SELECT 'header only' AS step, 0 AS row_count, 0 AS files UNION ALL SELECT 'unchanged', 0, 0
        UNION ALL SELECT 'another file', count(*), 1 FROM orders WHERE o_orderstatus <> 'F'
        UNION ALL SELECT 'filled', count(*), 2 FROM orders WHERE o_orderstatus = 'F'""",
    "inc_edited_files": "SELECT 'edited_0.csv' AS name WHERE (SELECT count(*) FROM orders) > 0",
    "inc_renamed_files": "SELECT 'arrived_0.csv' AS name, 'moved_0.csv' AS former WHERE (SELECT count(*) FROM orders) > 0",
    "inc_stream_to_targets": 'SELECT o_orderkey AS "O_ORDERKEY", o_totalprice AS "O_TOTALPRICE" FROM orders',
    "inc_new_to_targets": """SELECT count(*) AS row_count, CAST(sum(o_orderkey) AS BIGINT) AS keys,
        count(*) FILTER (o_orderstatus = 'F') AS first_lot, count(*) FILTER (o_orderstatus <> 'F') AS second_lot,
        FALSE AS third FROM orders""",
    "inc_new_files": f"""SELECT path, replace(path, '/in/', '') AS name
        FROM ({_all} EXCEPT {_labelled})""",
    "inc_cursor_advance": f"""SELECT path, 0 AS step FROM ({_all})
        UNION ALL SELECT path, 1 FROM ({_labelled} EXCEPT {_all})
        UNION ALL SELECT path, 2 FROM ({_all} EXCEPT {_labelled})""",
    "inc_reset_cursor": _all,
    "inc_batch_summary": """SELECT count(DISTINCT n) AS file_count, string_agg(DISTINCT n, ',' ORDER BY n) AS new_files
        FROM (SELECT lang || '_' || source || '.csv' AS n FROM documents)""",
    "inc_stream_clean_load": RECIPE_ORDERS_SQL,
    "inc_stream_batches": """SELECT CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS batch_id,
        count(*) AS row_count, TRUE AS named FROM orders GROUP BY 1""",
    "inc_stream_rerun": "SELECT count(*) AS row_count FROM orders",
}
