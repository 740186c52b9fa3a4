"""Registered queries: SQL and table operations, and document collections."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.buckets import BucketStore
from ..operators.clean import clean_table
from ..operators.documents import DocumentStore, DuplicateIds
from ..operators.tables import TableStore, run_sql, value_counts
from ..session import scratch_path
from .cleaning import RECIPE_ORDERS_SQL
from .inputs import DIRTY_ORDERS, TABLES, derive, table
from .loading import unique

ORDERS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_orderdate")
EVENTS = ("event_id", "user_id", "event_type", "value", "props", "ts")


def orders_of(spark, sf):
    return table(spark, sf, "orders").select(*ORDERS)


def order_table(spark, sf, buckets=0):
    place = scratch_path(spark, "tables")
    store = BucketStore(spark, place, "o_orderkey", buckets) if buckets else TableStore(spark, place)
    name = unique("orders")
    store.replace(name, orders_of(spark, sf))
    return store, name


def param_select(spark, sf):
    view = unique("o")
    orders_of(spark, sf).createOrReplaceTempView(view)
    return run_sql(
        spark,
        f"SELECT o_orderkey, o_custkey, o_totalprice FROM {view} WHERE o_orderstatus = :status AND o_totalprice >= :least",
        {"status": "O", "least": 100000.0},
    )


def positional_select(spark, sf):
    view = unique("o")
    orders_of(spark, sf).createOrReplaceTempView(view)
    return run_sql(
        spark, f"SELECT o_orderkey, o_orderpriority FROM {view} WHERE o_orderpriority <> ?", ["5-LOW"]
    )


def insert_rows(spark, sf):
    store = TableStore(spark, scratch_path(spark, "tables"))
    name = unique("orders")
    orders = orders_of(spark, sf)
    done = orders.where("o_orderstatus = 'F'")
    store.replace(name, done.drop("o_orderpriority"))
    affected = store.append(name, orders.where("o_orderstatus <> 'F'"))
    return store.table(name).withColumn("affected", F.lit(affected))


def update_rows(spark, sf):
    store, name = order_table(spark, sf, buckets=8)
    matched, modified = store.update(
        name,
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"),
        {"o_orderpriority": F.lit("1-URGENT"), "o_totalprice": F.col("o_totalprice") * 2},
    )
    return store.table(name).withColumns({"matched": F.lit(matched), "modified": F.lit(modified)})


def delete_rows(spark, sf):
    store, name = order_table(spark, sf, buckets=8)
    deleted = store.delete(name, (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 50000))
    return store.table(name).withColumn("deleted", F.lit(deleted))


def untouched_buckets(spark, sf):
    """A change of the orders of one customer: how many buckets it wrote anew, and what the table holds."""
    store, name = order_table(spark, sf, buckets=64)
    before = store.places(name)
    first = store.table(name).agg(F.min("o_custkey")).first()[0]
    wanted = F.col("o_custkey") == first
    expected = len(store.touched(name, wanted))
    store.update(name, wanted, {"o_totalprice": F.col("o_totalprice") + 1})
    store.delete(name, wanted & (F.col("o_orderstatus") == "F"))
    after = store.places(name)
    moved = sum(before[k] != after[k] for k in before)
    return store.table(name).withColumns({"only_touched": F.lit(moved == expected), "few": F.lit(moved < len(before))})


def keep_versions(spark, sf):
    """Five rewrites of a table, of which the two before the last are kept and still read."""
    store, name = order_table(spark, sf)
    for k in range(4):
        store.replace(name, orders_of(spark, sf).where(F.col("o_orderkey") % 5 > k))
    removed = store.vacuum(name, keep=2)
    counts = [(k, store.read_version(name, v).count()) for k, v in enumerate(store.versions(name))]
    return spark.createDataFrame(counts, "age int, row_count bigint").withColumn("removed", F.lit(removed))


def table_exists(spark, sf):
    store, name = order_table(spark, sf)
    rows = store.table(name).count()
    before = store.exists(name)
    dropped = store.drop(name)
    answers = [("loaded", before), ("dropped", dropped), ("gone", not store.exists(name))]
    return spark.createDataFrame(
        [(step, answer, rows) for step, answer in answers],
        "step string, answer boolean, rows_loaded bigint",
    )


def counts_per_value(spark, sf):
    out, _ = clean_table(derive(spark, sf, DIRTY_ORDERS))
    return value_counts(out, "PRIORITY", "orders")


def preview(spark, sf):
    store, name = order_table(spark, sf)
    return store.preview(name, [F.desc("o_totalprice"), F.col("o_orderkey")])


def row_counts(spark, sf):
    parts = [
        table(spark, sf, t).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
        for t in TABLES
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def join_cleaned(spark, sf):
    c, o = unique("c"), unique("o")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    clean_table(customers)[0].createOrReplaceTempView(c)
    clean_table(orders_of(spark, sf))[0].createOrReplaceTempView(o)
    return run_sql(
        spark,
        f"""SELECT C_MKTSEGMENT AS segment, O_ORDERSTATUS AS status, count(*) AS orders,
                   CAST(sum(CAST(O_TOTALPRICE AS DECIMAL(18, 2))) AS DOUBLE) AS total
            FROM {o} JOIN {c} ON O_CUSTKEY = C_CUSTKEY GROUP BY C_MKTSEGMENT, O_ORDERSTATUS""",
    )


# --- documents -------------------------------------------------------------------------


def event_collection(spark, sf, buckets=0):
    place = scratch_path(spark, "docs")
    store = BucketStore(spark, place, buckets=buckets) if buckets else DocumentStore(spark, place)
    name = unique("events")
    store.insert_dataframe(
        name, table(spark, sf, "events").select(*EVENTS), replace=True, keys=["event_id"]
    )
    return store, name


FOUND = {
    "$or": [{"event_type": {"$in": ["click", "purchase"]}}, {"value": {"$gte": 90}}],
    "user_id": {"$ne": 7},
    "props": {"$exists": True},
    "event_id": {"$gt": 10},
}
FOUND_SQL = """(event_type IN ('click', 'purchase') OR value >= 90) AND user_id <> 7
    AND props IS NOT NULL AND event_id > 10"""


def find_many(spark, sf):
    store, name = event_collection(spark, sf)
    return store.find_many(name, FOUND)


def find_limited(spark, sf):
    store, name = event_collection(spark, sf)
    return store.find_many(name, FOUND, limit=25, order_by=[F.desc("value"), F.col("event_id")])


def find_first(spark, sf):
    store, name = event_collection(spark, sf)
    return store.find_one(name, {"event_type": "click"}, [F.desc("value"), F.col("event_id")])


def insert_many(spark, sf):
    store = DocumentStore(spark, scratch_path(spark, "docs"))
    name = unique("events")
    events = table(spark, sf, "events").select(*EVENTS)
    first = store.insert_many(name, events.where("value < 50").drop("props"), keys=["event_id"])
    second = store.insert_many(name, events.where("value >= 50"), keys=["event_id"])
    ids = first.ids.unionByName(second.ids)
    return (
        store.table(name)
        .join(ids, "_id", "left_semi")
        .withColumn("inserted", F.lit(first.count + second.count))
    )


def insert_random_ids(spark, sf):
    store = DocumentStore(spark, scratch_path(spark, "docs"))
    name = unique("events")
    got = store.insert_many(name, table(spark, sf, "events").select(*EVENTS))
    stored = store.table(name).join(got.ids, "_id", "left_semi")
    return stored.agg(
        F.count(F.lit(1)).alias("stored"),
        F.count_distinct("_id").alias("distinct_ids"),
        F.lit(got.count).cast("bigint").alias("inserted"),
    )


UPDATE = {"$set": {"event_type": "sale", "reviewed": True}, "$unset": {"props": ""}, "$inc": {"user_id": 1000}}


def update_many(spark, sf):
    store, name = event_collection(spark, sf, buckets=8)
    modified = store.update_many(name, {"event_type": "purchase"}, UPDATE)
    return store.table(name).withColumn("modified_count", F.lit(modified))


def update_first(spark, sf):
    store, name = event_collection(spark, sf, buckets=8)
    modified = store.update_one(
        name, {"event_type": "purchase"}, {"$set": {"event_type": "sale"}}, F.col("event_id")
    )
    return store.table(name).withColumn("modified_count", F.lit(modified))


def delete_many(spark, sf):
    store, name = event_collection(spark, sf, buckets=8)
    deleted = store.delete_many(name, {"value": {"$lt": 40}, "event_type": {"$nin": ["click"]}})
    return store.table(name).withColumn("deleted_count", F.lit(deleted))


def delete_first(spark, sf):
    store, name = event_collection(spark, sf, buckets=8)
    deleted = store.delete_one(name, {"event_type": "click"}, F.desc("event_id"))
    return store.table(name).withColumn("deleted_count", F.lit(deleted))


def collection_lifecycle(spark, sf):
    store = DocumentStore(spark, scratch_path(spark, "docs"))
    name = unique("life")
    created = store.create_collection(name, "event_id bigint, event_type string")
    again = store.create_collection(name)
    count = store.insert_many(
        name, table(spark, sf, "events").select("event_id", "event_type"), keys=["event_id"]
    ).count
    exists = store.exists(name)
    dropped, twice = store.drop_collection(name), store.drop_collection(name)
    rows = [("created", created), ("created_again", again), ("exists", exists),
            ("dropped", dropped), ("dropped_again", twice)]
    return spark.createDataFrame(
        [(step, answer, count) for step, answer in rows],
        "step string, answer boolean, documents bigint",
    )


def append_widening(spark, sf):
    """Fractions appended to a column of whole numbers."""
    store = TableStore(spark, scratch_path(spark, "tables"))
    name = unique("orders")
    orders = orders_of(spark, sf)
    store.replace(name, orders.where("o_orderstatus = 'F'"))
    store.append(name, orders.where("o_orderstatus <> 'F'").withColumn("o_custkey", F.col("o_custkey") + F.lit(0.5)))
    return store.table(name)


def delete_all_rows(spark, sf):
    store, name = order_table(spark, sf)
    deleted = store.delete(name, F.lit(True))
    return store.table(name).agg(F.count(F.lit(1)).alias("remaining")).withColumn("deleted", F.lit(deleted).cast("long"))


def increment_by_fraction(spark, sf):
    store, name = event_collection(spark, sf)
    modified = store.update_many(name, {"event_type": "click"}, {"$inc": {"user_id": 0.5}})
    return store.table(name).withColumn("modified_count", F.lit(modified).cast("long"))


def delete_all_documents(spark, sf):
    store, name = event_collection(spark, sf)
    deleted = store.delete_many(name, {})
    return store.find_many(name).agg(F.count(F.lit(1)).alias("remaining")).withColumn("deleted", F.lit(deleted).cast("long"))


def _halved_keys(spark, sf):
    """Events with two keys of which one is null: (k, null) and (null, k) are unlike."""
    half = F.expr("cast(floor(event_id / 2) as string)")
    even = F.expr("pmod(event_id, 2) = 0")
    return table(spark, sf, "events").withColumns({"left_key": F.when(even, half), "right_key": F.when(~even, half)})


def null_keys(spark, sf):
    store = DocumentStore(spark, scratch_path(spark, "docs"))
    name = unique("events")
    inserted = store.insert_many(name, _halved_keys(spark, sf), keys=["left_key", "right_key"])
    return store.table(name).agg(F.count(F.lit(1)).alias("stored"), F.countDistinct("_id").alias("distinct_ids")).withColumn(
        "inserted", F.lit(inserted.count).cast("long")
    )


def duplicate_ids(spark, sf):
    """The same documents again: refused, and nothing is added."""
    store, name = event_collection(spark, sf)
    try:
        store.insert_many(name, table(spark, sf, "events").select(*EVENTS), keys=["event_id"])
        refused = False
    except DuplicateIds:
        refused = True
    return store.table(name).agg(F.count(F.lit(1)).alias("stored")).withColumn("refused", F.lit(refused))


QUERIES = {
    "sql_param_select": param_select,
    "sql_positional_select": positional_select,
    "tbl_insert_rows": insert_rows,
    "tbl_untouched_buckets": untouched_buckets,
    "tbl_keep_versions": keep_versions,
    "tbl_update_where": update_rows,
    "tbl_delete_where": delete_rows,
    "tbl_exists": table_exists,
    "agg_value_counts": counts_per_value,
    "tbl_preview_limit": preview,
    "agg_count_rows": row_counts,
    "sql_join_cleaned_tables": join_cleaned,
    "doc_find_many": find_many,
    "doc_find_limited": find_limited,
    "doc_find_first": find_first,
    "doc_insert_many": insert_many,
    "doc_insert_random_ids": insert_random_ids,
    "doc_update_many": update_many,
    "doc_update_first": update_first,
    "doc_delete_many": delete_many,
    "doc_delete_first": delete_first,
    "doc_collection_lifecycle": collection_lifecycle,
    "tbl_append_widening": append_widening,
    "tbl_delete_all": delete_all_rows,
    "doc_inc_fraction": increment_by_fraction,
    "doc_delete_all": delete_all_documents,
    "doc_null_keys": null_keys,
    "doc_duplicate_ids": duplicate_ids,
}

_orders = ", ".join(ORDERS)
_docs = f"(SELECT sha256(CAST(event_id AS VARCHAR)) AS _id, {', '.join(EVENTS)} FROM events) d"
_urgent = "o_orderpriority IN ('1-URGENT', '2-HIGH')"

ORACLES = {
    "sql_param_select": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE o_orderstatus = 'O' AND o_totalprice >= 100000""",
    "sql_positional_select": "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW'",
    "tbl_insert_rows": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
        CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority, o_orderdate,
        CAST((SELECT count(*) FROM orders WHERE o_orderstatus <> 'F') AS INTEGER) AS affected FROM orders""",
    "tbl_untouched_buckets": """SELECT o_orderkey, o_custkey, o_orderstatus,
            CASE WHEN mine THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderpriority, o_orderdate,
            TRUE AS only_touched, TRUE AS few
        FROM (SELECT *, o_custkey = (SELECT min(o_custkey) FROM orders) AS mine FROM orders) WHERE NOT (mine AND o_orderstatus = 'F')""",
    "tbl_keep_versions": """SELECT CAST(age AS INTEGER) AS age, (SELECT count(*) FROM orders WHERE o_orderkey % 5 > 3 - age) AS row_count,
        CAST(2 AS INTEGER) AS removed FROM (VALUES (0), (1), (2)) t(age)""",
    "tbl_update_where": f"""SELECT o_orderkey, o_custkey, o_orderstatus,
        CASE WHEN {_urgent} THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
        CASE WHEN {_urgent} THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority, o_orderdate,
        CAST((SELECT count(*) FROM orders WHERE {_urgent}) AS INTEGER) AS matched,
        CAST((SELECT count(*) FROM orders WHERE {_urgent} AND (o_orderpriority <> '1-URGENT' OR o_totalprice <> 0))
             AS INTEGER) AS modified FROM orders""",
    "tbl_delete_where": f"""SELECT {_orders}, CAST((SELECT count(*) FROM orders
        WHERE o_orderstatus = 'P' AND o_totalprice > 50000) AS INTEGER) AS deleted FROM orders
        WHERE NOT (o_orderstatus = 'P' AND o_totalprice > 50000)""",
    "tbl_exists": """SELECT unnest(['loaded', 'dropped', 'gone']) AS step, TRUE AS answer,
        (SELECT count(*) FROM orders) AS rows_loaded""",
    "agg_value_counts": f'SELECT "PRIORITY", count(*) AS orders FROM ({RECIPE_ORDERS_SQL}) GROUP BY "PRIORITY"',
    "tbl_preview_limit": f"SELECT {_orders} FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
    "agg_count_rows": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES
    ),
    "sql_join_cleaned_tables": """SELECT c_mktsegment AS segment, o_orderstatus AS status, count(*) AS orders,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
    "doc_find_many": f"SELECT * FROM {_docs} WHERE {FOUND_SQL}",
    "doc_find_limited": f"SELECT * FROM {_docs} WHERE {FOUND_SQL} ORDER BY value DESC, event_id LIMIT 25",
    "doc_find_first": f"SELECT * FROM {_docs} WHERE event_type = 'click' ORDER BY value DESC, event_id LIMIT 1",
    "doc_insert_many": f"""SELECT _id, event_id, user_id, event_type, value, ts,
        CASE WHEN value >= 50 THEN props END AS props,
        CAST((SELECT count(*) FROM events) AS INTEGER) AS inserted FROM {_docs}""",
    "doc_insert_random_ids": """SELECT count(*) AS stored, count(*) AS distinct_ids, count(*) AS inserted
        FROM events""",
    "doc_update_many": f"""SELECT _id, event_id,
        CASE WHEN event_type = 'purchase' THEN user_id + 1000 ELSE user_id END AS user_id,
        CASE WHEN event_type = 'purchase' THEN 'sale' ELSE event_type END AS event_type, value, ts,
        CASE WHEN event_type <> 'purchase' THEN props END AS props,
        CASE WHEN event_type = 'purchase' THEN TRUE END AS reviewed,
        CAST((SELECT count(*) FROM events WHERE event_type = 'purchase') AS INTEGER) AS modified_count FROM {_docs}""",
    "doc_update_first": f"""SELECT _id, event_id, user_id,
        CASE WHEN event_id = (SELECT min(event_id) FROM events WHERE event_type = 'purchase')
             THEN 'sale' ELSE event_type END AS event_type, value, props, ts, 1 AS modified_count FROM {_docs}""",
    "doc_delete_many": f"""SELECT *, CAST((SELECT count(*) FROM events WHERE value < 40 AND event_type <> 'click')
        AS INTEGER) AS deleted_count FROM {_docs} WHERE NOT (value < 40 AND event_type <> 'click')""",
    "doc_delete_first": f"""SELECT *, 1 AS deleted_count FROM {_docs}
        WHERE event_id <> (SELECT max(event_id) FROM events WHERE event_type = 'click')""",
    "tbl_append_widening": """SELECT * REPLACE (CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS DOUBLE)
        ELSE o_custkey + CAST(0.5 AS DOUBLE) END AS o_custkey) FROM (SELECT """ + _orders + """ FROM orders)""",
    "tbl_delete_all": "SELECT CAST(0 AS BIGINT) AS remaining, count(*) AS deleted FROM orders",
    "doc_inc_fraction": f"""SELECT * REPLACE (CASE WHEN event_type = 'click' THEN user_id + CAST(0.5 AS DOUBLE)
        ELSE CAST(user_id AS DOUBLE) END AS user_id),
        (SELECT count(*) FROM events WHERE event_type = 'click') AS modified_count FROM {_docs}""",
    "doc_delete_all": "SELECT CAST(0 AS BIGINT) AS remaining, count(*) AS deleted FROM events",
    "doc_null_keys": "SELECT count(*) AS stored, count(*) AS distinct_ids, count(*) AS inserted FROM events",
    "doc_duplicate_ids": "SELECT count(*) AS stored, TRUE AS refused FROM events",
    "doc_collection_lifecycle": """SELECT * FROM (VALUES ('created', TRUE), ('created_again', FALSE),
        ('exists', TRUE), ('dropped', TRUE), ('dropped_again', FALSE)) t(step, answer),
        (SELECT count(*) AS documents FROM events)""",
}
