"""Registered queries: the cleaning steps and the whole recipe."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import strings
from ..functions.names import output_name_column, table_name_column
from ..operators import clean, columns
from ..operators.validate import between, matches, not_null, one_of, profile_columns, unique, validate
from .inputs import (
    DIRTY_ORDERS,
    DIRTY_ROWS,
    LINES,
    LINES_WITH_COPY,
    derive,
    sql_clean,
    sql_collapse,
    sql_number,
    sql_strip,
    sql_tokens,
    sql_upper,
    sql_whitelist,
    table,
)


def messy_names(spark, sf):
    c = table(spark, sf, "customer")
    messy = c.toDF("a", "A", "a_1", "  ", " seg ment ")
    return columns.with_normalized_names(messy)


def text_step(expression):
    def query(spark, sf):
        return table(spark, sf, "documents").select("doc_id", expression(F.col("text")).alias("value"))

    return query


def padded(step):
    return lambda c: step(F.concat(F.lit(" \t\n "), c, F.lit("  \n")))


def priority_step(expression):
    def query(spark, sf):
        return derive(spark, sf, DIRTY_ORDERS).select(
            "order_id", expression(F.col("priority")).alias("value")
        )

    return query


def documents_cleaned(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    return d.select(
        "doc_id", *[strings.clean_text(F.col(c)).alias(c) for c in ("text", "lang", "source")]
    )


def recipe(sql, config=None):
    def query(spark, sf):
        return clean.clean_table(derive(spark, sf, sql), config)[0]

    return query


def skip_empty_table(spark, sf):
    orders = derive(spark, sf, DIRTY_ORDERS)
    blank = table(spark, sf, "customer").select(
        F.lit(None).cast("string").alias("a"), F.lit(None).cast("double").alias("b")
    )
    constant = table(spark, sf, "supplier").select(F.lit("x").alias("a"), F.lit(1).alias("b"))
    records = [
        clean.TableRecord("orders.csv", orders),
        clean.TableRecord("blank.csv", blank),
        clean.TableRecord("constant.csv", constant),
    ]
    done = clean.clean_tables(records)
    return spark.createDataFrame(
        [(r.name, r.status, r.rows) for r in done], "table_name string, status string, row_count bigint"
    )


def report(spark, sf):
    records = clean.clean_tables(
        [
            clean.TableRecord("dirty_orders.csv", derive(spark, sf, DIRTY_ORDERS)),
            clean.TableRecord("dirty_rows.csv", derive(spark, sf, DIRTY_ROWS)),
        ]
    )
    return clean.clean_report(spark, records).select(
        "table_name", "step", "rows_before", "rows_after", "columns_before", "columns_after"
    )


def cleaning_summary(spark, sf):
    records = clean.clean_tables(
        [
            clean.TableRecord("dirty_orders.csv", derive(spark, sf, DIRTY_ORDERS)),
            clean.TableRecord("dirty_rows.csv", derive(spark, sf, DIRTY_ROWS)),
        ]
    )
    return clean.clean_summary(spark, records).withColumn(
        "file_names", F.concat_ws(",", F.sort_array("file_names"))
    )


def contract_applied(spark, sf):
    """A plan fitted on the orders, stored as JSON, and applied to the same layout again."""
    orders = derive(spark, sf, DIRTY_ORDERS)
    stored = clean.fit_plan(orders).to_json()
    return clean.CleanPlan.from_json(stored).apply(orders)


TEXTS = (("pages", "page_id", ("html", "url")), ("conversations", "conv_id", ("text", "role")), ("benchmark", "item_id", ("text",)))


def texts_cleaned(spark, sf):
    """Every text column of the other text tables."""
    parts = [
        table(spark, sf, name).select(
            F.lit(f"{name}.{c}").alias("origin"), F.col(key).cast("string").alias("id"), strings.clean_text(F.col(c)).alias("value")
        )
        for name, key, columns in TEXTS
        for c in columns
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def orders_with_dates(spark, sf):
    """The recipe on the orders as they are: dates pass, texts are cleaned."""
    return clean.clean_table(table(spark, sf, "orders"))[0]


def orders_profile(spark, sf):
    return profile_columns(table(spark, sf, "orders"))


def orders_rules(spark, sf):
    checks = [
        unique("o_orderkey"), unique("o_custkey"), not_null("o_orderdate"), between("o_totalprice", 1000, 200000),
        one_of("o_orderstatus", ("F", "O")), matches("o_orderpriority", r"^[1-4]-"),
    ]
    return validate(table(spark, sf, "orders"), checks)


QUERIES = {
    "clean_strings_texts": texts_cleaned,
    "clean_table_dates": orders_with_dates,
    "profile_columns": orders_profile,
    "validate_rules": orders_rules,
    "clean_normalize_columns": messy_names,
    "clean_drop_sparse": lambda s, d: columns.drop_sparse_columns(derive(s, d, DIRTY_ORDERS)),
    "clean_column_classes": lambda s, d: clean.column_classes(derive(s, d, DIRTY_ORDERS)),
    "clean_strings": lambda s, d: clean.clean_text_columns(derive(s, d, DIRTY_ORDERS)),
    "clean_strings_documents": documents_cleaned,
    "str_strip": text_step(padded(strings.strip_whitespace)),
    "str_collapse_ws": text_step(strings.collapse_whitespace),
    "str_fold_accents": text_step(lambda c: strings.uppercase(strings.fold_accents(c))),
    "str_upper": text_step(strings.uppercase),
    "str_whitelist": text_step(lambda c: strings.keep_whitelist(strings.uppercase(c))),
    "str_null_tokens": priority_step(
        lambda c: strings.null_tokens_to_na(strings.uppercase(strings.squeeze(c)))
    ),
    "fill_string_na": priority_step(strings.fill_na),
    "clean_coerce_numeric": lambda s, d: clean.coerce_numeric_columns(derive(s, d, DIRTY_ORDERS)),
    "clean_drop_empty_rows": lambda s, d: clean.drop_empty_rows(
        clean.clean_text_columns(derive(s, d, DIRTY_ROWS))
    ),
    "clean_drop_low_variety": lambda s, d: columns.drop_low_variety_columns(derive(s, d, LINES)),
    "clean_drop_duplicate_columns": lambda s, d: columns.drop_duplicate_columns(
        derive(s, d, LINES_WITH_COPY)
    ),
    "clean_skip_empty_table": skip_empty_table,
    "clean_report": report,
    "clean_summary": cleaning_summary,
    "clean_table_orders": recipe(DIRTY_ORDERS),
    "clean_table_rows": recipe(DIRTY_ROWS),
    "clean_table_lineitem": recipe(LINES_WITH_COPY),
    "clean_table_numeric": recipe("SELECT l_orderkey, l_quantity, l_extendedprice FROM lineitem"),
    "clean_contract_apply": contract_applied,
    "name_output": lambda s, d: table(s, d, "pages").select(
        "page_id", output_name_column(F.col("url")).alias("output_name")
    ),
    "name_sanitize_table": lambda s, d: table(s, d, "part").select(
        "p_partkey",
        table_name_column(F.concat("p_name", F.lit(" "), "p_type", F.lit(".csv"))).alias("plain"),
        table_name_column(F.concat("p_partkey", F.lit("_é-"), "p_name", F.lit(".csv"))).alias("prefixed"),
    ),
}

_dirty = f"({DIRTY_ORDERS}) t"
_rows = f"({DIRTY_ROWS}) t"
_TEXTS = ("priority", "sparse_5pct", "status", "status_copy", "flag", "const_col")

RECIPE_ORDERS_SQL = f"""
SELECT order_id AS "ORDER_ID", {sql_clean('priority')} AS "PRIORITY",
       coalesce({sql_number('cust_txt')}, 0) AS "CUST_TXT",
       {sql_clean('status')} AS "STATUS", coalesce(price, 0) AS "PRICE"
FROM {_dirty}
"""
RECIPE_ROWS_SQL = f"""
SELECT * FROM (SELECT order_id AS "ORDER_ID", {sql_clean('a')} AS "A", {sql_clean('b')} AS "B" FROM {_rows})
WHERE NOT ("A" = 'NA' AND "B" = 'NA')
"""


def _class_row(name: str, numeric: str) -> str:
    return f"""
    SELECT '{name}' AS column_name,
           CASE WHEN count({numeric}) > 0.5 * count(*) THEN 'number' ELSE 'text' END AS column_class,
           count({name}) AS present, count({numeric}) AS numeric_values FROM {_dirty}"""


def _step_rows(name: str, source: str, kept: str, counts) -> str:
    steps = ("normalize_names", "sparse_columns", "empty_rows", "low_variety_columns", "duplicate_columns")
    out = []
    for i, step in enumerate(steps):
        before = source if i < 3 else kept
        after = source if i < 2 else kept
        out.append(
            f"SELECT '{name}' AS table_name, '{step}' AS step, (SELECT count(*) FROM {before}) AS rows_before, "
            f"(SELECT count(*) FROM {after}) AS rows_after, {counts[i][0]} AS columns_before, "
            f"{counts[i][1]} AS columns_after"
        )
    return " UNION ALL ".join(out)


_docs = "FROM documents"
_padded = "' ' || chr(9) || chr(10) || ' ' || text || '  ' || chr(10)"
_plain = "regexp_replace(p_name || ' ' || p_type, '\\.[^.]*$', '')"

ORACLES = {
    "clean_strings_texts": " UNION ALL ".join(
        f"SELECT '{t}.{c}' AS origin, CAST({key} AS VARCHAR) AS id, {sql_clean(c)} AS value FROM {t}"
        for t, key, columns in TEXTS
        for c in columns
    ),
    "clean_table_dates": f"""SELECT o_orderkey AS "O_ORDERKEY", o_custkey AS "O_CUSTKEY", {sql_clean('o_orderstatus')} AS "O_ORDERSTATUS",
        o_totalprice AS "O_TOTALPRICE", o_orderdate AS "O_ORDERDATE", {sql_clean('o_orderpriority')} AS "O_ORDERPRIORITY" FROM orders""",
    "profile_columns": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, '{kind}' AS column_type, count(*) AS row_count, count(*) - count({c}) AS null_count,
        count(DISTINCT {c}) + CAST(count(*) > count({c}) AS BIGINT) AS distinct_count,
        {f'CAST(min({c}) AS DOUBLE)' if number else 'CAST(NULL AS DOUBLE)'} AS min_number,
        {f'CAST(max({c}) AS DOUBLE)' if number else 'CAST(NULL AS DOUBLE)'} AS max_number,
        {'CAST(NULL AS VARCHAR)' if number else f'CAST(min({c}) AS VARCHAR)'} AS min_text,
        {'CAST(NULL AS VARCHAR)' if number else f'CAST(max({c}) AS VARCHAR)'} AS max_text FROM orders"""
        for c, kind, number in (
            ("o_orderkey", "bigint", True), ("o_custkey", "bigint", True), ("o_orderstatus", "string", False),
            ("o_totalprice", "double", True), ("o_orderdate", "timestamp_ntz", False), ("o_orderpriority", "string", False),
        )
    ),
    "validate_rules": """SELECT rule, CAST(failed AS BIGINT) AS failed, failed = 0 AS passed FROM (
        SELECT unnest(['o_orderkey unique', 'o_custkey unique', 'o_orderdate not null', 'o_totalprice between 1000 and 200000',
                       'o_orderstatus one of 2', 'o_orderpriority matches ^[1-4]-']) AS rule,
               unnest([(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey HAVING count(*) > 1)),
                       (SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1)),
                       (SELECT count(*) FROM orders WHERE o_orderdate IS NULL),
                       (SELECT count(*) FROM orders WHERE o_totalprice NOT BETWEEN 1000 AND 200000),
                       (SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')),
                       (SELECT count(*) FROM orders WHERE NOT regexp_matches(o_orderpriority, '^[1-4]-'))]) AS failed)""",
    "clean_normalize_columns": """SELECT c_custkey AS "A", c_name AS "A_1", c_nationkey AS "A_1_1",
        c_acctbal AS "COLUMN_3", c_mktsegment AS "SEG MENT" FROM customer""",
    "clean_drop_sparse": f"""SELECT order_id, priority, cust_txt, status, status_copy, flag, const_col, price
        FROM {_dirty}""",
    "clean_column_classes": " UNION ALL ".join(
        [_class_row("order_id", "order_id"), _class_row("price", "price")]
        + [_class_row(c, sql_number(c)) for c in ("cust_txt", *_TEXTS)]
    ),
    "clean_strings": "SELECT order_id, cust_txt, price, "
    + ", ".join(f"{sql_clean(c)} AS {c}" for c in _TEXTS) + f" FROM {_dirty}",
    "clean_strings_documents": "SELECT doc_id, "
    + ", ".join(f"{sql_clean(c)} AS {c}" for c in ("text", "lang", "source")) + " FROM documents",
    "str_strip": f"SELECT doc_id, {sql_strip(_padded)} AS value {_docs}",
    "str_collapse_ws": f"SELECT doc_id, {sql_collapse('text')} AS value {_docs}",
    "str_fold_accents": f"SELECT doc_id, {sql_upper('strip_accents(text)')} AS value {_docs}",
    "str_upper": f"SELECT doc_id, {sql_upper('text')} AS value {_docs}",
    "str_whitelist": f"SELECT doc_id, {sql_whitelist(sql_upper('text'))} AS value {_docs}",
    "str_null_tokens": f"""SELECT order_id, {sql_tokens('x')} AS value
        FROM (SELECT order_id, upper({sql_collapse(sql_strip('priority'))}) AS x FROM {_dirty})""",
    "fill_string_na": f"SELECT order_id, coalesce(priority, 'NA') AS value FROM {_dirty}",
    "clean_coerce_numeric": f"""SELECT order_id, priority, coalesce({sql_number('cust_txt')}, 0) AS cust_txt,
        sparse_5pct, status, status_copy, flag, const_col, coalesce(price, 0) AS price FROM {_dirty}""",
    "clean_drop_empty_rows": f"""SELECT * FROM (SELECT order_id, {sql_clean('a')} AS a,
        {sql_clean('b')} AS b FROM {_rows}) WHERE NOT (a = 'NA' AND b = 'NA')""",
    "clean_drop_low_variety": f"SELECT * EXCLUDE (l_linestatus) FROM ({LINES}) t",
    "clean_drop_duplicate_columns": f"SELECT * FROM ({LINES}) t",
    "clean_skip_empty_table": """SELECT 'orders.csv' AS table_name, 'ok' AS status, count(*) AS row_count FROM orders
        UNION ALL SELECT 'blank.csv', 'empty', 0 UNION ALL SELECT 'constant.csv', 'empty', 0""",
    "clean_report": _step_rows(
        "dirty_orders.csv", "orders", "orders", [(9, 9), (9, 8), (8, 8), (8, 6), (6, 5)]
    ) + " UNION ALL " + _step_rows(
        "dirty_rows.csv", "orders", f"({RECIPE_ROWS_SQL}) k", [(3, 3)] * 5
    ),
    "clean_summary": f"""SELECT 2 AS files_transformed,
        (SELECT count(*) FROM orders) + (SELECT count(*) FROM ({RECIPE_ROWS_SQL}) k) AS total_rows,
        'dirty_orders_transformed.csv,dirty_rows_transformed.csv' AS file_names""",
    "clean_table_orders": RECIPE_ORDERS_SQL,
    "clean_table_rows": RECIPE_ROWS_SQL,
    "clean_table_lineitem": f"""SELECT l_orderkey AS "L_ORDERKEY", l_partkey AS "L_PARTKEY",
        l_suppkey AS "L_SUPPKEY", l_linenumber AS "L_LINENUMBER", l_quantity AS "L_QUANTITY",
        l_extendedprice AS "L_EXTENDEDPRICE", l_discount AS "L_DISCOUNT", l_tax AS "L_TAX",
        {sql_clean('l_returnflag')} AS "L_RETURNFLAG", {sql_clean('l_shipday')} AS "L_SHIPDAY"
        FROM ({LINES}) t""",
    "clean_table_numeric": """SELECT l_orderkey AS "L_ORDERKEY", l_quantity AS "L_QUANTITY",
        l_extendedprice AS "L_EXTENDEDPRICE" FROM lineitem""",
    "clean_contract_apply": RECIPE_ORDERS_SQL,
    "name_output": r"""SELECT page_id, regexp_replace(url, '\.[^.]*$', '') || '_transformed.csv' AS output_name
        FROM pages""",
    "name_sanitize_table": """SELECT p_partkey,
        CASE WHEN regexp_matches(x, '^[0-9]') THEN 'tbl_' || x ELSE x END AS plain,
        'tbl_' || p_partkey || '_e_' || regexp_replace(lower(p_name), '[^a-z0-9]', '_', 'g') AS prefixed
        FROM (SELECT p_partkey, p_name, regexp_replace(lower(p_name || ' ' || p_type), '[^a-z0-9]', '_', 'g') AS x
              FROM part)""",
}
