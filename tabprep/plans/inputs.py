"""Input tables of the registered queries, and SQL building blocks for their checks.

The base tables hold no dirt, so it is derived from ``orders`` by SQL that both
engines run unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

DIRTY_ORDERS = """
SELECT o_orderkey AS order_id,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 'null'
            WHEN o_orderkey % 11 = 0 THEN '   '
            ELSE '  ' || lower(o_orderpriority) || '   #é ' END AS priority,
       CASE WHEN o_orderkey % 3 = 0 THEN 'bad' ELSE CAST(o_custkey AS VARCHAR(20)) END AS cust_txt,
       CASE WHEN o_orderkey % 20 = 0 THEN 'x' ELSE NULL END AS sparse_5pct,
       o_orderstatus AS status, o_orderstatus AS status_copy,
       CASE WHEN o_orderkey % 2 = 0 THEN 'Y' ELSE 'N' END AS flag,
       'const' AS const_col,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice END AS price
FROM orders
"""

DIRTY_ROWS = """
SELECT o_orderkey AS order_id,
       CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderpriority END AS a,
       CASE WHEN o_orderkey % 4 = 0 THEN 'none' ELSE o_orderstatus END AS b
FROM orders
"""

LINES = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, CAST(CAST(l_shipdate AS DATE) AS VARCHAR(10)) AS l_shipday
FROM lineitem
"""

LINES_WITH_COPY = f"SELECT t.*, CAST(l_linenumber AS DOUBLE) AS dupn FROM ({LINES}) t"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run shared SQL over the base table it names."""
    for name in TABLES:
        if f"FROM {name}" in sql:
            return spark.sql(sql.replace(f"FROM {name}", "FROM {base}"), base=table(spark, sf_dir, name))
    raise ValueError("no base table in the SQL")


# --- the same operations as plain SQL ------------------------------------------------

NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def sql_collapse(x: str) -> str:
    return rf"regexp_replace({x}, '\s+', ' ', 'g')"


def sql_upper(x: str) -> str:
    return f"replace(upper({x}), 'ẞ', 'SS')"


def sql_whitelist(x: str) -> str:
    return rf"regexp_replace({x}, '[^A-Z0-9@/\s.\-_]', '', 'g')"


def sql_tokens(x: str) -> str:
    return f"CASE WHEN {x} IN ('NAN', 'NONE', 'NULL', '', ' ') THEN 'NA' ELSE {x} END"


def sql_clean(x: str) -> str:
    folded = sql_upper(f"strip_accents({sql_collapse(sql_strip(x))})")
    return f"coalesce({sql_tokens(sql_whitelist(folded))}, 'NA')"


def sql_number(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '{NUMBER}') THEN try_cast({x} AS DOUBLE) END"
