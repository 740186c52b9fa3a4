"""Registered queries: listing, detecting and reading delimited files.

The files are written from whole base tables first, so the work grows with them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.clean import TableRecord
from ..session import scratch_path
from ..sinks.delimited import write_delimited
from ..sources.delimited import (
    extraction_report,
    extract,
    extract_parts,
    extraction_metrics,
    inferred,
    read_delimited,
    union_parts,
)
from ..sources.dialect import LATIN1, Dialect, detect_dialects, first_match
from ..sources.files import file_inventory
from .inputs import table

ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


def lower_names(df):
    return df.toDF(*[c.lower() for c in df.columns])


def one_folder(records):
    """The single table of a folder of part files, with types inferred and original names."""
    (record,) = records
    return lower_names(inferred(record.df))


def inventory(spark, sf):
    path = scratch_path(spark, "inventory")
    line = F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus")
    lines = table(spark, sf, "orders").select("o_orderstatus", line.alias("line"))
    lines.write.partitionBy("o_orderstatus").text(path)
    files = file_inventory(spark, path, "*.txt", recursive=True)
    status = F.regexp_extract("path", "o_orderstatus=([^/]*)/", 1)
    return files.groupBy(status.alias("o_orderstatus")).agg(
        F.sum("length").alias("total_bytes"),
        F.bool_and(F.col("name").endswith(".txt") & F.col("modified").isNotNull()).alias("listed"),
    )


# How each table is written for the detection query.
_WRITTEN = {
    "customer": (",", "UTF-8", ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")),
    "supplier": (";", "UTF-8", ("s_suppkey", "s_name", "s_nationkey", "s_acctbal")),
    "part": ("|", "UTF-8", ("p_partkey", "p_name", "p_brand", "p_type", "p_size")),
    "orders": ("\t", "UTF-8", ("o_orderkey", "o_orderstatus", "o_totalprice")),
    "documents": ("»", LATIN1, ("doc_id", "lang", "source", "n_chars")),
}


def _write_dialects(spark, sf) -> str:
    path = scratch_path(spark, "dialects")
    for name, (separator, encoding, names) in _WRITTEN.items():
        df = table(spark, sf, name).select(*names)
        write_delimited(df, f"{path}/{name}", separator, encoding)
    return path


def _per_source(detected):
    return detected.groupBy(
        F.element_at(F.split("path", "/"), -2).alias("source"), "separator", "encoding", "fields"
    ).agg(
        F.sum(F.col("lines") - 1).alias("data_rows"),
        F.sum(F.col("lines") - F.col("agreeing_lines")).alias("odd_lines"),
    )


def dialects(spark, sf):
    return _per_source(detect_dialects(spark, f"{_write_dialects(spark, sf)}/*"))


def strict_dialects(spark, sf):
    found = first_match(detect_dialects(spark, f"{_write_dialects(spark, sf)}/*"))
    return found.groupBy(F.element_at(F.split("path", "/"), -2).alias("source"), "separator", "encoding").agg(
        F.sum(F.col("lines") - 1).alias("data_rows")
    )


def roundtrip(name, columns, separator="|", encoding="UTF-8"):
    def query(spark, sf):
        path = scratch_path(spark, "roundtrip")
        write_delimited(table(spark, sf, name).select(*columns), path, separator, encoding)
        return one_folder(extract_parts(spark, path))

    return query


def documents_roundtrip(spark, sf):
    """Free text with quotes and line breaks, written and read as quoted fields."""
    path = scratch_path(spark, "quoted")
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    write_delimited(docs, path, ",")
    df = read_delimited(spark, path, Dialect(",", multiline=True), ["doc_id", "text", "lang"], na_tokens=())
    return lower_names(df).withColumn("doc_id", F.col("doc_id").cast("bigint"))


def ragged(spark, sf):
    path = scratch_path(spark, "ragged")
    o = table(spark, sf, "orders")
    line = (
        F.when(F.col("o_orderkey") % 7 == 0, F.concat_ws(",", "o_orderkey", "o_custkey"))
        .when(F.col("o_orderkey") % 11 == 0, F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus", F.lit("X")))
        .when(F.col("o_orderkey") % 13 == 0, F.concat(F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus"), F.lit(",")))
        .otherwise(F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus"))
    )
    # One unquoted column whose name is the header line gives files with arbitrary lines.
    o.select(line.alias("o_orderkey,o_custkey,o_orderstatus")).write.options(
        sep="\x01", quote="", header="true"
    ).csv(path)
    return one_folder(extract_parts(spark, path))


def fallback(spark, sf):
    path = scratch_path(spark, "fallback")
    write_delimited(table(spark, sf, "customer").select("c_name"), path, "\t")
    (record,) = extract_parts(spark, path)
    d = record.dialect
    return lower_names(record.df).select(
        "c_name",
        F.lit(d.separator).alias("separator"),
        F.lit(d.encoding).alias("encoding"),
        F.lit(d.detected).alias("detected"),
    )


def parts(spark, sf):
    path = scratch_path(spark, "parts")
    orders = table(spark, sf, "orders").select(*ORDER_COLUMNS)
    orders.write.partitionBy("o_orderstatus").option("header", "true").csv(path)
    read = []
    for status in ("F", "O", "P"):
        (record,) = extract_parts(spark, f"{path}/o_orderstatus={status}")
        read.append(record.df.withColumn("O_ORDERSTATUS", F.lit(status)))
    return lower_names(inferred(union_parts(read)))


def skip_empty(spark, sf):
    path = scratch_path(spark, "withempty")
    orders = table(spark, sf, "orders").select(*ORDER_COLUMNS)
    write_delimited(orders, path, ",")
    orders.limit(0).coalesce(1).write.mode("append").option("header", "true").csv(path)
    records = extract(spark, path)
    metrics = extraction_metrics(records).agg(F.sum("row_count").alias("row_count"))
    ok = metrics.select(F.lit("ok").alias("status"), "row_count")
    skipped = sorted({(r.status, r.rows) for r in records if r.status != "ok"})
    return ok.unionByName(spark.createDataFrame(skipped, "status string, row_count bigint"))


def metrics(spark, sf):
    path = scratch_path(spark, "metrics")
    records = []
    for name, (separator, encoding, columns) in _WRITTEN.items():
        write_delimited(table(spark, sf, name).select(*columns), f"{path}/{name}", separator, encoding)
        (record,) = extract_parts(spark, f"{path}/{name}")
        records.append(TableRecord(name, record.df))
    return extraction_metrics(records)


def report_with_dropped(spark, sf):
    """Two lots of unlike files; every tenth line has a field too many, and some fields hold quotes or separators."""
    folder = scratch_path(spark, "report")
    orders = table(spark, sf, "orders")
    for sep, which in ((";", "o_orderstatus = 'F'"), ("|", "o_orderstatus <> 'F'")):
        last = F.when(F.expr("o_orderkey % 10 = 0"), F.lit(f"x{sep}y")).when(F.expr("o_orderkey % 10 = 1"), F.lit(f'"q{sep}r"'))
        last = last.when(F.expr("o_orderkey % 10 = 2"), F.lit('5" z')).otherwise(F.col("o_orderpriority"))
        # whole lines as one column, so that nothing is quoted; its name is the header
        line = F.concat_ws(sep, "o_orderkey", "o_totalprice", last).alias(sep.join(("o_orderkey", "o_totalprice", "remark")))
        lines = orders.where(which).repartition(3, "o_orderkey").select(line)
        lines.write.mode("append").options(sep="\u0001", header="true", quote="\u0000").csv(folder)
    found = extraction_report(spark, folder)
    return found.groupBy("separator", "encoding", "column_count").agg(
        F.sum("row_count").alias("row_count"), F.sum("dropped_lines").alias("dropped_lines"), F.count_distinct("file_name").alias("files")
    )


QUERIES = {
    "src_extract_report": report_with_dropped,
    "src_file_inventory": inventory,
    "src_detect_dialect": dialects,
    "src_first_match_dialect": strict_dialects,
    "src_csv_roundtrip": roundtrip("customer", _WRITTEN["customer"][2]),
    "src_csv_latin1": roundtrip("documents", ("doc_id", "lang", "source"), "»", LATIN1),
    "src_csv_documents": documents_roundtrip,
    "src_csv_lineitem": roundtrip(
        "lineitem",
        ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
         "l_discount", "l_tax", "l_returnflag", "l_linestatus"),
    ),
    "src_csv_ragged": ragged,
    "src_fallback_dialect": fallback,
    "src_union_parts": parts,
    "src_skip_empty": skip_empty,
    "src_extract_metrics": metrics,
}


def _counted(extra: str) -> str:
    return " UNION ALL ".join(
        extra.format(name=n, separator=w[0].replace("\t", "' || chr(9) || '"), encoding=w[1], fields=len(w[2]))
        for n, w in _WRITTEN.items()
    )


ORACLES = {
    "src_extract_report": """SELECT CASE WHEN o_orderstatus = 'F' THEN ';' ELSE '|' END AS separator, 'UTF-8' AS encoding,
        CAST(3 AS INTEGER) AS column_count, count(*) FILTER (o_orderkey % 10 <> 0) AS row_count,
        count(*) FILTER (o_orderkey % 10 = 0) AS dropped_lines, CAST(3 AS BIGINT) AS files FROM orders GROUP BY 1""",
    "src_file_inventory": """SELECT o_orderstatus,
        CAST(sum(length(o_orderkey || ',' || o_custkey || ',' || o_orderstatus) + 1) AS BIGINT) AS total_bytes,
        TRUE AS listed FROM orders GROUP BY o_orderstatus""",
    "src_detect_dialect": _counted(
        "SELECT '{name}' AS source, '{separator}' AS separator, '{encoding}' AS encoding, "
        "{fields} AS fields, count(*) AS data_rows, CAST(0 AS BIGINT) AS odd_lines FROM {name}"
    ),
    "src_first_match_dialect": " UNION ALL ".join(
        f"SELECT '{n}' AS source, '»' AS separator, 'ISO-8859-1' AS encoding, count(*) AS data_rows FROM {n}"
        for n in _WRITTEN
    ),
    "src_csv_roundtrip": """SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
        c_acctbal, c_mktsegment FROM customer""",
    "src_csv_latin1": "SELECT doc_id, lang, source FROM documents",
    "src_csv_documents": "SELECT doc_id, text, lang FROM documents",
    "src_csv_lineitem": """SELECT l_orderkey, l_partkey, l_suppkey,
        CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus FROM lineitem""",
    "src_csv_ragged": """SELECT o_orderkey, o_custkey,
        CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS o_orderstatus FROM orders
        WHERE o_orderkey % 7 = 0 OR (o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0)""",
    "src_fallback_dialect": """SELECT c_name, ',' AS separator, 'UTF-8' AS encoding, FALSE AS detected
        FROM customer""",
    "src_union_parts": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
    "src_skip_empty": "SELECT 'ok' AS status, count(*) AS row_count FROM orders UNION ALL SELECT 'empty', CAST(0 AS BIGINT)",
    "src_extract_metrics": _counted(
        "SELECT '{name}' AS file_name, {fields} AS column_count, count(*) AS row_count FROM {name}"
    ),
}
