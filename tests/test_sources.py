import re

import pytest

from tabprep.operators.clean import clean_table
from tabprep.sources.delimited import extract, extract_parts, extraction_metrics, inferred, read_delimited
from tabprep.sources.dialect import Dialect, detect_dialects, first_match
from tabprep.sources.files import NoInputFiles, file_inventory, require_files
from tabprep.sources.relational import jdbc_options

FILES = {
    "std.csv": b"a,b,c\n1,2,3\n",
    "legacy.csv": "a»b\né»x\n".encode("latin-1"),
    "utf8_guillemet.csv": "a»b\nx»yé\n".encode(),
    "bom.csv": b"\xef\xbb\xbfname,age\nx,1\n",
    "euro.csv": b"a;b\n1;2\n",
    "pipe.csv": b"a|b\n1|2\n",
    "tabs.csv": b"a\tb\n1\t2\n",
    "cp1252.csv": b"a,b\n\x80\x93,1\n",
    "quoted_sep.csv": 'a,b\né,"x,y"\n'.encode(),
    "ragged.csv": b"a,b,c\n1,2\n1,2,3,4\n5,6,7\n",
    "trailing sep+1.csv": "a»b\n1»2\n4»5»\n".encode(),
    "shifted.csv": "a»b\n1»2»3\n4»5»6\n".encode(),
    "dup_header.csv": b"a,a,A,,b\n1,2,3,4,5\n",
    "na_tokens.csv": b"h,i\nNA,1\nN/A,1\nnull,1\nNone,1\nnan,1\n#N/A,1\n<NA>,1\n-,1\n",
    "lead0.csv": b"z\n007\n010\n",
    "empty.csv": b"",
    "header_only.csv": b"a,b\n",
    "binary.csv": b"\x00\x01",
    "lines.csv": b'a,b\n"x\ny",2\n3,4\n',
    "quotes.csv": b'a,b\n"he said ""hi, x""",2\n',
    "blank.csv": b"a,b\n\n1,2\n  \n3,4\n",
    "[odd]{name}.csv": b"a,b\n8,9\n",
}
ROWS = {
    "std.csv": [("1", "2", "3")], "legacy.csv": [("é", "x")], "utf8_guillemet.csv": [("x", "yé")],
    "bom.csv": [("x", "1")], "euro.csv": [("1", "2")], "pipe.csv": [("1", "2")], "tabs.csv": [("1", "2")],
    "cp1252.csv": [("€“", "1")], "quoted_sep.csv": [("é", "x,y")],
    "ragged.csv": [("1", "2", None), ("5", "6", "7")], "trailing sep+1.csv": [("1", "2")], "shifted.csv": [],
    "dup_header.csv": [("1", "2", "3", "4", "5")],
    "na_tokens.csv": [(None, "1")] * 7 + [("-", "1")], "lead0.csv": [("007",), ("010",)],
    "lines.csv": [("x\ny", "2"), ("3", "4")], "quotes.csv": [('he said "hi, x"', "2")],
    "blank.csv": [("1", "2"), ("3", "4")], "[odd]{name}.csv": [("8", "9")],
}


def test_folder_of_odd_files(spark, write_files):
    records = {r.name: r for r in extract(spark, write_files(FILES))}
    assert set(records) == set(FILES)
    assert {n for n, r in records.items() if r.status == "empty"} == {"empty.csv", "header_only.csv", "binary.csv"}
    got = {n: [tuple(row) for row in r.df.collect()] for n, r in records.items() if r.status == "ok"}
    assert got == ROWS
    assert records["dup_header.csv"].df.columns == ["A", "A_1", "A_2", "COLUMN_3", "B"]
    assert records["bom.csv"].df.columns == ["NAME", "AGE"]
    encodings = {n: records[n].dialect.encoding for n in ("legacy.csv", "cp1252.csv", "utf8_guillemet.csv")}
    assert encodings == {"legacy.csv": "ISO-8859-1", "cp1252.csv": "windows-1252", "utf8_guillemet.csv": "UTF-8"}


def test_long_rows_are_dropped_whatever_is_selected(spark, write_files):
    (record,) = extract(spark, write_files({"r.csv": FILES["ragged.csv"]}))
    assert record.df.count() == 2
    assert [r.B for r in record.df.select("B").collect()] == ["2", "6"]
    assert [r.C for r in record.df.select("C").collect()] == [None, "7"]


def test_shifted_file_is_reported_empty(spark, write_files):
    (record,) = extract(spark, write_files({"s.csv": FILES["shifted.csv"]}))
    with pytest.raises(ValueError):
        clean_table(record.df, untyped=True)


def test_leading_zeros_become_numbers(spark, write_files):
    (record,) = extract(spark, write_files({"z.csv": b"z\n007\n010\n011\n"}))
    assert sorted(r.Z for r in clean_table(record.df, untyped=True)[0].collect()) == [7, 10, 11]


def test_strict_first_match(spark, write_files):
    folder = write_files({"std.csv": FILES["std.csv"]})
    row = first_match(detect_dialects(spark, folder)).first()
    assert (row.separator, row.encoding) == ("»", "ISO-8859-1")
    (record,) = extract(spark, folder, strict_first_match=True)
    assert [tuple(r) for r in record.df.collect()] == [("1,2,3",)]


def test_separator_by_agreement(spark, write_files):
    body = "".join(f"{i};{'a, b, c' if i % 2 else 'd'}\n" for i in range(50))
    row = detect_dialects(spark, write_files({"p.csv": ("id;text, more\n" + body).encode()})).first()
    assert row.separator == ";" and row.fields == 2 and row.lines == row.agreeing_lines == 51


def test_files_of_one_layout_are_one_table(spark, write_files):
    folder = write_files({"1.csv": b"a,b\n1,x\n", "2.csv": b"a,b\n2,y\n", "3.csv": b"c;d\n3;z\n"})
    records = extract_parts(spark, folder)
    assert sorted((len(r.df.columns), r.df.count()) for r in records) == [(2, 1), (2, 2)]
    rows = extraction_metrics(extract(spark, folder)).collect()
    assert {(r.file_name, r.row_count) for r in rows} == {("1.csv", 1), ("2.csv", 1), ("3.csv", 1)}


def test_type_inference(spark, write_files):
    (record,) = extract(spark, write_files({"t.csv": b"i,f,g,b,s\n1,1.5,2,True,x\n2,2,,False,3\n"}))
    assert [t for _, t in inferred(record.df).dtypes] == ["bigint", "double", "double", "boolean", "string"]


def test_fallback_is_one_column(spark, write_files):
    (record,) = extract(spark, write_files({"w.csv": b"word\nab\ncd\n"}))
    assert record.dialect == Dialect(detected=False) and record.df.count() == 2


def test_inventory_and_missing_folders(spark, write_files):
    folder = write_files({"a.csv": b"a\n1\n", "b.txt": b"x"})
    assert [(r.name, r.length) for r in file_inventory(spark, folder).collect()] == [("a.csv", 4)]
    with pytest.raises(NoInputFiles):
        require_files(spark, folder + "/missing")
    with pytest.raises(NoInputFiles):
        require_files(spark, folder, "*.json")


def test_explicit_dialect(spark, write_files):
    folder = write_files({"x.csv": b"a|b\n1|NA\n"})
    df = read_delimited(spark, f"{folder}/x.csv", Dialect("|"), na_tokens=())
    assert [tuple(r) for r in df.collect()] == [("1", "NA")]


def test_jdbc_options():
    o = jdbc_options("jdbc:x:y", query="SELECT 1")
    assert o["query"] == "SELECT 1" and "dbtable" not in o
    o = jdbc_options("jdbc:x:y", table="t", partition_column="id", lower=0, upper=10, partitions=4)
    assert o["dbtable"] == "t" and o["numPartitions"] == "4"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x:y")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x:y", table="t", partition_column="id")


def test_surplus_is_judged_by_the_readers_own_tokens(spark, write_files):
    text = 'a,b\n1,2\n5" x,6" y,extra\n"q,r",s\n"q,r",s,t\n7,8,\n9\n'
    (record,) = extract(spark, write_files({"t.csv": text.encode()}))
    rows = sorted(tuple(r) for r in record.df.na.fill("").collect())
    assert rows == [("1", "2"), ("9", ""), ("q,r", "s")]


def test_only_named_files_are_taken(spark, write_files):
    folder = write_files({"a.csv": b"x;y\n1;2\n", "b.csv": b"x,y\n3,4\n"})
    listed = [r.path for r in file_inventory(spark, folder).where("name = 'b.csv'").collect()]
    (record,) = extract(spark, folder, paths=listed)
    assert record.name == "b.csv" and record.df.collect()[0].asDict() in ({"x": "3", "y": "4"}, {"X": "3", "Y": "4"})


def test_profile_of_many_text_columns_is_code_that_the_jvm_compiles(spark, monkeypatch):
    """HotSpot interprets methods above 8000 bytes; text columns beside others give the same sums."""
    from pyspark.sql import functions as F
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    from tabprep.operators import profile

    words = ["1", " 2 ", "3.5", "True", "x", None, "12345678901234567890", "-0"]
    df = spark.range(40).repartition(3).select(
        "id",
        F.when(F.col("id") % 3 > 0, F.lit(1.5)).otherwise(F.lit(float("nan"))).alias("d"),
        *[F.element_at(F.array(*map(F.lit, words)), ((F.col("id") * (i + 1)) % len(words) + 1).cast("int")).alias(f"t`{i}") for i in range(12)],
    )
    run, texts = Classic.collect, []

    def collect(self):
        texts.append(self._jdf.queryExecution().explainString(getattr(spark._jvm.org.apache.spark.sql.execution.ExplainMode, "fromString")("codegen")))
        return run(self)

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        monkeypatch.setattr(Classic, "collect", collect)
        got = profile.profile_sums(df, untyped=True)
    finally:
        monkeypatch.undo()
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(int(n) for t in texts for n in re.findall(r"maxMethodCodeSize:(\d+)", t)) < 8000
    partials = profile.profile_partials(df.schema.fields, True)
    expected = df.agg(*[e.alias(k) for k, e in partials.items()]).first().asDict()
    assert {k: got[k] for k in expected} == expected
    assert profile.profile_sums(df.where("false"), untyped=True) == dict.fromkeys(expected, 0)
