import re
import unicodedata

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabprep.functions import names, numeric, strings

TEXT = [
    (" José  Ñandú", "JOSE NANDU"), ("Straße", "STRASSE"), ("A & B", "A  B"), ("ﬁn²", "FIN2"),
    ("$$$", "NA"), ("中文", "NA"), ("& &", "NA"), ("n/a", "N/A"), (None, "NA"), ("null", "NA"),
    ("-", "-"), ("é\tx", "E X"), ("ı", "I"), ("# x #", " X "), ("\xa0z", "Z"), ("\x1cq", "Q"),
    ("wait… ½ ™", "WAIT... 12 TM"), ("  x  #  ", "X "), ("nan", "NA"), ("None", "NA"), ("NANCY", "NANCY"),
]


def reference_text(value: str) -> str:
    value = re.sub(r"\s+", " ", value.strip())
    value = unicodedata.normalize("NFKD", value).upper()
    value = re.sub(r"[^A-Z0-9@/\s.\-_]", "", value)
    return "NA" if value in ("NAN", "NONE", "NULL", "", " ") else value


def cleaned(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", strings.clean_text(F.col("v")).alias("c")).orderBy("i").collect()
    return [r.c for r in rows]


def test_text_vectors(spark):
    assert cleaned(spark, [v for v, _ in TEXT]) == [w for _, w in TEXT]


def test_every_code_point(spark):
    """All of Unicode, alone and between letters, against the definition of the steps."""
    chars = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    frame = pd.DataFrame(
        {
            "alone": chars,
            "inside": ["x" + c + "y" for c in chars],
            "want_alone": [reference_text(c) for c in chars],
            "want_inside": [reference_text("x" + c + "y") for c in chars],
        }
    )
    df = spark.createDataFrame(frame)
    wrong = df.where(
        (strings.clean_text(F.col("alone")) != F.col("want_alone"))
        | (strings.clean_text(F.col("inside")) != F.col("want_inside"))
    )
    assert wrong.count() == 0


def test_random_text(spark):
    collected = []

    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet=st.characters(exclude_categories=("Cs",), exclude_characters="\x00"), max_size=40))
    def gather(value):
        collected.append(value)

    gather()
    assert cleaned(spark, collected) == [reference_text(v) for v in collected]


def test_surely_not_missing_never_lies(spark):
    values = [v for v, _ in TEXT] + ["NA", "na", "NoNe", "x", "0", "ñ", "nul", "nullx"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    wrong = df.where(strings.surely_not_missing(F.col("v")) & (strings.clean_text(F.col("v")) == "NA"))
    assert wrong.count() == 0


def test_keep_chars(spark):
    df = spark.createDataFrame([("a:b, c",)], "v string")
    assert df.select(strings.clean_text(F.col("v"), keep_chars=":")).first()[0] == "A:B C"


def test_float_text(spark):
    values = [12.0, 1e7, 1.5e7, 1e16, 1.234e-4, 1.5e-5, 0.0, -0.0, 123456789.125, -3.25e20, 1e100, 0.001, float("inf")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r.t for r in df.select("i", strings.float_text(F.col("v")).alias("t")).orderBy("i").collect()]
    assert got == [str(v) for v in values]


def test_numeric_vectors(spark):
    good = {"1": 1.0, " 2 ": 2.0, "1e3": 1000.0, "+3": 3.0, "inf": float("inf"), "-INF": float("-inf"),
            "1.": 1.0, ".5": 0.5, "\t7": 7.0}
    bad = ["0x10", "1_000", "1,000", "1d", "5f", "", None, "True", "nan", "1e", " inf", "1 2", "--1", "i"]
    df = spark.createDataFrame([(v,) for v in [*good, *bad]], "v string")
    rows = df.select("v", numeric.text_to_double(F.col("v")).alias("d")).collect()
    assert {r.v: r.d for r in rows if r.d is not None} == good


def test_integers(spark):
    rows = spark.createDataFrame(
        [("007",), ("9223372036854775807",), ("9223372036854775808",), ("1.0",), ("x",)], "v string"
    ).select(numeric.text_to_long(F.col("v")).alias("n")).collect()
    assert [r.n for r in rows] == [7, 9223372036854775807, None, None, None]


def test_column_names():
    assert names.normalize_columns(["name", "", "name", None, "age"]) == [
        "NAME", "COLUMN_1", "NAME_1", "COLUMN_3", "AGE"]
    assert names.normalize_columns(["a", "A", "a_1"]) == ["A", "A_1", "A_1_1"]
    assert names.normalize_columns(["a", "a", "A", "", "b"]) == ["A", "A_1", "A_2", "COLUMN_3", "B"]


@given(st.lists(st.one_of(st.none(), st.sampled_from(["a", "A", "a_1", "a_2", "", " ", "column_1", "é"]))))
def test_column_names_are_unique(raw):
    out = names.normalize_columns(raw)
    assert len(out) == len(raw) == len(set(out))


def test_file_and_table_names(spark):
    cases = {
        "002_report_transformed.csv": "tbl_002_report_transformed", "my-data.csv": "my_data",
        "Ñandú straße.csv": "nandu_strasse", "a.b.csv": "a_b", "noext": "noext",
    }
    assert {f: names.table_name(f) for f in cases} == cases
    assert names.table_name("002_x.csv", "col_") == "col_002_x"
    rows = spark.createDataFrame([(f,) for f in cases], "f string").select(
        "f", names.table_name_column(F.col("f")).alias("t"), names.output_name_column(F.col("f")).alias("o")
    ).collect()
    assert {r.f: r.t for r in rows} == cases
    assert {r.f: r.o for r in rows} == {f: names.output_name(f) for f in cases}
    assert names.output_name("a.b.csv") == "a.b_transformed.csv"


def test_name_collisions():
    files = ["a-b.csv", "a_b.csv"]
    with pytest.raises(names.NameCollision):
        names.table_names(files)
    assert names.table_names(files, on_collision="suffix") == {"a-b.csv": "a_b", "a_b.csv": "a_b_1"}
    assert set(names.table_names(files, on_collision="replace").values()) == {"a_b"}
