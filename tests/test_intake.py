import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tabprep.operators.tables import TableStore
from tabprep.plans.pipeline import process_new, run_pipeline
from tabprep.sinks.base import LoadLedger
from tabprep.sinks.catalog import RelationalSink, TableSink
from tabprep.sources.dialect import Dialect, detect_dialects
from tabprep.sources.files import FileSystem
from tabprep.streaming.intake import DEFAULT_INTERVAL, FileCursor, FileIntake, batch_summary, new_files


def listing(spark, *names):
    return spark.createDataFrame([(n, n, f"t{len(n)}") for n in names], "path string, name string, modified string")


def paths(df):
    return sorted(r.path for r in df.collect())


def test_cursor_forgets_and_resets(spark, tmp_path):
    cursor = FileCursor(TableStore(spark, str(tmp_path)), "cursor_t")
    assert paths(cursor.pending(listing(spark, "1", "2"))) == ["1", "2"]
    cursor.advance(listing(spark, "1", "2"))
    assert paths(cursor.pending(listing(spark, "2", "3"))) == ["3"]
    cursor.advance(listing(spark, "2", "3"))
    assert paths(cursor.pending(listing(spark, "1", "2", "3"))) == ["1"]
    assert cursor.reset()
    assert paths(cursor.pending(listing(spark, "2"))) == ["2"]


def test_modified_files(spark):
    seen = listing(spark, "a", "b")
    now = seen.withColumn("modified", F.when(F.col("path") == "b", "later").otherwise(F.col("modified")))
    assert paths(new_files(now, seen)) == []
    assert paths(new_files(now, seen, modified="modified")) == ["b"]


def test_summary(spark):
    row = batch_summary(listing(spark, "b.csv", "a.csv", "a.csv")).first()
    assert (row.file_count, row.new_files) == (2, "a.csv,b.csv")


def test_stream_takes_each_file_once(spark, write_files, tmp_path_factory):
    folder = write_files({"a.csv": b"k;v\n1;x\n2;y\n3;z;long\n"})
    work = str(tmp_path_factory.mktemp("work"))
    intake = FileIntake(spark, folder, ["k", "v"], work, Dialect(";"))
    intake.run_once()
    assert sorted(r.K for r in intake.landed().collect()) == ["1", "2"]
    write_files({"b c.csv": b"k;v\n4;NA\n5;w\n6;q\n"})
    intake.run_once()
    intake.run_once()
    assert sorted((r.K, r.V) for r in intake.landed().collect() if r.V) == [
        ("1", "x"), ("2", "y"), ("5", "w"), ("6", "q")]
    assert {(r.batch_id, r.name) for r in intake.batches().collect()} == {(0, "a.csv"), (1, "b c.csv")}
    out, plan = intake.clean()
    assert out.count() == 4 and out.columns == ["K", "V"]  # row 4 holds no text
    pinned, _ = intake.clean(plan=plan)
    assert pinned.exceptAll(out).isEmpty()
    again = FileIntake(spark, folder, ["k", "v"], work, Dialect(";"), run="again")
    again.run_once()
    assert again.landed().count() == 5


def test_another_header_stops_the_stream(spark, write_files, tmp_path_factory):
    folder = write_files({"a.csv": b"k;v\n1;x\n", "b.csv": b"v;k\ny;2\n"})
    intake = FileIntake(spark, folder, ["k", "v"], str(tmp_path_factory.mktemp("work")), Dialect(";"))
    with pytest.raises(Exception, match="HeaderMismatch"):
        intake.run_once()


def test_new_files_are_loaded_with_their_own_headers(spark, write_files, tmp_path_factory):
    work = tmp_path_factory.mktemp("targets")
    rows = "\n".join(f"{i};n{i};{i * 2}" for i in range(5))
    folder = write_files({"a.csv": f"k;name;n\n{rows}\n".encode()})
    store = TableStore(spark, str(work / "tables"))
    sink, cursor = TableSink(store, name_prefix="own_"), FileCursor(TableStore(spark, str(work / "cursor")), "own_cursor")
    assert process_new(spark, folder, cursor, [sink]).loads[0].row_count == 5
    write_files({"b.csv": b"n,name,k\n10,p,1\n11,q,2\n12,r,3\n"})
    second = process_new(spark, folder, cursor, [sink])
    assert [r.name for r in second.records] == ["b.csv"] and process_new(spark, folder, cursor, [sink]) is None
    (target,) = [r.target for r in second.loads]
    assert sorted((r.K, r.N) for r in store.table(target).collect()) == [(1, 10), (2, 11), (3, 12)]


def test_default_interval():
    assert DEFAULT_INTERVAL == "10 seconds"


def test_a_refused_batch_never_lands(spark, write_files, tmp_path_factory):
    folder = write_files({"a.csv": b"k;v\n1;x\n2;y\n"})
    work = str(tmp_path_factory.mktemp("work"))
    intake = FileIntake(spark, folder, ["k", "v"], work, Dialect(";"))
    intake.run_once()
    write_files({"b.csv": b"v;k\nz;3\n"})
    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            intake.run_once()
        assert sorted(r.K for r in intake.landed().collect()) == ["1", "2"]
    skipping = FileIntake(spark, folder, ["k", "v"], work, Dialect(";"), on_mismatch="skip")
    skipping.run_once()
    write_files({"c.csv": b"k;v\n4;w\n"})
    skipping.run_once()
    assert sorted(r.K for r in skipping.landed().collect()) == ["1", "2", "4"]
    assert [(r.name, r.header) for r in skipping.refused().collect()] == [("b.csv", "v,k")]
    assert {r.name for r in skipping.batches().collect()} == {"a.csv", "c.csv"}


def test_headers_of_other_encodings_are_checked(spark, write_files, tmp_path_factory):
    folder = write_files({"a.csv": "schlüssel;v\n1;ä\n".encode("latin-1"), "b.csv": "v;schlüssel\n2;ä\n".encode("latin-1")})
    intake = FileIntake(spark, folder, ["schlüssel", "v"], str(tmp_path_factory.mktemp("work")), Dialect(";", "ISO-8859-1"), on_mismatch="skip")
    intake.run_once()
    assert [tuple(r) for r in intake.landed().collect()] == [("1", "ä")]


class Lost(RuntimeError):
    pass


@pytest.mark.parametrize("lost_at", range(1, 8))
def test_append_once_wherever_the_driver_is_lost(spark, tmp_path, monkeypatch, lost_at):
    """Every step of the file system may be the last one; the load tried again gives each row once."""
    store, name = TableStore(spark, str(tmp_path)), f"once_{lost_at}"
    store.replace(name, spark.createDataFrame([(1, "a")], "k long, v string"))
    load = spark.range(2, 8).selectExpr("id as k", "'b' as v", "id * 2 as w").repartition(3)
    steps = 0
    real = {n: getattr(FileSystem, n) for n in ("write_text", "rename", "delete")}

    def counted(which):
        def step(self, *args):
            nonlocal steps
            steps += 1
            if steps == lost_at:
                raise Lost
            return real[which](self, *args)

        return step

    for which in real:
        monkeypatch.setattr(FileSystem, which, counted(which))
    try:
        assert store.append_once(name, load, "key") == (6, True)
    except Lost:
        assert store.append_once(name, load, "key") in ((6, True), (6, False))
    assert store.append_once(name, load, "key") == (6, False)
    assert sorted(r.k for r in store.table(name).collect()) == list(range(1, 8))
    assert store.append_once(name, load, "other")[1] and store.table(name).count() == 13


def test_a_ledger_skips_what_is_loaded(spark, write_files, tmp_path_factory):
    folder = write_files({"a.csv": b"k;v\n1;x y\n2;y z\n3;z x\n", "b.csv": b"k;v\n1;x y\n2;y z\n3;z x\n"})
    root = str(tmp_path_factory.mktemp("tables"))
    store, ledger = TableStore(spark, root), LoadLedger(spark, f"{root}/ledger")
    sink = RelationalSink(store, "append", name_prefix="led_")

    def run():
        return sorted((r.source, r.action) for r in run_pipeline(spark, folder, [sink], ledger=ledger, batch="7").loads)

    assert run() == [("a.csv", "created"), ("b.csv", "created")]
    assert run() == [("a.csv", "skipped"), ("b.csv", "skipped")]
    write_files({"b.csv": b"k;v\n4;x y\n5;y z\n6;z x\n7;q q\n"})
    assert run() == [("a.csv", "skipped"), ("b.csv", "appended")]
    assert {(r.source, r.batch, r.row_count) for r in ledger.entries().collect()} == {("a.csv", "7", 3), ("b.csv", "7", 3), ("b.csv", "7", 4)}
    assert store.table("led_a_transformed").count() == 3 and store.table("led_b_transformed").count() == 7


def test_content_is_told_by_lines_not_by_their_order(spark, write_files):
    folder = write_files({
        "a.csv": b"k;v\n1;x\n2;y\n", "same.csv": b"k;v\n2;y\n1;x\n", "edited.csv": b"k;v\n1;x\n2;z\n",
        "longer.csv": b"k;v\n1;x\n2;y\n2;y\n", "head.csv": b"1;x\nk;v\n2;y\n",
    })
    content = {r.name: r.content for r in detect_dialects(spark, folder).collect()}
    assert content["a.csv"] == content["same.csv"] and len(set(content.values())) == 4
