import random
from dataclasses import replace
from functools import reduce

import pytest
from pyspark.sql import DataFrame

from tabprep.operators.additive import AdditivePlan
from tabprep.operators.clean import CleanConfig, EmptyTable, fit_plan
from tabprep.sources.dialect import Dialect
from tabprep.streaming.intake import FileIntake

COLUMNS = ["id", "word", "copy", "flag", "late", "mixed", "empty"]
SCHEMA = ", ".join(f"{c} string" for c in COLUMNS)


def batch(seed, n, late="x", mixed=None, flags="YN"):
    r = random.Random(seed)
    rows = []
    for k in range(n):
        word = r.choice(["Ab", "c d", None, " null ", "é"])
        rows.append((str(seed * 1000 + k), word, word, r.choice(flags), late, mixed or str(r.random()), None))
    return rows


CASES = {
    "plain": [batch(1, 40), batch(2, 30), batch(3, 1)],
    "copies part": [batch(1, 30), [(*x[:2], "other", *x[3:]) for x in batch(2, 30)]],
    "late values": [batch(1, 30, late="x"), batch(2, 30, late="y"), batch(3, 30, late="z")],
    "class changes": [batch(1, 10), batch(2, 60, mixed="text"), batch(3, 5)],
    "empty batches": [[], batch(1, 20), [], [(None,) * 7] * 4],
    "flags differ": [batch(1, 30, flags="Y"), batch(2, 30, flags="N"), batch(3, 30, flags="Y")],
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_merged_plan_is_that_of_all_rows(spark, tmp_path, case):
    states = AdditivePlan(spark, str(tmp_path / "states"), COLUMNS)
    frames = {f"b{i}": spark.createDataFrame(rows, SCHEMA).coalesce(1) for i, rows in enumerate(CASES[case])}
    total, earlier = reduce(DataFrame.unionByName, frames.values()), None
    for upto in (len(frames) - 1, len(frames)):
        seen = sorted(frames)[:upto]
        plan, reads = states.plan(seen, frames.__getitem__, total.schema)
        assert reads == (seen if earlier is None or plan.rules != earlier.rules else seen[-1:])
        earlier = plan
    want = fit_plan(total, untyped=True)
    assert plan == replace(want, config=plan.config) and plan.config == want.config
    assert states.plan(seen, frames.__getitem__, total.schema) == (plan, [])


def test_nothing_landed(spark, tmp_path):
    with pytest.raises(EmptyTable):
        AdditivePlan(spark, str(tmp_path), COLUMNS).plan([], None, spark.createDataFrame([], SCHEMA).schema)


def test_a_stream_cleans_by_merged_plans(spark, write_files, tmp_path_factory):
    work = str(tmp_path_factory.mktemp("work"))
    files = {}
    for k in range(3):
        lines = [f"{k * 10 + i};w{i % 4};{i % 2};same" for i in range(12)]
        files[f"f{k}.csv"] = ("\n".join(["a;b;c;d", *lines]) + "\n").encode()
    folder = write_files({"f0.csv": files["f0.csv"]})
    intake = FileIntake(spark, folder, ["a", "b", "c", "d"], work, Dialect(";"))
    for k in (0, 2):
        write_files({f"f{k}.csv": files[f"f{k}.csv"]})
        intake.run_once()
        out, plan = intake.clean(additive=True)
        want, wanted = intake.clean()
        assert plan == wanted and sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))
        assert intake.merged_plan()[1] == []
    assert plan.kept == ("A", "B") and intake.clean(CleanConfig(min_distinct=1), additive=False)[1].kept == ("A", "B", "C", "D")
