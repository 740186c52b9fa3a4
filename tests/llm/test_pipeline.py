import corpus_pipeline as P
from tabprep.llm import decontaminate, jaccard_join, quality_rules, secret_scan

from .conftest import EDGE
from .test_decontaminate import brute as brute_hits
from .test_jaccard_join import brute as brute_groups
from .test_jaccard_join import copies
from .test_packing import ids_of
from .test_quality_rules import brute as brute_measures

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def staged(spark, tmp_path, docs, sf_dir, count):
    """The first stages as the check runs them: each written and read again."""
    out = [docs]
    for k, (_, stage) in enumerate(P.STAGES[:count]):
        stage(spark, out[-1], sf_dir).write.parquet(f"{tmp_path}/{k}")
        out.append(spark.read.parquet(f"{tmp_path}/{k}"))
    return out


def test_stages_against_plain_versions(spark, frame, prose, tmp_path):
    items = [(i, t) for i, t in enumerate(prose(21, 6, 15, 30, words=4000))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/sf/benchmark.parquet")
    rows = copies(prose, 22, families=10, members=5)
    rows += [(900, "before " + items[0][1] + " after words"), (901, 'a token = "abcdefgh12" in a text that has ten other words at least'), (902, "$ # % words that stand among far too many symbols $ # % & $ # %")]
    rows += EDGE
    docs = frame(rows)
    raw, ruled, single, clean, masked = staged(spark, tmp_path, docs, f"{tmp_path}/sf", 4)
    texts = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)
    assert all(df.columns == COLUMNS for df in (ruled, single, clean, masked))

    kept = texts(ruled)
    measured = {t: brute_measures(t) for _, t in rows}
    assert all(n[0] >= 10 and 100 * n[4] <= 20 * n[0] and 10 * n[2] <= n[0] for n in (measured[t] for _, t in kept))
    assert 902 not in dict(kept) and {900, 901} <= {d for d, _ in kept}

    groups = brute_groups(kept, 5, 80)
    assert sorted(d for d, _ in texts(single)) == sorted({d for d, _, g in groups if d == g})

    hit = {d for d, _, h, _ in brute_hits(texts(single), items, 10) if h}
    assert 900 in hit and texts(clean) == sorted(((d, t) for d, t in texts(single) if d not in hit), key=repr)

    assert texts(masked) == sorted(((d, secret_scan.redacted(t, secret_scan.spans_of(t))) for d, t in texts(clean)), key=repr)
    assert "[SECRET]" in dict(texts(masked))[901]

    out = P.sequences(spark, masked, "").collect()
    whole = {}
    for r in sorted(out, key=lambda r: (r["doc_id"], r["piece"])):
        whole.setdefault(r["doc_id"], []).extend(r["ids"])
    assert whole == {d: ids_of(t) for d, t in texts(masked)}


def test_stages_take_edge_rows_and_empty_tables(spark, frame, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/sf/benchmark.parquet")
    for _, stage in P.STAGES[:4]:
        out = stage(spark, frame(EDGE), f"{tmp_path}/sf")
        assert out.columns == COLUMNS and out.count() <= len(EDGE)
        assert stage(spark, frame([]), f"{tmp_path}/sf").collect() == []
    assert P.sequences(spark, frame([]), "").collect() == []


def test_repeated_rows_become_one(spark, frame):
    text = "some words that are long enough to be shingled more than once here"
    out = P.deduplicated(spark, frame([(1, text), (1, text), (2, text), (3, "something quite different from all of the others in here")]), "")
    assert sorted(r.doc_id for r in out.collect()) == [1, 3]


def test_stages_are_the_five_operators():
    assert [k for k, _ in P.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "best-fit packing"]
    assert all(m.__name__.startswith("tabprep.llm.") for m in (quality_rules, jaccard_join, decontaminate, secret_scan))
