"""The registered queries over whole tables: against SQL where there is one, else their contracts."""

import math
import zlib

import duckdb
import pytest

from tabprep.llm import queries

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SMALL)
    result = duck.execute(queries.ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def held(doc_id, fold, of):
    return zlib.crc32(str(doc_id).encode()) % of == fold


def test_languages(spark, duck):
    lang = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    out = queries.op2_language_id(spark, SMALL).collect()
    assert {r.doc_id for r in out} == set(lang) and all(r.held_out == held(r.doc_id, 0, 5) for r in out)
    apart = [r for r in out if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in apart) >= 0.95 * len(apart)


def test_quality(spark, duck):
    label = dict(duck.execute("SELECT doc_id, quality FROM labels").fetchall())
    out = queries.op6_quality_classifier(spark, "/root/testdata/sf0.01").collect()
    label = dict(duck.execute("SELECT doc_id, quality FROM read_parquet('/root/testdata/sf0.01/labels.parquet')").fetchall())
    assert all(r.held_out == held(r.doc_id, 2, 4) and r.predicted == (r.score >= 0.7) for r in out)
    apart = [r for r in out if r.held_out and r.doc_id in label]
    assert sum(r.predicted == label[r.doc_id] for r in apart) >= 0.95 * len(apart)


def test_scores(spark, duck):
    size = dict(duck.execute("SELECT doc_id, strlen(text) FROM documents").fetchall())
    out = queries.op7_lm_scoring(spark, SMALL).collect()
    assert all(r.held_out == held(r.doc_id, 2, 7) and math.isclose(r.bits_per_byte, -r.score * math.log2(10) / size[r.doc_id]) for r in out)
    assert sum(-r.score * math.log2(10) for r in out) < 3.2 * sum(size.values())


def test_secrets_and_packing_cover_every_document(spark, duck):
    ids = sorted(r[0] for r in duck.execute("SELECT doc_id FROM documents").fetchall())
    assert sorted(r.doc_id for r in queries.op5_secret_scans(spark, SMALL).collect()) == ids
    assert sorted(r.doc_id for r in queries.op3_best_fit_packing(spark, SMALL).where("piece = 0").collect()) == ids


def test_token_limits(spark, duck):
    total = duck.execute("SELECT count(*) FROM documents").fetchone()[0]
    out = queries.op4_token_counts(spark, SMALL).orderBy("length").collect()
    assert sum(r.n_docs for r in out) == total == out[-1].docs_whole and out[-1].tokens_lost == 0


def test_ordered_packing_covers_every_token(spark, duck):
    from .test_ordered_packing import checked

    rows = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    waste, total = checked(queries.op13_ordered_packing(spark, SMALL).collect(), rows)
    assert waste < 0.02 * total
