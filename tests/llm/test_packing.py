import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tabprep.llm import packing, token_counts
from tabprep.llm.tokens import Encoder, default_tokenizer

from .conftest import EDGE

ODD = ["", "hi <|endoftext|> there", "a\u0085b c  d  \t\n", "don't we'll I'm 12345 ٣٤٥ ½", "𝒳𝓎 👩‍👩‍👧 é", "\x00\x1c\x7f", "x" * 5000, " " * 3000]


def test_ids_are_the_tokenizers_own(prose):
    own, exact = Encoder(default_tokenizer()), Tokenizer.from_file(default_tokenizer())
    assert own._ranks is not None
    for text in [*ODD, *prose(1, 50), *(t or "" for _, t in EDGE)]:
        assert own.ids(text) == exact.encode(text, add_special_tokens=False).ids


def ids_of(text, exact=Tokenizer.from_file(default_tokenizer())):
    return [*exact.encode(text or "", add_special_tokens=False).ids, 2]


def test_round_trip(frame, prose):
    rows = [*enumerate([*prose(4, 300, 1, 400), *ODD], 1000), *EDGE]
    out = packing.packed(frame(rows)).collect()
    texts, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        assert len(r["ids"]) == r["length"] <= 1024
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    for r in sorted((r for r in out if r["doc_id"] is not None and r["doc_id"] >= 1000), key=lambda r: (r["doc_id"], r["piece"])):
        assert r["start"] == len(texts[r["doc_id"]])
        texts[r["doc_id"]] += r["ids"]
        assert r["piece"] == 0 or r["length"] == 1024
    assert texts == {i: ids_of(t) for i, t in rows if i is not None and i >= 1000}
    total = sum(len(ids_of(t)) for _, t in rows)
    assert sum(r["length"] for r in out) == total
    assert len(sequences) <= -(-total // 1024) * 1.01 + 1


@pytest.mark.parametrize("seed", range(4))
def test_islands_never_lose_to_best_fit(seed):
    r = random.Random(seed)
    lengths = np.array([r.choice([r.randint(1, 1023), r.randint(300, 600)]) for _ in range(400)])
    island = packing.Island(lengths, 1024, seed)
    plain = island.first(0.0)
    grown = island.evolved([], 4, 8)
    for bins in (plain, grown, island.crossed(plain, island.first(0.3)), island.shaken(grown)):
        assert len(bins) == len(lengths) and island.fills(bins).max() <= 1024 and island.fills(bins).sum() == lengths.sum()
    assert island.fitness(grown) >= island.fitness(plain)


def test_best_fit_takes_the_tightest_bin():
    assert packing.best_fit([6, 5, 4, 5], {}, 10, 0) == [0, 1, 0, 1]
    assert packing.best_fit([3], {9: [7], 3: [8], 4: [9]}, 10, 20) == [8]


def test_levels_cover_every_item(spark, frame):
    items = spark.range(3000).selectExpr("id as uid", "1 + pmod(xxhash64(id), 1024) as length")
    placed = packing.grouped(items, 1024, shard=256).join(items, "uid").groupBy("sequence_id").agg({"length": "sum", "uid": "count"}).collect()
    assert sum(r["count(uid)"] for r in placed) == 3000 and max(r["sum(length)"] for r in placed) <= 1024


def test_empty_tables(frame):
    assert packing.packed(frame([])).collect() == []
    assert token_counts.limits(token_counts.histogram(frame([]))).collect() == []


def test_token_counts(frame, prose):
    rows = [*enumerate(prose(9, 80, 0, 300), 100), *EDGE]
    lengths = [len(ids_of(t)) - 1 for _, t in rows]
    limited = token_counts.limits(token_counts.histogram(frame(rows).withColumnRenamed("lang", "n_tokens"))).cache()
    found = {r["length"]: r for r in limited.collect()}
    assert set(found) == set(lengths)
    for n, r in found.items():
        assert r["n_docs"] == lengths.count(n)
        assert r["docs_whole"] == sum(x <= n for x in lengths) and r["docs_cut"] == sum(x > n for x in lengths)
        assert r["tokens_whole"] == sum(x for x in lengths if x <= n)
        assert r["tokens_truncated"] == sum(min(x, n) for x in lengths)
        assert r["tokens_lost"] == sum(max(x - n, 0) for x in lengths)
    for limit in (0, 1, 100, 1024, 10**9):
        assert token_counts.truncated_total(limited, limit) == sum(min(x, limit) for x in lengths)
    for share in (0.1, 0.5, 1.0):
        assert token_counts.length_quantile(limited, share) == sorted(lengths)[max(0, int(np.ceil(share * len(lengths))) - 1)]
