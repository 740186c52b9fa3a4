import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tabprep.llm import ordered_packing as op
from tabprep.llm.tokens import default_tokenizer, encoder

from .conftest import EDGE


def ids_of(text, exact=Tokenizer.from_file(default_tokenizer())):
    return [*exact.encode(text or "", add_special_tokens=False).ids, 0]


def plain(places, cost, capacity):
    """The least total cost by trying every earlier cut."""
    best = [0] + [None] * (len(places) - 1)
    for j in range(1, len(places)):
        best[j] = min(
            best[i] + (cost[i] if i else 0) + op.padding(places[j] - places[i], capacity)
            for i in range(j) if places[j] - places[i] <= capacity
        )
    return best[-1]


@pytest.mark.parametrize("seed", range(60))
def test_cuts_cost_the_least(seed):
    r = random.Random(seed)
    capacity = r.choice([4, 8, 16, 64])
    places = np.cumsum([r.randint(0, 9), *(r.randint(1, r.choice([2, capacity])) for _ in range(r.randint(1, 80)))])
    cost = np.array([r.choice([0, 0, 1, 4, 20]) for _ in places])
    path, total = op.cheapest_cuts(places, cost, capacity)
    assert path[0] == 0 and path[-1] == len(places) - 1 and path == sorted(set(path))
    lengths = np.diff(places[path])
    assert lengths.max() <= capacity
    assert total == sum(op.padding(int(n), capacity) for n in lengths) + sum(int(cost[i]) for i in path[1:-1])
    assert total == plain(places.tolist(), cost.tolist(), capacity)


def test_padding_spares_powers_of_two():
    assert [op.padding(n, 1024) for n in (1, 2, 3, 512, 1000, 1024)] == [0, 0, 1021, 0, 24, 0]


def checked(out, rows, capacity=1024):
    """All that the contract says of the pieces; returns the padding and the number of tokens."""
    texts, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
        texts[r.doc_id].append(r)
    assert set(texts) == {i for i, _ in rows}
    for doc_id, want in rows:
        pieces = sorted(texts[doc_id], key=lambda r: r.start)
        if sum(i == doc_id for i, _ in rows) > 1:
            continue
        ids, at = np.array(ids_of(want), "<u4"), 0
        for p in pieces:
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    waste = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        waste += op.padding(at, capacity)
    total = sum(len(ids_of(t)) for _, t in rows)
    assert sum(r.length for r in out) == total
    return waste, total


def sentences(prose, seed, docs, words=20):
    r = random.Random(seed)
    return [" ".join(x.capitalize() + r.choice([".", "!", ".\n"]) for x in prose(seed + k, r.randint(1, 40), 2, words)) for k in range(docs)]


@pytest.mark.parametrize("segment", [1 << 18, 4096])
def test_round_trip(frame, prose, segment):
    rows = [*enumerate([*sentences(prose, 3, 200), "a <|endoftext|> b. c", "一。二！三？" * 2000, "no end " * 3000], 1000), *EDGE]
    out = op.packed(frame(rows), segment=segment).collect()
    waste, total = checked(out, rows)
    assert waste < 0.03 * total


def test_little_padding_and_sentences_whole(frame, prose):
    rows = [*enumerate(sentences(prose, 50, 300, 6))]
    out = op.packed(frame(rows).coalesce(1)).collect()
    waste, total = checked(out, rows)
    assert waste < 0.005 * total
    exact, inside = encoder(default_tokenizer()), 0
    for r in out:
        if r.start:
            text = rows[r.doc_id][1]
            head = Tokenizer.from_file(default_tokenizer()).decode(exact.ids(text)[: r.start], skip_special_tokens=False)
            inside += head.rstrip()[-1:] not in ".!?"
    assert inside <= 10  # only where the last windows of the partition are split into powers of two


def test_order_is_kept(frame, prose):
    rows = [*enumerate(sentences(prose, 7, 120))]
    out = op.packed(frame(rows).coalesce(1)).collect()
    order = sorted(out, key=lambda r: (r.sequence_id, r.offset))
    assert [(r.doc_id, r.start) for r in order] == sorted((r.doc_id, r.start) for r in out)


def test_long_texts_are_encoded_in_pieces(monkeypatch, prose):
    monkeypatch.setattr(op, "PIECE_CHARS", 200)
    path = default_tokenizer()
    for text in [*sentences(prose, 11, 5), "x" * 5000, "a  b   c \n d " * 300, "don't 12 34 we'll ,. " * 90]:
        parts = [p for p in op._encoded(path, 0, [(1, text)])]
        assert [p[3] for p in parts] == [False] * (len(parts) - 1) + [True]
        assert np.concatenate([p[1] for p in parts]).tolist() == ids_of(text)
    assert len(parts) > 2


def test_pieces_wait_for_the_end_of_their_document():
    windows = op.Windows(8, 0, segment=32)
    for k in range(40):
        windows.add(5, np.arange(k, k + 7, dtype=np.int32), np.array([3]), k == 39)
    assert windows.length <= 32 + 7 + 8 * (op.KEPT_WINDOWS + 1)
    windows.finish()
    rows = windows.ready()
    assert {r[4] for r in rows} == {280} and sum(r[2] for r in rows) == 280


def test_empty_and_clashing(spark, frame):
    assert op.packed(frame([])).collect() == []
    clash = spark.createDataFrame([(1, "One. Two.", 5, "x")], "doc_id int, text string, start int, sequence_id string")
    out = op.packed(clash).collect()
    assert {r.doc_tokens for r in out} == {len(ids_of("One. Two."))} == {sum(r.length for r in out)}
    assert out[0].start == 0 and op.packed(clash).dtypes == [(n, "bigint") for n in out[0].__fields__]
