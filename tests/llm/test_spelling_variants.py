import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tabprep.llm import spelling_variants as sv

from .conftest import EDGE

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def read(doc_id, text):
    for run in RUN.findall(text or ""):
        run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
        h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
        k = h % len(run)
        yield run[:k] + run[k + 1 :] if h % 31 == 0 else run


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    counts = Counter(w for r in rows for w in read(*r) if len(w) >= 7)
    counts = {w: n for w, n in counts.items() if n >= 2}
    out = {}
    for w, n in counts.items():
        others = [v for v in counts if near(w, v)]
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= 10 * n else None
        out[w] = (form, n, len(others), counts[form] if form else None)
    result = {}
    for w, rest in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        result[w] = (rest[0], root, *rest[1:])
    return result


def found(df):
    rows = [(r.word, (r.form, r.root, r.n, r.n_near, r.form_n)) for r in df.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


def misspelt(seed, words, alphabet, docs):
    """Texts of words of which some are very frequent, with slips of one letter, one after another."""
    r = random.Random(seed)
    base = ["".join(r.choice(alphabet) for _ in range(r.randint(6, 10))) for _ in range(words)]
    pool = []
    for k, w in enumerate(base):
        pool += [w] * (1, 3, 30, 400)[k % 4]
        for _ in range(6):
            i, c = r.randrange(len(w)), r.choice(alphabet)
            v = r.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]])
            pool += [v] * r.choice([2, 3, 35])
            i = r.randrange(len(v))
            pool += [v[:i] + c + v[i + 1 :]] * 2
    r.shuffle(pool)
    step = -(-len(pool) // docs)
    return [r.choice([" ", ", ", "-", "\n"]).join(x.title() if r.random() < 0.1 else x for x in pool[i : i + step]) for i in range(0, len(pool), step)]


@pytest.mark.parametrize("crowd", [256, 3, 1])
@pytest.mark.parametrize("seed", range(2))
def test_against_all_pairs(frame, seed, crowd):
    rows = [*enumerate(misspelt(seed, 40, "abéö" if seed else "abcdeßÿ÷", 60), 100), *EDGE]
    want = plain(rows)
    assert any(f for f, *_ in want.values()) and any(x[0] and x[0] != x[1] for x in want.values())
    assert found(sv.variants(frame(rows), crowd=crowd)) == want


def test_words_of_equal_letters(frame):
    """Many words of the same letters share all parts of them; only the places tell them apart."""
    r = random.Random(3)
    words = sorted({"".join(r.sample("abcdefgh", 8)) for _ in range(400)})
    words += [w[:3] + w[4:] for w in words[:50]] + [w[:5] + "x" + w[6:] for w in words[50:90]]
    rows = [(k, " ".join(words)) for k in range(3)]
    assert found(sv.variants(frame(rows), crowd=8)) == plain(rows)


def test_very_long_words(frame):
    long = "ab" * 40_000
    rows = [(1, f"{long} {long[:-1]}"), (2, f"{long} {long[1:]}x {long[:-1]}"), (3, f"{long[1:]}x")]
    out = found(sv.variants(frame(rows)))
    want = Counter(w for row in rows for w in read(*row))
    assert {w: x[2] for w, x in out.items()} == {w: n for w, n in want.items() if n >= 2}
    for w, x in out.items():
        assert x[3] == sum(near(w, v) for v in out)


def test_words_about_the_bound_of_long_ones(frame):
    r = random.Random(8)
    base = "".join(r.choice("abcde") for _ in range(66))
    words = [base[:63], base[:64], base[:65], base[1:65], "x" + base[1:64], base[:30] + "é" + base[31:65], base[:40] + base[41:65], base[:62], base[:20] + "q" + base[20:64]]
    rows = [(k, " ".join(words)) for k in range(3)]
    assert found(sv.variants(frame(rows))) == plain(rows)


def test_crc_side_by_side():
    r = np.random.default_rng(1)
    data = r.integers(0, 256, 4000).astype(np.uint8)
    starts = r.integers(0, 3000, 200)
    lengths = r.integers(0, 130, 200)
    seeds = r.integers(0, 1 << 32, 200).astype(np.uint32)
    want = [zlib.crc32(data[s : s + n].tobytes(), int(x)) for s, n, x in zip(starts, lengths, seeds)]
    assert sv.crc32_of(data, starts, lengths, seeds).tolist() == want


def test_near_words_share_a_part_of_their_letters():
    r = random.Random(5)
    for _ in range(300):
        w = "".join(r.choice("aabcéÿ") for _ in range(r.randint(7, 14)))
        i, c = r.randrange(len(w)), r.choice("abcdé")
        v = r.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]])
        one, other = sv.part_hashes(*sv._latin(pa.array([w, v])))
        assert (one == other).any()


def test_counts_are_passed_on_in_parts(frame, monkeypatch):
    rows = [*enumerate(misspelt(9, 30, "abcde", 50))]
    out = {r.word: r.n for r in sv.word_counts(frame(rows)).collect()}
    batches = [pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows[k : k + 5]]), pa.array([t for _, t in rows[k : k + 5]])], ["doc_id", "text"]) for k in range(0, 50, 5)]
    monkeypatch.setattr(sv, "HELD", 10)
    parts = defaultdict(int)
    emitted = list(sv._count(iter(batches)))
    for b in emitted:
        for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            parts[w] += n
    assert len(emitted) > 1 and dict(parts) == out == Counter(w for r in rows for w in read(*r) if len(w) >= 7)


def test_nothing_and_clashing_names(spark, frame):
    assert sv.variants(frame([])).collect() == []
    assert sv.variants(frame([(1, None), (2, "short words")])).collect() == []
    clash = spark.createDataFrame([(2, "variant variant", "w", 3), (None, None, "x", 4)], "doc_id int, text string, word string, n int")
    (row,) = sv.variants(clash).collect()
    assert (row.word, row.form, row.root, row.n, row.n_near, row.form_n) == ("variant", None, "variant", 2, 0, None)
