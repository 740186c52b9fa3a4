import itertools
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tabprep.llm import crf_language, mixing_lm, qda_quality, scan

from .conftest import EDGE

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def packed(texts):
    return scan.bytes_and_offsets(pa.array(texts, pa.large_string()))


# Language identification


def test_posteriors_are_those_of_all_paths():
    r = np.random.default_rng(1)
    e, steps, starts = r.normal(size=(7, 3)), r.normal(size=(3, 3)), r.normal(size=3)
    heads = np.array([1, 0, 0, 0, 1, 0, 0], bool)
    a = np.exp(steps) / np.exp(steps).sum(axis=1, keepdims=True)
    p = np.exp(starts) / np.exp(starts).sum()
    expected, pairs = np.zeros((7, 3)), np.zeros((3, 3))
    for lo, hi in ((0, 4), (4, 7)):
        total, marginal, joint = 0.0, np.zeros((hi - lo, 3)), np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=hi - lo):
            w = p[path[0]] * math.prod(a[x, y] for x, y in zip(path, path[1:])) * math.exp(sum(e[lo + i, y] for i, y in enumerate(path)))
            total += w
            for i, y in enumerate(path):
                marginal[i, y] += w
            for x, y in zip(path, path[1:]):
                joint[x, y] += w
        expected[lo:hi] = marginal / total
        pairs += joint / total
    found, both = crf_language.posteriors(e, heads, steps, starts, pairs=True)
    assert np.allclose(found, expected) and np.allclose(both, pairs)


def test_lanes_do_not_matter(monkeypatch):
    r = np.random.default_rng(2)
    e, heads = r.normal(size=(500, 4)), r.random(500) < 0.02
    heads[0] = True
    steps, starts = r.normal(size=(4, 4)), r.normal(size=4)
    whole = crf_language.posteriors(e, heads, steps, starts)
    monkeypatch.setattr(crf_language, "LANE", 3)
    assert np.allclose(crf_language.posteriors(e, heads, steps, starts), whole)


ENGLISH = "the quick brown fox jumps over this lazy dog and then there was nothing more that they would rather have than those other things"
GERMAN = "der schnelle braune fuchs springt über diesen faulen hund und dann gab es nichts mehr was sie lieber hätten als jene anderen sachen"


def mixed(text, seed, count):
    r = np.random.default_rng(seed)
    words = text.split()
    return [" ".join(words[i] for i in r.integers(0, len(words), 30)) for _ in range(count)]


@pytest.fixture(scope="module")
def field():
    texts = [*mixed(ENGLISH, 1, 40), *mixed(GERMAN, 2, 40)]
    return crf_language.fitted(texts, ["en"] * 40 + ["de"] * 40, passes=8)


def test_switched_text_is_labelled_piece_by_piece(field):
    text = " ".join([*mixed(ENGLISH, 5, 1), *mixed(GERMAN, 6, 1)])
    words = crf_language.words_of(pa.array([text]))
    heads = np.zeros(60, bool)
    heads[0] = True
    label = crf_language.posteriors(field.emissions(words, field.listing(words.hashes)), heads, field.steps, field.starts).argmax(axis=1)
    wanted = [field.languages.index("en")] * 30 + [field.languages.index("de")] * 30
    assert (label == wanted).mean() > 0.9


def test_languages_of_edge_rows(frame, field):
    rows = [(50, "THE LAZY DOG AND OTHER THINGS"), (51, "der faule hund"), (52, "12 34 !?"), *EDGE]
    docs = frame(rows).withColumnRenamed("source", "lang_pred")
    out = crf_language.identified(docs, field).collect()
    by_text = {r.text: r for r in out}
    assert by_text["THE LAZY DOG AND OTHER THINGS"].lang_pred == "en" and by_text["der faule hund"].lang_pred == "de"
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and 0 <= r.score <= 1 for r in out)
    assert {r.lang_pred for r in crf_language.identified(frame(rows), None).collect()} == {"und"}
    assert crf_language.identified(frame([]), field).collect() == []
    assert crf_language.learned(frame(EDGE)) is None


# Quality classifier


def test_scores_are_differences_of_log_densities():
    r = np.random.default_rng(3)
    x0, x1 = r.normal(size=(300, 3)) * [1, 2, 3], r.normal(size=(500, 3)) + [2, 0, 1]
    model = qda_quality.discriminant(np.array([300.0, 500.0]), np.stack([x0.sum(0), x1.sum(0)]), np.stack([x0.T @ x0, x1.T @ x1]), pooled=0.0, round_=0.0)

    def density(x, rows):
        c = np.cov(rows.T, bias=True)
        d = x - rows.mean(axis=0)
        return -0.5 * d @ np.linalg.inv(c) @ d - 0.5 * np.linalg.slogdet(c)[1]

    for x in r.normal(size=(20, 3)):
        odds = math.log(500.5 / 300.5) + (density(x, x1) - density(x, x0)) / qda_quality.TEMPERATURE
        assert math.isclose(model.scores(x[None])[0], 1 / (1 + math.exp(-odds)), rel_tol=1e-6)


def test_statistics_by_hand():
    raw, offsets = packed(["Aa bb bb\n$ É!\nAa bb bb", "", "one"])
    x = dict(zip(qda_quality.STATISTICS, qda_quality.statistics(raw, offsets)[0]))
    share = lambda a, b: math.log((a + 0.5) / (b + 1))
    assert math.isclose(x["log_words"], math.log(9)) and math.isclose(x["symbols"], share(1, 8))
    assert math.isclose(x["capitals"], share(3, 15)) and math.isclose(x["distinct_words"], share(4, 8))
    assert math.isclose(x["top_word"], share(4, 8)) and math.isclose(x["same_as_last"], share(2, 8))
    assert math.isclose(x["repeated_lines"], share(1, 3)) and math.isclose(x["repeated_pairs"], share(2, 7))
    assert np.isfinite(qda_quality.statistics(raw, offsets)).all()


def test_classifier_on_edge_rows_and_labels(spark, frame):
    docs = frame([*((100 + i, "plain words that say a thing or two " * 3) for i in range(8)), *((200 + i, "$$$ %%% ### " * (5 + i)) for i in range(8)), *EDGE])
    labels = spark.createDataFrame([*((100 + i, 1) for i in range(8)), *((200 + i, 0) for i in range(8)), (1, 0), (1, 1), (None, 1), (2, 7), (3, None)], "doc_id long, quality int")
    vectors = qda_quality.with_statistics(docs.withColumnRenamed("lang", "statistics")).cache()
    out = qda_quality.scored(vectors, qda_quality.learned(vectors, labels)).collect()
    assert len(out) == 16 + len(EDGE) and all(0 <= r.score <= 1 for r in out)
    assert all((r.score > 0.5) == (r.doc_id < 200) for r in out if r.doc_id and r.doc_id >= 100)
    none = qda_quality.learned(vectors, labels.where("false"))
    assert {r.score for r in qda_quality.scored(vectors, none).collect()} == {0.5}
    empty = qda_quality.with_statistics(frame([]))
    assert qda_quality.scored(empty, qda_quality.learned(empty, labels)).collect() == []


# Language-model scoring


def test_all_symbols_have_probability_one_together():
    pairs = np.zeros(256 * mixing_lm.SYMBOLS, np.int64)
    raw, offsets = packed(["hello world, hello"])
    pairs += np.bincount(mixing_lm.symbols(raw, offsets).pair, minlength=len(pairs))
    r = np.random.default_rng(4)
    odds = [r.integers(-40, 40, mixing_lm._SIZES[0]).astype(np.int8) for _ in range(mixing_lm.CONTEXTS)]
    mixer = mixing_lm.Mixer(mixing_lm.tree(pairs), odds, r.random((mixing_lm.GATES, mixing_lm.CONTEXTS)))
    contexts = [np.full(mixing_lm.SYMBOLS, 12345 * (k + 1), np.int32) for k in range(mixing_lm.CONTEXTS)]
    pair = ord("h") * mixing_lm.SYMBOLS + np.arange(mixing_lm.SYMBOLS)
    cost, _ = mixer._step(pair, contexts, np.arange(mixing_lm.SYMBOLS), np.repeat(mixer.weights[None], mixing_lm.SYMBOLS, axis=0))
    assert math.isclose((10.0**-cost).sum(), 1.0, rel_tol=1e-6)


def test_a_score_does_not_depend_on_its_neighbours(prose):
    texts = [*prose(5, 20, 1, 300), "", "x" * 3000]
    pairs = np.bincount(mixing_lm.symbols(*packed(texts)).pair, minlength=256 * mixing_lm.SYMBOLS)
    r = np.random.default_rng(6)
    mixer = mixing_lm.Mixer(mixing_lm.tree(pairs), [r.integers(-40, 40, mixing_lm._SIZES[0]).astype(np.int8) for _ in range(mixing_lm.CONTEXTS)], np.full((mixing_lm.GATES, mixing_lm.CONTEXTS), 0.3))
    together = mixer.scores(*packed(texts))
    assert np.allclose(together, [mixer.scores(*packed([t]))[0] for t in texts])


def test_contexts_hold_only_what_came_before():
    a, b = mixing_lm.symbols(*packed(["abcdefgh xyz"])), mixing_lm.symbols(*packed(["abcdefgh qqqqq"]))
    for x, y in zip([a.pair // mixing_lm.SYMBOLS, *a.contexts], [b.pair // mixing_lm.SYMBOLS, *b.contexts]):
        assert np.array_equal(x[:10], y[:10])
    one = mixing_lm.symbols(*packed(["abc", "abc"]))
    for x in [one.pair, *one.contexts]:
        assert np.array_equal(x[:4], x[4:])


def test_base_scores(spark, frame, prose):
    rows = [*enumerate(prose(7, 60, 1, 50), 100), *EDGE]
    train = {i for i, _ in rows if i is None or i % 3}
    docs = frame(rows).selectExpr("doc_id", "text", "case when doc_id is null then true when pmod(doc_id, 3) > 0 then true end as train")
    out = mixing_lm.language_model(docs).collect()
    low = lambda t: WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [0]
    counts = Counter(w for i, t in rows if i in train for w in low(t))
    n, v = sum(counts.values()), len(counts)
    expected = Counter((i, len(low(t)), sum(counts[w] > 0 for w in low(t)), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in low(t)), 4)) for i, t in rows)
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in out) == expected
    assert all(r.score < 0 for r in out)


def test_tables_grow_with_the_training_bytes():
    assert [mixing_lm.slot_bits(n) for n in (0, 1, 1 << 29, (1 << 29) + 512, 26 * 10**9)] == [20, 20, 20, 21, 26]
    s = mixing_lm.symbols(*packed(["some words of a text"]), bits=26)
    assert max(c.max() for c in s.contexts) >= 1 << 20


@pytest.mark.parametrize("bits", [21, 23])
def test_wide_tables_count_every_bit_once(spark, frame, prose, monkeypatch, bits):
    """Sums of sparse rows are those of arrays, and scores come from the slots of the whole table."""
    texts = [*prose(9, 40, 1, 200), "", None]
    pairs = np.bincount(mixing_lm.symbols(*packed([t or "" for t in texts])).pair, minlength=256 * mixing_lm.SYMBOLS)
    codes = mixing_lm.tree(pairs)
    monkeypatch.setattr(mixing_lm, "slot_bits", lambda trained: bits)
    docs = frame(list(enumerate(texts))).repartition(3).selectExpr("doc_id", "text", "true as train")
    mixer = mixing_lm.fitted(docs, pairs)
    assert mixer.bits == bits and all(len(o) == (1 << bits) + 256 for o in mixer.odds)
    s = mixing_lm.symbols(*packed([t or "" for t in texts]), bits=bits)
    for k, odds in enumerate(mixer.odds):
        c = np.zeros(2 * len(odds), np.int64)
        for _, _, bit, slots in mixing_lm._levels(codes, s.pair, s.contexts, s.pair):
            np.add.at(c, 2 * slots[k] + bit, 1)
        expected = np.clip(np.rint(8 * np.log((c[1::2] + 0.1) / (c[0::2] + 0.1))), -127, 127)
        assert np.array_equal(expected, odds) and (odds != 0).sum() > 1000
    out = mixing_lm.language_model(docs).collect()
    raw, offsets = packed([t or "" for t in texts])
    assert np.allclose(sorted(r.score for r in out), sorted(mixer.scores(raw, offsets)))


def test_starting_weights_come_from_every_training_row(frame, prose):
    """Many texts and one of 30,000 characters: all their bits are in the fit, each left out of its own odds."""
    texts = [*prose(12, 450, 1, 30), "ab cd " * 5000, "", None]
    raw, offsets = packed([t or "" for t in texts])
    s = mixing_lm.symbols(raw, offsets)
    pairs = np.bincount(s.pair, minlength=256 * mixing_lm.SYMBOLS)
    docs = frame(list(enumerate(texts))).repartition(3).selectExpr("doc_id", "text")
    levels = list(mixing_lm._levels(mixing_lm.tree(pairs), s.pair, s.contexts, s.pair))
    gate = np.concatenate([np.full(len(bit), min(depth, mixing_lm.GATES - 1)) for depth, _, bit, _ in levels])
    bit = np.concatenate([bit for _, _, bit, _ in levels]).astype(np.int64)
    cells = gate
    for k in range(mixing_lm.CONTEXTS):
        slot = np.concatenate([slots[k] for _, _, _, slots in levels])
        zero, one = (np.bincount(slot[bit == b], minlength=slot.max() + 1)[slot] - (bit == b) for b in (0, 1))
        cells = cells << 5 | np.searchsorted(mixing_lm._EDGES, np.log((one + 0.1) / (zero + 0.1)), "right")
    cells, n = np.unique(cells << 1 | bit, return_counts=True)
    weights = mixing_lm.fitted(docs, pairs).weights
    assert np.allclose(weights, mixing_lm._first_weights(cells, n), atol=1e-6)

    def cost(w):
        odds = mixing_lm._MIDDLES[cells[:, None] >> np.array([11, 6, 1]) & 31]
        return n @ np.logaddexp(0, (1 - 2 * (cells & 1)) * (odds * w[cells >> 16]).sum(axis=1)) + ((w - mixing_lm.PRIOR) ** 2).sum() / 2

    for change in np.eye(weights.size).reshape(-1, *weights.shape) * 0.01:
        assert cost(weights) < min(cost(weights + change), cost(weights - change))


def test_model_without_training_rows_or_documents(frame):
    docs = frame([(1, "a b"), (2, None)]).selectExpr("doc_id", "text", "false as train")
    assert {(r.doc_id, r.n_known, r.train_tokens, r.base_score) for r in mixing_lm.language_model(docs).collect()} == {(1, 0, 0, 0.0), (2, 0, 0, 0.0)}
    assert mixing_lm.language_model(docs.where("false")).collect() == []
