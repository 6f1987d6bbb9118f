import random
from collections import Counter
from math import log10
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from headway.llm import elias_fano, language_model
from tests.llm.fixtures import docs_frame, words


def sequence(values, universe):
    parts = elias_fano.Sequence.encode(np.array(values, np.uint64), universe)
    return elias_fano.Sequence([a.view(np.uint8) for a in parts])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**63 - 1), max_size=200), st.lists(st.integers(0, 2**63 - 1), max_size=50), st.sampled_from([3, 7, 40, 63]))
def test_sequence_finds_successors(values, probes, bits):
    values = sorted(v >> (63 - bits) for v in values)
    probes = np.array([p >> (63 - bits) for p in probes] + values, np.uint64)
    s = sequence(values, 1 << bits)
    assert s.get(np.arange(len(values))).tolist() == values if values else True
    assert s.successor(probes).tolist() == np.searchsorted(np.array(values, np.uint64), probes).tolist()
    assert ((s.find(probes) >= 0) == np.isin(probes, np.array(values, np.uint64))).all()


def test_long_runs_of_ones_and_zeros():
    values = [5] * 10_000 + [1 << 30] * 10_000 + [(1 << 40) - 1]
    s = sequence(values, 1 << 40)
    assert s.get(np.arange(len(values))).tolist() == values
    assert s.successor(np.array([0, 5, 6, 1 << 30, (1 << 30) + 1, (1 << 40) - 1], np.uint64)).tolist() == [0, 0, 10_000, 10_000, 20_000, 20_000]


def test_successors_are_looked_for_among_a_nodes_own():
    s = sequence([3, 4, 9, 9, 12], 16)
    assert s.successor(np.array([9, 9, 1, 13]), np.array([0, 3, 2, 1]), np.array([2, 5, 4, 3])).tolist() == [2, 3, 2, 3]


def test_trie_holds_exactly_its_triples():
    rnd = np.random.default_rng(0)
    grams = np.unique(rnd.integers(0, 14, (900, 3)), axis=0)
    with elias_fano.Mapped(list(grams.T), np.arange(len(grams))) as trie:
        asked = np.stack(np.meshgrid(*[np.arange(16)] * 3), -1).reshape(-1, 3)
        at = np.zeros(len(asked), np.int64)
        for k in range(3):
            at = trie.descend(k, at, asked[:, k])
        held = {tuple(g): i for i, g in enumerate(grams.tolist())}
        assert at.tolist() == [held.get(tuple(g), -1) for g in asked.tolist()]
        assert trie.codes.tolist() == list(range(len(grams)))


def corpus():
    rnd = random.Random(11)
    vocab = [f"w{i}" for i in range(50)] + ["É", "The", "the"]
    follow = {w: rnd.sample(vocab, 4) for w in vocab}
    rows = []
    for i in range(160):
        w = [rnd.choice(vocab)]
        for _ in range(rnd.randint(0, 60)):
            w.append(rnd.choice(follow[w[-1]]) if rnd.random() < 0.8 else rnd.choice(vocab))
        rows.append((i, " \n".join(w)))
    return rows + [(900, None), (901, ""), (902, "neverseen " * 3), (903, "x " * 5000), (950, "again"), (950, "again"), (None, "no id")]


def brute(rows):
    split = lambda t: [*words(t), None]
    held = lambda d: crc32(b"" if d is None else str(d).encode()) % 10 == 0
    train = [split(t) for d, t in rows if not held(d)]
    c = Counter(w for t in train for w in t)
    n, v = sum(c.values()), len(c)
    pairs = Counter(p for t in train for p in zip([None, *t], t))
    triples = Counter(p for t in train for p in zip([None, *t], t, t[1:]))
    discount = lambda x: sum(k == 1 for k in x.values()) / sum(k * (k < 3) for k in x.values())
    d2, d3 = discount(pairs), discount(triples)
    k2, k3 = Counter(a for a, _ in pairs), Counter(x[:2] for x in triples)
    p1 = lambda w: (c[w] + 0.1) / (n + 0.1 * (v + 1))
    p2 = lambda a, w: (max(0, pairs[a, w] - d2) + d2 * k2[a] * p1(w)) / c[a] if c[a] else p1(w)
    p3 = lambda a, b, w: (max(0, triples[a, b, w] - d3) + d3 * k3[a, b] * p2(b, w)) / pairs[a, b] if pairs[a, b] else p2(b, w)
    assert sum(p3("w1", "w2", w) for w in [*c, "another"]) == pytest.approx(1)
    out = {}
    for d, t in rows:
        w = split(t)
        score = log10(p2(None, w[0])) + sum(log10(p3(*x)) for x in zip([None, *w], w, w[1:]))
        out[d, t] = (held(d), len(w), sum(c[x] > 0 for x in w), n, sum(log10(p1(x)) for x in w), score)
    return out


@pytest.mark.parametrize("block,shard", [(1_000_000, 2_000_000), (700, 900), (3000, 100)])
def test_against_brute_force(spark, block, shard):
    rows = corpus()
    want = brute(rows)
    out = language_model.score(docs_frame(spark, rows), block, shard, slices=1).collect()
    assert len(out) == len(rows)
    texts = {d: t for d, t in rows}
    for r in out:
        h, n, known, total, base, score = want[r.doc_id, texts[r.doc_id]]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert abs(r.score - score) < 0.0021 * n
    held = [r for r in out if r.held_out and r.n_tokens > 5 and r.doc_id is not None and r.doc_id < 900]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("block,shard", [(language_model.BLOCK, language_model.SHARD), (700, 900)])
def test_all_triples_set_the_discount(spark, block, shard):
    rows = [(d, t) for d, t in corpus() if d is not None and d < 900]
    want = brute(rows)
    for r in language_model.score(docs_frame(spark, rows), block, shard).collect():
        assert r.score == pytest.approx(want[r.doc_id, dict(rows)[r.doc_id]][-1], rel=1e-9)


def test_texts_that_occur_twice_score_apart(spark):
    rnd = random.Random(3)
    vocab = [f"v{i}" for i in range(3000)]
    texts = [" ".join(rnd.choices(vocab, k=40)) for _ in range(300)]
    rows = list(enumerate([*texts, *texts[:30]]))
    out = {r.doc_id: r.score / r.n_tokens for r in language_model.score(docs_frame(spark, rows)).collect() if not r.held_out}
    twice, once = [out[i] for i in range(30) if i in out and i + 300 in out], [out[i] for i in range(30, 300) if i in out]
    assert min(twice) > max(once)


def test_frequent_contexts_are_dealt_out():
    n = 10_000
    block = language_model.Block.__new__(language_model.Block)
    block.gid = np.arange(n, dtype=np.uint64)
    shards = {}
    for seen in (500, 1):
        g = language_model.Grams(block, None, None, np.full(n, 77, np.uint64), np.full(n, seen), np.zeros(n, np.int64), np.arange(n))
        g.deal(1000, 50)
        shards[seen] = np.count_nonzero(np.diff(g.edge))
    assert shards[500] > 25 and shards[1] == 1


def test_no_training_rows_and_empty(spark):
    assert language_model.score(docs_frame(spark, [])).collect() == []
    held = next(i for i in range(100) if crc32(str(i).encode()) % 10 == 0)
    (r,) = language_model.score(docs_frame(spark, [(held, "a b")])).collect()
    assert (r.n_known, r.train_tokens, r.n_tokens) == (0, 0, 3) and r.base_score == pytest.approx(0)
