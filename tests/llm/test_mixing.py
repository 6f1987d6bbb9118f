import random

import pytest

from headway.llm import mixing
from tests.llm.fixtures import docs_frame, words


def brute_targets(sizes, weights=(1, 2, 3)):
    """{source: target}: reshared round by round."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in stopped]
        rest = total - sum(stopped.values())
        t = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if t[s] > 3 * sizes[s] + 1e-9]
        if not over:
            return stopped | t
        stopped |= {s: 3.0 * sizes[s] for s in over}


def rows():
    rnd = random.Random(2)
    out = [(i, " ".join("w" for _ in range(rnd.randint(0, 300))), rnd.choice(["a", "b", "é", "z", None])) for i in range(300)]
    return out + [(900, "x " * 40_000, "big"), (901, "tiny one", "m"), (902, None, "empty"), (903, "", "a"), (5, "again again", "b"), (5, "again again", "b"), (None, "no id here", "b")]


def test_against_brute_force(spark):
    docs = docs_frame(spark, rows())
    out = mixing.mix(docs, block=64).collect()
    assert len(out) == len(rows())
    sizes, taken = {}, {}
    for d, t, s in rows():
        sizes[s] = sizes.get(s, 0) + len(words(t))
    want = brute_targets(sizes)
    for r in out:
        assert 0 <= r.taken <= 3 * r.size and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-9)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in sizes:
        assert taken[s] == int(want[s] + 1e-9) or abs(taken[s] - want[s]) <= 1
    again = mixing.mix(docs.repartition(5), block=64).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_slots_follow_the_golden_ratio(spark):
    quota = spark.createDataFrame([(1, "a", 64 * 100, 64 * 50.0), (2, "b", 64 * 100, 64 * 120.0), (3, "c", 64 * 10, 64 * 30.0)], "sid int, source string, source_size long, target double")
    out = mixing.slots(quota, block=64).collect()
    by = {}
    for r in out:
        by.setdefault(r.sid, []).append((r.rank, r.block, r["words"]))
    n, hits, edges = 200, {1: 0, 2: 0, 3: 0}, [(1, 50 / 200), (2, 170 / 200), (3, 1.0)]
    for i in range(n):
        u = i * mixing.GOLDEN % (1 << 31) / (1 << 31)
        hits[next(s for s, e in edges if u < e)] += 1
    for s, want, blocks in ((1, 50, 100), (2, 120, 100), (3, 30, 10)):
        assert sorted(by[s]) == [(r, r % blocks, 64) for r in range(want)]
        assert abs(hits[s] - want) <= 3  # what is dropped or closes the schedule is a few slots


def test_chunks_change_nothing(spark, monkeypatch):
    docs = docs_frame(spark, rows())
    one = sorted(map(str, mixing.mix(docs, block=64).collect()))
    monkeypatch.setattr(mixing, "CHUNK", 7)
    assert sorted(map(str, mixing.mix(docs, block=64).collect())) == one


def test_empty(spark):
    assert mixing.mix(docs_frame(spark, [])).collect() == []
    assert [r.taken for r in mixing.mix(docs_frame(spark, [(1, None), (2, " ")])).collect()] == [0, 0]
