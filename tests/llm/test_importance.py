import random

import numpy as np

from headway.llm import importance
from tests.llm.fixtures import docs_frame


def corpus(n=1200):
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice(["an", "er", "th", "on", "is", "él"]) for _ in range(rnd.randint(1, 4)))
    rows, labels = [], []
    for i in range(n):
        w = [word() for _ in range(rnd.randint(5, 200))]
        kind = i % 10
        if kind == 0:
            for bad in rnd.sample(["vile", "nasty", "odious", "rotten", "foul"], 3):
                w.insert(rnd.randrange(len(w)), bad)
        elif kind == 1:
            w = [x + "%%" for x in w]
        rows.append((i, " ".join(w)))
        if i % 7 < 3:
            labels.append((i, int(kind != 1), int(kind == 0)))
    return rows, labels


def label_frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    out = {r.doc_id: r.kept for r in importance.verdicts(docs_frame(spark, rows), label_frame(spark, labels)).collect()}
    taught = {i for i, *_ in labels}
    good = [out[i] for i in out if i not in taught and i % 10 > 1]
    bad = [out[i] for i in out if i not in taught and i % 10 < 2]
    assert len(out) == len(rows) and np.mean(good) > 0.97 and np.mean(bad) < 0.1


def test_sample_is_the_largest_keys(spark):
    rows, labels = corpus(300)
    rows += [(0, rows[0][1]), (700, None), (701, ""), (None, "an er"), (702, "x " * 30_000)]
    docs, known = docs_frame(spark, rows), label_frame(spark, labels + [(99_999, 1, 0), (None, 1, 0), (3, None, None)])
    out = importance.verdicts(docs, known).collect()
    assert len(out) == len(rows)
    assert min(r.sample_key for r in out if r.kept) > max((r.sample_key for r in out if not r.kept), default=-(2**62))
    again = importance.verdicts(docs.repartition(3), known).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    kept = importance.accept(docs, known)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in out)
    assert importance.resample(docs, known).count() == sum(r.kept for r in out)


def test_kth_largest(spark):
    rnd = random.Random(1)
    x = [rnd.randint(-(10**12), 10**12) for _ in range(500)] + [7, 7, 7]
    df = spark.createDataFrame([(v,) for v in x], "v long")
    for k in (1, 2, 250, 503):
        assert importance.kth_largest(df, "v", k) == sorted(x)[-k]
    assert importance.kth_largest(df, "v", 504) is None and importance.kth_largest(df, "v", 0) is None


def test_stutter_and_empty_ngrams():
    assert importance.ngrams("").shape == importance.ngrams(None).shape == (2, 0)
    a, b = importance.ngrams("x " * 40), importance.ngrams("y " * 40)
    assert len(np.intersect1d(a[0], b[0])) >= 6


def test_nothing_to_learn_from(spark):
    rows, labels = corpus(60)
    docs = docs_frame(spark, rows)
    for known in ([], [(i, 1, 0) for i in range(50)], [(i, 0, 1) for i in range(50)]):
        out = importance.verdicts(docs, label_frame(spark, known)).collect()
        assert len(out) == 60 and (known and known[0][1] == 0 or all(r.kept for r in out))
    assert importance.verdicts(docs_frame(spark, []), label_frame(spark, labels)).collect() == []
    assert importance.accept(docs_frame(spark, []), label_frame(spark, [])).collect() == []


def test_labels_are_bounded(spark):
    known = label_frame(spark, [(i, 1, 0) for i in range(2000)])
    assert 350 < importance.labelled(known, 500).count() < 650


def test_ratios_against_brute_force(spark):
    import random

    import numpy as np

    rnd = random.Random(9)
    vocab = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(rnd.choices(vocab, k=30)) + (" vile stuff" if i % 4 == 0 else "")) for i in range(800)]
    docs = docs_frame(spark, rows)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(0, 800, 2)], "doc_id long, quality int, toxic int")
    known = importance.labelled(labels)
    good = {r.doc_id for r in known.collect() if r.good and r.fold > 0}
    raw, want = np.zeros(importance.BUCKETS), np.zeros(importance.BUCKETS)
    for i, t in rows:
        found = np.unique(importance.ngrams(t))
        raw[found] += 1
        want[found] += i in good
    part = len(good) / len(rows)
    expected = raw * part
    away = (expected - want) / np.sqrt(expected * (1 - part) + 1e-9)
    ratios = importance.model(docs, known)
    for k, z in enumerate(importance.SIGNIFICANT):
        brute = np.where(away > z, np.log((want + importance.PSEUDO) / (expected + importance.PSEUDO)), 0)
        assert np.abs(ratios[k] - brute).max() < 1e-5
    assert ratios[0].min() < -1 and (ratios <= 0).all()
    weights = {r.doc_id: r.log_weights for r in importance.log_weights(docs, ratios).collect()}
    for i, t in rows[:40]:
        g = importance.ngrams(t)
        assert np.allclose(weights[i], [np.maximum(r[g[0]], r[g[1]]).sum() for r in ratios], atol=1e-3)
