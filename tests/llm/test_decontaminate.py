import hashlib
import random
import re

from headway.llm import decontaminate
from tests.llm.fixtures import ascii_lower, docs_frame

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(rows, items):
    split = lambda t: WORD.findall(ascii_lower(t))
    spans = {}
    for item, t in items:
        w = split(t)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            spans.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for d, t in rows:
        w, hit, found = split(t), set(), set()
        for n in {len(s) for s in spans}:
            for i in range(len(w) - n + 1):
                if (s := tuple(w[i : i + n])) in spans:
                    hit.update(range(i, i + n))
                    found |= spans[s]
        names = sorted(str(x) for x in found if x is not None)
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def cases():
    rnd = random.Random(3)
    vocab = ["the", "of", "and", "Ünd", "x1"] + [f"w{i}" for i in range(30)]
    text = lambda n: " ".join(rnd.choice(vocab) + rnd.choice(["", ",", ".", " -"]) for _ in range(n))
    items = [(i, text(rnd.randint(10, 40))) for i in range(12)] + [(20, "ab w3"), (21, "THE of, and"), (22, ""), (23, None), (24, "a a a a a a a a a a a a"), (25, "w1 w2 w3 w4 w5 w6 w7"), (3, "ab w3"), (None, "zq zr")]
    rows = []
    for i in range(80):
        t = text(rnd.randint(0, 60))
        if i % 3 == 0:
            w = (rnd.choice(items)[1] or "").split()
            a = rnd.randint(0, max(0, len(w) - 1))
            t += " \n" + " ".join(w[a : a + rnd.randint(5, 40)]).upper() + "! " + text(5)
        rows.append((i, t))
    rows += [(90, None), (91, ""), (92, "a " * 5000), (93, items[0][1]), (93, items[0][1]), (93, items[1][1]), (None, items[2][1]), (94, "w1 w2 w3 w4 w5 w6 w7 " * 3)]
    return rows, items


def got(spark, rows, items):
    b = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in decontaminate.report(docs_frame(spark, rows), b).collect()), key=str)


def test_against_brute_force(spark):
    rows, items = cases()
    assert got(spark, rows, items) == brute(rows, items)


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr("headway.llm.decontaminate.small", lambda df, **_: df)
    rows, items = cases()
    assert got(spark, rows, items) == brute(rows, items)


def test_empty_tables(spark):
    rows, items = cases()
    assert got(spark, [], items) == []
    assert got(spark, rows, []) == brute(rows, [])


def test_clean_keeps_columns(spark):
    rows, items = cases()
    docs = docs_frame(spark, rows)
    out = decontaminate.clean(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert out.columns == docs.columns
    dirty = {r[0] for r in brute(rows, items) if r[-1]}
    assert {r.doc_id for r in out.collect()} == {r[0] for r in rows} - dirty


def test_clean_rows_without_an_id_or_with_a_shared_one_stay(spark):
    rows = [(None, "ab w3"), (None, "quite another text"), (5, "ab w3"), (5, "clean"), (6, None), (None, None)]
    out = decontaminate.clean(docs_frame(spark, rows), spark.createDataFrame([(1, "ab w3")], "item_id long, text string"))
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(None, "quite another text"), (5, "clean"), (6, None), (None, None)], key=str)
