import random

from headway.llm import line_dedup
from tests.llm.fixtures import docs_frame


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = set(), []
    for d, t in rows:
        lines = (t or "").split("\n")
        full = [(i, x.strip(" \t\r\x0b\x0c")) for i, x in enumerate(lines) if x.strip(" \t\r\x0b\x0c")]
        gone = set()
        for j in range(len(full) - 2):
            w = tuple(x for _, x in full[j : j + 3])
            if w in seen:
                gone.update(i for i, _ in full[j : j + 3])
            seen.add(w)
        out.append((d, None if t is None else "\n".join(x for i, x in enumerate(lines) if i not in gone), 0 if t is None else len(lines), len(gone)))
    return sorted(out, key=str)


def rows():
    rnd = random.Random(4)
    out = [(i, "\n".join(rnd.choice(["a", "b", " b", "c\t", "d", "", "é x"]) for _ in range(rnd.randint(0, 12)))) for i in range(60)]
    return out + [(100, None), (101, ""), (102, "a\n" * 3000), (103, "one\ntwo\nthree"), (104, "one\n\n two\r\nthree\nfour"), (105, "\n\n\n"), (None, "one\ntwo\nthree\nfive")]


def test_against_brute_force(spark):
    docs = docs_frame(spark, rows())
    out = line_dedup.dedup(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_removed"]
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in out.collect()), key=str) == brute(rows())


def test_repeated_rows_stay(spark):
    out = line_dedup.dedup(docs_frame(spark, [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "z\na\nb\nc")])).collect()
    assert sorted((r.doc_id, r.text) for r in out) == [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "z")]


def test_empty(spark):
    assert line_dedup.dedup(docs_frame(spark, [])).collect() == []


def test_names_of_its_own_may_clash(spark):
    docs = docs_frame(spark, [(1, "a\nb\nc"), (2, "z\na\nb\nc")])
    for c in ("_id", "_key", "_at", "_new", "_k", "at", "w1", "n_lines"):
        docs = docs.withColumn(c, docs["doc_id"] * 10)
    out = {r.doc_id: r for r in line_dedup.dedup(docs).collect()}
    assert out[2].text == "z" and out[2]["_id"] == out[2]["_at"] == 20 and out[2].n_lines == 4
