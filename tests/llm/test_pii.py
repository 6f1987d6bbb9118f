import random
import re
from hashlib import sha256

from headway.llm import pii
from tests.llm.fixtures import docs_frame

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(sum(divmod(int(c) * (2 if i % 2 else 1), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text or ""):
            d = re.sub(r"[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(d) <= 19 and luhn(d)):
                continue
            if kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def rows():
    rnd = random.Random(12)
    bits = ["joe.x@mail.example.com", "a@b.c_d@e.f", "x@y", "a@b..c", "%+@q-.r.s", "😀é", "1.2.3.4.5.6.7.8", "256.1.1.1", "007.010.255.0", "4111 1111 1111 1111", "4111-1111-1111-1112", "1 2 3", "9807915762804490", "+1 (017) 555-7713", "+49 30 1", "+1()..--22 3334444 5-", "..", "@", "\n", "+", "tel", "٣٤٥", "1234567890123456789012", "-", " "]
    out = [(i, "".join(rnd.choice(bits) + rnd.choice(["", " ", ", ", "é"]) for _ in range(rnd.randint(0, 25)))) for i in range(300)]
    out += [(400, None), (401, ""), (402, "a" * 30_000), (403, "1" * 30_000), (404, "a." * 20_000 + "@x.y"), (405, "1.1." * 5_000), (406, "+1" * 10_000), (407, "x@y.z " * 2_000)]
    return out + [(5, out[5][1]), (None, "me@here.org")]


def test_base_spans_against_brute_force(spark):
    out = pii.detect(docs_frame(spark, rows())).collect()
    want = {(i, t): brute(t) for i, t in rows()}
    texts = dict(rows()[:-2])
    texts[None] = "me@here.org"
    assert len(out) == len(rows())
    for r in out:
        base = want[r.doc_id, texts[r.doc_id]]
        assert r.base_sha256 == sha256(",".join(base).encode()).hexdigest(), (r.doc_id, texts[r.doc_id], base, r.spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k + ":") for s in base) for k in PATTERNS]
        assert set(base) - {""} <= set(r.spans.split(","))


def supervised():
    rnd = random.Random(7)
    rows, truth = [], {}
    for i in range(400):
        digits = "".join(rnd.choice("0123456789") for _ in range(4))
        good = [f"please call {rnd.randint(200, 999)}-555-{digits} today", f"phone: +1 ({rnd.randint(200, 999)}) 555-{digits}", f"write an email to jo{i} (at) mail{i % 7} (dot) org soon", f"server address 83.{i % 250}.7.{i % 99}", "my card number 4111 1111 1111 1111", f"mail me at ann{i}@site.com"]
        bad = [f"order {rnd.randint(200, 999)} 555 {digits} was sent", f"the version 1.2.{i}.999 is out", f"serial no 98765432101234{i % 90 + 10}", "nothing at all here"]
        pick = rnd.choice(good) if i % 2 else rnd.choice(bad)
        rows.append((i, f"Some words before. {pick} and words after."))
        truth[i] = bool(i % 2)
    return rows, truth


def test_method_adds_what_the_base_misses(spark):
    rows, truth = supervised()
    out = {r.doc_id: r for r in pii.detect(docs_frame(spark, rows)).collect()}
    found = {i: out[i].spans != "" for i in truth}
    assert sum(found[i] for i in truth if truth[i]) > 0.95 * sum(truth.values())
    assert not any(out[i].n_added for i in truth if not truth[i])
    added = [i for i in truth if out[i].n_added]
    assert len(added) > 20
    for i in added:
        kind, a, b = out[i].spans.split(",")[-1].split(":")
        text = dict(rows)[i][int(a) : int(b)]
        assert "(at)" in text if kind == "email" else "555-" in text


def test_em_learns_who_is_reliable():
    # The second labeler agrees with the majority at random, the others mostly: its votes must weigh little.
    patterns = [(0, (1, x, 1, 1, 1), 100) for x in (-1, 1)] + [(0, (-1, x, -1, -1, -1), 100) for x in (-1, 1)] + [(0, (1, -1, 1, 1, -1), 5), (0, (-1, 1, -1, -1, 1), 5)]
    p = pii.expectation_maximisation(patterns)
    assert p[0, (1, -1, 1, 1, 1)] > 0.9 and p[0, (-1, 1, -1, -1, -1)] < 0.1 and p[0, (1, -1, 1, 1, -1)] > 0.5


def test_empty(spark):
    assert pii.detect(docs_frame(spark, [])).collect() == []
    assert [r.spans for r in pii.detect(docs_frame(spark, [(1, "none"), (2, None)])).collect()] == ["", ""]


def test_secrets_and_their_like(spark):
    rnd = random.Random(5)
    hexed = lambda n: "".join(rnd.choice("0123456789abcdef") for _ in range(n))
    good = [lambda: f'token = "{hexed(40)}"', lambda: f"api_key: {hexed(32)}", lambda: f"password={hexed(9)}Qz{hexed(9)}", lambda: f"the secret is ghp_{hexed(36)}"]
    bad = [lambda: f"see /usr/lib/python{rnd.randint(2, 9)}/site-packages/x", lambda: f"order-number-{rnd.randint(10**9, 10**10)}-of-today", lambda: "incomprehensibilities2", lambda: "1234567890123456789012", lambda: "a plain sentence"]
    rows = [(i, f"Words before, {rnd.choice(good if i % 2 else bad)()} and after.") for i in range(400)]
    out = {r.doc_id: r for r in pii.detect(docs_frame(spark, rows)).collect()}
    found = {i: "secret:" in out[i].spans for i, _ in rows}
    precision = sum(found[i] for i in found if i % 2) / max(1, sum(found.values()))
    recall = sum(found[i] for i in found if i % 2) / 200
    assert precision > 0.95 and recall > 0.9, (precision, recall)
    for i, t in rows:
        if out[i].n_added:
            a, b = map(int, out[i].spans.split(",")[-1].split(":")[1:])
            assert t[a:b].strip('"') == t[a:b] and len(t[a:b]) >= 16
    assert all(out[i].n_spans == len([s for s in out[i].spans.split(",") if s]) for i in out)


def test_the_drivers_documents_gain_spans(spark):
    import os

    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet" if os.path.exists(folder) else "")
    out = pii.detect(docs).join(docs.select("doc_id", "text"), "doc_id")
    has = out.selectExpr("n_added > 0 and spans like '%secret:%' as found", "coalesce(text, '') like '%token = \"%' as planted").groupBy("found", "planted").count().collect()
    n = {(r.found, r.planted): r["count"] for r in has}
    assert n[True, True] > 0.95 * (n[True, True] + n.get((False, True), 0)) and n.get((True, False), 0) <= 0.02 * n[True, True]
