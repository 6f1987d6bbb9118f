import random
import re

from headway.llm import quality_rules
from tests.llm.fixtures import docs_frame


def brute(rows):
    out = []
    for d, t, *_ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        seen, rep = {}, set()
        for i in range(len(w) - 7):
            seen.setdefault(tuple(w[i : i + 8]), []).append(i)
        for at in seen.values():
            if len(at) > 1:
                for i in at:
                    rep.update(range(i, i + 8))
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        base = len(w) < 20 or 100 * len(rep) > 30 * len(w)
        out.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep), base))
    return sorted(out, key=str)


def rows():
    rnd = random.Random(1)
    vocab = ["aé", "b", "中文字", "x#", "<p>", "😀"] + [f"w{i}" for i in range(40)]
    found = []
    for i in range(120):
        w = [rnd.choice(vocab) for _ in range(rnd.randint(0, 90))]
        if i % 4 == 0:
            w += w[3:20] + w[5:18]
        t = "".join(x + rnd.choice([" ", "\t", "\n", " \n\n"]) for x in w)
        found.append((i, t + ("\n" + t if i % 7 == 0 else ""), f"h{i % 5}"))
    return found + [(200, None, None), (201, "", "h1"), (3, "a b", "h9"), (3, "a b", "h9"), (None, "z " * 30_000, "h2"), (202, "a\n \na\nb \nb", "h1")]


def test_measures_against_brute_force(spark):
    out = quality_rules.judge(docs_frame(spark, rows())).collect()
    assert sorted((tuple(r)[:7] for r in out), key=str) == brute(rows())
    assert not any(r.kept and r.base_failed for r in out)


def test_empty(spark):
    assert quality_rules.judge(docs_frame(spark, [])).collect() == []


def good(i):
    return " ".join(f"word{i}x{j}" for j in range(40))


def test_hosts(spark):
    bad = "## %% " * 3 + " ".join("$$%%##" for _ in range(3)) + " "
    rows = [(i, good(i), f"h{i % 20}") for i in range(400)]
    rows += [(1000 + i, bad + good(i)[:60] if i % 10 else good(9000 + i), "spam") for i in range(60)]
    rows += [(2000, bad + "x y z", "tiny"), (2001, good(5000), "tiny")]
    kept = {r.doc_id: r.kept for r in quality_rules.judge(docs_frame(spark, rows)).collect()}
    assert all(kept[i] for i in range(400))
    assert not any(kept[1000 + i] for i in range(60))
    assert kept[2001] and not kept[2000]  # two documents are too few to block a host


def test_rates_shrink_toward_the_mean(spark):
    rows = [(i, "few", f"h{i % 4}") if i % 3 == 0 else (i, good(i), f"h{i % 4}") for i in range(120)] + [(999, "few", "one")]
    found = quality_rules.measures(docs_frame(spark, rows))
    rates = {r.host: r.rate_base for r in quality_rules.host_rates(found).collect()}
    assert 0.3 < rates["one"] < 1 and abs(rates["h1"] - 1 / 3) < 0.2
