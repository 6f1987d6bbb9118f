import random

import xxhash

from headway.llm import common, simhash
from tests.llm.fixtures import docs_frame, words


def brute_fingerprint(text):
    w = words(text)
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def brute_components(rows):
    ids, fps = [i for i, _ in rows], [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4:
                root[find(i)] = find(j)
    best = {}
    for i, d in enumerate(ids):
        r = find(i)
        if d is not None:
            best[r] = min(best.get(r, d), d)
    return sorted(((d, f"{fps[i]:016x}", best.get(find(i))) for i, d in enumerate(ids)), key=str)


def sample_rows():
    rnd = random.Random(5)
    vocab = ["Wort%d" % i for i in range(300)] + ["É", "中文", "a b"]
    base = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 150))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(100, 180):
        w = base[i % 60].split(" ")
        for _ in range(rnd.randint(0, 2)):
            w[rnd.randrange(len(w))] = rnd.choice(vocab)
        rows.append((i, "\t ".join(w)))
    rows += [(200, ""), (201, None), (202, " \n "), (None, base[0]), (7, base[7]), (7, base[7]), (203, "x " * 40_000)]
    return rows


def got(spark, rows, **how):
    out = simhash.near_duplicates(docs_frame(spark, rows), **how).collect()
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in out), key=str)


def test_against_brute_force(spark):
    rows = sample_rows()
    assert got(spark, rows) == brute_components(rows)


def test_crowded_buckets_lose_no_link(spark):
    rows = sample_rows()
    assert got(spark, rows, crowd=1) == brute_components(rows)


def test_segments_and_masks():
    assert simhash.segments(4, 3) == [(0, 21, 1), (21, 21, 1), (42, 22, 0)]
    assert len(simhash.masks(64, 2)) == 2081


def test_empty(spark):
    assert got(spark, []) == []


def test_chain_of_links(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (5, 5)], "a long, b long")
    found = {r.node: r.root for r in simhash.components(edges).collect()}
    assert found == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_one_of_each_group_stays(spark):
    rows = [(3, "a b c d e"), (1, "a b c d e"), (2, "q w e r t y"), (None, "a b c d e")]
    out = simhash.keep_one(docs_frame(spark, rows))
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "2", "None"]
    assert out.columns == docs_frame(spark, rows).columns


def test_any_number_of_segments_and_large_groups_agree(spark):
    import random

    rnd = random.Random(8)
    base = [rnd.getrandbits(64) for _ in range(40)]
    fps = {b ^ sum(1 << k for k in rnd.sample(range(64), rnd.randint(0, 3))) for b in base for _ in range(12)} | set(base)
    rows = spark.createDataFrame([(simhash.signed(x),) for x in fps], "fp long")
    found = [{(r.node, r.root) for r in common.components(simhash.links(rows, 4, count, crowd)).collect()} for count, crowd in ((3, 1024), (2, 1024), (3, 4), (2, 4))]
    assert found[0] and all(f == found[0] for f in found)
    assert simhash.tables(10**6) == 3 and simhash.tables(10**10) == 2
    nodes = spark.createDataFrame([(k, k % 3 if k % 3 else k, 100 - k) for k in range(60)], "node long, root long, first_id long")
    small, large = ({(r.node, r.component_id) for r in common.least_of_group(nodes, c).collect()} for c in (1000, 5))
    assert small == large and len(small) == 60 and (58, 100 - 58) in small and (55, 42) in small and (6, 94) in small


def test_edges_of_near_copies_grow_with_their_number(spark, monkeypatch):
    """A ball of near copies is contracted from edges in proportion to its members, not to their pairs, and none is lost."""
    rnd = random.Random(11)
    base, read = rnd.getrandbits(64), []
    ball = sorted({base ^ sum(1 << k for k in rnd.sample(range(64), rnd.randint(0, 5))) for _ in range(3000)})
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, n: docs.select("doc_id", docs.text.cast("long").alias("fp")))
    monkeypatch.setattr(simhash, "components", lambda edges: read.append(edges.count()) or common.components(edges))
    rows = [(i, str(simhash.signed(x))) for i, x in enumerate(ball)]
    out = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs_frame(spark, rows)).collect()}
    root = list(range(len(ball)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    pairs = [(i, j) for i, x in enumerate(ball) for j in range(i) if (x ^ ball[j]).bit_count() <= 4]
    for i, j in pairs:
        a, b = sorted((find(i), find(j)))
        root[b] = a
    assert out == {i: find(i) for i in range(len(ball))}
    assert max(read) < 20 * len(ball) < len(pairs) / 4, (len(ball), len(pairs), read)
