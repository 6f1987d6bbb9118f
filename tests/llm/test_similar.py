import random

import corpus_pipeline
from headway.llm import common, similar, simhash
from tests.llm.fixtures import docs_frame, words


def brute(rows):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                root[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            best[find(i)] = min(best.get(find(i), d), d)
    return sorted(((d, best.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def sample_rows():
    """Copies from exact to half alike, one large group among them."""
    rnd = random.Random(8)
    vocab = [f"Wort{i}" for i in range(300)] + ["É", "中文"]
    base = [[rnd.choice(vocab) for _ in range(rnd.choice([1, 4, 5, 9, 60, 200, 400]))] for _ in range(40)]
    rows = [(i, " ".join(w)) for i, w in enumerate(base)]
    for i in range(100, 260):
        w = list(base[3 if i > 200 else i % 40])
        for _ in range(rnd.randint(0, len(w) // 25 + 1)):
            w[rnd.randrange(len(w))] = rnd.choice(vocab)
        rows.append((i, "\t ".join(w)))
    return rows + [(300, ""), (301, None), (302, " \n "), (None, rows[4][1]), (7, rows[7][1]), (303, "x " * 9_000)]


def test_against_brute_force(spark):
    rows = sample_rows()
    assert sorted((tuple(r) for r in similar.near_duplicates(docs_frame(spark, rows)).collect()), key=str) == brute(rows)


def test_pipeline_stage_drops_what_is_similar(spark):
    rows = sample_rows()
    kept = corpus_pipeline.near_duplicates(spark, docs_frame(spark, rows), "").collect()
    assert {r.doc_id for r in kept if r.doc_id is not None} == {c for d, c in brute(rows) if d is not None}


def test_empty(spark):
    assert similar.near_duplicates(docs_frame(spark, [])).collect() == []


def test_candidates_of_a_large_group(spark):
    """Of copies that differ more from each other than from their source, similar pairs alone are worth a look."""
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(400):
        w = list(base)
        for at in rnd.sample(range(150), rnd.choice([1, 4, 5, 6, 7])):
            w[at] = f"{i if rnd.random() < 0.8 else at}x{at}"
        rows.append((i, " ".join(w)))
    known = similar.sets(docs_frame(spark, rows), 5).cache()
    sets = {r.node: set(r.hashes) for r in known.collect()}
    low = min(sets)
    root = {n: low if 5 * len(s & sets[low]) >= 4 * len(s | sets[low]) else n for n, s in sets.items()}
    members = spark.createDataFrame(list(root.items()), "node long, root long")
    found = [tuple(r) for r in similar.candidates(members, known, 80).collect()]
    pairs = [(a, b) for a in sets for b in sets if a < b and root[a] != root[b]]
    due = {(a, b) for a, b in pairs if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    assert due and due <= set(found) and len(found) == len(set(found))
    assert all(root[a] != root[b] for a, b in found)
    assert len(found) - len(due) < len(pairs) / 10
    known.unpersist()


def test_fingerprints_join_before_bands_do(spark, monkeypatch):
    """SimHash alone joins the similar texts within four bits; bands are left the others."""
    rnd = random.Random(2)
    rows = []
    for i in range(40):
        w = [f"w{rnd.randrange(2000)}" for _ in range(200)]
        rows.append((i, " ".join(w)))
        for at in rnd.sample(range(200), i % 5):
            w[at] = "other"
        rows.append((i + 100, " ".join([*w, "end"])))
    fps = {d: similar.set_fingerprint(similar.shingles(t)) for d, t in rows}
    assert fps[3] == simhash.signed(simhash.fingerprint(rows[6][1], 5))
    near = {i + 100 for i in range(40) if bin((fps[i] ^ fps[i + 100]) & (1 << 64) - 1).count("1") <= 4}
    similar_ones = {d for d, c in brute(rows) if c < d}
    asked = []
    monkeypatch.setattr(similar, "links", lambda entries, known, percent, edges: asked.append(entries) or edges)
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs_frame(spark, rows), "").collect()}
    assert asked and 10 < len(near & similar_ones) < len(similar_ones)
    assert {d for d, _ in rows} - kept == near & similar_ones


def test_tasks_of_components(spark):
    """The driver keeps account of each task: stars cost no round, and a few edges no task for each partition."""
    rnd, sc = random.Random(3), spark.sparkContext
    tree = [(i, rnd.randrange(max(0, i - 9), i)) for i in range(1, 300)]
    stars = [(i, i % 7) for i in range(7, 300)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", 64)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for name, rows, most in (("stars", stars, 400), ("tree", tree, 3000)):
            sc.setJobGroup(name, name)
            found = {r.node: r.root for r in common.components(spark.createDataFrame(rows, "a long, b long")).collect()}
            assert found == ({i: i % 7 for i in range(300)} if name == "stars" else dict.fromkeys(range(300), 0))
            stages = {s for j in sc.statusTracker().getJobIdsForGroup(name) for s in sc.statusTracker().getJobInfo(j).stageIds}
            tasks = sum(x.numCompletedTasks for s in stages if (x := sc.statusTracker().getStageInfo(s)))
            assert tasks <= most
    finally:
        sc._jsc.clearJobGroup()
        for k, v in before.items():
            spark.conf.set(k, v)


def test_components_of_any_size(spark):
    """Broadcast or shuffled minima, coalesced or not, find the same."""
    rnd = random.Random(4)
    rows = [(rnd.randrange(-200, 200), rnd.randrange(-200, 200)) for _ in range(150)] + [(i, -500) for i in range(900, 990)]
    edges = spark.createDataFrame(rows, "a long, b long")
    one, other = ({(r.node, r.root) for r in common.components(edges, few=few, rows=per).collect()} for few, per in ((10**5, 20_000), (0, 1)))
    root = {x: x for p in rows for x in p if p[0] != p[1]}
    for _ in root:
        for a, b in rows:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert one == other == set(root.items())
