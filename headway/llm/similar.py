"""Near-duplicates by SimHash, held to a Jaccard similarity of word shingles: whole sets decide on what is proposed.

Fingerprints propose first, found by the multi-index hashing of `simhash.links`. They can't propose all that is similar:
texts of similarity 0.8 differ in ten bits on average and in 16 at times, and balls of that size around segments hold more
words than there are documents. Min-hash bands propose what fingerprints have left apart.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm import simhash
from headway.llm.common import components, cut, least_of_group, small, text_key

SEED = 42
#: A pair of similarity s meets in some band with 1 - (1 - s^6)^30: 0.9999 at 0.8, and 0.02 at 0.3.
BANDS, ROWS = 30, 6
#: Shingles whose min-hashes are taken at once, so that one long text needs bounded memory.
CHUNK = 1 << 10
_RANDOM = np.random.default_rng(SEED)
FACTORS = _RANDOM.integers(0, 1 << 63, (BANDS * ROWS, 1), np.uint64) << np.uint64(1) | np.uint64(1)
OFFSETS = _RANDOM.integers(0, 1 << 63, (BANDS * ROWS, 1), np.uint64)


def shingles(text: str | None, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles, A-Z in lower case; of all words where there are fewer."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    if len(tokens) < n:
        starts, ends = [0], [len(joined)]
    else:
        at = np.zeros(len(tokens) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1, out=at[1:])
        starts, ends = at[: len(tokens) - n + 1].tolist(), (at[n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, len(starts)))


def band_codes(hashes: np.ndarray) -> list[int]:
    """A signed long for each band; bands of equal min-hashes have equal codes. None for no shingles."""
    if not len(hashes):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(hashes), CHUNK):
        np.minimum(least, (hashes[k : k + CHUNK] * FACTORS + OFFSETS).min(1), out=least)
    return np.array([xxhash.xxh64_intdigest(x.tobytes(), k) for k, x in enumerate(least.reshape(BANDS, ROWS))], np.uint64).view(np.int64).tolist()


def set_fingerprint(hashes: np.ndarray) -> int:
    """The SimHash of distinct shingles as a signed long; zero for none."""
    total = np.zeros(64, np.int64)
    for k in range(0, len(hashes), simhash.CHUNK):
        total += simhash.set_bits(hashes[k : k + simhash.CHUNK])
    return simhash.signed(simhash.majority(total, len(hashes)))


def sketches(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, text_id, node, fp, codes): a row for each row; node is a hash of the set of shingles, fp its SimHash."""

    def run(batches):
        for b in batches:
            found = [shingles(t, n) for t in b.column(2).to_pylist()]
            nodes = [xxhash.xxh64_intdigest(h.tobytes()) for h in found]
            fps, codes = pa.array([set_fingerprint(h) for h in found], pa.int64()), pa.array([band_codes(h) for h in found], pa.list_(pa.int64()))
            columns = [b.column(0).cast(pa.int64()), b.column(1), pa.array(np.array(nodes, np.uint64).view(np.int64)), fps, codes]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_id", "node", "fp", "codes"])

    return docs.select("doc_id", text_key(F.col("text")).alias("text_id"), "text").mapInArrow(run, "doc_id long, text_id long, node long, fp long, codes array<long>")


def sets(texts: DataFrame, n: int) -> DataFrame:
    """(node, hashes): the distinct sets of shingles."""

    def run(batches):
        for b in batches:
            found = [shingles(t, n) for t in b.column(0).to_pylist()]
            nodes = [xxhash.xxh64_intdigest(h.tobytes()) for h in found]
            hashes = pa.array([h.view(np.int64) for h in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(np.array(nodes, np.uint64).view(np.int64)), hashes], ["node", "hashes"])

    return texts.select("text").mapInArrow(run, "node long, hashes array<long>").dropDuplicates(["node"])


def similar(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have a Jaccard similarity of at least so many percent."""
    left, right = known.select(F.col("node").alias("a"), F.col("hashes").alias("x")), known.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return pairs.join(left, "a").join(right, "b").where(100 * both >= percent * (F.size("x") + F.size("y") - both)).select("a", "b")


def candidates(members: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of members (node, root) of different roots; all similar ones are among them.

    Each set is ordered by how many members have a hash, rarest first. Two similar sets have their first common hash so
    early that as many as they must share can still follow, so only the front fifth of a set is looked up, and pairs
    whose places in it rule the similarity out are not made. What copies of one text have in common is frequent and comes
    last, so those that differ too much meet on nothing. A hash's most frequent root is not paired with itself.
    """
    flat = members.join(known, "node").select("node", "root", F.explode("hashes").alias("hash"))
    seen = flat.groupBy("hash").agg(F.count("*").alias("n_members"))
    order = flat.join(seen, "hash").groupBy("node", "root").agg(F.sort_array(F.collect_list(F.struct("n_members", "hash"))).alias("ordered"))
    front = F.size("ordered") - F.ceil(F.size("ordered") * percent / 100.0 - 1e-9).cast("int") + 1
    entries = order.select("node", "root", F.size("ordered").alias("n"), F.posexplode(F.slice("ordered", F.lit(1), front)).alias("at", "x"))
    entries = cut(entries.where("x.n_members > 1").select("node", "root", "n", "at", "x.hash"))
    by_root = entries.groupBy("hash", "root").agg(F.count("*").alias("rows"))
    major = by_root.groupBy("hash").agg(F.max_by("root", F.struct("rows", "root")).alias("major"), F.count("*").alias("roots")).where("roots > 1").select("hash", "major")
    left = entries.join(major, "hash").where("root <> major").select("hash", F.col("node").alias("a"), F.col("root").alias("root_a"), F.col("n").alias("n_a"), F.col("at").alias("at_a"))
    common = F.least(F.col("n") - F.col("at"), F.col("n_a") - F.col("at_a"))
    met = left.join(entries, "hash").where((F.col("root") != F.col("root_a")) & ((100 + percent) * common >= percent * (F.col("n") + F.col("n_a"))))
    return met.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()


def by_fingerprint(nodes: DataFrame, radius: int = 4) -> DataFrame:
    """(a, b): pairs of nodes (node, fp) by SimHash, enough to join all fingerprints that differ in at most `radius` bits.

    A fingerprint's nodes are held against its least one, which stands for it before the others.
    """
    firsts = cut(nodes.groupBy("fp").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n")))
    near = simhash.links(firsts.select("fp"), radius, simhash.tables(firsts.count()))
    a, b = (firsts.select(F.col("fp").alias(side), F.col("first").alias(f"node_{side}")) for side in ("a", "b"))
    apart = near.join(a, "a").join(b, "b").select("node_a", "node_b")
    same = nodes.join(small(firsts.where("n > 1").select("fp", "first")), "fp").where("node <> first").select("first", "node")
    return apart.unionAll(same).toDF("a", "b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def links(entries: DataFrame, known: DataFrame, percent: int, edges: DataFrame) -> DataFrame:
    """(a, b): enough to join what edges join, and all similar pairs of nodes that share a code.

    entries (node, code) has codes that several nodes share. What edges have joined is one. Each code's nodes are held
    against its least node, then against one drawn for each code, so a group of near copies costs its members and not
    their square. What is not joined then, such as copies that differ more from each other than from their source, meets
    by its rarest shingles. What is joined goes on as edges to its root, so each turn contracts only what it has found.
    """
    roots = components(edges)
    edges = roots.toDF("a", "b")
    for least in (F.col("node"), F.xxhash64("node", "code"), None):
        now = entries.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        parted = now.groupBy("code").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("code")
        now = cut(now.join(parted, "code", "left_semi"))
        if now.isEmpty():
            break
        if least is not None:
            one = now.groupBy("code").agg(F.min_by(F.struct(F.col("node").alias("first"), F.col("root").alias("first_root")), least).alias("one")).select("code", "one.*")
            pairs = now.join(one, "code").where("root <> first_root").select(F.least("node", "first").alias("a"), F.greatest("node", "first").alias("b")).distinct()
        else:
            pairs = candidates(now.select("node", "root").distinct(), known, percent)
        found = cut(similar(pairs, known, percent))
        if found.isEmpty():
            continue
        edges = edges.unionAll(found)
        if least is not None:
            roots = components(edges)
            edges = roots.toDF("a", "b")
    return edges


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, component_id): a row for each row of docs (doc_id, text).

    component_id is the smallest doc_id that links of texts whose n-word shingles have a Jaccard similarity of at least
    `percent` reach, proposed by SimHash fingerprints and, where those leave similar texts apart, by min-hash bands. Texts
    without words are alike; a row without doc_id links and can't be a smallest id.
    """
    found = cut(sketches(docs, n))
    nodes = cut(found.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.min("text_id").alias("text_id"), F.first("fp").alias("fp"), F.first("codes").alias("codes")))
    near = cut(by_fingerprint(nodes.select("node", "fp")))
    entries = nodes.select("node", F.explode("codes").alias("code"))
    shared = entries.groupBy("code").count().where("count > 1").select("code")
    entries = cut(entries.join(shared, "code", "left_semi"))
    met = entries.select("node").unionAll(near.select("a")).unionAll(near.select("b")).distinct()
    asked = small(cut(nodes.join(met, "node", "left_semi").select("text_id")))
    known = cut(sets(docs.join(asked, text_key(F.col("text")) == F.col("text_id"), "left_semi"), n))
    edges = links(entries, known, percent, cut(similar(near, known, percent)))
    labelled = nodes.select("node", "first_id").join(components(edges), "node", "left").withColumn("root", F.coalesce("root", "node"))
    return found.select("doc_id", "node").join(cut(least_of_group(labelled)), "node").select("doc_id", "component_id")
