"""SimHash near-duplicates, found by multi-index hashing."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import components, cut, least_of_group, small

SEED = 42
#: Shingles whose bits are counted at once, so that one long text needs bounded memory.
CHUNK = 1 << 15


def set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set."""
    return np.unpackbits(hashes.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)


def majority(total: np.ndarray, of: int) -> int:
    """64 bits, each set if it is set in over half of so many hashes."""
    return sum(1 << i for i, c in enumerate(total.tolist()) if 2 * c > of)


def fingerprint(text: str | None, n: int = 4) -> int:
    """64 bits, each set if it is set in over half the hashes of the n-word shingles (repeats count)."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) < n:
        starts, ends = [0], [len(joined)]
    else:
        at = np.zeros(len(tokens) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1, out=at[1:])
        starts, ends = at[: len(tokens) - n + 1].tolist(), (at[n:] - 1).tolist()
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(starts), CHUNK):
        part = [digest(joined[a:b], SEED) for a, b in zip(starts[k : k + CHUNK], ends[k : k + CHUNK])]
        total += set_bits(np.array(part, "<u8"))
    return majority(total, len(starts))


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, n: int = 4) -> DataFrame:
    """(doc_id, fp): one row for each row; fp is the fingerprint as a signed long."""

    def run(batches):
        for b in batches:
            fps = [signed(fingerprint(t, n)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def segments(radius: int, count: int = 3) -> list[tuple[int, int, int]]:
    """(shift, width, ball radius) for each segment.

    By the pigeonhole principle some segment differs in at most its ball radius, if the radii plus one sum to over
    `radius`.
    """
    cuts = [64 * k // count for k in range(count + 1)]
    need = [(radius + 1) // count - 1 + (k < (radius + 1) % count) for k in range(count)]
    return [(a, b - a, r) for a, b, r in zip(cuts, cuts[1:], need) if r >= 0]


def masks(width: int, radius: int, shift: int = 0) -> list[int]:
    """All words of `width` bits with at most `radius` set."""
    return [signed(sum(1 << (i + shift) for i in c)) for r in range(radius + 1) for c in combinations(range(width), r)]


def lookups(fps: DataFrame, segs: list[tuple[int, int, int]], balls: bool) -> DataFrame:
    """fps with (k, code): the entry of each fingerprint in each segment's table, or all words of the ball around it."""
    found = []
    for k, (shift, width, ball) in enumerate(segs):
        code = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))
        flips = F.array(*[F.lit(m) for m in (masks(width, ball) if balls else [0])])
        found.append(F.transform(flips, lambda m: F.struct(F.lit(k).alias("k"), code.bitwiseXOR(m).alias("code"))))
    return fps.select(*fps.columns, F.explode(F.concat(*found)).alias("x")).select(*fps.columns, "x.*")


def through_words(probes: DataFrame, crowded: DataFrame, radius: int) -> DataFrame:
    """(a, b): links of all that look up crowded entries (k, code), each to the least of a word within half the radius."""
    if radius % 2:
        raise ValueError("an even radius is needed")
    hot = cut(probes.join(crowded, ["k", "code"], "left_semi").select("fp").distinct())
    half = F.array(*[F.lit(m) for m in masks(64, radius // 2)])
    words = hot.select("fp", F.explode(F.transform(half, lambda m: F.col("fp").bitwiseXOR(m))).alias("mid"))
    least = words.groupBy("mid").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").select("mid", "a")
    return words.join(least, "mid").where("a <> fp").select("a", F.col("fp").alias("b")).distinct()


def within(radius: int) -> Column:
    """That a and b are two fingerprints that differ in at most `radius` bits."""
    return (F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def links(fps: DataFrame, radius: int = 4, count: int = 3, crowd: int = 1024) -> DataFrame:
    """(a, b): pairs of distinct fingerprints of column fp, enough to join all that differ in at most `radius` bits.

    Each fingerprint's segments form one table per segment. Small Hamming balls around each segment are looked up in
    it, and the whole distance verifies what is found. A table entry that over `crowd` fingerprints share would be
    paired with itself; instead its members, and those that look it up, are hashed to all words within half the radius:
    two fingerprints within the radius share such a word, and all that share one are within it, so each is linked to
    the least. This is linear in the members and loses no link's connection.
    """
    segs = segments(radius, count)
    entries, probes = lookups(fps.select("fp"), segs, False), lookups(fps.select("fp"), segs, True)
    crowded = cut(entries.groupBy("k", "code").count().where(F.col("count") > crowd).select("k", "code"))
    none = crowded.isEmpty()
    found = probes if none else probes.join(crowded, ["k", "code"], "left_anti")
    near_pairs = (
        found.withColumnRenamed("fp", "a")
        .join(entries.withColumnRenamed("fp", "b"), ["k", "code"])
        .where(within(radius))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )
    return (near_pairs if none else near_pairs.unionAll(through_words(probes, crowded, radius))).distinct()


def forest(fps: DataFrame, radius: int = 4, count: int = 3, crowd: int = 1024) -> DataFrame:
    """(a, b): edges that join what `links` joins, about as many as fingerprints and not as pairs of near copies.

    What looks an entry up is held against two of its members only, the least and one drawn for each entry, which joins
    most near copies. Then it is held against all members of entries of several that have another root, so no link is
    lost; two roots that meet are one edge. Crowded entries go by words, as in `links`.
    """
    segs = segments(radius, count)
    entries, probes = lookups(fps.select("fp"), segs, False), lookups(fps.select("fp"), segs, True)
    drawn = F.min_by("fp", F.xxhash64("fp", "k", "code"))
    groups = cut(entries.groupBy("k", "code").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("first"), drawn.alias("drawn")))
    crowded = groups.where(F.col("n") > crowd).select("k", "code")
    few = groups.where(F.col("n") <= crowd).select("k", "code", F.explode(F.array_distinct(F.array("first", "drawn"))).alias("b"))
    edges = probes.withColumnRenamed("fp", "a").join(few, ["k", "code"]).where(within(radius)).select("a", "b")
    roots = cut(components(edges if crowded.isEmpty() else edges.unionAll(through_words(probes, crowded, radius))))
    rooted = cut(fps.select("fp").join(small(roots.withColumnRenamed("node", "fp")), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    several = groups.where((F.col("n") > 1) & (F.col("n") <= crowd)).select("k", "code")
    members = small(cut(lookups(rooted, segs, False).join(several, ["k", "code"], "left_semi").toDF("k", "code", "b", "root_b")))
    left = lookups(rooted, segs, True).withColumnRenamed("fp", "a").join(members, ["k", "code"]).where(within(radius) & (F.col("root") != F.col("root_b")))
    met = left.select(F.least("root", "root_b").alias("a"), F.greatest("root", "root_b").alias("b")).distinct()
    return roots.toDF("a", "b").unionAll(met)


def tables(fingerprints: int) -> int:
    """How many segments: three, whose keys of 21 bits share an entry with 2^9 others of 2^30 fingerprints; beyond, two of
    32 bits, whose balls are larger but whose entries stay small."""
    return 3 if fingerprints <= 1 << 30 else 2


def near_duplicates(docs: DataFrame, n: int = 4, radius: int = 4, count: int | None = None, crowd: int = 1024) -> DataFrame:
    """(doc_id, fingerprint, component_id): a row for each row of docs (doc_id, text).

    component_id is the smallest doc_id that links of at most `radius` differing bits reach. A null or empty text has
    fingerprint zero and links like any other; a row without doc_id keeps its row and can't be a smallest id; repeated
    rows are links to themselves; an empty table gives no rows. Copies of a fingerprint are one node, so a group of
    copies costs one row in what follows. `count` segments are searched, by default as many as their number asks for.
    """
    fps = cut(fingerprints(docs, n))
    nodes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(forest(nodes.select("fp"), radius, count or tables(nodes.count()), crowd))
    labelled = nodes.withColumnRenamed("fp", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    members = cut(least_of_group(labelled, crowd).withColumnRenamed("node", "fp"))
    return fps.join(members, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, find=near_duplicates, **how) -> DataFrame:
    """docs with one row of each near-duplicate group of `find`: that of the smallest doc_id; rows without doc_id stay.

    Rows with one doc_id are one document, of which one row stays. Texts are shuffled only for such rows, unless the
    ids that go are too many to broadcast.
    """
    found = find(docs, **how).where("doc_id is not null").groupBy("doc_id").agg(F.max("component_id").alias("top"), F.count("*").alias("n"))
    found = cut(found.where("top < doc_id or n > 1").select("doc_id", (F.col("top") < F.col("doc_id")).alias("goes")))
    gone, twice = small(found.where("goes").select("doc_id")), small(found.where("not goes").select("doc_id"))
    kept = docs.join(gone, "doc_id", "left_anti")
    once = kept.join(twice, "doc_id", "left_anti")
    return once.unionByName(kept.join(twice, "doc_id", "left_semi").dropDuplicates(["doc_id"])).select(docs.columns)
