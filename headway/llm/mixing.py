"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import cut, small, words

#: The weights of the sources in order, repeating, and the most times that a source is read.
WEIGHTS, MOST = (1, 2, 3), 3
BLOCK_WORDS = 512
#: The golden ratio's fraction in units of 2**-31, made odd so that multiples visit every unit.
GOLDEN, UNITS = 1327217885, 31
CELL = 20
#: Slots in a chunk and shuffled runs in a source: ranks and sums go chunk by chunk, so no task holds a whole source.
CHUNK, RUNS = 1 << 16, 12


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, h): words of each text and the place in its source's shuffled order."""
    size = F.coalesce(F.size(words(F.col("text"))), F.lit(0)).cast("long")
    found = docs.select("doc_id", "source", F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(size).alias("size"), F.xxhash64("text").alias("_t"))
    return found.select("doc_id", "source", "size", F.xxhash64(F.lit(6), "doc_id", "_t").alias("h"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(sid, source, source_size, target): a row for each source. The one window over all rows here is over sources.

    The weights share all words; a source stops at `most` times its size, and the rest goes on to the others. With
    sources in order of cap / weight, those that stop come first, and one level of words per weight holds for the rest.
    """
    found = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    cap, w = F.col("source_size") * float(most), F.col("w")
    found = found.withColumn("sid", F.row_number().over(order)).withColumn("w", F.get(F.array(*[F.lit(float(x)) for x in weights]), (F.col("sid") - 1) % len(weights)))
    by = Window.orderBy(cap / w, "sid")
    every = Window.partitionBy()
    found = found.withColumns({
        "left": F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "share": F.sum("w").over(by.rowsBetween(0, Window.unboundedFollowing)),
    })
    level = F.col("left") / F.col("share")
    # The first source in this order that doesn't stop sets the level.
    found = found.withColumn("level", F.min(F.when(level * w <= cap, F.struct(cap / w, "sid", level.alias("level")))).over(every)["level"])
    return found.select("sid", "source", "source_size", F.least(cap, F.coalesce(F.col("level") * w, cap)).alias("target"))


def slots(quota: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """(sid, rank, block, words): the schedule; a slot reads so many words of one shuffled block of its source.

    Slot i falls on i times the golden ratio, modulo 1, in the sources' cumulative shares of slots; a source's slots are
    ranked in order, and rank r reads its block r modulo its blocks, the last slot only what is left to the target. The
    points keep each count within a few slots of its share: further ones are dropped, and missing ones close the
    schedule, so that each source meets its target in whole words.
    """
    words_due = F.floor("target").cast("long")
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    q = quota.where("source_size > 0").withColumns({"due": words_due, "blocks": blocks})
    q = q.withColumn("n", (F.floor(F.col("due") / F.col("source_size")) * F.col("blocks") + F.ceil((F.col("due") % F.col("source_size")) / block)).cast("long")).where("n > 0")
    upto = F.sum("n").over(Window.orderBy("sid"))
    unit = float(1 << UNITS)
    q = q.withColumns({"total": F.sum("n").over(Window.partitionBy()), "hi": upto, "lo": upto - F.col("n")})
    q = cut(q.withColumns({c: F.round(F.col(c) / F.col("total") * unit).cast("long") for c in ("lo", "hi")}))
    total = q.agg(F.max("total")).first()[0] or 0
    cells = q.select("sid", "lo", "hi", F.explode(F.sequence(F.shiftright("lo", CELL), F.shiftright(F.greatest("lo", F.col("hi") - 1), CELL))).alias("cell"))
    i = F.col("id")
    u = ((i % (1 << UNITS)) * GOLDEN) % (1 << UNITS)
    points = q.sparkSession.range(total).select(i.alias("i"), u.alias("u")).withColumn("cell", F.shiftright("u", CELL))
    dealt = points.join(small(cells), "cell").where("u >= lo and u < hi").select("sid", "i", F.floor(F.col("i") / CHUNK).alias("chunk"))
    dealt = dealt.withColumn("within", F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("i")))
    chunks = cut(dealt.groupBy("sid", "chunk").agg(F.count("*").alias("n")))
    before = chunks.withColumn("before", F.sum("n").over(Window.partitionBy("sid").orderBy("chunk")) - F.col("n")).select("sid", "chunk", "before")
    ranked = dealt.join(before, ["sid", "chunk"]).select("sid", (F.col("before") + F.col("within") - 1).alias("rank"))
    got = chunks.groupBy("sid").agg(F.sum("n").alias("got"))
    missing = q.join(got, "sid", "left").withColumn("got", F.coalesce("got", F.lit(0).cast("long"))).where("got < n").select("sid", F.explode(F.sequence("got", F.col("n") - 1)).alias("rank"))
    placed = ranked.unionByName(missing).join(small(q.select("sid", "source_size", "due", "blocks", "n")), "sid").where("rank < n")
    placed = placed.withColumn("block", F.col("rank") % F.col("blocks"))
    done = F.floor(F.col("rank") / F.col("blocks")) * F.col("source_size") + F.col("block") * block
    return placed.select("sid", "rank", "block", F.least(F.lit(block).cast("long"), F.col("source_size") - F.col("block") * block, F.col("due") - done).alias("words"))


def block_spans(sizes: DataFrame, quota: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """(sid, doc_id, size, start, block, a, b, source_size, target): the parts of documents in their source's blocks.

    Each source's texts follow each other in the order of h and are cut into blocks of equal words; a and b are places
    in the block. Documents without words have no part.
    """
    q = small(quota.withColumnRenamed("source", "_source"))
    at = sizes.where("size > 0").join(q, F.col("source").eqNullSafe(F.col("_source"))).withColumn("run", F.shiftrightunsigned("h", 64 - RUNS))
    runs = at.groupBy("sid", "run").agg(F.sum("size").alias("words"))
    runs = runs.select("sid", "run", (F.sum("words").over(Window.partitionBy("sid").orderBy("run")) - F.col("words")).alias("before"))
    within = Window.partitionBy("sid", "run").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    at = at.withColumn("upto", F.sum("size").over(within)).join(runs, ["sid", "run"]).withColumn("start", F.col("before") + F.col("upto") - F.col("size"))
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    at = at.withColumn("block", F.explode(F.sequence(first, last)))
    zero = F.col("block") * block
    return at.select("sid", "doc_id", "size", "start", "block", F.greatest(F.lit(0), F.col("start") - zero).alias("a"), F.least(F.lit(block), F.col("start") + F.col("size") - zero).alias("b"), "source_size", "target")


def mix(docs: DataFrame, block: int = BLOCK_WORDS, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): a row for each row of docs (doc_id, text, source).

    taken is the number of the document's words that the schedule's slots read, repeats counted; a source's taken words
    sum to its target's whole part, and no document is read over `most` times. Null and empty texts have size 0 and
    taken 0; null is a source, last in order; repeated rows are documents of their own; an empty table gives no rows.
    """
    sizes = cut(sized(docs))
    quota = cut(targets(sizes, weights, most))
    spans = block_spans(sizes, quota, block)
    read = spans.join(slots(quota, block), ["sid", "block"], "left").withColumn("taken", F.greatest(F.lit(0).cast("long"), F.least("b", "words") - F.col("a")))
    # least() skips nulls, so parts of blocks that no slot reads are told by words.
    taken = read.groupBy("sid", "start", "doc_id", "size", "source_size", "target").agg(F.sum(F.when(F.col("words").isNotNull(), F.col("taken")).otherwise(F.lit(0))).alias("taken"))
    names = small(quota.select("sid", "source"))
    some = taken.join(names, "sid").select("doc_id", "source", "size", "source_size", "target", "taken")
    q = small(quota.withColumnRenamed("source", "_source"))
    none = sizes.where("size = 0").join(q, F.col("source").eqNullSafe(F.col("_source"))).select("doc_id", "source", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
    return some.unionByName(none)
