"""What the operators share: text expressions, lineage cuts, connected components."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words, as contracts state it.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows up to which a table that was counted may be broadcast.
BROADCAST_ROWS = 400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """A copy in the shared checkpoint folder, with no lineage. In local mode a folder is made where the session names none;
    on a cluster, whose executors don't share one of the driver's, that is an error."""
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="headway-"))
    return df.checkpoint(eager=True)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Plans made inside drop the files of their exchanges as they end: for plans that end in cut, of which nothing is
    read again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def small(df: DataFrame, rows: int = BROADCAST_ROWS, weight: Column | None = None) -> DataFrame:
    """The table with a broadcast hint if it has been counted and found small; else as it is, for a shuffled join.

    weight says how many rows a row of varying length counts as.
    """
    n = df.count() if weight is None else df.agg(F.sum(weight)).first()[0] or 0
    return F.broadcast(df) if n <= rows else df


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once: a lambda's variable is bound, while an alias may be inlined."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """Lower case for A-Z alone."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def text_key(*cols: Column) -> Column:
    """Tells rows with one id and other contents apart."""
    return F.xxhash64(*cols)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that the table has no column of."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
        taken.add(n.lower())
    return out


def least_of_group(labelled: DataFrame, crowd: int = 1024) -> DataFrame:
    """(node, component_id) of (node, root, first_id): the least first_id of a root, for each of its nodes.

    A node alone needs no join. Roots of over `crowd` nodes are few, one at most for so many nodes, and are broadcast if
    they have been counted and found small, so a large group meets in no one task; the others are joined by root.
    """
    groups = cut(labelled.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    large = small(groups.where(F.col("n") > crowd).select("root", F.col("component_id").alias("of_large"), F.lit(True).alias("is_large")))
    rows = labelled.join(large, "root", "left")
    found = rows.where("is_large").select("node", F.col("of_large").alias("component_id"))
    rest = rows.where("is_large is null").join(groups.where(F.col("n") <= crowd).select("root", "component_id", "n"), "root", "left")
    return found.unionAll(rest.select("node", F.when(F.col("n").isNull(), F.col("first_id")).otherwise(F.col("component_id")).alias("component_id")))


def components(edges: DataFrame, limit: int = 60, few: int = 100_000, rows: int = 20_000) -> DataFrame:
    """(node, root): the smallest node reachable over edges (a, b) of longs, for each node that has an edge.

    Alternates large-star and small-star contractions, each a partially aggregated minimum and a join; edges never
    outnumber what came in, and a hub's edges are dealt by the other end after the first round. It ends when each edge
    leads from a node with no other to a root, so edges that come as such stars cost no round. The driver keeps account
    of each task: a task reads so many `rows` of the edges at least, if that leaves one for each core, and up to `few`
    nodes the minima are broadcast, which shuffles no edges.
    """
    e, cores = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()), edges.sparkSession.sparkContext.defaultParallelism
    for _ in range(limit):
        ends = F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up")))
        by_node = e.select(F.explode(ends).alias("x")).groupBy("x.node").agg(F.sum("x.up").alias("ups"), F.count(F.lit(1)).alias("n"))
        nodes, n, moving = by_node.agg(F.count(F.lit(1)), F.sum("ups"), F.count_if((F.col("ups") > 0) & (F.col("n") > 1))).first()
        e = e.coalesce(max(cores, (n or 0) // rows + 1))
        if not moving:
            roots = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())
        whole = nodes <= few
        both = e.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x")).select("x.a", "x.b")
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(F.broadcast(low) if whole else low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = large if whole else large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        star = large.join(F.broadcast(low) if whole else low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = cut(star.unionAll(low.select("a", F.col("m").alias("b"))).where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    raise RuntimeError(f"components did not settle in {limit} rounds")
