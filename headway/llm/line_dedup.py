"""Removing lines that repeat in overlapping three-line windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import cut, fresh, let, small, text_key

LINES = 3
BLANK = " \t\r\x0b\x0c"


def _lines() -> Column:
    return F.split(F.coalesce("text", F.lit("")), "\n")


def _full(x: Column) -> Column:
    """The places of the lines that aren't blank."""
    return F.filter(F.transform(x, lambda s, i: F.when(F.trim(s, F.lit(BLANK)) != "", i)), lambda i: i.isNotNull())


def windows(docs: DataFrame, n: int = LINES) -> DataFrame:
    """(doc_id, _key, w1, w2, at): the overlapping windows of n lines, by two hashes; blank lines don't count."""

    def found(h: Column) -> Column:
        both = lambda j: [F.xxhash64(*[F.get(h, j + d)[c] for d in range(n)]) for c in ("a", "b")]
        return F.when(F.size(h) >= n, F.transform(F.sequence(F.lit(0), F.size(h) - n), lambda j: F.struct(both(j)[0].alias("w1"), both(j)[1].alias("w2"), j.alias("at"))))

    trimmed = F.filter(F.transform(_lines(), lambda s: F.trim(s, F.lit(BLANK))), lambda s: s != "")
    hashed = F.transform(trimmed, lambda s: F.struct(F.xxhash64(s).alias("a"), F.xxhash64(F.lit(8), s).alias("b")))
    return docs.select("doc_id", text_key(F.col("text")).alias("_key"), F.explode(let(hashed, found)).alias("w")).select("doc_id", "_key", "w.*")


def later(docs: DataFrame, n: int = LINES) -> DataFrame:
    """(doc_id, _key, at): for each document, where windows begin that occur earlier, by doc_id and then by place."""
    w = windows(docs, n)
    place = F.struct("doc_id", "_key", "at")
    first = w.groupBy("w1", "w2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").select("w1", "w2", "first")
    again = w.join(first, ["w1", "w2"]).where(~place.eqNullSafe(F.col("first")))
    return again.groupBy("doc_id", "_key").agg(F.collect_set("at").alias("at"))


def dedup(docs: DataFrame, n: int = LINES) -> DataFrame:
    """docs (doc_id, text, ...) with texts changed and two columns more, n_lines and n_removed.

    A line goes if it lies in a window of n non-blank lines (trimmed) that occurs earlier in the corpus: in a smaller
    doc_id, or further up in the text. Any line that goes has an equal line earlier that stays. Blank lines stay and
    break no window. A null text stays null; texts of fewer lines stay whole; rows with one doc_id and one text are one
    document, as they came; of rows with one doc_id and other texts, any may be the earlier, but always the same.
    """
    n_lines, n_removed = "n_lines", "n_removed"
    rows = docs.select(*[c for c in docs.columns if c not in (n_lines, n_removed)])
    id_, key_, at_, new_ = fresh(rows, "_id", "_key", "_at", "_new")
    found = cut(later(docs, n).select(F.col("doc_id").alias(id_), F.col("_key").alias(key_), F.col("at").alias(at_)))
    found = small(found, weight=1 + F.size(at_) / 4)
    key = text_key(F.col("text"))
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col(id_)) & (key == F.col(key_)), "left")

    def kept(x: Column) -> Column:
        cover = let(_full(x), lambda p: F.array_distinct(F.flatten(F.transform(at_, lambda a: F.slice(p, a + 1, n)))))
        stay = F.array_except(F.sequence(F.lit(0), F.size(x) - 1), cover)
        return F.struct(F.array_join(F.transform(stay, lambda i: F.get(x, i)), "\n").alias("text"), F.size(x).alias("n"), (F.size(x) - F.size(stay)).alias("gone"))

    joined = joined.withColumn(new_, F.when(F.col(at_).isNotNull(), let(_lines(), kept)))
    out = {"text": F.when(F.col(new_).isNull(), F.col("text")).otherwise(F.col(f"{new_}.text"))}
    count = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(F.split("text", "\n")))
    return joined.select(*[out.get(c, F.col(f"`{c}`")).alias(c) for c in rows.columns], count.cast("long").alias(n_lines), F.coalesce(f"{new_}.gone", F.lit(0)).cast("long").alias(n_removed))
