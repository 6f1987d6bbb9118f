"""Benchmark decontamination by winnowed fingerprints, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import ascii_lower, cut, let, small, text_key

#: A word, once A-Z are lower case.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPAN = 10


def hashed_words(text: Column) -> Column:
    """A long for each word of the text; none for null."""
    found = F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))
    return F.coalesce(F.transform(found, lambda w: F.xxhash64(w)), F.array().cast("array<long>"))


def _gram(span: int) -> int:
    """Words in a fingerprint, for spans of so many words: any two spans' halves cover them."""
    return (span + 1) // 2


def winnowed(h: Column, span: int) -> Column:
    """array<struct<span, fp, start, spans>>: the fingerprints chosen in an array of word hashes.

    Each span of `span` words holds span - k + 1 k-grams and chooses their least hash. Neighbouring spans mostly agree;
    each run of spans with one choice becomes one entry, with the hashes of its spans from the word `start` on. Equal
    spans choose alike, so all spans that two texts share meet in equal fp.
    """
    k = _gram(span)
    n = F.size(h)

    def runs(g):
        least = F.transform(F.sequence(F.lit(0), n - span), lambda s: F.array_min(F.slice(g, s + 1, span - k + 1)))
        return let(least, lambda p: let(F.filter(F.sequence(F.lit(0), n - span), lambda s: (s == 0) | (F.get(p, s) != F.get(p, s - 1))), lambda first: F.transform(first, lambda s, i: F.struct(
            F.lit(span).alias("span"),
            F.get(p, s).alias("fp"),
            s.alias("start"),
            F.transform(F.sequence(s, F.coalesce(F.get(first, i + 1), n - span + 1) - 1), lambda j: F.xxhash64(F.get(g, j), F.get(g, j + (span - k)))).alias("spans"),
        ))))

    grams = F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[F.get(h, i + d) for d in range(k)]))
    return F.when(n >= span, let(grams, runs)).otherwise(F.array().cast("array<struct<span:int,fp:long,start:int,spans:array<long>>>"))


def benchmark_spans(benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """(span, fp, word_span, items): the distinct spans of the items; an item of fewer words is one span."""
    h = benchmark.select(F.col("item_id").cast("string").alias("item"), let(hashed_words(F.col("text")), lambda h: F.when(F.size(h) >= span, winnowed(h, span)).otherwise(F.coalesce(*[F.when(F.size(h) == m, winnowed(h, m)) for m in range(1, span)], winnowed(h, span)))).alias("runs"))
    rows = h.select("item", F.explode("runs").alias("r")).select("item", "r.span", "r.fp", F.explode("r.spans").alias("word_span"))
    return rows.groupBy("span", "fp", "word_span").agg(F.sort_array(F.collect_set("item")).alias("items"))


def hits(docs: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, _key, n_words, n_hit, items, places): a row for each row of docs; places are (start, span) of shared spans,
    and _key tells texts of one doc_id apart."""
    known = cut(benchmark_spans(benchmark, span))
    lengths = sorted(r[0] for r in known.select("span").distinct().collect())  # at most `span` numbers
    chosen = small(known.select("span", "fp", F.lit(True).alias("chosen")).distinct())
    known = small(known, weight=1 + F.size("items"))
    marker = lambda h: F.array(F.struct(F.lit(0).alias("span"), F.xxhash64("doc_id", "_key").alias("fp"), F.size(h).alias("start"), F.array(F.lit(0).cast("long")).alias("spans")))
    runs = docs.select("doc_id", "text").select("doc_id", text_key(F.col("text")).alias("_key"), "text")
    runs = runs.select("doc_id", "_key", F.explode(let(hashed_words(F.col("text")), lambda h: F.concat(marker(h), *[winnowed(h, m) for m in lengths]))).alias("r")).select("doc_id", "_key", "r.*")
    # Runs whose fingerprint the benchmark chose are extended to their spans, and those are looked up whole; the row of
    # span 0 stands for the document itself.
    met = runs.join(chosen, ["span", "fp"], "left").where("span = 0 or chosen")
    met = met.select("doc_id", "_key", "span", "fp", "start", F.posexplode("spans").alias("i", "word_span")).join(known, ["span", "fp", "word_span"], "left").where("span = 0 or items is not null")
    met = met.select("doc_id", "_key", "span", "start", "items", (F.col("start") + F.col("i")).alias("at"))
    own = F.col("span") == 0
    found = met.groupBy("doc_id", "_key").agg(
        F.count(F.when(own, 1)).alias("copies"),
        F.max(F.when(own, F.col("start"))).cast("long").alias("n_words"),
        F.sort_array(F.collect_set(F.when(~own, F.struct(F.col("at").alias("start"), "span")))).alias("places"),
        F.collect_set(F.when(~own, F.col("items"))).alias("item_sets"),
    )
    covered = F.aggregate(
        "places",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda a, p: F.struct((a["n"] + F.greatest(F.lit(0), p["start"] + p["span"] - F.greatest(a["end"], p["start"]))).cast("long").alias("n"), F.greatest(a["end"], p["start"] + p["span"]).alias("end")),
        lambda a: a["n"],
    )
    found = found.select("doc_id", "_key", "copies", "n_words", covered.alias("n_hit"), F.array_sort(F.array_distinct(F.flatten("item_sets"))).alias("items"), "places")
    return found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies", "_copy")


def report(docs: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated): a row for each row of docs (doc_id, text).

    Null and empty texts have no words and no hits; an empty benchmark leaves all clean; items without words match
    nothing; repeated rows each get their row; an item without item_id still hits but has no name to count.
    """
    found = hits(docs, benchmark, span)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """docs without the rows that share a span with the benchmark; others with their doc_id, or without one, stay."""
    found = hits(docs, benchmark, span).where("n_hit > 0")
    dirty = small(cut(found.select(F.col("doc_id").alias("_id"), "_key").distinct()))
    return docs.join(dirty, (text_key(docs["text"]) == dirty["_key"]) & docs["doc_id"].eqNullSafe(dirty["_id"]), "left_anti")
