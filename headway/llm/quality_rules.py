"""Document quality rules with host-level verdicts, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import cut, let, small, words

#: The base rules.
WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT, SYMBOLS = 8, 20, 30, "#*$%&|<>"
SPACE = r"[\x20\x09-\x0D]+"

#: A host is blocked above this shrunk rate of failing documents; below TRUST a rule's failure there is a false alarm.
BLOCK, TRUST = 0.5, 0.01


def repeated_words(h: Column, n: int = WINDOW) -> Column:
    """How many of the hashed words lie in an n-word window that the array holds twice or more."""

    def covered(g: Column) -> Column:
        ordered = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        twice = let(ordered, lambda s: F.transform(F.filter(s, lambda e, i: (F.get(s, i - 1)["x"] == e["x"]) | (F.get(s, i + 1)["x"] == e["x"])), lambda e: e["i"]))
        return F.aggregate(
            F.sort_array(twice),
            F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
            lambda a, s: F.struct((a["n"] + s + n - F.greatest(a["end"], s)).alias("n"), (s + n).alias("end")),
            lambda a: a["n"],
        )

    grams = F.transform(F.sequence(F.lit(0), F.size(h) - n), lambda i: F.xxhash64(*[F.get(h, i + d) for d in range(n)]))
    found = let(grams, lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), covered(g)).otherwise(F.lit(0)))
    return F.when(F.size(h) > n, found).otherwise(F.lit(0))


def measures(docs: DataFrame) -> DataFrame:
    """(doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines) of doc_id, text and source."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = let(F.transform(words(text), lambda w: F.xxhash64(w)), lambda h: F.struct(F.size(h).alias("n_words"), repeated_words(h).alias("n_repeat_words")))
    lined = let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    found = docs.select(
        "doc_id",
        F.col("source").alias("host"),
        counted.alias("c"),
        F.length(F.regexp_replace(text, SPACE, "")).alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("n_symbols"),
        lined.alias("l"),
    )
    counts = {"n_words": "c.n_words", "word_chars": "word_chars", "n_symbols": "n_symbols", "n_dup_lines": "l.n_dup_lines", "n_repeat_words": "c.n_repeat_words", "n_lines": "l.n_lines"}
    return found.select("doc_id", "host", *[F.col(c).cast("long").alias(n) for n, c in counts.items()])


def failures() -> dict[str, Column]:
    """The rules by name: true where a measured document fails."""
    chars, n = F.col("word_chars"), F.col("n_words")
    return {
        "base": (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n),
        "symbols": 10 * F.col("n_symbols") > chars,
        "lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "length": (chars < 2 * n) | (chars > 20 * n),
    }


def host_rates(found: DataFrame) -> DataFrame:
    """(host, docs, rate_<rule>..., rate_any): failure rates by host, shrunk by a beta prior fitted over all hosts.

    The prior has the mean and variance of the hosts' own rates (the method of moments); a host of few documents stays
    near the mean. Where hosts don't vary, the prior counts as PRIOR_MOST documents.
    """
    rules = failures()
    rules["any"] = rules["base"] | rules["symbols"] | rules["lines"] | rules["length"]
    hosts = found.groupBy("host").agg(F.count("*").alias("docs"), *[F.count_if(c).alias(f"n_{r}") for r, c in rules.items()])
    hosts = cut(hosts)
    rate = {r: F.col(f"n_{r}") / F.col("docs") for r in rules}
    spread = hosts.agg(*[x for r in rules for x in (F.avg(rate[r]).alias(f"m_{r}"), F.coalesce(F.var_pop(rate[r]), F.lit(0.0)).alias(f"v_{r}"))]).first()
    out = [F.col("host"), F.col("docs")]
    for r in rules:
        m, v = spread[f"m_{r}"] or 0.0, spread[f"v_{r}"]
        weight = min(PRIOR_MOST, max(1.0, m * (1 - m) / v - 1)) if v > 0 else PRIOR_MOST
        out.append(((F.col(f"n_{r}") + m * weight) / (F.col("docs") + weight)).alias(f"rate_{r}"))
    return hosts.select(*out)


PRIOR_MOST = 1000.0


def judge(docs: DataFrame, block: float = BLOCK, trust: float = TRUST) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, host_blocked): a row for
    each row of docs (doc_id, text, source).

    The host of a document is its source. A document goes if it fails a base rule, if its host is blocked, or if it
    fails a further rule that its host isn't trusted on. A null text has no words and fails; null sources are one host;
    repeated rows count each; an empty table gives no rows.
    """
    found = cut(measures(docs))
    hosts = small(host_rates(found).withColumnRenamed("host", "_host"))
    rules = failures()
    against = F.lit(False)
    for r in ("symbols", "lines", "length"):
        against = against | (rules[r] & (F.col(f"rate_{r}") >= trust))
    blocked = F.col("rate_any") > block
    joined = found.join(hosts, F.col("host").eqNullSafe(F.col("_host")), "left")
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", rules["base"].alias("base_failed"), (~rules["base"] & ~against & ~blocked).alias("kept"), blocked.alias("host_blocked"))
