"""Quality by importance resampling: hashed n-gram models of wanted and of all text, sampled by Gumbel top-k."""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import cut, small, text_key

#: Buckets of hashed n-grams, in two tables of half each, and so the length of what the driver holds of either model.
BUCKETS = 1 << 20
#: At most so many labelled rows teach the models; which, a hash of their ids decides.
LABELLED = 200_000
#: Standard deviations from which on a bucket's ratio counts: held-out labels choose one, as more text takes a stricter
#: one. Pseudo-documents in each bucket; a lost good document costs so many bad ones kept; what weights are divided by
#: before noise is added.
SIGNIFICANT = (3.0, 4.0, 5.0)
PSEUDO, GOOD_COST, TEMPERATURE = 4.0, 10.0, 0.25
#: Steps per unit of a sampling key, and bins in which the k-th largest is looked for.
STEP, BINS = 1 << 20, 4096


#: A token is a run of letters and digits or one of marks.
TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+|[^\x00-\x200-9a-z\x80-\xff]+")


def ngrams(text: str | None) -> np.ndarray:
    """The buckets of a text's distinct tokens and token pairs, A-Z in lower case: a row for each of the two tables.

    A token that repeats the one before counts as a mark of how long the run is, in powers of two, so that any stutter
    has the same features.
    """
    tokens = TOKEN.findall((text or "").encode("utf-8", "surrogatepass").lower())
    h = np.fromiter(map(crc32, tokens), np.uint64, len(tokens))
    at = np.arange(len(h))
    run = at - np.maximum.accumulate(np.where(np.r_[True, h[1:] != h[:-1]][: len(h)], at, 0))
    h[run > 0] = np.uint64(1 << 33) + np.log2(run[run > 0]).astype(np.uint64)
    pair = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
    one = np.concatenate([h * np.uint64(0xD6E8FEB86659FD93), (pair ^ (pair >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)])
    one = np.unique(one)
    two = (one ^ (one >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    bits = np.uint64(64 - (BUCKETS // 2).bit_length() + 1)
    return np.stack([one >> bits, (two >> bits) + np.uint64(BUCKETS // 2)]).astype(np.int64)


def weigh(found: np.ndarray, ratios: np.ndarray) -> list[float]:
    """For each row of ratios, the sum of the n-grams' log ratios, each the one nearer to zero of its two buckets, as one
    may be shared."""
    return ratios[:, found].max(axis=1).sum(axis=1, dtype=np.float64).tolist()


def labelled(labels: DataFrame, most: int = LABELLED) -> DataFrame:
    """(doc_id, good, fold): at most about `most` labels. good: of quality and not toxic; any label against it wins."""
    n = labels.count()
    part = labels if n <= most else labels.where(F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(1_000_003)) < int(1_000_003 * most / n))
    good = (F.coalesce("quality", F.lit(0)) == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    part = part.where("doc_id is not null").groupBy("doc_id").agg(F.min(good).alias("good"))
    return part.withColumn("fold", F.pmod(F.xxhash64(F.lit(2), "doc_id"), F.lit(5)))


def _with_labels(docs: DataFrame, known: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id", "left")  # bounded by LABELLED


def model(docs: DataFrame, known: DataFrame) -> np.ndarray:
    """Log ratios by bucket of the wanted documents' model to all documents' model, a row for each of SIGNIFICANT.

    Each bucket counts the documents that hold its n-grams: in the raw model all of them, in the target model the good
    labelled ones of folds 1-4. A pseudo-count pulls rare buckets to zero, and ratios that chance may explain are zero,
    so small differences don't add up over a long text. All text holds the wanted text, so a ratio over one says little
    (it is bounded by the wanted share's inverse) and many of them would outweigh clear signs against: they are zero.
    """

    def count(batches):
        raw, want = np.zeros(BUCKETS + 1, np.int64), np.zeros(BUCKETS + 1, np.int64)
        for b in batches:
            for text, good in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = np.unique(ngrams(text))
                raw[found] += 1
                raw[BUCKETS] += 1
                if good:
                    want[found] += 1
                    want[BUCKETS] += 1
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(want[at])], ["bucket", "raw", "want"])

    rows = _with_labels(docs, known).select("text", (F.coalesce("good", F.lit(False)) & (F.col("fold") > 0)).alias("good"))
    counts = cut(rows.mapInArrow(count, "bucket long, raw long, want long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("want").alias("want")))
    total = counts.where(F.col("bucket") == BUCKETS).first()
    ratios = np.zeros((len(SIGNIFICANT), BUCKETS), np.float32)
    if total and total.want:
        part = total.want / total.raw
        expected = F.col("raw") * part
        away = (expected - F.col("want")) / F.sqrt(expected * (1 - part) + 1e-9)
        clear = counts.where(F.col("bucket") < BUCKETS).select("bucket", away.alias("away"), F.log((F.col("want") + PSEUDO) / (expected + PSEUDO)).alias("ratio"))
        for r in clear.where(F.col("away") > SIGNIFICANT[0]).toLocalIterator():
            ratios[[k for k, z in enumerate(SIGNIFICANT) if r.away > z], r.bucket] = r.ratio
    return ratios


def log_weights(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """(doc_id, _key, log_weights): the summed log ratios of each row's n-grams, for each row of ratios."""
    sent = docs.sparkSession.sparkContext.broadcast(ratios)  # a few times BUCKETS floats

    def run(batches):
        for b in batches:
            w = [weigh(ngrams(t), sent.value) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(1), pa.array(w, pa.list_(pa.float64()))], ["doc_id", "_key", "log_weights"])

    return docs.select("doc_id", text_key(F.col("text")).alias("_key"), "text").mapInArrow(run, "doc_id long, _key long, log_weights array<double>")


def least_good(weights: DataFrame, known: DataFrame) -> tuple[int, float]:
    """(which of the log weights, and the least good one): what best parts good from bad labelled rows of fold 0, which no
    model saw; (0, -inf) if none of them are bad."""
    rows = weights.join(F.broadcast(known.where("fold = 0")), "doc_id").select("log_weights", "good").toPandas()  # bounded by LABELLED
    good = rows.good.to_numpy(dtype=bool)
    if good.all():
        return 0, float("-inf")
    best = (0.0, 0, float("-inf"))
    for k, w in enumerate(np.array(rows.log_weights.tolist()).T):
        order = np.argsort(w, kind="stable")
        x, g = w[order], good[order]
        gain = np.cumsum(~g) / (~good).sum() - GOOD_COST * np.cumsum(g) / max(1, good.sum())
        gain[:-1][x[1:] == x[:-1]] = -np.inf  # equal weights stay together
        at = int(np.argmax(gain))
        if gain[at] > best[0]:
            best = (float(gain[at]), k, float(x[at] + x[at + 1]) / 2 if at + 1 < len(x) else float(x[at]) + 1e-6)
    return best[1:]


def gumbel(*key: str) -> Column:
    """Standard Gumbel noise that the columns' hash decides, so that reruns agree."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(3), *key), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def kth_largest(df: DataFrame, col: str, k: int) -> int | None:
    """The k-th largest of a long column, by counts in ever smaller bins; None if there are fewer."""
    lo, hi, n = df.agg(F.min(col), F.max(col), F.count(col)).first()
    if n < k or k < 1:
        return None
    while lo < hi:
        width = -(-(hi - lo + 1) // BINS)
        bins = df.where(F.col(col).between(lo, hi)).groupBy(F.expr(f"({col} - {lo}L) div {width}L").alias("bin")).count().collect()  # BINS rows
        for b in sorted(bins, key=lambda r: -r["bin"]):
            if k <= b["count"]:
                lo, hi = lo + b["bin"] * width, min(hi, lo + (b["bin"] + 1) * width - 1)
                break
            k -= b["count"]
    return lo


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, _key, log_weight, sample_key, kept): a row for each row of docs (doc_id, text).

    k documents are wanted: as many as have a log weight that held-out labels call good. Those of the k largest sample
    keys, log weights sharpened by the temperature plus Gumbel noise, are kept, and any that tie with the last. Without
    labels, or without good ones, all weigh the same; without bad ones, all are kept. Null and empty texts have weight
    zero; repeated rows share a key and a verdict; labels of unknown documents teach nothing.
    """
    known = cut(labelled(labels))
    ratios = model(docs, known)
    weights = cut(log_weights(docs, ratios))
    which, bound = least_good(weights, known)
    noisy = F.col("log_weight") / TEMPERATURE + gumbel("doc_id", "_key")
    scored = weights.select("doc_id", "_key", F.get("log_weights", F.lit(which)).alias("log_weight")).withColumn("sample_key", F.round(noisy * STEP).cast("long"))
    k = scored.where(F.col("log_weight") >= bound).count()
    last = kth_largest(scored, "sample_key", k)
    kept = F.lit(False) if last is None else F.col("sample_key") >= last
    return scored.withColumn("kept", kept)


def resample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, log_weight, sample_key, kept): the sample, a row for each document that is kept."""
    return verdicts(docs, labels).where("kept").select("doc_id", "log_weight", "sample_key", "kept")


def accept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the sample keeps."""
    gone = small(cut(verdicts(docs, labels).where("not kept").select(F.col("doc_id").alias("_id"), "_key").distinct()))
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_id"]) & (text_key(docs["text"]) == gone["_key"]), "left_anti")
