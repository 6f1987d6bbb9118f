"""Personal data by weak supervision, in DataFrame functions alone: labelers vote, EM weighs them, a classifier decides."""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import cut, let

#: Kinds of spans; the contract's base patterns are of all but the last, secrets such as keys and tokens.
KINDS = ("email", "ip", "card", "phone", "secret")

#: The base patterns. Possessive runs and the looks behind leave the matches as they are; they keep the
#: search linear in long runs of letters or digits.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Further candidates: spelled-out signs, version 6, other separators, and numbers without a country's sign.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[({]at[\])}] ?[A-Za-z0-9-]++(?: ?(?:\.|[\[({]dot[\])}]) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9.])[0-9]{4}(?:[._/][0-9]{4}){2}[._/][0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z.+-])(?:\(0?[0-9]{2,4}\) ?|00[1-9][0-9]?[ -]|0?[0-9]{3}[ -])[0-9]{3,4}[ -][0-9]{3,5}(?![0-9-])",
    "secret": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{16,}+={0,2}",
}
#: What a text must have for a pattern to be searched in it.
HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]{2}|[0-9][ -][0-9]", "phone": r"\+[0-9]"}
LOOSE_HINT = {"email": r"[\[({]at[\])}]", "ip": ":[0-9A-Fa-f]{1,4}:", "card": "[0-9]{4}[._/][0-9]{4}", "phone": "[0-9]{3}[) -]", "secret": "[A-Za-z0-9+/_-]{16}"}

#: Gazetteers: top domains, issuers' and countries' first digits, networks that name nobody.
TOP_DOMAINS = "com org net edu gov mil int info biz io co me tv ai app dev eu uk us ca de fr es it nl be ch at se no fi dk pl pt ru ua cn jp kr in br mx ar au nz za"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|30|36|38|6011|65|62|35)"
COUNTRIES = r"^(?:00)?(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
NOBODY = r"^(?:0|10|127|169\.254|192\.168|255|224)\."
CUES = {
    "email": r"e-?mail|contact|write|reach|correo|courriel|adresse|mailto",
    "ip": r"\bip\b|address|host|server|login|from|client|adresse",
    "card": r"card|visa|master|amex|credit|debit|karte|tarjeta|carte|payment|account",
    "secret": r"token|secret|passw|pwd|api[ _-]?key|\bkey|auth|bearer|credential|private|signature",
    "phone": r"phone|\btel|call|fax|mobile|cell|whatsapp|sms|t[eé]l[eé]|telefon|llam|appel|anruf",
}
#: What known issuers' keys begin with, and the lengths of hexadecimal ones.
ISSUED = r"^(?:AKIA|ASIA|ghp_|gho_|github_pat_|glpat-|sk-|sk_live_|rk_live_|xox[abps]-|eyJ|AIza|npm_|pypi-)|^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64})$"
AGAINST = r"version|\bv\.?$|release|section|chapter|isbn|doi|serial|order|invoice|model|part|\bno\.?$|sum|total|page|port"

LABELERS = ("pattern", "check", "gazetteer", "context", "shape")
ROUNDS, KEEP, POOLED = 40, 0.9, 20.0
#: Characters before a span that count as its context, and hash buckets of shapes.
CONTEXT, SHAPES = 40, 256

SPAN = "array<struct<kind:int,start:int,stop:int,hit:string,near:string,ok:boolean>>"


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(hit: Column) -> Column:
    """Whether the digits' checksum holds."""

    def total(d: Column) -> Column:
        n = F.length(d)
        digit = lambda i: F.substr(d, n - i, F.lit(1)).cast("int")
        twice = lambda x: F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda a, i: a + let(digit(i), lambda x: F.when(i % 2 == 1, twice(x)).otherwise(x)))

    return let(_digits(hit), lambda d: total(d) % 10 == 0)


def holds(kind: str, hit: Column) -> Column:
    """The base rule beyond the pattern."""
    n = F.length(_digits(hit))
    if kind == "ip":
        return F.forall(F.split(hit, r"\."), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.when(n.between(13, 19), luhn(hit)).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def find(text: Column, kind: str, pattern: str, hint: str, rule) -> Column:
    """The spans of a pattern's leftmost matches, none overlapping, in code points.

    Each match comes with the text since the one before, so places are sums of lengths. At \\G the search goes on where
    it stopped, and after the last match it ends.
    """
    whole = rf"(?s)\G(.*?)({pattern})"
    gaps, hits = (F.regexp_extract_all(text, F.lit(whole), F.lit(i)) for i in (1, 2))
    pairs = F.zip_with(gaps, hits, lambda g, h: F.struct(F.length(g).alias("gap"), F.length(h).alias("n"), h.alias("hit"), F.right(g, F.lit(CONTEXT)).alias("near")))
    number = F.lit(KINDS.index(kind))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def add(a: Column, x: Column) -> Column:
        span = F.struct(number.alias("kind"), (a["at"] + x["gap"]).alias("start"), (a["at"] + x["gap"] + x["n"]).alias("stop"), x["hit"].alias("hit"), x["near"].alias("near"), rule(x["hit"]).alias("ok"))
        return F.struct((a["at"] + x["gap"] + x["n"]).alias("at"), F.array_append(a["out"], span).alias("out"))

    found = F.aggregate(pairs, start, add, lambda a: a["out"])
    return F.when(text.rlike(hint), found).otherwise(F.array().cast(SPAN))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, base, loose): arrays of spans for each row of docs; base ones have ok where the rule holds."""
    text = F.coalesce("text", F.lit(""))
    base = F.concat(*[find(text, k, BASE[k], HINT[k], lambda h, k=k: holds(k, h)) for k in BASE])
    loose = F.concat(*[find(text, k, LOOSE[k], LOOSE_HINT[k], lambda h: F.lit(False)) for k in LOOSE])
    clear = lambda f, x: ~F.exists(f["base"], lambda b: b["ok"] & (b["start"] < x["stop"]) & (x["start"] < b["stop"]))
    found = docs.select("doc_id", F.struct(base.alias("base"), loose.alias("loose")).alias("f"))
    return found.select("doc_id", F.col("f.base").alias("base"), F.when(F.size("f.loose") > 0, F.filter("f.loose", lambda x: clear(F.col("f"), x))).otherwise(F.col("f.loose")).alias("loose"))


def votes(span: Column) -> dict[str, Column]:
    """What each labeler says of a span: 1 for personal data, -1 against, 0 for nothing.

    pattern: it has the base pattern's form; check: the rule beyond the form; gazetteer: who issues such; context: words
    before it; shape: how it is written and set off.
    """
    kind, hit, near = span["kind"], span["hit"], F.lower(span["near"])
    n = F.length(_digits(hit))
    by = lambda options: F.coalesce(*[F.when(kind == i, options[k]) for i, k in enumerate(KINDS) if k in options], F.lit(0))
    sign = lambda yes: F.when(yes, F.lit(1)).otherwise(F.lit(-1))
    cue = F.coalesce(*[F.when((kind == i) & near.rlike(CUES[k]), F.lit(1)) for i, k in enumerate(KINDS)], F.when(near.rlike(AGAINST), F.lit(-1)), F.lit(0))
    formed = by({"email": F.when(hit.contains("@"), 1), "ip": F.when(hit.contains("."), 1), "card": F.when(hit.rlike(r"^[0-9 -]+$"), 1), "phone": F.when(hit.startswith("+"), 1), "secret": F.when(near.rlike(r"[=:]\s*[\"'`]?$"), 1)})
    return {
        "pattern": formed,
        "check": by({
            "ip": F.when(hit.contains("."), sign(holds("ip", hit))).otherwise(F.lit(1)),
            "card": F.when(n.between(13, 19), sign(luhn(hit))).otherwise(F.lit(-1)),
            "phone": sign(n.between(9, 15)),
            "secret": sign((n >= 3) & (F.size(F.array_distinct(F.split(hit, ""))) >= 8) & ~hit.rlike(r"/.*/|-.*-.*-")),
        }),
        "gazetteer": by({
            "email": sign(F.lower(F.regexp_extract(hit, "([A-Za-z0-9-]+)$", 1)).isin(*TOP_DOMAINS.split())),
            "ip": sign(~hit.rlike(NOBODY)),
            "card": sign(_digits(hit).rlike(ISSUERS)),
            "phone": sign(_digits(hit).rlike(COUNTRIES)),
            "secret": F.when(hit.rlike(ISSUED), F.lit(1)).otherwise(F.lit(0)),
        }),
        "context": cue,
        "shape": by({
            "email": sign(hit.rlike("^[A-Za-z0-9]") & hit.rlike("[A-Za-z]")),
            "ip": sign(~near.rlike(r"[0-9A-Za-z.]$")),
            "card": sign(hit.rlike(r"^[0-9]{13,19}$|^[0-9]{4}(?:[ ._/-][0-9]{4}){2}[ ._/-][0-9]{1,7}$|^3[0-9]{3}[ -][0-9]{6}[ -][0-9]{5}$") & ~near.rlike(r"[0-9A-Za-z.]$")),
            "phone": sign(hit.rlike(r"[ ().-]") & ~hit.rlike(r"[ ().-]{4}")),
            "secret": sign(~hit.rlike(r"[A-Za-z]{8}") & ~near.rlike(r"[/.@]$")),
        }),
    }


def expectation_maximisation(patterns: list[tuple[int, tuple[int, ...], int]], rounds: int = ROUNDS) -> dict[tuple[int, tuple[int, ...]], float]:
    """The chance that a span is personal data, for each (kind, votes), of (kind, votes, how many).

    Each labeler has, for each kind, a chance of each vote given the truth (drawn to its chance over all kinds by POOLED votes); with the truth hidden, EM estimates these and each kind's
    share from the agreement of the votes, starting from the majority. At most 5 * 3**5 patterns: a table on the driver.
    """
    p = {(k, v): min(0.95, max(0.05, 0.5 + 0.15 * sum(v))) for k, v, _ in patterns}
    for _ in range(rounds):
        share: dict[int, list[float]] = {}
        says: dict[tuple[int, int, int, int], float] = {}
        for k, v, n in patterns:
            for truth, q in ((1, p[k, v]), (0, 1 - p[k, v])):
                share.setdefault(k, [1.0, 1.0])[truth] += n * q
                for j, x in enumerate(v):
                    says[k, j, truth, x] = says.get((k, j, truth, x), 0.0) + n * q
        pooled: dict[tuple[int, int, int], float] = {}
        for (_, j, t, x), n in says.items():
            pooled[j, t, x] = pooled.get((j, t, x), 0.0) + n
        total = {(k, j, t): sum(says.get((k, j, t, x), 0.0) for x in (-1, 0, 1)) for k in share for j in range(len(LABELERS)) for t in (0, 1)}

        def rate(k: int, j: int, t: int, x: int) -> float:
            common = (pooled.get((j, t, x), 0.0) + 1) / (sum(pooled.get((j, t, y), 0.0) for y in (-1, 0, 1)) + 3)
            return (says.get((k, j, t, x), 0.0) + POOLED * common) / (total[k, j, t] + POOLED)

        for k, v, _ in patterns:
            odds = log(share[k][1] / share[k][0]) + sum(log(rate(k, j, 1, x) / rate(k, j, 0, x)) for j, x in enumerate(v))
            p[k, v] = 1 / (1 + pow(2.718281828459045, -max(-50.0, min(50.0, odds))))
    return p


def _features(span: Column) -> Column:
    """The classifier's features: (name, value) strings of a bounded number."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(span["hit"], "[0-9]+", "9"), "[A-Za-z]+", "a"), "(?:9.)+", "9.")
    last = F.regexp_replace(F.regexp_replace(F.right(span["near"], F.lit(1)), r"[A-Za-z0-9]", "w"), r"[^w\s]", "p")
    value = lambda name, x: F.concat_ws("=", F.lit(name), span["kind"].cast("string"), x.cast("string"))
    return F.array(
        value("length", F.least(F.length(span["hit"]), F.lit(40))),
        value("shape", F.pmod(F.xxhash64(shape), F.lit(SHAPES))),
        value("last", F.coalesce(F.ascii(last), F.lit(0))),
        *[value(name, vote) for name, vote in votes(span).items() if name != "pattern"],
    )


def classifier(spans: DataFrame) -> tuple[dict[str, float], dict[int, float]]:
    """(log odds of each feature, prior log odds of each kind), trained on all spans, each weighed by its EM chance."""
    voted = spans.select("span", *[v.alias(n) for n, v in votes(F.col("span")).items()])
    counted = voted.groupBy(F.col("span.kind").alias("kind"), *LABELERS).count().collect()  # 5 * 3**5 rows at most
    chance = expectation_maximisation([(r.kind, tuple(r[n] for n in LABELERS), r["count"]) for r in counted])
    if not chance:
        return {}, {}
    spark = spans.sparkSession
    known = F.broadcast(spark.createDataFrame([(k, *v, p) for (k, v), p in chance.items()], f"kind int, {', '.join(f'{n} int' for n in LABELERS)}, p double"))
    soft = voted.withColumn("kind", F.col("span.kind")).join(known, ["kind", *LABELERS]).select("kind", "p", F.explode(_features(F.col("span"))).alias("feature"))
    rows = soft.groupBy("kind", "feature").agg(F.sum("p").alias("a"), F.sum(1 - F.col("p")).alias("b")).collect()  # bounded by the features' values
    whole: dict[int, list[float]] = {}
    for r in rows:
        if r.feature.startswith("length="):
            w = whole.setdefault(r.kind, [1.0, 1.0])
            w[0], w[1] = w[0] + r.a, w[1] + r.b
    odds = {r.feature: log((r.a + 0.5) / (whole[r.kind][0] + 1)) - log((r.b + 0.5) / (whole[r.kind][1] + 1)) for r in rows}
    return odds, {k: log(a / b) for k, (a, b) in whole.items()}


def detect(docs: DataFrame, keep: float = KEEP) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, n_spans): a row for each row of docs (doc_id,
    text).

    The counts and the digest are of the base spans, which all stay; spans has those and the candidates that the trained
    classifier gives a chance of at least `keep`, unless their rule (checksum, range, length) is broken or the words before
    speak against them; n_spans is the
    number of all. Null and empty texts have none; repeated rows each get theirs; without any candidate nothing is added.
    """
    found = cut(candidates(docs))
    every = found.select(F.explode(F.concat("base", "loose")).alias("span"))
    odds, prior = classifier(every)

    def score(span: Column) -> Column:
        total = F.coalesce(*[F.when(span["kind"] == k, F.lit(v)) for k, v in prior.items()], F.lit(-99.0))
        table = F.create_map(*[F.lit(x) for kv in odds.items() for x in kv])
        return F.aggregate(_features(span), total, lambda a, f: a + F.coalesce(F.try_element_at(table, f), F.lit(0.0)))

    ok = F.filter("base", lambda s: s["ok"])
    if odds:
        wanted = log(keep / (1 - keep))
        rest = F.concat(F.filter("base", lambda s: ~s["ok"]), F.col("loose"))
        added = F.filter(rest, lambda s: F.when((votes(s)["check"] >= 0) & (votes(s)["context"] >= 0), score(s) >= wanted).otherwise(F.lit(False)))
    else:
        added = F.array().cast(SPAN)
    line = lambda s: F.array_join(F.transform(F.array_sort(F.transform(s, lambda x: F.struct(x["kind"].alias("k"), x["start"].alias("a"), x["stop"].alias("b")))), lambda x: F.concat_ws(":", F.get(F.array(*[F.lit(k) for k in KINDS]), x["k"]), x["a"].cast("string"), x["b"].cast("string"))), ",")
    out = found.select("doc_id", ok.alias("ok"), added.alias("added"))
    count = lambda i: F.size(F.filter("ok", lambda s: s["kind"] == i)).cast("long")
    return out.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS) if k in BASE], F.sha2(line(F.col("ok")), 256).alias("base_sha256"), line(F.concat("ok", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"), (F.size("ok") + F.size("added")).cast("long").alias("n_spans"))
