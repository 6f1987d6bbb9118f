"""Main text of web pages: the best-scoring contiguous run of words and tags."""

from __future__ import annotations

import html
import re
from bisect import bisect
from collections import Counter
from collections.abc import Iterator
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: At most about so many pages teach the weights; which, a hash of their ids decides.
LABELLED = 20_000
#: What a word is worth, a tag that says nothing, and the most that a tag can cost.
WORD_SCORE, TAG_SCORE, TAG_MOST = 1.0, -0.01, 40.0

#: Elements whose inside is no text, that are no part of an article, and that are inside a line.
RAW = {"script", "style", "template", "svg", "iframe", "noscript", "textarea", "select", "canvas", "object", "video", "audio", "title", "xmp", "noembed", "noframes", "datalist"}
ASIDE = {"nav", "footer", "aside", "form", "dialog", "menu", "button", "head", "fieldset", "input", "option"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "rb", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Words in class, id or role that name what is no part of an article, and what turns that around.
NOT_ARTICLE = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "commentlist", "complementary", "contentinfo", "cookie", "cookies", "consent", "dialog", "disclaimer", "disqus", "footer", "form", "gdpr", "hidden", "login", "masthead", "menu", "menubar", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pager", "pagination", "popup", "promo", "promoted", "promotion", "related", "replies", "reply", "respond", "recommended", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget", "widgets", "alert", "respondents", "teaser"}
HAS = {"with", "has", "no", "without"}
#: Words that may stand next to those in a name without changing what it names.
PLACES = {"bar", "block", "bottom", "box", "button", "buttons", "center", "container", "content", "form", "global", "header", "inline", "inner", "item", "items", "left", "link", "links", "list", "main", "mobile", "nav", "outer", "page", "panel", "right", "section", "side", "site", "slot", "small", "text", "title", "top", "unit", "wrap", "wrapper", "area", "policy", "posts", "articles", "stories", "thread", "count", "icon", "icons", "media", "us", "up", "to"}

#: What a page has whose markup may name its article.
MARKED = r"(?i)<(?:article|main)[\s>]|articlebody"
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)", re.S)
NAMES = re.compile(r"(?:^|[\s\"'])(class|id|role|itemprop|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, value) in page order: kinds are text, open and close; comments are left out, and so is all inside
    raw elements but for the end tag that ends them."""
    at, n = 0, len(page)
    while at < n:
        tag = TOKEN.search(page, at)
        if not tag:
            break
        if tag.start() > at:
            yield "text", "", page[at : tag.start()]
        at = tag.end()
        if tag.group(0).startswith("<![CDATA["):
            yield "text", "", html.escape(tag.group(0)[9:].removesuffix("]]>"))
        if not tag.group(2):
            continue
        name = tag.group(2).lower()
        yield "close" if tag.group(1) else "open", name, tag.group(3)
        if name in RAW and not tag.group(1) and not tag.group(3).endswith("/"):
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = end.start() if end else n
    if at < n:
        yield "text", "", page[at:]


def names_an_aside(value: str) -> bool:
    """Whether a class, id or role names what is no part of an article: by its words alone, but for such as may stand next
    to them. related is such a name, and related-posts; related-work is not."""
    words = {x.lower() for x in PART.findall(value) if not x.isdigit()}
    return bool(words & NOT_ARTICLE) and not words & HAS and words <= NOT_ARTICLE | PLACES


def keys(name: str, attributes: str) -> tuple[str, bool]:
    """What a tag is weighed by, and whether its names say that it is no part of an article."""
    found: set[str] = set()
    aside = False
    for what, *values in NAMES.findall(attributes) if "=" in attributes or "hidden" in attributes else ():
        value = "".join(values)
        if what.lower() in ("hidden", "aria-hidden"):
            if value.lower() != "false":
                found.add("hidden")
                aside = True
        else:
            found.update(x.lower() for x in PART.findall(value))
            aside = aside or any(map(names_an_aside, value.split()))
    return (f"{name}.{' '.join(sorted(found))}" if found else name), aside


class Tag:
    __slots__ = ("key", "aside", "block")

    def __init__(self, key: str, aside: bool, block: bool):
        self.key, self.aside, self.block = key, aside, block


def parse(page: str) -> list[str | Tag]:
    """Texts and tags; texts inside what is no part of an article are left out.

    An element is left out up to the end tag that matches it; one that is never ended only if it is a raw one or of a
    kind that ends pages, else a forgotten end tag would take the article along. An element that holds an article stays.
    """
    found = list(tokens(page))
    names = [keys(name, value) if kind == "open" else ("/" + name, False) for kind, name, value in found]
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    articles: list[int] = []
    for i, (kind, name, value) in enumerate(found):
        if kind == "open" and name not in VOID and not value.endswith("/"):
            opened.setdefault(name, []).append(i)
            if name in ("article", "main") and not names[i][1]:
                articles.append(i)
        elif kind == "close" and opened.get(name):
            ends[opened[name].pop()] = i

    def left_out(i: int, name: str, depth: int) -> bool:
        if name in RAW:
            return True
        if name in ("html", "body") or i in ends and bisect(articles, ends[i]) > bisect(articles, i - 1):
            return False
        return name in ASIDE or name == "header" and depth <= 0 or names[i][1]

    out: list[str | Tag] = []
    i, depth = 0, 0
    while i < len(found):
        kind, name, value = found[i]
        if kind == "text":
            out.append(value)
            i += 1
            continue
        aside = kind == "open" and left_out(i, name, depth)
        out.append(Tag(names[i][0], aside, name not in INLINE))
        if aside:
            if i in ends:
                i = ends[i] + 1
                continue
            if name in RAW or name == "footer":
                break
        if name in ("article", "main"):
            depth += 1 if kind == "open" else -1
        i += 1
    return out


def inside(items: list[str | Tag]) -> tuple[int, int] | None:
    """Where the one element that markup names as the article begins and ends: what makes a page a labelled one."""
    marks = [i for i, x in enumerate(items) if isinstance(x, Tag) and (x.key in ("article", "main") or x.key.startswith(("article.", "main.")) or "articlebody" in x.key)]
    if len(marks) != 1:
        return None
    name = re.split(r"[.]", items[marks[0]].key)[0]
    depth = 0
    for i in range(marks[0], len(items)):
        x = items[i]
        if isinstance(x, Tag) and (x.key == "/" + name or re.split(r"[.]", x.key)[0] == name):
            depth += -1 if x.key[0] == "/" else 1
            if not depth:
                return marks[0], i
    return None


def counts(page: str) -> Counter:
    """(key, whether inside the article) of each tag of a labelled page; nothing for others."""
    items = parse(page)
    where = inside(items)
    return Counter((x.key, where[0] <= i <= where[1]) for i, x in enumerate(items) if isinstance(x, Tag)) if where else Counter()


def weights(pages: DataFrame, most: int = LABELLED) -> dict[str, float]:
    """The score of each tag key, by how much more often labelled pages have it outside of the article than inside. All
    keys of those pages count; their number is bounded by that of the pages."""
    part = pages.select("page_id", "html").where(F.col("html").rlike(MARKED))
    n = part.count()
    if n > most:
        part = part.where(F.pmod(F.xxhash64(F.lit(1), "page_id"), F.lit(1_000_003)) < int(1_000_003 * most / n))

    def run(batches):
        total: Counter = Counter()
        for b in batches:
            for page in b.column(0).to_pylist():
                total.update(counts(page or ""))
        yield pa.RecordBatch.from_pydict({"key": [k for k, _ in total], "inside": [x for _, x in total], "n": list(total.values())}, pa.schema([("key", pa.string()), ("inside", pa.bool_()), ("n", pa.int64())]))

    rows = part.select("html").mapInArrow(run, "key string, inside boolean, n long")
    found = rows.groupBy("key").agg(F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("inside"), F.lit(0)).otherwise(F.col("n"))).alias("b"))
    return {r.key: -min(TAG_MOST, 4 * log((r.b + 0.5) / (r.a + 0.5))) for r in found.where("b > a").toLocalIterator()}


def extract(page: str | None, scores: dict[str, float]) -> str:
    """The text of the best contiguous run; the first and then the longest of runs that score alike."""
    items = parse(page or "")
    texts = [html.unescape(x) if isinstance(x, str) else None for x in items]
    best, span = 0.0, None
    run, start = 0.0, 0
    for i, x in enumerate(items):
        if isinstance(x, str):
            run += WORD_SCORE * len(texts[i].split())
        else:
            run += scores.get(x.key, TAG_SCORE if not x.aside else -1.0)
        if run < 0:
            run, start = 0.0, i + 1
        elif run > best + 1e-9:
            best, span = run, (start, i)
    if span is None:
        return ""
    out = []
    for i in range(span[0], span[1] + 1):
        x = items[i]
        out.append(texts[i] if isinstance(x, str) else " " if x.block else "")
    return " ".join("".join(out).split())


def main_text(pages: DataFrame, most: int = LABELLED) -> DataFrame:
    """(page_id, url, text, n_chars): a row for each row of pages (page_id, url, html).

    Weights are learned from pages whose markup names their article, at most about `most` of them; without any, all tags
    weigh the same, and elements that are no part of an article are still left out. A null or empty page, or one without
    words, has an empty text; repeated rows each get theirs; an empty table gives no rows.
    """
    sent = pages.sparkSession.sparkContext.broadcast(weights(pages, most))  # of at most `most` pages

    def run(batches):
        for b in batches:
            texts = [extract(x, sent.value) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
