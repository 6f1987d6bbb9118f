import html
import random

import pytest

from headway.llm import html_text

SCHEMA = "page_id long, url string, html string, text string, n_chars long"


def page(blocks, style):
    body = "".join(f"<{t}>{html.escape(x)}</{t}>\n" for t, x in blocks)
    if style == 1:
        body = f"<article>{body}</article>"
    elif style == 2:
        body = f"<div class='page with-sidebar'><div id=content>{body}</div><div class=sidebar><h3>More</h3><p>{'side words here ' * 30}</div></div>"
    else:
        body = f"<main><header><h2>Kept head</h2></header>{body}<section class=comments><article class=comment><p>first! nice text</p></article></section></main>"
    return f"<!doctype html><html><head><title>No title</title><style>p{{a:b}}</style><script>if (a<b) x='</p>'</script></head><body><header><p>Site</p></header><nav><ul><li><a href='/x'>One</a><li><a>Two</a></ul></nav><div class=ad>Buy {'now ' * 40}</div><!-- <p>no</p> --><form><p>Name</p><input></form>{body}<footer>&copy; Site"


def cases():
    rnd = random.Random(8)
    rows, want = [], []
    for i in range(90):
        blocks = [("h1", f"Tïtle {i} & more")] + [("p", " ".join(rnd.choice(["word", "a<b", "é", "&amp;", "x y"]) for _ in range(rnd.randint(1, 40)))) for _ in range(rnd.randint(1, 6))]
        style = 1 + i % 3
        rows.append((i, f"u{i}", page(blocks, style)))
        want.append(" ".join(" ".join((["Kept head"] if style == 3 else []) + [x for _, x in blocks]).split()))
    return rows, want


def run(spark, rows):
    return html_text.main_text(spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA))


def test_exact_text(spark):
    rows, want = cases()
    out = {r.page_id: r for r in run(spark, rows).collect()}
    assert [out[i].text for i in range(90)] == want
    assert all(r.n_chars == len(r.text) for r in out.values())


def test_driver_pages(spark, sf):
    import re

    rows = spark.read.parquet(f"{sf}/pages.parquet").collect()
    out = {r.page_id: r.text for r in html_text.main_text(spark.read.parquet(f"{sf}/pages.parquet")).collect()}
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        text = html.unescape(re.sub(r"<[^>]*>", "\0", re.sub(r"</?b>", "", inner))).replace("\0", " ")
        assert out[r.page_id] == " ".join(text.split())


def test_odd_pages(spark):
    odd = [None, "", "   ", "plain words", "<p>a<p>b", "<p title='it>s'>a</p", "<", "<b", "a < b &lt; c &amp", "<script>x", "<p>one</p><div class=ad>two", "<![CDATA[ c<d ]]>", "<p>" * 5000 + "deep", "x " * 50_000, "<a title=it's>an</a> other's"]
    out = {r.page_id: r.text for r in run(spark, [(i, None, t) for i, t in enumerate(odd)] + [(3, None, "plain words"), (None, None, "no id")]).collect()}
    assert [out[i] for i in range(3)] == ["", "", ""] and out[3] == "plain words" and out[4] == "a b" and out[5] == "a"
    assert out[8] == "a < b < c &" and out[9] == "" and out[11] == "c<d" and out[12] == "deep" and len(out[13]) == 99_999 and out[14] == "an other's"
    assert run(spark, []).collect() == []


@pytest.mark.parametrize("n", [50, 10_000])
def test_sample_is_bounded(spark, n):
    rows, want = cases()
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert html_text.weights(frame, n)["nav"] < -3


def test_best_run_is_the_maximum():
    rnd = random.Random(0)
    for _ in range(200):
        parts = [rnd.choice(["w w w", "<hr>", "<x>", "w"]) for _ in range(rnd.randint(1, 12))]
        scores = {"hr": -2.5, "x": -1.25}
        value = lambda p: scores.get(p.strip("<>"), len(p.split()))
        best = max((sum(map(value, parts[i:j])) for i in range(len(parts)) for j in range(i + 1, len(parts) + 1)), default=0)
        got = html_text.extract(" ".join(parts), scores)
        assert (best <= 0) == (got == "")


def test_names_that_only_hold_such_a_word_are_part_of_the_article():
    body = " ".join(f"word{i}" for i in range(30))
    for mark, end in (('<section class="discussion">', "</section>"), ('<div id="related-work">', "</div>"), ('<p class="search-algorithms">', "</p>"), ('<div class="alert-level">', "</div>"), ("<math><mi>", "</mi></math>"), ("<label>", "</label>")):
        page = f"<body><nav>menu</nav><article><p>{body}</p>{mark}inside it{end}<p>{body}</p></article></body>"
        assert "inside it" in html_text.extract(page, {}), mark
    for mark in ('class="related-posts"', 'class="ad"', 'id="comments"', 'class="cookie-notice"', 'class="share-buttons"', "hidden", 'class="sidebar_left"', 'role="search"'):
        page = f"<body><article><p>{body}</p><div {mark}>not this</div><p>{body}</p></article></body>"
        assert html_text.extract(page, {}) == f"{body} {body}", mark
