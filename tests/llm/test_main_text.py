import random
import time

import numpy as np
import pytest
from html import escape

from larder.llm import main_text as mt
from larder.llm import queries

NOISE = [
    "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>About us</a></li></ul></nav>",
    '<div class="ad">Buy <b>this</b> now, it is very good value for you and for all your friends.</div>',
    "<header><h2>The site of the day</h2></header>", "<footer>&copy; 2020 &middot; All rights reserved by us</footer>",
    '<aside><p>On the side</p><p>More on the side of this</p></aside>', '<div id="cookie-notice"><p>We use cookies</p><button>OK</button></div>',
    '<form action="/q"><label>Name</label><input name="n"><select><option>One</option></select></form>',
    "<script>var x = '</p><article><p>not text</p>'; if (a < b) {}</script>", "<style>p > a { margin: 0 }</style>", "<!-- <p>hidden</p> -->",
    '<section class="comments"><h3>Comments</h3><div class="comment"><p>I liked it a lot</p></div></section>',
    '<div class="share social"><a href="x">Share it</a></div>', "<noscript><p>Turn on scripts</p></noscript>",
    '<div role="navigation"><a href="1">Next</a></div>', "<article class='comment'><p>Reader says hello</p></article>",
]


@pytest.mark.parametrize("container", ["article", "main", "div class='content'"])
def test_blocks_between_noise_are_kept_whole(container):
    rng = random.Random(container)
    for _ in range(80):
        blocks = [" ".join(rng.choices(["Er.", "tion", "a<b", "é&è", "&amp;", "\"q\"", "word", "日本"], k=rng.choice([1, 2, 8, 60])))
                  for _ in range(rng.randint(1, 12))]
        inner = "".join(rng.choice([f"<p>{escape(b)}</p>", f"<p>{escape(b)}", f"<h2>{escape(b)}</h2>", f"<div> {escape(b)}\n</div>"])
                        + (rng.choice(NOISE[:2] + NOISE[6:10]) if rng.random() < 0.15 else "") for b in blocks)
        before, after = ("".join(rng.sample(NOISE, rng.randint(1, 5))) for _ in range(2))
        page = f"<!DOCTYPE html><html><head><title>T</title></head><body>{before}<{container}>{inner}</{container.split()[0]}>{after}</body></html>"
        assert mt.main_text(page) == "\n".join(blocks), page


def test_teasers_in_articles_do_not_replace_the_body():
    body = "".join(f"<p>{'Long sentences of the body. ' * 12}{i}</p>" for i in range(6))
    cards = "".join(f"<article><h3>Card {i}</h3><p>A teaser</p></article>" for i in range(4))
    want = "\n".join("Long sentences of the body. " * 12 + str(i) for i in range(6))
    assert mt.main_text(f"<div id=content>{body}</div>{cards}") == want
    for about in ("<aside>%s</aside>", "<section class='related'>%s</section>", "<div class='comments'><div>%s</div></div>"):
        assert mt.main_text(f"<div id=content>{body}</div>{about % cards}") == want
        assert mt.main_text(f"<article>{body}</article>{about % cards}") == want
    # An article keeps its short runs, text outside as full as the article stays, and a page inside a form has its article.
    assert mt.main_text(f"<article><h1>Title</h1>{'<aside>x</aside>' * 4}{body}</article><p>Small print</p>") == "Title\n" + want
    assert mt.main_text(f"<article>{body}</article><div>{body}</div>") == want + "\n" + want
    assert mt.main_text(f"<form><article>{body}</article></form>") == want


def test_names_that_only_mention_something_else():
    body = "".join(f"<p>{'Long sentences of the body. ' * 12}{i}</p>" for i in range(6))
    want = "\n".join("Long sentences of the body. " * 12 + str(i) for i in range(6))
    title = "<h2>The site</h2>"
    for opened, closed in (("<article class='post category-legal'>", "</article>"), ("<div class='layout sidebar-right'>", "</div>"),
                           ("<div id='page-with-sidebar'>", "</div>"), ("<main class='main-search social-share'>", "</main>"),
                           ("<div class='layout sidebar-right'><article>", "</article></div>")):
        assert want in mt.main_text(title + opened + body + closed)
    assert mt.main_text(f"<article><h1 class='article-header'>Title</h1>{body}</article>") == "Title\n" + want
    # Even a mark that says so does not take nearly all of a page.
    assert want in mt.main_text(f"{title}<div class='notice'>{body}</div>")
    for name in ("related-posts", "ad-slot2", "sidebar", "commentList", "post-comments", "share-buttons", "site-header", "cookieBanner"):
        assert mt.main_text(f"<article>{body}<div class='{name}'>Not the article</div></article>") == want


def test_surge_and_dive_points():
    sizes = np.array([0, 0, 0, 0, 9, 0, 0, 5, 0, 0, 0, 4])
    assert mt.block_runs(sizes) == [(2, 8, 9), (9, 12, 4)]
    assert mt.block_runs(np.array([], np.int64)) == [] and mt.block_runs(np.zeros(4, np.int64)) == []


def test_odd_markup():
    assert mt.main_text("") == mt.main_text("<p></p><div>  </div>") == mt.main_text("<script>x") == ""
    assert mt.main_text("just text &amp; no tags") == "just text & no tags"
    assert mt.main_text("<p>a<br>b&nbsp; c<p><b>bold<i>er</b> x</i>") == "a b c\nbolder x"
    assert mt.main_text('<div class="ad">never closed <article><p>Text here</p>') == "Text here"
    assert mt.main_text('<div class="page no-sidebar"><p>Text here</p></div>') == "Text here"
    assert mt.main_text('<article><p class="notice">Sign here<p>Text <span aria-hidden="true">icon</span>here<p hidden>no<p>End</article>') == "Text here\nEnd"
    assert mt.main_text('<div id="ad2">Buy</div><div class="cookieBanner">Yes</div><div class="adventure story">Text here</div>') == "Text here"
    assert mt.main_text('<div class="promo"><p>All there is</p></div>') == "All there is"
    assert mt.main_text("<p>1 < 2 and <3 <a title='x>y'>link text</a> with more around it") == "1 < 2 and <3 link text with more around it"
    assert mt.main_text("<article>" + "<p>x" * 30_000) == "\n".join(["x"] * 30_000)
    assert mt.main_text("<" * 50_000) == "<" * 50_000


def test_query_nulls_repeats_and_clashes(spark, tmp_path):
    rows = [(1, "u", "<article><p>One</p><p>Two &lt;</p></article>", "old"), (2, None, None, "old"), (2, None, None, "old"), (None, "x", "", None)]
    spark.createDataFrame(rows, "page_id long, url string, html string, text string").write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.op7_html_extraction(spark, str(tmp_path)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(1, "u", "One\nTwo <", 9), (2, None, "", 0), (2, None, "", 0), (None, "x", "", 0)]))
    assert mt.extract(spark.read.parquet(f"{tmp_path}/pages.parquet").where("false")).count() == 0


def test_a_megabyte_of_odd_markup_is_read_in_time():
    pages = ["<p " * 330_000, "<p a='" * 170_000, "<aside><article>" * 65_000, "<" * 1_000_000, "<!" * 500_000, "<script " * 120_000,
             "<p ''" * 200_000 + ">", "<script></script " * 60_000, "<div class=ad><main>" * 50_000, "<!--" * 250_000, "<p " * 330_000 + ">",
             "".join(f"<x{i} class=ad><article>" for i in range(40_000))]
    for page in pages:
        began = time.process_time()
        mt.main_text(page)
        assert time.process_time() - began < 5, page[:20]


def test_comments_and_tags_that_never_end():
    body = "<article><p>" + "words of the article itself " * 8 + "</p></article>"
    want = ("words of the article itself " * 8).strip()
    for tail in ("<!-- never closed", "<!-- with > inside", "<!-- with <p>tags</p> inside"):
        assert mt.main_text(body + tail) == want
    assert mt.main_text(body + "<aside class=related>" + "more " * 60) == want


def test_long_reader_comments_do_not_outweigh_a_short_article():
    comments = "<section class='comments'>" + "".join(f"<p>{'A reader has much to say. ' * 20}{i}</p>" for i in range(30)) + "</section>"
    for size in (1, 5, 40):
        want = " ".join(["Short news of the day."] * size)
        assert mt.main_text(f"<article><p>{want}</p></article>{comments}") == want
        assert mt.main_text(f"<main><p>{want}</p>{comments}</main>") == want


def test_windows_decide_without_tags_or_names():
    """Plain divs only: lines of links part the page into runs, and the fullest windows stay."""
    body = ["The words of the body, as long as sentences are. " * 6 + str(i) for i in range(5)]
    menu = "".join(f"<div><a href='/{i}'>Choice {i}</a></div>" for i in range(5))
    inner = "".join(f"<div>{b}</div>" for b in body)
    want = "\n".join(b.strip() for b in body)
    page = f"<div>Name of the site</div><div>A motto</div>{menu}<div>{inner}</div>{menu}<div>Printed on paper</div>"
    assert mt.main_text(page) == want
    # Two menu lines are narrower than a window, so the line before them is of the same run.
    near = "".join(f"<div><a href='/{i}'>Choice {i}</a></div>" for i in range(2))
    assert mt.main_text(f"{menu}<div>A title</div>{near}{inner}{menu}<div>Printed on paper</div>") == "A title\n" + want


def _slow_body(lines, inside):
    """The kept text by the definition: every window summed anew, every run and article looked at on its own."""
    sums = [sum(len(x) for x in lines[i:i + mt.WINDOW]) for i in range(len(lines))]
    runs, i = [], 0
    while i < len(lines):
        if sums[i]:
            surge = i
            while i < len(lines) and sums[i]:
                i += 1
            runs.append((surge, i))
        i += 1
    if not runs:
        return ""

    def owner(run):
        return max(inside[k] for k in range(*run) if lines[k])

    def weight(run):
        return max(sums[k] for k in range(*run)) * (mt.ARTICLE_BONUS if owner(run) else 1)

    fullest, kept = max(map(weight, runs)), []
    for run in runs:
        group = [r for r in runs if owner(r) == owner(run)] if owner(run) else [run]
        if max(map(weight, group)) >= mt.LEAST_SHARE * fullest:
            kept += [x for x in lines[slice(*run)] if x]
    return "\n".join(kept)


def test_query_equals_slow_windows(spark, tmp_path):
    rng = random.Random(11)
    pages = []
    for i in range(400):
        parts = []
        for _ in range(rng.randint(0, 14)):
            block = "<p>" + "word " * rng.choice([1, 2, 10, 80, 300]) + "</p>"
            parts.append(rng.choice([block, block, block, f"<article>{block * rng.randint(1, 3)}</article>", "<aside>no</aside>" * rng.randint(1, 4),
                                     "<div><a href='x'>only a link</a></div>" * rng.randint(1, 4)]))
        pages.append((i, "u", "".join(parts)))
    spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4).write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r for r in queries.op7_html_extraction(spark, str(tmp_path)).collect()}
    dropped = 0
    for i, _, html in pages:
        lines, inside = mt.to_lines(html)
        want = _slow_body(lines, inside)
        assert (got[i].text, got[i].n_chars) == (want, len(want)), html
        dropped += want != "\n".join(x for x in lines if x)
    assert dropped > 50
