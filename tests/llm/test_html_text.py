import random
import re
import time
from html import escape, unescape

import pandas as pd
import pytest

from stratalake.llm import html_text

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a="</p>";</script></head><body>
<header><h2>Site name here</h2></header><nav><ul><li><a href="/">home</a><li>more</ul></nav><!-- x <p>no</p> -->
<div class="cookie-notice">We use cookies, as all do.</div><div class="ad">Buy, now!</div>
{open}<h1>Head &amp; line</h1><p><b>First, one.<br><p>Second &lt;one&gt;, with <a title="a>b">a link</a> and   spaces.</p>
<form><label>mail</label><p>Give us your address, please.</p></form><aside>Aside, here.</aside><p>Third&nbsp;&#233; 1 < 2.</p>{close}
<div class="side-bar"><p>Other pages, other texts.</p></div><section id="comments"><article><p>I liked it, a lot, really.</p></article></section>
<footer>&copy; someone, 2020.</footer></body></html>"""
TEXT = "Head & line\nFirst, one.\nSecond <one>, with a link and spaces.\nThird é 1 < 2."


@pytest.mark.parametrize("open_, close", [("<article>", "</article>"), ("<main>", "</main>"), ('<div id="story">', "</div>"), ("<div><div>", "</div></div>")])
def test_boilerplate_goes_and_content_stays_whole(open_, close):
    assert html_text.main_text(PAGE.format(open=open_, close=close)) == TEXT


@pytest.mark.parametrize("source, text", [
    (None, ""), ("", ""), ("plain words", "plain words"), ("<p>", ""), ("<p>a<p>b", "a\nb"), ("<script>x", ""), ("<!-- x", ""),
    ("</p></div>a", "a"), ("<ul><li>a<li>b</ul>", "a\nb"), ("<article><p>a</article>b", "a"), ("<P CLASS='Ad'>x</P><p>y</p>", "y"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<p>a &lt;b&gt; &amp;amp; c</p>", "a <b> &amp; c"), ("<div hidden>x</div><p>y</p>", "y")])
def test_odd_pages(source, text):
    assert html_text.main_text(source) == text


@pytest.mark.parametrize("open_, close", [
    ('<div class="layout has-sidebar"><div>', "</div></div>"), ('<div id="page" class="with-comments">', "</div>"), ('<article class="post tag-social">', "</article>"),
    ('<article class="category-advertising">', "</article>"), ('<div class="widget">', "</div>")])
def test_names_do_not_drop_what_holds_the_content(open_, close):
    story = "".join(f"<p>Sentence {k}, which is part of the story, goes on; and it ends here.</p>" for k in range(9))
    page = f'<body><div class="cookie-notice"><p>We use cookies, as all do.</p></div>{open_}{story}<p>See <span class="share">tweet it</span> below.</p>{close}<div class="sidebar"><p>Other texts, here.</p></div></body>'
    text = html_text.main_text(page)
    assert text.split("\n") == [*(f"Sentence {k}, which is part of the story, goes on; and it ends here." for k in range(9)), "See below."]


STORY = [f"Sentence {k}, which is part of the story, goes on; and it ends here." for k in range(4)]
STORY_HTML = "".join(f"<p>{s}</p>" for s in STORY)
REMARK = "<p>I think so, too, and more than that: this remark is longer than it should be; really, it is.</p>"
REMARKS = "".join(f'<div class="c"><span>Reader {k}</span>{REMARK}</div>' for k in range(20))
DATED = "".join(f"<li><b>Reader {k}</b> <span>{k + 2} days ago</span>{REMARK}</li>" for k in range(20))


@pytest.mark.parametrize("page, heading", [
    (f'<form id="aspnetForm"><div class="nav"><a href="x">one</a></div><div>{STORY_HTML}</div></form>', ""),
    (f"<button>{STORY_HTML}</button>", ""),
    (f"<dialog open><h1>Head</h1>{STORY_HTML}</dialog><footer>Outside, here.</footer>", "Head"),
    (f"<header>Site</header><article><header><h1>Head</h1></header>{STORY_HTML}<footer>tags, x.</footer></article>", "Head"),
    (f'<article>{STORY_HTML}</article><section id="comments">{REMARKS}</section>', ""),
    (f'<article>{STORY_HTML}<div class="comments-area">{REMARKS}</div></article>', ""),
    (f"<div>{STORY_HTML}</div><div><h3>20 remarks</h3><ul>{DATED}</ul></div>", ""),
    (f'<div>{STORY_HTML}</div><div class="sidebar-left"><p>One long sentence, which tells a lot, none of it of interest; so it goes.</p></div>', ""),
    (f'<div class="cookie-notice-bar"><p>We use cookies, as all do, and so on and on, more than you think.</p></div><div>{STORY_HTML}</div>', ""),
    (f'<p class=foo">Head</p>{STORY_HTML}', "Head"),
    (f'<p class="foo>Head</p>{STORY_HTML}'.replace('"', "'"), "Head"),
    (f'<div>{STORY_HTML}<ul><li><a href="1">Another text, elsewhere</a><li><a href="2">One more</a><li><a href="3">And a third</a></ul></div>', "")])
def test_evidence_is_weighed_by_what_elements_hold(page, heading):
    assert html_text.main_text(f"<html><body>{page}</body></html>").split("\n") == [heading] * bool(heading) + STORY


def test_a_short_article_is_not_replaced_by_its_footer():
    page = "<nav><a>x</a></nav><div class='ad'>Buy.</div><article><h1>Éaux.</h1><p><b>Éaux.<br></article><footer>&copy; a.example &middot; Some long, long, very long sentence; and more.</footer>"
    assert html_text.main_text(page) == "Éaux.\nÉaux."


@pytest.mark.parametrize("part", [
    "<div ", "<div><p>", "<", "</", '<a b="', "<a b='\"", "<!--", "<p>a</p>", "<script></scriptx", "&#", "<svg><title>", "<td>", "<ul><li>", "<b><table>", "<a>", "<!", "<h1><span></h2>"])
def test_cost_is_linear_whatever_the_markup(part):
    def seconds(size):
        source = part * (size // len(part))
        start = time.process_time()
        html_text.main_text(source)
        return time.process_time() - start

    # four times the length: about four times the time, where it can be measured
    small, large = min(seconds(50_000) for _ in range(2)), seconds(200_000)
    assert large < 0.1 or large < 9 * small


@pytest.mark.parametrize("seed", range(40))
def test_generated_pages_give_back_their_story(seed):
    """Pages drawn at random from wrappers, boilerplate and comments around a known text."""
    draw = random.Random(seed)
    word = lambda: draw.choice("stone river <left> under & often é walks three".split())
    sentence = lambda n: " ".join(word() for _ in range(n)) + ", " + word() + "."
    story = [sentence(draw.randint(2, 5)), *(sentence(draw.randint(8, 60)) for _ in range(draw.randint(3, 9)))]
    body = f"<h1>{escape(story[0])}</h1>" + "".join(f"<p>{escape(s).replace(' ', draw.choice([' ', chr(10), '  ', '&nbsp;']))}" + draw.choice(["</p>", ""]) for s in story[1:])
    open_, close = draw.choice([("<article>", "</article>"), ("<main>", "</main>"), ("<div><div>", "</div></div>"), ('<form action="/">', "</form>"), ('<div class="has-sidebar">', "</div>")])
    menu = "".join(f"<li><a href='/{k}'>{escape(word())}</a>" for k in range(6))
    before = [f"<nav><ul>{menu}</ul></nav>", f"<div class='menu'><ul>{menu}</ul></div>", f"<div class='ad'>{escape(sentence(12))}</div>", "<script>var a='<p>no, no.</p>'</script>", f"<header><p>{escape(sentence(5))}</p></header>"]
    after = [f"<footer>{escape(sentence(9))}</footer>", f"<div id='comments'>{REMARKS}</div>", f"<ol>{DATED}</ol>", f"<aside><p>{escape(sentence(20))}</p></aside>", f"<form><label>mail</label><p>{escape(sentence(6))}</p></form>"]
    page = "".join(draw.sample(before, 3)) + open_ + body + close + "".join(draw.sample(after, 3))
    assert html_text.main_text(f"<html><head><title>x</title></head><body>{page}</body></html>").split("\n") == story


def test_every_given_page_gives_its_article():
    """The given pages hold their text in one article of headings and paragraphs: cut out by patterns."""
    pages = pd.read_parquet("/root/testdata/sf0.01/pages.parquet")
    for source in pages.html.dropna():
        inner = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", source, re.S)[1]
        parts = re.split(r"</?(?:h1|p)>", re.sub(r"<br>", " ", re.sub(r"</?(?:b|i|a|em|span)\b[^>]*>", "", inner)))
        expected = [t for t in (" ".join(unescape(p).split()) for p in parts) if t]
        assert html_text.main_text(source).split("\n") == expected


def test_paths_with_long_punctuated_blocks_win():
    scores = html_text.path_scores(["menu", "menu", "A long, long sentence; with marks. And more.", "Another one, as long as that, is here."], ["ul/li", "ul/li", "div/p", "div/p"])
    assert scores[2:].min() > 2 * scores[:2].max()


def test_query_columns_with_nulls_repeats_and_clashing_names(spark):
    rows = [(1, "u", PAGE.format(open="<article>", close="</article>"), "x"), (1, "u", None, "x"), (None, None, "<p>é", "x"), (2, "v", "<p>" + "word, " * 50_000, "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, main string")
    got = html_text.report(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = sorted(((r.page_id, r.text, r.n_chars) for r in got.collect()), key=repr)
    assert found == sorted([(1, TEXT, len(TEXT)), (1, "", 0), (None, "é", 1), (2, ("word, " * 50_000).strip(), 299_999)], key=repr)
    assert html_text.report(pages.limit(0)).count() == 0
