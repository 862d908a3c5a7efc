"""Main texts of pages: the table's own layout, layouts of other kinds, and broken sources."""

import html
import re
from collections import Counter

import pytest

from clearset.llm import html_blocks, main_text

LAYOUTS = {
    "comments and aside": (
        "<html><body class='has-sidebar'><header><h1>My Site</h1><p>the best site of the whole world for you</p></header><nav><ul><li><a href=x>Home</a></li></ul></nav><main><article><h1>Title of it</h1><p>Body text one two three.</p><p>Ok.</p><aside><p>You may also like this other thing here today</p></aside><p>More body text.</p></article>"
        "<section class='comments'><h3>3 comments</h3><div class='comment'><p>I really like this article so much that I wrote a very long comment about it, thanks.</p></div></section></main><footer><p>All rights reserved by us in the year.</p></footer></body></html>",
        ["Title of it", "Body text one two three.", "Ok.", "More body text."],
    ),
    "only divs": (
        "<div id=page><div class='cookie-banner'>We use cookies to improve the way this site works for you. Accept?</div><div class=topnav><a>Home</a> <a>News</a></div><div class=content><h2>Headline here</h2><div class=body>First long paragraph of text that goes on and on for a while so that it counts.</div><div class=body>Short one.</div><div class='ad-slot'>Buy now our product cheap cheap cheap</div>"
        "<div class=body>Another long paragraph of text which continues the story.</div></div><div class=sidebar><p>Popular posts and other things that no one reads at all in life</p></div></div>",
        ["Headline here", "First long paragraph of text that goes on and on for a while so that it counts.", "Short one.", "Another long paragraph of text which continues the story."],
    ),
    "no layout": ("<body><h1>Only a title</h1><p>And a text.</p></body>", ["Only a title", "And a text."]),
    "breaks off": ("<p>word", ["word"]),
    "no tag": ("just text without any tag at all", ["just text without any tag at all"]),
    "no text": ("<nav><a>a</a></nav><footer>© x</footer>", []),
    "lists and a form": (
        "<article><h1>T</h1><ul><li>first item of list<li>second</ul><table><tr><td>cell a<td>cell b</table><pre>x  y\n z</pre></article><form><input><label>Your name please</label><button>Send</button></form>",
        ["T", "first item of list", "second", "cell a", "cell b", "x y z"],
    ),
    "upper case and references": (
        "<ARTICLE><P>It&apos;s a &lt;tag&gt; &amp; &nbsp; more<!-- <p>not this --> text<script>if (a<b) { '</p>' }</script><P>two<br>lines, 2 < 3</ARTICLE><DIV CLASS='Reader-Comments'><P>Comment text that is here for a long while and more</DIV>",
        ["It's a <tag> & more text", "two lines, 2 < 3"],
    ),
    "notices around a post": (
        "<body><div class='site-notice'><p>Notice: our service is down today for maintenance between two and four, sorry.</p></div><div class='post'><h1>A b c</h1><p>Long paragraph of the post that has some words in it and more.</p><p>Second.</p></div><div class='share-buttons'><a>Tweet</a></div><div class='newsletter-signup'><p>Subscribe to our newsletter for the latest news</p></div></body>",
        ["A b c", "Long paragraph of the post that has some words in it and more.", "Second."],
    ),
    "quoted brackets and hidden text": (
        "<article><p title='a > b' data-x=\"</p>\">shown text of the page</p><p hidden>not shown</p><div style='display: none'>nor this</div><noscript>no script</noscript><svg><text>drawn</text></svg></article>",
        ["shown text of the page"],
    ),
}


@pytest.fixture(scope="module")
def model(spark, data):
    return main_text.train(spark.read.parquet(f"{data}/pages.parquet"))


def by_template(source):
    """What the table's own layout says: paragraphs of its only article."""
    own = re.search("<article>(.*?)(?:</article>|$)", source, re.DOTALL)[1]
    blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", own))
    return "\n\n".join(b for b in blocks if b)


def test_query_equals_the_template(spark, data):
    got = {r.page_id: r for r in main_text.op13_main_text(spark, data).collect()}
    pages = spark.read.parquet(f"{data}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        assert (got[p.page_id].url, got[p.page_id].text) == (p.url, by_template(p.html))
        assert got[p.page_id].n_chars == len(got[p.page_id].text)


@pytest.mark.parametrize("name", LAYOUTS)
def test_other_layouts(model, name):
    source, want = LAYOUTS[name]
    assert main_text.main_text(source, model) == "\n\n".join(want)


def test_fixed_pages_alone_learn_their_labels():
    weights = main_text.fit(Counter(), Counter())
    right = total = 0
    for page in main_text.LABELLED.strip().splitlines():
        source = re.sub(r"\{(\d+)\}", lambda m: "word " * int(m[1]), page)
        for names, label in main_text.labelled_blocks(source):
            if not isinstance(names, str):
                total += 1
                score = weights[2] + sum(weights[0][n] for n in names)
                right += ((score > 0) and names.isdisjoint(main_text.NEVER)) == bool(label)
    assert right / total >= 0.93


def test_best_region_against_all_regions():
    import random

    rng = random.Random(5)
    for _ in range(300):
        s = [rng.choice([-2.0, -1.0, 0.0, 1.0, 3.0]) for _ in range(rng.randrange(12))]
        start, end = main_text.best_region(s)
        best = max((sum(s[i:j]) for i in range(len(s)) for j in range(i, len(s) + 1)), default=0.0)
        assert sum(s[start:end]) == max(best, 0.0)


def test_edge_rows_and_clashing_columns(spark, model):
    long = "<article>" + "<p>one two three four</p>" * 30_000 + "</article>"
    rows = [(1, None, 1), (1, "", 2), (None, long, 3), (2, "<p>same words here again</p>", 4), (2, "<p>same words here again</p>", 5), (3, "<a '" * 3000, 6), (4, "<div>" * 3000 + "deep text of a page", 7), (5, "<!-- never closed <p>x", 8)]
    pages = spark.createDataFrame([(*r, "mine", -1) for r in rows], "page_id long, html string, n int, text string, n_chars int")
    got = main_text.extract(pages, model)
    assert got.columns == ["page_id", "html", "n", "text", "n_chars"]
    found = {r.n: r for r in got.collect()}
    assert [found[i].text for i in (1, 2, 4, 5, 8)] == ["", "", "same words here again", "same words here again", ""]
    assert found[3].text == "\n\n".join(["one two three four"] * 30_000) and found[3].n_chars == len(found[3].text)
    assert found[7].text == "deep text of a page"
    none = pages.where("n < 0")
    assert main_text.extract(none, main_text.train(none)).count() == 0


def test_blocks_say_where_they_stand():
    found = [t for t in html_blocks.tokens("<div id='mainMenu' class='top-nav'><p>a <a>b</a></div>c<p>d<p>e") if not isinstance(t, str)]
    assert [(b.text, b.words, b.linked) for b in found] == [("a b", 2, 1), ("c", 1, 0), ("d", 1, 0), ("e", 1, 0)]
    assert found[0].context.names == {"tag:div", "tag:p", "name:main", "name:menu", "name:top", "name:nav"}
    assert found[3].context.names == {"tag:p"}
