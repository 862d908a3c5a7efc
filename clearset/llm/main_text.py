"""Main text of web pages: the contiguous region of highest score.

A page is a sequence of words and tags.  Words score by what stands around them (element names,
words of class, id and role, links), tags score below zero; both weights come from labelled pages:
a fixed set that marks its main text (``LABELLED``), and pages of the corpus that say themselves
where theirs is (article, main).  One linear scan finds the region with the highest sum.  Inside it,
blocks whose own words score below zero (adverts, notices, asides) are left out.

Defined cases: a null or empty page, or one without words that score above zero, gives an empty
text; pages of any length are read whole; a page that breaks off is read to its end; without
labelled pages in the corpus the fixed set is all; rows that repeat a page_id are pages of their
own; an empty table gives an empty result; extra columns stay, but columns named text or n_chars
give way to the operator's own.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearset.llm.html_blocks import Block, tokens
from clearset.llm.text import small_batches

#: Bounds of the fit: expected number of corpus pages (a sample by hash of the page_id), blocks of
#: one page that are fitted, and names that have a weight.
TRAIN_PAGES, TRAIN_BLOCKS, NAMES = 2000, 200, 512
#: What all corpus pages together count, next to the fixed pages.
CORPUS = 0.5
#: Largest score of a word on either side, what a rejected block costs at most, and largest and least
#: cost of a tag.
WORD, BLOCK, TAG, LEAST_TAG = 3.0, 3.0, 0.3, 0.01

#: Labelled pages.  {n} stands for n words; data-main marks the main text, data-rest what is none.
LABELLED = """
<body><header class="site-header"><div class="logo"><a>{2}</a></div><nav class="menu"><ul><li><a>{1}</a></li><li><a>{2}</a></li></ul></nav></header><main><article class="post" data-main><header class="entry-header"><h1>{8}</h1></header><div class="entry-content"><p>{60}</p><p>{4}</p><h2>{3}</h2><p>{45}</p><ul><li>{9}</li><li>{3}</li></ul><aside class="related" data-rest><h3>{2}</h3><p>{12}</p></aside><p>{30}</p></div></article></main><footer class="site-footer"><p>© {6}</p></footer></body>
<body><div id="cookie-consent" class="notice"><p>{25}</p><button>{1}</button></div><div id="header"><h1>{3}</h1><p>{6}</p></div><div id="content" data-main><h1>{7}</h1><p>{80}</p><p>{2}</p><blockquote><p>{25}</p></blockquote><p>{33}</p></div><div id="sidebar"><h3>{2}</h3><p>{18}</p><ul><li><a>{4}</a></li></ul></div><div id="footer"><p>© {9}</p><a>{2}</a></div></body>
<body><nav><a>{1}</a><a>{1}</a></nav><div class="ad"><p>{14}</p></div><div class="story-body" data-main><h1>{9}</h1><p>{50}</p><div class="advert" data-rest>{9}</div><p>{40}</p><figure><figcaption>{10}</figcaption></figure><div class="sponsored promo" data-rest><p>{16}</p></div><p>{22}</p></div><section id="comments" class="comments"><h2>{2}</h2><article class="comment"><p>{30}</p></article><div class="comment-body"><p>{12}</p></div><form><label>{2}</label><button>{1}</button></form></section></body>
<body><h1 data-main>{6}</h1><p data-main>{40}</p><p data-main>{3}</p><p data-main>{55}</p><p data-main>{1}</p></body>
<body><table><tr><td class="menu"><a>{1}</a><a>{2}</a></td><td data-main><h1>{5}</h1><p>{70}</p><p>{31}</p><table><tr><td>{2}</td><td>{3}</td></tr></table></td></tr><tr><td class="footer">© {5}</td></tr></table></body>
<body><div class="topbar banner alert">{12}</div><div class="breadcrumb"><a>{1}</a><a>{1}</a></div><div class="wrapper"><div class="main-column" data-main><h2>{6}</h2><div>{90}</div><div>{12}</div><div>{40}</div></div><div class="right-column widget"><h4>{2}</h4><p>{22}</p><form class="search">{2}</form></div></div><div class="copyright legal">{10}</div></body>
<body><div role="navigation"><ul><li><a>{1}</a></li></ul></div><div role="main" data-main><h1>{4}</h1><p>{20}</p><pre>{30}</pre><ol><li>{12}</li><li>{20}</li></ol><dl><dt>{2}</dt><dd>{14}</dd></dl></div><div role="complementary"><p>{20}</p></div><div role="contentinfo"><p>{8}</p></div></body>
<body><section class="newsletter subscribe signup"><h2>{4}</h2><p>{16}</p><form><input></form></section><section class="article-body" data-main><h1>{10}</h1><p>{64}</p><p>{5}</p><p>{41}</p><div class="share social" data-rest><a>{1}</a><a>{1}</a></div><p>{18}</p><div class="newsletter" data-rest><p>{15}</p></div><p>{28}</p></section><section class="recommended more related"><h3>{2}</h3><article><h4><a>{7}</a></h4><p>{14}</p></article><article><p>{11}</p></article></section><div class="pagination pager"><a>{1}</a></div></body>
<body><div class="modal popup overlay"><p>{20}</p></div><div class="masthead"><p>{5}</p></div><article data-main><h1>{12}</h1><p>{10}</p><p>{1}</p></article><aside><p>{33}</p></aside><aside class="sidebar"><h2>{2}</h2><p>{21}</p></aside><footer><div><p>{12}</p></div></footer></body>
<body><div class="navbar"><span>{2}</span></div><div class="container"><div class="text" data-main><p>{35}</p><p>{44}</p></div><div class="ads advertisement"><p>{10}</p></div><div class="reader-comments discussion"><div class="reply"><p>{25}</p></div><div class="response"><p>{9}</p></div></div></div><div class="bottom footer"><p>{7}</p></div></body>
<body><form action=x><p>{8}</p><fieldset><legend>{2}</legend><p>{5}</p></fieldset></form><main data-main><h1>{5}</h1><section><h2>{3}</h2><p>{52}</p></section><section><h2>{4}</h2><p>{38}</p></section><form data-rest><p>{9}</p><label>{3}</label></form><section><p>{19}</p></section></main><div class="disclaimer cookies gdpr privacy"><p>{26}</p></div></body>
<body><menu><li>{2}</li></menu><header><h1>{3}</h1><p>{9}</p></header><div class="toc contents"><ul><li><a>{3}</a></li><li><a>{2}</a></li></ul></div><div class="page-content" data-main><h1>{6}</h1><p>{48}</p><div class="warning notice" data-rest>{12}</div><p>{26}</p><table><tr><th>{1}</th><td>{4}</td></tr></table><nav data-rest><a>{2}</a></nav><p>{14}</p></div><footer><p>{10}</p><ul><li>{2}</li></ul></footer></body>
<body data-main>{40}</body>
<body><div data-main>{3}</div><div data-main>{30}</div><div data-main>{8}</div><div class="foot">© {4}</div></body>
<body><div class="post" data-main><h1>{4}</h1><p>{22}</p><p>{2}</p><p>{9}</p></div><div class="share-buttons social"><a>{1}</a></div><div class="newsletter-signup"><p>{11}</p></div><div class="post-comments"><p>{17}</p></div></body>
<body><main><h1 data-main>{5}</h1><p data-main>{12}</p><p data-main>{3}</p><div class="ad-slot ad">{8}</div><p data-main>{20}</p><section class="comments"><article class="comment"><p>{30}</p></article><article class="comment"><p>{6}</p></article></section><aside><p>{15}</p></aside></main></body>
<body><main><article data-main><h1>{6}</h1><p>{18}</p><div class="ad banner" data-rest><p>{12}</p></div><p>{7}</p><div class="related-links" data-rest><p>{9}</p></div><p>{21}</p><footer data-rest><p>{16}</p></footer><div class="comments-area" data-rest><p>{26}</p></div><form class="comment-form" data-rest><p>{8}</p></form></article></main></body>
<body><div class="site-notice"><p>{18}</p></div><div class="entry" data-main><h2>{5}</h2><p>{10}</p><p>{1}</p><ul><li>{4}</li><li>{8}</li></ul></div><div class="comment-list"><ol><li>{20}</li><li>{5}</li></ol></div><div class="sidebar-right"><ul><li>{6}</li></ul></div></body>
<body><div class="header"><p>{7}</p></div><div class="nav"><ul><li>{1}</li><li>{2}</li></ul></div><div class="article" data-main><h1>{9}</h1><p>{44}</p><p>{3}</p></div><div class="sponsor"><p>{20}</p></div><div class="footer"><p>{17}</p></div></body>
<body><header class="page-header"><h1>{2}</h1><p>{12}</p></header><div class="content-area" data-main><h1>{6}</h1><p>{5}</p><p>{36}</p><div class="cookie-notice" data-rest><p>{20}</p></div><table><tr><td>{2}</td><td>{9}</td></tr></table><p>{15}</p></div><div class="footer-widgets"><p>{11}</p></div></body>
"""  # fmt: skip

#: Elements that mark the main text of pages that label themselves, and those that never hold any.
OWN_LABELS = frozenset(("tag:article", "tag:main", "name:articlebody"))
NEVER = frozenset("tag:" + t for t in ("nav", "aside", "footer", "menu", "button", "select", "dialog"))
#: Elements that say nothing of what they hold.
PLAIN = frozenset("tag:" + t for t in ("html", "body", "div", "section"))

Model = tuple[dict[str, float], dict[str, float], float]


def block_names(b: Block) -> frozenset[str]:
    """What a block's words are weighted by."""
    own = {"few words"} if b.words < 4 else {"many words"} if b.words > 14 else set()
    if 2 * b.linked > b.words:
        own.add("linked")
    if "©" in b.text:
        own.add("rights")
    return b.context.names - PLAIN | own


def labelled_blocks(source: str, most: int = TRAIN_BLOCKS) -> Iterator[tuple[frozenset[str] | str, int]]:
    """(names of a block or name of a tag, 1 in the main text or 0) of a page that marks its main
    text; nothing of others.  Where the page's own elements are the labels, its blocks come a
    second time without them, so that pages without such elements are learned as well."""
    found = list(tokens(source))
    blocks = [t for t in found if isinstance(t, Block)]
    marked = any(b.context.mark is not None for b in blocks)
    if not marked and not any(b.context.names & OWN_LABELS for b in blocks):
        return
    label, left = 0, most
    for t in found:
        if isinstance(t, str):
            yield t, label
            continue
        names = block_names(t)
        label = t.context.mark or 0 if marked else int(bool(names & OWN_LABELS) and names.isdisjoint(NEVER))
        if t.context.hidden or left == 0:
            continue
        left -= 1
        yield names, label
        if not marked:
            yield names - OWN_LABELS, label


def _counts(pages: Iterator[str], most: int) -> tuple[Counter, Counter]:
    blocks, tags = Counter(), Counter()
    for source in pages:
        for what, label in labelled_blocks(source, most):
            (tags if isinstance(what, str) else blocks)[what, label] += 1
    return blocks, tags


def fit(blocks: Counter, tags: Counter, names: int = NAMES, penalty: float = 0.3, rounds: int = 30) -> Model:
    """(weights of names, weights of tags, intercept) from counted labels: logistic regression for
    words, and for tags their share outside of main texts."""
    fixed_blocks, fixed_tags = _counts((re.sub(r"\{(\d+)\}", lambda m: "word " * int(m[1]), p) for p in LABELLED.strip().splitlines()), TRAIN_BLOCKS)
    scale = CORPUS * fixed_blocks.total() / max(blocks.total(), 1)
    total = Counter({k: float(n) for k, n in fixed_blocks.items()})
    for k, n in blocks.items():
        total[k] += n * scale
    rows = sorted(total, key=lambda k: (sorted(k[0]), k[1]))
    known = {n for k, _ in fixed_blocks for n in k}
    often = Counter(n for (k, _), c in blocks.items() for n in sorted(k - known) for _ in range(min(c, 3)))
    chosen = sorted(known) + [n for n, c in sorted(often.items(), key=lambda x: (-x[1], x[0])) if c >= 3][: max(names - len(known), 0)]
    at = {n: i for i, n in enumerate(chosen)}
    x = np.zeros((len(rows), len(chosen) + 1))
    x[:, -1] = 1
    for i, (k, _) in enumerate(rows):
        x[i, [at[n] for n in k if n in at]] = 1
    y, weight = np.array([label for _, label in rows]), np.array([total[k] for k in rows])
    ridge = np.r_[np.full(len(chosen), penalty), 1e-3]
    w = np.zeros(len(chosen) + 1)
    for _ in range(rounds):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + ridge * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    share = Counter()
    for counted, times in ((fixed_tags, 1.0), (tags, CORPUS * fixed_tags.total() / max(tags.total(), 1))):
        for (tag, label), n in counted.items():
            share[tag, label] += n * times
    outside = {t: -max(LEAST_TAG, TAG * share[t, 0] / (share[t, 0] + share[t, 1])) for t, _ in share}
    return dict(zip(chosen, w[:-1].tolist())), outside, float(w[-1])


def train(pages: DataFrame, html: str = "html", page_id: str = "page_id", max_pages: int = TRAIN_PAGES) -> Model:
    """Weights from the fixed labelled pages and from a sample of about ``max_pages`` pages that label
    themselves, of which Spark counts the blocks."""
    small_batches(pages.sparkSession)
    own = pages.where(F.col(html).rlike(r"(?i)<(article|main)\b|articleBody"))
    share = min(1.0, max_pages / max(own.select(page_id).count(), 1))
    sample = own.where(F.pmod(F.xxhash64(F.lit("pages"), F.col(page_id)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            blocks, tags = _counts(iter(b.column(0).to_pylist()), TRAIN_BLOCKS)
            keys = [("\n".join(sorted(k)), label, n) for (k, label), n in blocks.items()] + [("<" + k, label, n) for (k, label), n in tags.items()]
            what, label, n = zip(*keys) if keys else ((), (), ())
            yield pa.record_batch([pa.array(what, pa.string()), pa.array(label, pa.int32()), pa.array(n, pa.int64())], ["what", "label", "n"])

    counted = sample.select(html).mapInArrow(count, "what string, label int, n long").groupBy("what", "label").agg(F.sum("n").alias("n"))
    blocks, tags = Counter(), Counter()
    for r in counted.collect():  # bounded by max_pages * TRAIN_BLOCKS
        if r.what.startswith("<"):
            tags[r.what[1:], r.label] += r.n
        else:
            blocks[frozenset(r.what.split("\n")), r.label] += r.n
    return fit(blocks, tags)


def best_region(scores: list[float]) -> tuple[int, int]:
    """(start, end) of the contiguous stretch with the highest positive sum, in one scan; the first
    of equals, and (0, 0) where nothing is above zero."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, region = total, (start, i + 1)
    return region


def main_text(source: str | None, model: Model) -> str:
    """Blocks of the best region, two line feeds between them."""
    names, tags, intercept = model
    found = list(tokens(source or ""))
    cache: dict[frozenset[str], float] = {}

    def word(b: Block) -> float:
        own = block_names(b)
        if own not in cache:
            cache[own] = min(WORD, max(-WORD, intercept + sum(names.get(n, 0.0) for n in own))) if own.isdisjoint(NEVER) else -WORD
        return -WORD if b.context.hidden else cache[own]

    values = [tags.get(t, -TAG) if isinstance(t, str) else word(t) for t in found]
    scores = [v if isinstance(t, str) else max(v * t.words, -BLOCK) for t, v in zip(found, values)]
    start, end = best_region(scores)
    return "\n\n".join([t.text for t, v in zip(found[start:end], values[start:end]) if isinstance(t, Block) and v > 0])


def extract(pages: DataFrame, model: Model, html: str = "html") -> DataFrame:
    """``pages`` with text and n_chars (code points)."""
    small_batches(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(model)  # at most NAMES weights and those of tags

    def run(column: pa.Array) -> pa.Array:
        return pa.array([main_text(x, shared.value) for x in column.to_pylist()], pa.string())

    rest = [c for c in pages.columns if c not in ("text", "n_chars")]
    d = pages.select(*rest, F.arrow_udf(run, "string")(html).alias("__text"))
    return d.select(*rest, F.col("__text").alias("text"), F.length("__text").cast("long").alias("n_chars"))


def op13_main_text(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages, train(pages)).select("page_id", "url", "text", "n_chars")
