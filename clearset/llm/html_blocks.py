"""Blocks of text and tags of a web page, in one linear pass over its source."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

# ---- fixed values: element names of HTML
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
HIDDEN = frozenset("noscript template svg object canvas audio video".split())
ENDS_P = frozenset("address article aside blockquote dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "p": ("p",)}
# ---- end of fixed values

#: A comment, a raw element with its content, a tag, or another declaration.  Each alternative that
#: begins to match also ends, at the end of the page at the latest, so the scan is linear.
_VALUE = r"""=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+)?+"""
_ATTRIBUTES = rf"(?:[^>=]++|{_VALUE})*+"
_TOKEN = re.compile(
    rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<({'|'.join(RAW)})(?=[\s/>])({_ATTRIBUTES})(?:>|\Z).*?(?:</\1(?=[\s/>])[^>]*+(?:>|\Z)|\Z)|<(/?)([a-z][^\s/>]*+)({_ATTRIBUTES})(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NAMES = re.compile(r"[A-Z]?[a-z]{2,}|[A-Z]{2,}")


class Context(NamedTuple):
    """What stands around a text: names of elements (tag:p) and words of their class, id and role
    (name:menu); whether it is hidden; and its mark in labelled pages (see ``MARKS``)."""

    names: frozenset[str]
    hidden: bool
    mark: int | None


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    context: Context


#: Attributes that label an element's text: main text, or not.
MARKS = {"data-main": 1, "data-rest": 0}
_TOP = Context(frozenset(), False, None)


@lru_cache(maxsize=1 << 14)
def _described(tag: str, attributes: str) -> tuple[frozenset[str], bool, int | None]:
    names, hidden, mark = {f"tag:{tag}"}, tag in HIDDEN, None
    for key, *values in _ATTRIBUTE.findall(attributes) if attributes.strip(" /") else ():
        key, value = key.lower(), "".join(values)
        if key in ("class", "id", "role", "itemprop") and tag not in ("html", "body"):
            names |= {f"name:{w.lower()}" for w in _NAMES.findall(value)}
        elif key in MARKS:
            mark = MARKS[key]
        elif key == "hidden" or (key == "style" and re.search(r"display\s*:\s*none", value, re.IGNORECASE)):
            hidden = True
    return frozenset(names), hidden, mark


def tokens(source: str) -> Iterator[Block | str]:
    """Blocks in page order and, as strings, the names of the tags between and inside them.

    Text is decoded, its white space turned into single spaces; line breaks count as white space.
    Unclosed paragraphs, list items and cells end where the next one begins; other tags may be
    missing or stray.  Comments, scripts and styles give nothing.
    """
    stack: list[tuple[str, Context]] = []
    open_: dict[str, int] = {}
    parts: list[tuple[str, bool]] = []
    inside: list[str] = []  # inline tags of the block
    link = False
    at = 0

    def flush() -> Iterator[Block | str]:
        text = " ".join("".join([p for p, _ in parts]).split())
        if text:
            linked = sum(len(p.split()) for p, a in parts if a)
            yield Block(text, text.count(" ") + 1, linked, stack[-1][1] if stack else _TOP)
        yield from inside
        parts.clear()
        inside.clear()

    def close(name: str) -> None:
        while stack:
            top = stack.pop()[0]
            open_[top] -= 1
            if top == name:
                return

    def text(piece: str) -> None:
        if piece:
            parts.append((html.unescape(piece) if "&" in piece else piece, link))

    for m in _TOKEN.finditer(source):
        text(source[at : m.start()])
        at = m.end()
        if m[4] is None:
            if m[1]:
                yield from flush()
                yield m[1].lower()
            continue
        name, ends = m[4].lower(), bool(m[3])
        if name in INLINE or name in VOID and name != "hr":
            if name == "a":
                link = not ends
            if name == "br":
                parts.append((" ", False))
            inside.append(name)
            continue
        yield from flush()
        yield name
        if ends:
            link = False
            if open_.get(name):
                close(name)
        elif name != "hr":
            for also in (("p",) if name in ENDS_P else ()) + SIBLINGS.get(name, ()):
                while stack and stack[-1][0] == also:
                    close(also)
            own, hidden, mark = _described(name, m[5])
            above = stack[-1][1] if stack else _TOP
            names = above.names if own <= above.names else above.names | own
            stack.append((name, Context(names, above.hidden or hidden, above.mark if mark is None else mark)))
            open_[name] = open_.get(name, 0) + 1
    text(source[at:])
    yield from flush()
