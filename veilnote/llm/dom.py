"""Pages as trees of elements with their own texts, read with one pass of a pattern."""
from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?=>)|[^>]*+)>", re.S)
_NAMES = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

# Kinds of elements by name, as HTML has them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
                   "strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section "
                     "table ul figure details".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


@dataclass
class Page:
    """Elements in page order, without those that hold nothing; the first is the page itself. texts: (element, text) and (-1, "") between blocks."""

    tags: list[str] = field(default_factory=lambda: ["#page"])
    names: list[str] = field(default_factory=lambda: [""])
    parents: list[int] = field(default_factory=lambda: [-1])
    depths: list[int] = field(default_factory=lambda: [0])
    texts: list[tuple[int, str]] = field(default_factory=list)


def parse(source: str) -> Page:
    """The tree of a page. Missing end tags are supplied, end tags without a start are left out, character references
    are decoded, comments and declarations dropped. Nothing is too long or too deep, and nothing makes it fail."""
    page, stack, at, last = Page(), [0], 0, source.rfind(">") + 1
    tags, texts, lower = page.tags, page.texts, None
    open_count: dict[str, int] = {}

    def pop() -> None:
        open_count[tags[stack.pop()]] -= 1

    while (found := _TOKEN.search(source, at, last)) is not None:
        if found.start() > at:
            texts.append((stack[-1], html.unescape(source[at:found.start()])))
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        inline = tag in INLINE
        if not inline:
            texts.append((-1, ""))
        if found[1]:
            if open_count.get(tag, 0):
                while tags[stack[-1]] != tag:
                    pop()
                pop()
            continue
        if tag in VOID:
            continue
        if tag in CLOSES_P and open_count.get("p", 0) and not any(tags[k] in ("td", "th", "li") for k in stack[-3:]):
            while tags[stack[-1]] != "p":
                pop()
            pop()
        elif tag in CLOSED_BY:
            while len(stack) > 1 and (tags[stack[-1]] in CLOSED_BY[tag] or tags[stack[-1]] in INLINE or tags[stack[-1]] == "p"):
                closing = tags[stack[-1]] in CLOSED_BY[tag]
                pop()
                if closing and tags[stack[-1]] not in CLOSED_BY[tag]:
                    break
        tags.append(tag)
        page.names.append(" ".join("".join(x) for x in _NAMES.findall(found[3])).lower() if found[3] else "")
        page.parents.append(stack[-1])
        page.depths.append(len(stack))
        if tag in RAW:
            lower = source.lower() if lower is None else lower
            end = lower.find(f"</{tag}", at)
            end = len(source) if end < 0 else end
            texts.append((len(tags) - 1, source[at:end]))
            close = source.find(">", end)
            at = len(source) if close < 0 else close + 1
            texts.append((-1, ""))
            continue
        stack.append(len(tags) - 1)
        open_count[tag] = open_count.get(tag, 0) + 1
    if at < len(source):
        texts.append((stack[-1], html.unescape(source[at:])))
    return page
