"""Labelled pages to train the page model on: layouts drawn at random, with the state of each element known."""
from __future__ import annotations

import random

from veilnote.llm.dom import Page, parse

# Words that the pages' texts are made of.
WORDS = ("time year people way day thing man world life hand part child eye woman place work week case point company number group problem fact "
         "house river stone bread light water green long small early public open le la maison jour der und haus zeit el sol casa").split()
CONTENT_NAMES = ("article", "post-content", "entry-content", "main-text", "story-body", "content", "article__body", "prose", "")
SIDE_NAMES = ("sidebar", "related-posts", "widget", "popular", "tags", "more-stories")
NOTICE_NAMES = ("cookie-notice", "consent", "newsletter-signup", "alert", "promo-box", "popup")
ADVERT_NAMES = ("ad", "ads", "advertisement", "sponsored", "ad-slot")
TALK_NAMES = ("comments", "comment-list", "respond", "discussion", "disqus_thread")

#: Marks a page whose text outside of any element is content.
BARE = "<!--state1-->"


class Writer:
    """Writes html; every element is marked with its state, which is read back and removed by `labelled`."""

    def __init__(self, seed: int) -> None:
        self.draw, self.out = random.Random(seed), []

    def words(self, lo: int, hi: int) -> str:
        text = " ".join(self.draw.choice(WORDS) for _ in range(self.draw.randint(lo, hi)))
        return text.capitalize() + self.draw.choice((".", ".", "", "!", " &amp; more."))

    def open(self, tag: str, content: bool, name: str = "") -> None:
        kind = f' {self.draw.choice(("class", "class", "id"))}="{name}"' if name else ""
        self.out.append(f'<{tag}{kind} data-state="{int(content)}">')

    def close(self, tag: str) -> None:
        self.out.append(f"</{tag}>")

    def element(self, tag: str, content: bool, text: str, name: str = "", closed: bool = True) -> None:
        self.open(tag, content, name)
        self.out.append(text)
        if closed:
            self.close(tag)

    def links(self, tag: str, name: str = "", listed: bool = True) -> None:
        self.open(tag, False, name)
        if listed:
            self.open("ul", False)
        for _ in range(self.draw.randint(2, 9)):
            if listed:
                self.open("li", False)
            self.element("a", False, self.words(1, 4))
            if listed:
                self.close("li")
        if listed:
            self.close("ul")
        self.close(tag)

    def paragraph(self) -> None:
        self.open("p", True)
        if self.draw.random() < 0.15:
            self.element("b", True, self.words(1, 60) + "<br>", closed=False)
            return
        self.out.append(self.words(1, 80 if self.draw.random() < 0.6 else 8))
        for _ in range(self.draw.choice((0, 0, 0, 1, 2))):
            self.element(self.draw.choice(("a", "b", "em", "i", "strong", "span", "code")), True, self.words(1, 12))
            self.out.append(" " + self.words(2, 40))
        if self.draw.random() < 0.8:
            self.close("p")

    def boilerplate(self) -> None:
        kind = self.draw.randrange(7)
        if kind == 0:
            self.links(self.draw.choice(("nav", "div")), self.draw.choice(("menu", "navbar", "breadcrumbs", "pagination")))
        elif kind == 1:
            self.element("div", False, self.words(2, 25), self.draw.choice(ADVERT_NAMES))
        elif kind == 2:
            self.open(self.draw.choice(("div", "section")), False, self.draw.choice(NOTICE_NAMES))
            self.element("p", False, self.words(5, 40))
            self.close("section" if self.out[-4].startswith("<section") else "div")
        elif kind == 3:
            tag = self.draw.choice(("aside", "div"))
            self.open(tag, False, self.draw.choice(SIDE_NAMES))
            self.element("h3", False, self.words(1, 3))
            self.links("div")
            if self.draw.random() < 0.5:
                self.element("p", False, self.words(5, 30))
            self.close(tag)
        elif kind == 4:
            self.open("form", False, self.draw.choice(("", "search", "login")))
            self.element("label", False, self.words(1, 3))
            self.element("p", False, self.words(2, 9))
            self.element("button", False, self.words(1, 2))
            self.close("form")
        elif kind == 5:
            self.element("div", False, self.words(1, 6), self.draw.choice(("share", "social", "byline", "meta")))
        else:
            self.element("p", False, self.words(3, 15), self.draw.choice(ADVERT_NAMES + NOTICE_NAMES))

    def article(self) -> None:
        tag = self.draw.choice(("article", "article", "main", "div", "section"))
        name = self.draw.choice(CONTENT_NAMES)
        name = name or ("content" if tag in ("div", "section") else "")
        self.open(tag, True, name)
        if self.draw.random() < 0.8:
            self.element(self.draw.choice(("h1", "h1", "h2")), True, self.words(2, 12))
        for _ in range(self.draw.choice((0, 0, 1, 1, 2, 4, 6, 12))):
            kind = self.draw.random()
            if kind < 0.7:
                self.paragraph()
            elif kind < 0.78:
                self.element(self.draw.choice(("h2", "h3", "h4")), True, self.words(1, 8))
            elif kind < 0.84:
                self.open("ul", True)
                for _ in range(self.draw.randint(1, 5)):
                    self.element("li", True, self.words(2, 25), closed=self.draw.random() < 0.7)
                self.close("ul")
            elif kind < 0.88:
                self.element(self.draw.choice(("blockquote", "pre", "div", "figcaption")), True, self.words(3, 40))
            elif kind < 0.91:
                self.open("table", True)
                self.open("tr", True)
                self.element("td", True, self.words(1, 6))
                self.element("td", True, self.words(1, 6))
                self.close("tr")
                self.close("table")
            elif kind < 0.94:
                self.out.append("<br>" + self.words(2, 20))
            else:
                self.boilerplate()
        self.close(tag)

    def comments(self) -> None:
        tag = self.draw.choice(("section", "div", "ol"))
        self.open(tag, False, self.draw.choice(TALK_NAMES))
        for _ in range(self.draw.randint(1, 6)):
            inner = self.draw.choice(("div", "li", "article"))
            self.open(inner, False, self.draw.choice(("comment", "comment", "reply")))
            self.element("p", False, self.words(3, 60))
            self.close(inner)
        self.close(tag)

    def page(self) -> str:
        self.out.append("<!DOCTYPE html><html><head><title>" + self.words(2, 9) + "</title><style>p{margin:0}</style></head>")
        self.open("body", False)
        if self.draw.random() < 0.6:
            self.open("header", False)
            self.element("h1" if self.draw.random() < 0.3 else "div", False, self.words(1, 5))
            self.close("header")
        if self.draw.random() < 0.8:
            self.links("nav", listed=self.draw.random() < 0.7)
        for _ in range(self.draw.choice((0, 1, 1, 2))):
            self.boilerplate()
        wrapped = self.draw.random() < 0.4
        if wrapped:
            self.open("div", True, self.draw.choice(("wrapper", "container", "page", "")))
        self.article()
        if wrapped:
            self.close("div")
        if self.draw.random() < 0.4:
            self.comments()
        for _ in range(self.draw.choice((0, 1, 2))):
            self.boilerplate()
        tag = self.draw.choice(("footer", "footer", "div"))
        self.element(tag, False, "&copy; " + self.words(3, 20), "" if tag == "footer" else "footer")
        return "".join(self.out) + self.draw.choice(("</body></html>", ""))


    def bare(self) -> str:
        """A page that is little more than its text: no markup, lines, some paragraphs, a short article, at times with a menu."""
        kind = self.draw.randrange(8)
        if kind < 2:
            self.out.append(BARE)
            for _ in range(self.draw.choice((1, 1, 2, 5))):
                self.out.append(self.words(1, 60) + self.draw.choice(("<br>", "\n\n", " ")))
            return "".join(self.out)
        whole = kind > 3
        if whole:
            self.out.append(self.draw.choice(("", "<!DOCTYPE html>")) + "<html>" + self.draw.choice(("", "<head><title>" + self.words(1, 6) + "</title></head>")))
        own = kind == 4                              # text right in the body
        if whole:
            self.open("body", own)
        if not own and self.draw.random() < 0.3:
            self.links("nav")
        if own:
            for _ in range(self.draw.choice((1, 2, 4))):
                self.out.append(self.words(1, 60) + self.draw.choice(("<br>", " ")))
        elif kind in (2, 5):
            for _ in range(self.draw.choice((1, 1, 2, 4))):
                self.element("p", True, self.words(1, 60) + self.draw.choice(("", " If a < b and b > c then a is small.")))
        else:
            tag = self.draw.choice(("article", "article", "main", "div"))
            self.open(tag, True, "content" if tag == "div" else "")
            if self.draw.random() < 0.5:
                self.open("header", True)
                self.element("h1", True, self.words(1, 8))
                if self.draw.random() < 0.5:
                    self.element("p", True, self.words(2, 15))
                self.close("header")
            for _ in range(self.draw.choice((1, 1, 2, 3))):
                self.element("p", True, self.words(1, 40))
            self.close(tag)
        if not own and self.draw.random() < 0.3:
            self.element("footer", False, "&copy; " + self.words(2, 10))
        return "".join(self.out) + ("</body></html>" if whole else "")


def labelled(source: str) -> tuple[Page, list[bool]]:
    """The tree without the marks, and the state of each element."""
    page = parse(source.removeprefix(BARE).replace(' data-state="', ' id="state'))
    states = [source.startswith(BARE)]
    for k, names in enumerate(page.names):
        if k:
            states.append("state1" in names.split())
        page.names[k] = " ".join(w for w in names.split() if w not in ("state0", "state1"))
    return page, states


def labelled_pages(count: int, seed: int = 0) -> list[tuple[Page, list[bool]]]:
    """Pages of which every fourth is bare."""
    return [labelled(Writer(seed + k).bare() if k % 4 == 3 else Writer(seed + k).page()) for k in range(count)]
