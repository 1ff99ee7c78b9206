"""Made-up labelled pages, on which the block labeller is trained.

Each page comes with the label of each of its blocks, in page order: 1 for the article's own text.
The layouts vary in their elements, class names and order; the words are random syllables, so that
what is learned is where a block stands, and the few words that give notices and menus away.
"""

from __future__ import annotations

import random

SYLLABLES = "th er on an in en re at st ing le la de que ou ch sch ung der ar os as ci ra ko mi ta no".split()
# Names by which page authors mark what is not the article, and what is.
BOILER = (
    "ad ads advert advertisement sponsored sponsor promo banner menu navbar navigation sidebar side widget breadcrumb breadcrumbs toolbar header footer "
    "site-header site-footer masthead topbar copyright legal cookie cookies consent notice alert popup modal newsletter subscribe signup login search "
    "share social sharing related recommended more-stories pagination pager tags meta-links comments comment reply respond disqus feedback skip-link"
).split()
#: Names that stand on articles and on other things alike, so that they say nothing.
NEUTRAL = "box block inner wrap wrapper container row col grid item list unit module section panel card area left right top bottom c1 c2 x main-wrap clearfix".split()
CONTENT = "content post post-body entry entry-content article article-body story story-body main-text text body-text page-content".split()
BOILER_WORDS = (
    "home about contact login subscribe newsletter privacy terms cookies copyright menu search share reply share next previous advertisement sponsored rights reserved "
    "sign up read more accept reject comments impressum kontakt datenschutz accueil mentions inicio"
).split()


def _words(rng: random.Random, n: int) -> str:
    out = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    if rng.random() < 0.6:
        out[0] = out[0].capitalize()
        out[-1] += "."
    return " ".join(out)


class Page:
    """Collects markup and the labels of the blocks it makes."""

    def __init__(self, seed: int) -> None:
        self.rng = random.Random(seed)
        self.html: list[str] = []
        self.labels: list[int] = []

    def block(self, tag: str, text: str, label: int, attrs: str = "", closed: bool = True) -> None:
        rng = self.rng
        if label and rng.random() < 0.15:
            text = f"<b>{text}" + ("</b>" if rng.random() < 0.5 else "")
        if label and rng.random() < 0.1:
            text += "<br>"
        self.html.append(f"<{tag}{attrs}>{text}" + (f"</{tag}>" if closed else ""))
        self.labels.append(label)

    def boiler_text(self, most: int) -> str:
        rng = self.rng
        if rng.random() < 0.35:
            return " ".join(rng.choice(BOILER_WORDS) for _ in range(rng.randint(1, 4)))
        return _words(rng, rng.randint(1, most))

    def menu(self, wrapper: str, attrs: str = "") -> None:
        self.html.append(f"<{wrapper}{attrs}><ul>")
        for _ in range(self.rng.randint(2, 9)):
            self.block("li", f'<a href="/x">{self.boiler_text(2)}</a>', 0)
        self.html.append(f"</ul></{wrapper}>")

    def neutral(self) -> str:
        return f' {self.rng.choice(["class", "class", "id"])}="{self.rng.choice(NEUTRAL)}{self.rng.choice(["", "", "-1", " " + self.rng.choice(NEUTRAL)])}"' if self.rng.random() < 0.4 else ""

    def unseen(self) -> None:
        """Markup without text of its own, closed, open or odd."""
        rng = self.rng
        kind = rng.randrange(7)
        body = rng.choice(["var t='</p>';", "if (a<b) { x(\"<div>\") }", "/* <nav> */", "p > a { color: red }"])
        self.html.append(
            [
                f"<script>{body}</script>", f"<style type=\"text/css\">{body}</style>", f"<!-- {_words(rng, 5)} <p> -->", f"<noscript><img src=\"/p.gif\">{_words(rng, 3)}</noscript>",
                f'<iframe src="/embed">{rng.choice(["", _words(rng, 2)])}</iframe>', f'<svg viewBox="0 0 1 1"><title>{_words(rng, 1)}</title><path d="M0 0"/></svg>', "<hr>",
            ][kind]
        )

    def table(self, label: int, attrs: str = "") -> None:
        rng = self.rng
        rows, columns = rng.randint(1, 4), rng.randint(1, 4)
        self.html.append(f"<table{attrs}>" + rng.choice(["", "<tbody>"]))
        for r in range(rows):
            self.html.append("<tr>")
            for _ in range(columns):
                tag = "th" if r == 0 and rng.random() < 0.5 else "td"
                text = _words(rng, rng.choice([1, 1, 2, 4, 12])) if rng.random() < 0.7 else str(rng.randrange(10_000))
                self.block(tag, text if label else rng.choice([text, f'<a href="/t">{text}</a>']), label, closed=rng.random() < 0.8)
            self.html.append("</tr>" if rng.random() < 0.8 else "")
        self.html.append("</table>")

    def link_list(self) -> None:
        """A heading and its links, as beside or below articles, under names that may say nothing."""
        rng = self.rng
        self.html.append(f"<{(tag := rng.choice(['div', 'section', 'aside', 'div']))}{self.neutral()}>")
        self.block(rng.choice(["h2", "h3", "h4", "div"]), rng.choice(["Most read", "More stories", "Related", "Read next", "Latest", "Popular", "You may also like"]) if rng.random() < 0.5 else _words(rng, rng.randint(1, 3)), 0)
        self.html.append(rng.choice(["<ul>", "<ol>"]))
        for _ in range(rng.randint(2, 6)):
            self.block("li", f'<a href="/s">{_words(rng, rng.randint(2, 9))}</a>', 0)
        self.html.append(f"</{tag}>")

    def boiler(self, inside: bool) -> None:
        rng = self.rng
        if rng.random() < 0.15:
            self.unseen()
        if not inside and rng.random() < 0.15:
            return self.link_list()
        if not inside and rng.random() < 0.05:
            return self.table(0, f' class="{rng.choice(BOILER)}"')
        kind = rng.random()
        name = f' {rng.choice(["class", "class", "id"])}="{rng.choice(BOILER)}"'
        if kind < 0.3 and not inside:
            self.menu(rng.choice(["nav", "nav", "div", "header", "aside"]), rng.choice(["", name]) if kind < 0.2 else name)
        elif kind < 0.45:
            self.html.append(f"<form{rng.choice(['', name])}>")
            for _ in range(rng.randint(1, 3)):
                self.block(rng.choice(["label", "p", "div"]), self.boiler_text(5), 0)
            self.block("button", self.boiler_text(2), 0)
            self.html.append("</form>")
        elif kind < 0.6:
            self.html.append(f"<{(tag := rng.choice(['aside', 'aside', 'section', 'div']))}{name}>")
            for _ in range(rng.randint(1, 4)):
                self.block(rng.choice(["p", "h3", "div", "p"]), self.boiler_text(25), 0)
            self.html.append(f"</{tag}>")
        elif kind < 0.75:
            self.html.append(f'<{(tag := rng.choice(["section", "div", "ol"]))} {rng.choice(["class", "id"])}="{rng.choice(["comments", "comment-list", "discussion", "responses"])}">')
            for _ in range(rng.randint(1, 5)):
                self.html.append('<div class="comment">')
                self.block("p", self.boiler_text(40), 0)
                self.html.append("</div>")
            self.html.append(f"</{tag}>")
        else:
            self.block("div", self.boiler_text(20), 0, name)

    def article(self) -> None:
        rng = self.rng
        wrappers = []
        for _ in range(rng.choice([0, 1, 1, 2])):
            tag = rng.choice(["article", "article", "main", "div", "div"])
            name = f' {rng.choice(["class", "id"])}="{rng.choice(CONTENT)}"' if tag == "div" or rng.random() < 0.2 else self.neutral()
            wrappers.append(tag)
            self.html.append(f"<{tag}{name}>")
        if not wrappers:
            wrappers.append("article")
            self.html.append("<article>")
        if rng.random() < 0.8:
            self.block("h1", _words(rng, rng.randint(1, 12)), 1)
        for _ in range(rng.choice([1, 2, 3, 5, 8, 14])):
            if rng.random() < 0.08:
                self.unseen()
            if rng.random() < 0.06:
                self.table(1, self.neutral())
            if rng.random() < 0.05:
                self.html.append("<figure><img src='/i.jpg'>")
                self.block("figcaption", _words(rng, rng.randint(2, 14)), 1)
                self.html.append("</figure>")
            if rng.random() < 0.08:  # wrapped paragraphs
                self.html.append(f"<div{self.neutral()}>")
                for _ in range(rng.randint(1, 3)):
                    self.block("p", _words(rng, rng.choice([3, 15, 40])), 1)
                self.html.append("</div>")
            kind = rng.random()
            if kind < 0.72:
                self.block("p", _words(rng, rng.choice([1, 2, 6, 15, 40, 90])), 1, closed=rng.random() < 0.8)
            elif kind < 0.8:
                self.block(rng.choice(["h2", "h3"]), _words(rng, rng.randint(1, 6)), 1)
            elif kind < 0.86:
                self.html.append("<ul>")
                for _ in range(rng.randint(2, 4)):
                    self.block("li", _words(rng, rng.randint(1, 14)), 1)
                self.html.append("</ul>")
            elif kind < 0.92:
                self.block(rng.choice(["blockquote", "pre", "div"]), _words(rng, rng.randint(3, 40)), 1)
            else:
                self.boiler(inside=True)
        self.html += [f"</{tag}>" for tag in reversed(wrappers)]

    def made(self) -> tuple[str, list[int]]:
        rng = self.rng
        self.html.append("<!DOCTYPE html><html><head>")
        self.block("title", _words(rng, rng.randint(1, 12)), 0)
        self.html.append("<style>p{margin:0}</style><script>var t='</p>';</script></head><body>")
        if rng.random() < 0.5:
            self.menu("nav")
        if rng.random() < 0.4:
            self.html.append("<header>")
            self.block(rng.choice(["div", "h1", "p", "span"]), self.boiler_text(8), 0)
            self.html.append("</header>")
        for _ in range(rng.randint(0, 3)):
            self.boiler(inside=False)
        self.article()
        for _ in range(rng.randint(0, 3)):
            self.boiler(inside=False)
        if rng.random() < 0.7:
            text = "&copy; " + self.boiler_text(25)
            if rng.random() < 0.5:
                self.block("footer", text, 0)
            else:
                self.html.append("<footer>")
                self.block("p", text, 0)
                self.html.append("</footer>")
        if rng.random() < 0.8:
            self.html.append("</body></html>")
        return "".join(self.html), self.labels


def labelled_page(seed: int) -> tuple[str, list[int]]:
    """The markup and block labels of page ``seed``, always the same."""
    return Page(seed).made()
