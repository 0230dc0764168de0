"""Labelled pages to train on: layouts drawn from a grammar, each leaf text marked as main text or not.

The grammar has menus, headers, footers, side columns, notices, adverts, forms, share rows and reader comments round and
inside an article, under the names that pages commonly give them, and articles with and without telling tags.
"""

from __future__ import annotations

import numpy as np

MAIN, OTHER = "\ue000", "\ue001"  # private-use marks before each leaf text, taken off again before features are read

# Common names of page parts.
ARTICLE = "article post content entry story main body text news blog page single".split()
MENU = "nav menu navbar navigation topbar tabs breadcrumb breadcrumbs pagination pager toc sitemap".split()
TOP = "header masthead top branding logo hero banner title site".split()
BOTTOM = "footer bottom copyright legal colophon foot credits".split()
SIDE = "sidebar side aside widget related recommended popular trending rail more links tags teaser".split()
NOTICE = "cookie cookies notice consent gdpr alert banner popup modal privacy message warning paywall".split()
ADVERT = "ad ads advert advertisement sponsored sponsor promo promotion adsense dfp partner banner".split()
FORM = "form subscribe newsletter signup login search register contact".split()
COMMENTS = "comments comment replies reply discussion disqus respond thread responses feedback reviews".split()
SHARE = "share social sharing buttons follow tools meta byline author".split()
SYLLABLES = "an be ci do er fa gu he in jo ka lo mi no or pa qui re st ta un ver wa xy zen é ü ß ñ".split()


class Draw:
    def __init__(self, seed: int):
        self.rng = np.random.default_rng(seed)

    def one(self, things):
        return things[int(self.rng.integers(len(things)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def word(self) -> str:
        return "".join(self.one(SYLLABLES) for _ in range(int(self.rng.integers(1, 5))))

    def words(self, least: int, most: int, style: str = "") -> str:
        said = [self.word() for _ in range(int(self.rng.integers(least, most + 1)))]
        if style == "loud":
            said = [w.upper() + "!!" for w in said]
        elif style == "marked":
            said = [w + self.one(["***", "###", "%%%", "$$$", "&amp;&amp;"]) for w in said]
        elif style == "table":
            return " | ".join(said)
        return " ".join(said).capitalize()

    def prose(self, most: int = 5, style: str = "") -> str:
        sentences = [self.words(3, 22, style) + self.one([".", ".", ".", "?", "!"]) for _ in range(int(self.rng.integers(1, most + 1)))]
        return self.one([" ", " ", "\n"]).join(sentences)

    def named(self, kinds: list[str], p: float = 0.85) -> str:
        """Attributes that name a part, in one of the usual spellings, or none."""
        if not self.chance(p):
            return ""
        name = self.one(kinds)
        more = self.one(["", "", f"-{self.one(['box', 'area', 'list', 'wrap', 'inner', 'container', 'block', 'section'])}", f"_{self.word()}", f" {self.word()}"])
        return f' {self.one(["class", "class", "id"])}="{name}{more}"'

    def leaf(self, mark: str, tag: str, text: str, attributes: str = "") -> str:
        if self.chance(0.1):
            text = f"<{self.one(['b', 'em', 'span', 'strong'])}>{text}" + self.one(["", f"</{self.one(['b', 'em', 'span', 'strong'])}>"])
        if mark == MAIN and self.chance(0.1):
            text += f' <a href="/{self.word()}">{self.word()}</a> {self.word()}.'
        return f"<{tag}{attributes}>{mark}{text}</{tag}>"

    def links(self, n: int) -> str:
        return "".join(f'<li><a href="/{self.word()}">{OTHER}{self.words(1, 4)}</a></li>' for _ in range(n))

    # Parts that are not main text.

    def menu(self) -> str:
        tag = self.one(["nav", "nav", "div", "ul", "header"])
        inner = self.links(int(self.rng.integers(2, 9)))
        return f"<{tag}{self.named(MENU, 0.3 if tag == 'nav' else 1)}>{inner if tag == 'ul' else f'<ul>{inner}</ul>'}</{tag}>"

    def top(self) -> str:
        tag = self.one(["header", "header", "div"])
        inner = self.leaf(OTHER, self.one(["h1", "div", "p", "span"]), self.words(1, 5)) + (self.leaf(OTHER, "p", self.words(3, 12)) if self.chance(0.5) else "")
        return f"<{tag}{self.named(TOP, 0.4 if tag == 'header' else 1)}>{inner}{self.menu() if self.chance(0.4) else ''}</{tag}>"

    def bottom(self) -> str:
        tag = self.one(["footer", "footer", "footer", "div"])
        inner = self.one([f"{OTHER}&copy; {self.word()}.com &middot; {self.prose(2)}", self.leaf(OTHER, "p", "&copy; 2020 " + self.prose(2)), f"<ul>{self.links(4)}</ul>"])
        return f"<{tag}{self.named(BOTTOM, 0.4 if tag == 'footer' else 1)}>{inner}{self.leaf(OTHER, 'p', self.prose(2)) if self.chance(0.4) else ''}</{tag}>"

    def side(self) -> str:
        tag = self.one(["aside", "aside", "div", "section"])
        inner = self.leaf(OTHER, self.one(["h3", "h4", "h2"]), self.words(1, 4)) + self.one([f"<ul>{self.links(4)}</ul>", self.leaf(OTHER, "p", self.prose(3)), self.leaf(OTHER, "div", self.prose(2))])
        return f"<{tag}{self.named(SIDE, 0.4 if tag == 'aside' else 1)}>{inner}</{tag}>"

    def notice(self) -> str:
        tag = self.one(["div", "div", "section", "aside", "dialog"])
        inner = self.one([f"{OTHER}{self.prose(2)}", self.leaf(OTHER, "p", self.prose(3))]) + (f"<button>{OTHER}{self.words(1, 2)}</button>" if self.chance(0.6) else "")
        return f"<{tag}{self.named(NOTICE, 1)}{self.one(['', ' role=\"alert\"', ' role=\"dialog\"'])}>{inner}</{tag}>"

    def advert(self) -> str:
        tag = self.one(["div", "div", "aside", "section", "p"])
        inner = f"{OTHER}{self.prose(2)}" if tag == "p" or self.chance(0.6) else self.leaf(OTHER, "p", self.prose(3)) + self.leaf(OTHER, "a", self.words(1, 4))
        return f"<!-- ad --><{tag}{self.named(ADVERT, 1)}>{inner}</{tag}>"

    def form(self) -> str:
        label = lambda: self.leaf(OTHER, self.one(["label", "p", "span"]), self.words(1, 8))
        return f'<form{self.named(FORM, 0.6)} action="/{self.word()}">{label()}<input name="a">{label() if self.chance(0.5) else ""}<select><option>{OTHER}{self.word()}</option><option>{OTHER}{self.word()}</option></select><button>{OTHER}{self.words(1, 2)}</button></form>'

    def share(self) -> str:
        return f"<{(t := self.one(['div', 'ul', 'p']))}{self.named(SHARE, 1)}>{self.links(3) if t == 'ul' else OTHER + self.words(2, 8)}</{t}>"

    def comments(self) -> str:
        tag = self.one(["section", "div", "ol", "ul", "aside"])
        out = "" if tag in ("ol", "ul") else self.leaf(OTHER, self.one(["h2", "h3", "h4"]), self.words(1, 3))
        for _ in range(int(self.rng.integers(1, 7))):
            inner = (self.leaf(OTHER, self.one(["h4", "b", "cite", "div"]), self.words(1, 3)) if self.chance(0.6) else "") + self.one([self.leaf(OTHER, "p", self.prose(5)), self.leaf(OTHER, "div", self.prose(4))])
            item = "li" if tag in ("ol", "ul") else self.one(["div", "article", "div", "section"])
            out += f"<{item}{self.named(COMMENTS, 0.6)}>{inner}</{item}>"
        return f"<{tag}{self.named(COMMENTS, 1)}>{out}{self.form() if self.chance(0.3) else ''}</{tag}>"

    # Main text.

    def main(self) -> str:
        style = self.one(["", "", "", "loud", "marked", "table"])
        plain = self.chance(0.25)  # paragraphs without any telling name
        out = self.leaf(MAIN, self.one(["h1", "h1", "h2"]), self.words(2, 9, style)) if self.chance(0.85) else ""
        if self.chance(0.12):
            out = f"<header>{out}</header>" if out else out
        for _ in range(int(self.rng.integers(1, 14))):
            kind = self.rng.random()
            if kind < 0.72:
                out += self.leaf(MAIN, "p", self.prose(self.one([1, 3, 8, 25]), style) if self.chance(0.9) else self.words(1, 2, style) + ".")
            elif kind < 0.78:
                out += self.leaf(MAIN, self.one(["h2", "h3"]), self.words(1, 7))
            elif kind < 0.83:
                tag = self.one(["ul", "ol"])
                out += f"<{tag}>" + "".join(self.leaf(MAIN, "li", self.words(2, 14)) for _ in range(3)) + f"</{tag}>"
            elif kind < 0.86:
                out += f"<blockquote>{self.leaf(MAIN, 'p', self.prose(3))}</blockquote>"
            elif kind < 0.88:
                out += f"<table><tr>{self.leaf(MAIN, 'td', self.words(1, 6))}{self.leaf(MAIN, 'td', self.words(1, 6))}</tr></table>"
            elif kind < 0.90:
                out += self.leaf(MAIN, "pre", self.words(4, 30))
            else:
                out += self.one([self.advert, self.side, self.share, self.form, self.notice, self.menu])()
        if self.chance(0.15):
            out += self.comments()
        tag = self.one(["article", "article", "main", "div", "section"])
        if tag in ("div", "section"):
            return f"<{tag}{'' if plain else self.named(ARTICLE, 1)}>{out}</{tag}>"
        return f"<{tag}{self.named(ARTICLE, 0.3)}>{out}</{tag}>"

    def page(self) -> str:
        before = [self.one([self.menu, self.top, self.notice, self.advert, self.form, self.side]) for _ in range(int(self.rng.integers(0, 5)))]
        after = [self.one([self.side, self.comments, self.comments, self.advert, self.form, self.notice, self.menu, self.share]) for _ in range(int(self.rng.integers(0, 4)))]
        body = "".join(f() for f in before)
        main = self.main()
        if self.chance(0.3):
            wrap = self.one(["main", "div", 'div id="wrapper"', 'div class="container"', 'div class="layout page"'])
            main = f"<{wrap}>{main}{self.side() if self.chance(0.5) else ''}</{wrap.split()[0]}>"
        body += main + "".join(f() for f in after) + (self.bottom() if self.chance(0.85) else "")
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title><style>p{{margin:0}}</style></head><body>{body}</body></html>"


def labelled_pages(n: int, seed: int) -> list[str]:
    draw = Draw(seed)
    return [draw.page() for _ in range(n)]
