"""Labelled pages to train the text extractor on: invented layouts with a known main text.

Nothing here is taken from the tables. A page is nested parts (article, menus, side columns, adverts, comments, ...)
whose tags, class names and markup faults are drawn at random, so that no single cue gives the answer away.
"""

from __future__ import annotations

import numpy as np

_SYLLABLES = "ba ce di fo gu la me ni or pu ra se ti un ver wo xi ya zen the on ing ter".split()

# The attribute tokens of each part of a page.
NAMES = {
    "main": "content article post entry story main body text post-content article-body entry-content",
    "nav": "nav menu navbar breadcrumb breadcrumbs pagination topnav site-nav tabs toc",
    "header": "header masthead topbar branding logo site-header",
    "footer": "footer copyright legal site-footer bottom colophon",
    "side": "sidebar aside related widget recommended popular trending rail more-stories",
    "ad": "ad ads advert advertisement sponsor promo banner-ad sponsored",
    "notice": "cookie cookie-notice consent gdpr notice alert popup modal newsletter subscribe",
    "form": "form search login signup search-box contact-form",
    "comment": "comments comment reply discussion disqus responses comment-list",
    "social": "share social sharing follow social-links",
}
TAGS = {
    "main": "article main div div section",
    "nav": "nav nav div ul",
    "header": "header header div",
    "footer": "footer footer div",
    "side": "aside aside div section",
    "ad": "div div aside section p",
    "notice": "div div section p",
    "form": "form form div",
    "comment": "section div div ul",
    "social": "div ul",
}


class Writer:
    def __init__(self, seed: int):
        self.rng = np.random.default_rng(seed)

    def pick(self, options: str | list) -> str:
        options = options.split() if isinstance(options, str) else options
        return options[int(self.rng.integers(len(options)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def words(self, low: int, high: int) -> str:
        n = int(self.rng.integers(low, high + 1))
        out = ["".join(self.pick(_SYLLABLES) for _ in range(int(self.rng.integers(1, 4)))) for _ in range(n)]
        for i in range(n):
            if self.chance(0.1):
                out[i] += self.pick([",", ".", "&amp;", "%", "!", "***"])
        text = " ".join(out)
        return text[:1].upper() + text[1:] + ("." if n > 3 else "")

    def inline(self, text: str) -> str:
        kind = self.rng.random()
        if kind < 0.1:
            return f"<b>{text}</b>"
        if kind < 0.18:
            return f'{text} <a href="/x">{self.words(1, 3)}</a> {self.words(1, 8)}'
        if kind < 0.25:
            return f"<b>{text}<br>"
        return text

    def attributes(self, part: str, named: bool = False) -> str:
        kind = self.rng.random() if not named else 1.0
        if kind < 0.3:
            return ""
        value = self.pick(NAMES[part])
        if kind < 0.36:
            value = self.pick("box block wrapper c1 row inner")
        return f' {self.pick("class class id")}="{value}"'

    def links(self, low: int, high: int) -> str:
        items = [f'<a href="/{i}">{self.words(1, 3)}</a>' for i in range(int(self.rng.integers(low, high + 1)))]
        if self.chance(0.7):
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return self.pick([" | ", " ", "<br>"]).join(items)

    def paragraph(self) -> str:
        kind = self.rng.random()
        if kind < 0.2:
            text = self.words(1, 5)
        elif kind < 0.6:
            text = self.words(8, 50)
        else:
            text = self.words(50, 180)
        tag = "p" if self.chance(0.85) else self.pick("h2 h3 blockquote pre div")
        close = "" if tag == "p" and self.chance(0.2) else f"</{tag}>"
        return f"<{tag}>{self.inline(text)}{close}"

    def listing(self) -> str:
        return "<ul>" + "".join(f"<li>{self.words(3, 20)}</li>" for _ in range(int(self.rng.integers(2, 6)))) + "</ul>"

    def boilerplate(self, part: str, named: bool = False) -> str:
        """``named``: with a telling attribute, as inside an article nothing else tells it from the main text."""
        if part == "nav":
            inner = self.links(3, 10)
        elif part == "header":
            inner = self.pick([f"<h1>{self.words(1, 3)}</h1>", f"<a href='/'>{self.words(1, 2)}</a>", f"<p>{self.words(2, 6)}</p>"])
        elif part == "footer":
            inner = self.pick([f"&copy; {self.words(2, 12)}", f"&copy; example.com &middot; {self.words(2, 20)}", f"<p>&copy; 2024 {self.words(2, 9)}</p>" + self.links(2, 5), self.links(3, 8)])
        elif part == "side":
            inner = f"<h3>{self.words(1, 4)}</h3>" + self.pick([self.links(3, 8), f"<p>{self.words(5, 30)}</p>" + self.links(1, 3)])
        elif part == "ad":
            inner = self.pick([self.words(3, 25), f"<p>{self.words(3, 20)}</p>", f'<a href="//x">{self.words(2, 10)}</a>'])
        elif part == "notice":
            inner = f"<p>{self.words(6, 30)}</p>" + self.pick(["<button>Ok</button>", f"<a href='#'>{self.words(1, 2)}</a>", ""])
        elif part == "form":
            inner = f"<label>{self.words(1, 3)}</label><input name=q><button>{self.words(1, 1)}</button>"
        elif part == "comment":
            one = [f"<{t} class='{c}'><b>{self.words(1, 2)}</b> <p>{self.words(4, 45)}</p></{t}>" for t, c in [self.pick([("div", "comment"), ("li", "comment"), ("div", "c")])] * int(self.rng.integers(1, 5))]
            inner = f"<h3>{self.words(1, 3)}</h3>" + "".join(one)
        else:
            inner = self.links(2, 5)
        tag = self.pick(TAGS[part])
        return f"<{tag}{self.attributes(part, named)}>{inner}</{tag}>"

    def page(self) -> str:
        """Main parts carry the attribute ``data-keep``, which the features never see."""
        head = f"<!DOCTYPE html><html><head><title>{self.words(2, 8)}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head><body>"
        body = [f"<h1 data-keep>{self.words(2, 12)}</h1>"] if self.chance(0.8) else []
        for _ in range(int(self.rng.integers(1, self.pick([3, 4, 12, 40])))):
            piece = self.listing() if self.chance(0.06) else self.paragraph()
            body.append(piece.replace(">", " data-keep>", 1))
            if self.chance(0.05):
                body.append(self.boilerplate(self.pick("ad social side notice"), named=True))
        if self.chance(0.25):
            body.append(self.boilerplate(self.pick("comment social form"), named=True))
        tag = self.pick(TAGS["main"])
        inner = f"<{tag}{self.attributes('main')}>" + "".join(body) + f"</{tag}>"
        if self.chance(0.3):
            inner = f"<div{self.attributes('main')}>{inner}{self.boilerplate('side') if self.chance(0.4) else ''}</div>"
        above = [self.boilerplate(p) for p in ("notice", "header", "nav", "form", "ad") if self.chance(0.45)]
        below = [self.boilerplate(p) for p in ("social", "comment", "side", "ad", "notice", "footer") if self.chance(0.4)]
        if self.chance(0.5):
            above.append(f"<!-- {self.words(1, 2)} -->")
        return head + "".join(above) + inner + "".join(below) + "</body></html>"
