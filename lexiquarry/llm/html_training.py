"""Training pages for the block labeller: real words in drawn-up layouts with known labels.

The pages of a corpus carry no labels. Their sentences are set anew, as articles
and as what surrounds articles, in layouts drawn from the usual elements and
names, some without telling names, some with misleading nesting. Which part a
block was written for is its label.
"""

from __future__ import annotations

import html

import numpy as np

# Names that site builders use for each part of a page.
MAIN_NAMES = "article post entry story content main body text page single hentry prose copy read chapter news".split()
OTHER_NAMES = {
    "menu": "nav menu navbar navigation topnav breadcrumb breadcrumbs tabs links toc pagination pager".split(),
    "header": "header masthead banner top topbar branding logo hero site tagline title".split(),
    "footer": "footer bottom colophon copyright legal imprint credits contact".split(),
    "sidebar": "sidebar aside side widget rail secondary related recommended trending popular teaser box".split(),
    "notice": "cookie consent notice gdpr alert warning modal popup overlay paywall banner privacy message".split(),
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion banner commercial partner dfp".split(),
    "form": "form search login signup subscribe newsletter register feedback field".split(),
    "comments": "comments comment respond replies reply discussion disqus thread reader reviews review responses".split(),
    "share": "share social meta byline tags tools toolbar actions follow print author".split(),
}
ELEMENTS = {
    "menu": ["nav", "div", "ul"],
    "header": ["header", "div"],
    "footer": ["footer", "div"],
    "sidebar": ["aside", "div", "section"],
    "notice": ["div", "section", "dialog"],
    "advert": ["div", "aside", "ins"],
    "form": ["form", "div"],
    "comments": ["section", "div", "ol"],
    "share": ["div", "ul", "p"],
}
NEUTRAL = "wrap wrapper container row col inner outer box block grid flex left right center x1 u2 css layout area".split()


class Setter:
    """Writes one page at a time; each text it sets is remembered with its label."""

    def __init__(self, sentences: list[str], seed: int):
        self.rng = np.random.default_rng(seed)
        self.sentences = sentences
        self.labels: list[int] = []

    def pick(self, items):
        return items[int(self.rng.integers(len(items)))]

    def chance(self, share: float) -> bool:
        return bool(self.rng.random() < share)

    def words(self, low: int, high: int) -> str:
        source, many = self.pick(self.sentences).split(), int(self.rng.integers(low, high + 1))
        while len(source) < many:
            source += self.pick(self.sentences).split()
        start = int(self.rng.integers(len(source) - many + 1))
        return " ".join(source[start : start + many])

    def block(self, label: int, text: str) -> str:
        self.labels.append(label)
        return html.escape(text, quote=False)

    def name(self, pool: list[str]) -> str:
        parts = [self.pick(pool)]
        if self.chance(0.4):
            parts.insert(int(self.rng.integers(2)), self.pick(NEUTRAL + pool))
        joined = self.pick(["-", "_", " "]).join(parts)
        return f' {self.pick(["class", "class", "id"])}="{joined}"'

    def attributes(self, pool: list[str], share: float) -> str:
        if self.chance(share):
            return self.name(pool)
        return self.name(NEUTRAL) if self.chance(0.3) else ""

    def linked(self, label: int, low: int = 1, high: int = 4) -> str:
        return f'<a href="/{self.rng.integers(999)}">{self.block(label, self.words(low, high))}</a>'

    def paragraph(self, label: int, low: int = 3, high: int = 60) -> str:
        text = self.block(label, self.words(low, high))
        if self.chance(0.15):
            cut = text.find(" ", len(text) // 2)
            if cut > 0:
                text = f'{text[:cut]} <a href="#">{text[cut + 1 :].split(" ")[0]}</a> {" ".join(text[cut + 1 :].split(" ")[1:])}'
        if self.chance(0.1):
            text = f"<b>{text}" + self.pick(["</b>", "<br>"])
        close = "</p>" if self.chance(0.9) else ""
        return f"<p{self.attributes(MAIN_NAMES, 0.03) if label else ''}>{text}{close}"

    def list_of(self, label: int, linked: bool) -> str:
        many = int(self.rng.integers(2, 8))
        inner = [self.linked(label) if linked else self.block(label, self.words(2, 20)) for _ in range(many)]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in inner) + "</ul>"

    def other(self, kind: str) -> str:
        """A part that isn't the article."""
        tag = self.pick(ELEMENTS[kind])
        telling = tag in ("nav", "footer", "aside", "form", "header")
        attributes = self.attributes(OTHER_NAMES[kind], 0.3 if telling else 0.95)
        if kind == "menu":
            inner = self.list_of(0, True) if tag != "ul" else "".join(f"<li>{self.linked(0)}</li>" for _ in range(4))
        elif kind == "header":
            inner = f"<{self.pick(['h1', 'h2', 'div', 'p'])}>{self.block(0, self.words(1, 6))}"
            inner += f"<p>{self.block(0, self.words(3, 12))}</p>" if self.chance(0.5) else ""
        elif kind == "footer":
            inner = f"<p>&copy; {self.block(0, self.words(2, 14))}</p>" if self.chance(0.5) else "&copy; " + self.block(0, self.words(2, 14))
            inner += self.list_of(0, True) if self.chance(0.3) else ""
        elif kind == "sidebar":
            inner = f"<h3>{self.block(0, self.words(1, 5))}</h3>" if self.chance(0.6) else ""
            inner += self.list_of(0, self.chance(0.7)) if self.chance(0.5) else self.paragraph(0, 4, 50)
        elif kind == "form":
            inner = f"<label>{self.block(0, self.words(1, 4))}</label><input type=text>" + (self.paragraph(0, 3, 20) if self.chance(0.4) else "")
            inner += f"<button>{self.block(0, self.words(1, 3))}</button>"
        elif kind == "comments":
            each = "li" if tag == "ol" else "div"
            inner = f"<h3>{self.block(0, self.words(1, 4))}</h3>" if self.chance(0.6) and tag != "ol" else ""
            for _ in range(int(self.rng.integers(1, 6))):
                who = f"<span>{self.words(1, 2)}</span> " if self.chance(0.5) else ""
                inner += f"<{each}{self.attributes(OTHER_NAMES['comments'], 0.5)}><p>{who}{self.block(0, self.words(4, 50))}</p></{each}>"
        elif kind == "share":
            inner = self.linked(0) if tag != "ul" else f"<li>{self.linked(0)}</li>"
        else:
            inner = self.block(0, self.words(3, 30)) if self.chance(0.5) else self.paragraph(0, 3, 40)
        return f"<{tag}{attributes}>{inner}</{tag}>"

    def main(self) -> str:
        """The article."""
        tag = self.pick(["article", "article", "article", "main", "div", "section", "div"])
        attributes = self.attributes(MAIN_NAMES, 0.3 if tag in ("article", "main") else 0.97)
        inner = f"<h1>{self.block(1, self.words(2, 12))}</h1>" if self.chance(0.85) else ""
        inner += self.other("share") if self.chance(0.15) else ""
        if self.chance(0.2):
            body = self.pick(["div", "section"])
            inner += f"<{body}{self.attributes(MAIN_NAMES, 0.8)}>"
        else:
            body = ""
        # Some articles are long, some are of very short paragraphs.
        brief, many = self.chance(0.1), int(self.rng.integers(1, 60 if self.chance(0.1) else 18))
        for _ in range(many):
            kind = self.rng.random()
            if kind < 0.82:
                inner += self.paragraph(1, 1, 4) if brief or self.chance(0.08) else self.paragraph(1)
            elif kind < 0.87:
                inner += f"<h2>{self.block(1, self.words(1, 8))}</h2>"
            elif kind < 0.91:
                inner += self.list_of(1, False)
            elif kind < 0.94:
                inner += f"<blockquote>{self.paragraph(1, 5, 40)}</blockquote>"
            elif kind < 0.96:
                inner += "<table>" + "".join(f"<tr><td>{self.block(1, self.words(1, 4))}</td><td>{self.block(1, self.words(1, 4))}</td></tr>" for _ in range(3)) + "</table>"
            else:
                inner += self.other(self.pick(["advert", "advert", "form", "sidebar", "share", "notice"]))
        inner += f"</{body}>" if body else ""
        inner += self.other("share") if self.chance(0.15) else ""
        inner += self.other("comments") if self.chance(0.15) else ""
        return f"<{tag}{attributes}>{inner}</{tag}>"

    def page(self) -> tuple[str, list[int]]:
        self.labels = []
        parts = []
        for kind, share in (("notice", 0.25), ("header", 0.4), ("menu", 0.75), ("form", 0.15), ("advert", 0.5), ("sidebar", 0.15), ("menu", 0.15)):
            if self.chance(share):
                parts.append(self.other(kind))
        order = list(range(len(parts)))
        if self.chance(0.3):
            # The parts are already labelled in this order, so all are of label 0 and may change places.
            self.rng.shuffle(order)
        before = [parts[k] for k in order]
        main = self.main()
        after = []
        for kind, share in (("share", 0.2), ("sidebar", 0.4), ("comments", 0.4), ("advert", 0.3), ("form", 0.2), ("notice", 0.15), ("menu", 0.15), ("footer", 0.85)):
            if self.chance(share):
                after.append(self.other(kind))
        middle = "".join([main, *after[:-1]])
        if self.chance(0.3):
            middle = f"<div{self.attributes(NEUTRAL, 0.9)}>{middle}</div>"
        comment = "<!-- x -->" if self.chance(0.3) else ""
        page = f"<!DOCTYPE html><html><head><title>{self.words(1, 8)}</title><script>var a='<p>';</script></head><body>"
        return page + "".join(before) + comment + middle + "".join(after[-1:]) + "</body></html>", self.labels
