"""Labelled pages for training: layouts put together from the parts that pages are made of.

``data-y`` on an element says whether its text is content; what lies inside an
element without one is labelled as that element is.
"""

from __future__ import annotations

import random

_MENU = ["nav", "menu", "navbar", "navigation", "topnav", "main-menu", "site-nav", "breadcrumb", "breadcrumbs", "pagination", "pager", "toolbar", "tabs", "links", "toc"]
_HEADER = ["header", "site-header", "masthead", "top", "banner", "branding", "logo", "page-header", "topbar"]
_FOOTER = ["footer", "site-footer", "bottom", "copyright", "colophon", "legal", "page-footer", "credits"]
_SIDE = ["sidebar", "side", "widget", "related", "rail", "aside", "recommended", "popular", "trending", "tags", "archive", "author-box", "share", "social", "sharing", "meta-bar"]
_NOTICE = ["cookie", "cookie-banner", "consent", "notice", "gdpr", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "paywall", "toast", "announcement"]
_ADVERT = ["ad", "ads", "advert", "advertisement", "sponsored", "sponsor", "promo", "promotion", "banner-ad", "ad-slot", "adbox", "commercial"]
_COMMENTS = ["comments", "comment", "comment-list", "commentlist", "responses", "discussion", "disqus", "replies", "reply", "reader-comments", "feedback"]
_CONTENT = ["content", "article", "post", "entry", "entry-content", "post-content", "article-body", "story", "main", "main-content", "text", "body-text", "page-content", "prose", "body"]


class _Maker:
    def __init__(self, seed: int) -> None:
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choices("etaoinshrdlu", k=self.r.randint(1, 9)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def sentences(self, low: int, high: int) -> str:
        return " ".join(self.words(3, 18).capitalize() + self.r.choice([".", ".", ".", ",", "?", "!"]) for _ in range(self.r.randint(low, high)))

    def named(self, tags: list[str], names: list[str], inside: str, y: int, bare: float = 0.1) -> str:
        tag, name = self.r.choice(tags), self.r.choice(names)
        if self.r.random() < 0.3:
            name += f"{self.r.choice(['-', '_', ' '])}{self.r.choice(['box', 'wrap', 'area', 'inner', 'x1', 'main', 'block', 'container'])}"
        known = "" if self.r.random() < bare else f' {self.r.choice(["class", "class", "id"])}="{name}"'
        return f'<{tag}{known} data-y="{y}">{inside}</{tag}>'

    def links(self, low: int, high: int) -> str:
        items = [f'<a href="/{self.word()}">{self.words(1, 4)}</a>' for _ in range(self.r.randint(low, high))]
        kind = self.r.randint(0, 2)
        return " | ".join(items) if kind == 0 else f"<ul>{''.join(f'<li>{x}</li>' for x in items)}</ul>" if kind == 1 else "".join(f"<div>{x}</div>" for x in items)

    def paragraph(self) -> str:
        text = self.sentences(1, self.r.choice([1, 2, 4, 8]))
        if self.r.random() < 0.25:
            text += f' <a href="/x">{self.words(1, 4)}</a> {self.sentences(1, 2)}'
        if self.r.random() < 0.2:
            text = f"<b>{text}" + self.r.choice(["</b>", "", "<br>"])
        return f"<p>{text}" + self.r.choice(["</p>", "</p>", "</p>", ""])

    def piece(self) -> str:
        kind = self.r.random()
        if kind < 0.72:
            return self.paragraph()
        if kind < 0.82:
            return f"<h2>{self.words(1, 7)}</h2>"
        if kind < 0.88:
            return f"<ul>{''.join(f'<li>{self.sentences(1, 2)}</li>' for _ in range(self.r.randint(1, 5)))}</ul>"
        if kind < 0.92:
            return f"<blockquote><p>{self.sentences(1, 3)}</p></blockquote>"
        if kind < 0.95:
            return f"<table>{''.join(f'<tr><td>{self.words(1, 4)}</td><td>{self.words(1, 6)}</td></tr>' for _ in range(self.r.randint(1, 4)))}</table>"
        if kind < 0.97:
            return f"<pre>{self.words(4, 30)}</pre>"
        return f"<figure><figcaption>{self.words(3, 12)}</figcaption></figure>"

    def advert(self) -> str:
        return self.named(["div", "div", "aside", "section"], _ADVERT, self.r.choice([self.sentences(1, 3), f"<p>{self.sentences(1, 2)}</p>", f'<a href="/buy">{self.words(2, 9)}</a>']), 0, 0)

    def form(self) -> str:
        return f'<form data-y="0"><label>{self.words(1, 3)}</label><input name="q"><select><option>{self.word()}<option>{self.word()}</select><p>{self.sentences(0, 2)}</p><button>{self.words(1, 2)}</button></form>'

    def comments(self) -> str:
        each = [self.named(["div", "li", "article"], ["comment", "reply", "comment-body", "post-comment"], f'<div class="author">{self.words(1, 2)}</div>{self.paragraph()}', 0) for _ in range(self.r.randint(1, 6))]
        return self.named(["section", "div", "ol", "ul"], _COMMENTS, f"<h3>{self.words(1, 2)}</h3>{''.join(each)}{self.form() if self.r.random() < 0.4 else ''}", 0, 0)

    def side(self) -> str:
        return self.named(["aside", "div", "div", "section"], _SIDE, f"<h3>{self.words(1, 3)}</h3>{self.links(2, 8)}{f'<p>{self.sentences(1, 2)}</p>' if self.r.random() < 0.4 else ''}", 0)

    def notice(self) -> str:
        return self.named(["div", "div", "section", "aside", "dialog"], _NOTICE, f"<p>{self.sentences(1, 3)}</p><button>{self.words(1, 2)}</button>" if self.r.random() < 0.7 else self.sentences(1, 2), 0, 0)

    def page(self) -> str:
        r = self.r
        title = self.words(2, 10)
        pieces = [self.piece() for _ in range(r.choice([1, 2, 4, 7, 15]))]
        for extra in (self.advert, self.side, self.notice):
            if r.random() < 0.15:
                pieces.insert(r.randint(0, len(pieces)), extra())
        heading = f"<h1>{title}</h1>" if r.random() < 0.8 else ""
        if heading and r.random() < 0.2:
            heading = f"<header>{heading}</header>"
        tags, bare = (["article", "main"], 0.6) if r.random() < 0.5 else (["div", "div", "section"], 0.08)
        body = self.named(tags, _CONTENT, heading + "".join(pieces), 1, bare)
        if r.random() < 0.3:
            body = f'<div class="{r.choice(["wrapper", "container", "page", "layout", "row", "column"])}">{body}</div>'
        before, after = [], []
        if r.random() < 0.6:
            before.append(self.named(["header", "header", "div"], _HEADER, f"{self.words(1, 4)}{self.links(0, 4)}", 0))
        if r.random() < 0.8:
            before.append(self.named(["nav", "nav", "div", "ul"], _MENU, self.links(3, 10), 0))
        for part, chance, place in ((self.notice, 0.4, before), (self.advert, 0.5, before), (self.side, 0.3, before), (self.form, 0.2, before), (self.advert, 0.3, after), (self.side, 0.4, after), (self.comments, 0.4, after), (self.form, 0.2, after), (self.notice, 0.2, after)):
            if r.random() < chance:
                place.append(part())
        if r.random() < 0.9:
            after.append(self.named(["footer", "footer", "div"], _FOOTER, f"&copy; {self.words(1, 5)}{r.choice(['', self.links(1, 6)])} {self.sentences(0, 2)}", 0))
        return f'<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style></head><body data-y="0">{"".join(before)}{body}{"".join(after)}</body></html>'


def labelled_pages(n: int, seed: int = 1) -> list[str]:
    return [_Maker(seed * 1_000_003 + k).page() for k in range(n)]
