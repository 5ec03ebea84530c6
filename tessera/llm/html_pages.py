"""Writes web pages whose main text is known, to train the extraction on.

Layouts, tags, class names, the order and number of parts, languages' letter ranges and sloppy markup
vary at random; parts of the main text carry data-main="1", a part inside it that is not, data-main="0".
"""

from __future__ import annotations

import random
from collections.abc import Iterator

_SYLLABLES = ("an re th er on ing ed ti ly es or at en of he st nd wh sh ou ea".split(), "en er ch sch ung ge te be ver lich keit ä ö ü ß pf".split(), "os as ez ción que ra ll rr ñ í ó do ta mi".split(), "é è eau eux ment tion ou ai en qu oi ç ré".split())


class _Writer:
    def __init__(self, rng: random.Random):
        self.r, self.parts = rng, rng.choice(_SYLLABLES)

    def word(self) -> str:
        return "".join(self.r.choice(self.parts) for _ in range(self.r.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def sentence(self) -> str:
        return self.words(1, 16).capitalize() + self.r.choice((".", ".", ".", "?", "!", ", " + self.words(1, 6) + "."))

    def prose(self, most: int = 8) -> str:
        return " ".join(self.sentence() for _ in range(self.r.randint(1, most)))

    def pick(self, *xs):
        return self.r.choice(xs)

    def chance(self, p: float) -> bool:
        return self.r.random() < p

    def inline(self, text: str) -> str:
        if self.chance(0.25):
            w = text.split(" ")
            i = self.r.randrange(len(w))
            t = self.pick("b", "i", "em", "strong", 'a href="/x"', "span", "code")
            w[i] = f"<{t}>{w[i]}</{t.split()[0]}>"
            text = " ".join(w)
        if self.chance(0.1):
            text = text.replace(" ", self.pick("&nbsp;", " &amp; ", "\n   ", "<br>"), 1)
        return text

    def block(self, name: str, classes: tuple[str, ...], body: str, tags: tuple[str, ...] = ("div",), plain: float = 0.15) -> str:
        tag = self.pick(*tags)
        if tag in ("div", "section", "ul") or self.chance(0.4):
            if not (self.chance(plain) and tag not in ("div", "section", "ul")):
                c = self.pick(*classes)
                attr = self.pick(f'class="{c}"', f'id="{c}"', f'class="{self.word()} {c}"', f'class="{c}" id="{self.word()}"', f'role="{name}" class="{c}"')
                return f"<{tag} {attr}>{body}</{tag}>"
        return f"<{tag}>{body}</{tag}>"

    def links(self, low: int, high: int) -> str:
        a = [f'<a href="/{self.word()}">{self.words(1, 3)}</a>' for _ in range(self.r.randint(low, high))]
        return self.pick("<ul>" + "".join(f"<li>{x}</li>" for x in a) + "</ul>", " | ".join(a), "<ul><li>" + "<li>".join(a) + "</ul>", "".join(f"<p>{x}</p>" for x in a))

    # Parts that are not main text

    def nav(self) -> str:
        return self.block("navigation", ("nav", "menu", "main-nav", "navbar", "topnav", "breadcrumbs", "site-navigation"), self.links(2, 9), ("nav", "nav", "nav", "div", "ul"))

    def header(self) -> str:
        body = self.pick(f"<h1>{self.words(1, 4)}</h1>", f"<a href='/'>{self.words(1, 3)}</a>", f"<p>{self.words(1, 8)}</p>", f"<div class='logo'>{self.word()}</div>") + (self.nav() if self.chance(0.5) else "") + (f"<p>{self.prose(2)}</p>" if self.chance(0.2) else "")
        return self.block("banner", ("header", "masthead", "site-header", "topbar", "page-header"), body, ("header", "header", "div"))

    def footer(self) -> str:
        body = self.pick(f"&copy; {self.word()}.example.com &middot; {self.prose(2)}", f"<p>&copy; 2020 {self.words(1, 3)}</p><p>{self.prose(3)}</p>", f"{self.prose(2)}", self.links(2, 6) + f"<p>{self.prose(1)}</p>")
        return self.block("contentinfo", ("footer", "site-footer", "copyright", "page-foot", "legal"), body, ("footer", "footer", "footer", "div"))

    def ad(self) -> str:
        body = self.pick(self.prose(2), f"<p>{self.prose(3)}</p>", f"<a href='/buy'>{self.words(2, 9)}</a>", f"<h3>{self.words(1, 4)}</h3><p>{self.prose(2)}</p>")
        return self.block("ad", ("ad", "ads", "advert", "ad-box", "sponsored", "promo", "advertisement"), body, ("div", "div", "div", "aside", "section"))

    def sidebar(self) -> str:
        body = "".join(f"<h{(k := self.r.randint(2, 4))}>{self.words(1, 4)}</h{k}>" + self.pick(self.links(2, 7), f"<p>{self.prose(3)}</p>") for _ in range(self.r.randint(1, 3)))
        return self.block("complementary", ("sidebar", "related", "widget", "side", "recommended", "popular", "rail"), body, ("aside", "aside", "div", "section"))

    def comments(self) -> str:
        one = lambda: self.pick(f"<p>{self.prose(5)}</p>", f"<div class='comment'><b>{self.word()}</b><p>{self.prose(6)}</p></div>", f"<li><p>{self.prose(4)}</p></li>", f"<article class='comment'><p>{self.prose(5)}</p></article>")
        return self.block("comments", ("comments", "comment-list", "reader-comments", "discussion", "responses", "disqus"), (f"<h3>{self.words(1, 3)}</h3>" if self.chance(0.7) else "") + "".join(one() for _ in range(self.r.randint(1, 6))), ("section", "div", "div", "ul"))

    def notice(self) -> str:
        return self.block("alert", ("cookie-notice", "notice", "consent", "cookie-banner", "alert", "newsletter", "popup", "gdpr"), self.pick(f"<p>{self.prose(3)}</p>", self.prose(3), f"<p>{self.prose(2)}</p><button>{self.word()}</button>"), ("div", "div", "section", "aside"))

    def form(self) -> str:
        return f"<form action='/{self.word()}' class='{self.pick('search', 'login', 'signup', self.word())}'>" + self.pick(f"<label>{self.words(1, 4)}</label><input type='text'>", f"<p>{self.prose(2)}</p><input name='q'>", f"<fieldset><legend>{self.word()}</legend><input></fieldset>") + f"<button>{self.word()}</button></form>"

    def share(self) -> str:
        return self.block("share", ("share", "social", "share-buttons", "follow"), self.links(2, 5), ("div", "ul"))

    # Main text

    def paragraph(self) -> str:
        text = self.inline(self.prose(self.pick(1, 2, 6, 14)))
        if self.chance(0.15):
            return f"<p><b>{text}<br>"
        return f"<p>{text}" + ("</p>" if self.chance(0.9) else "")

    def main(self, labelled: str) -> str:
        body, n = [], self.r.choice((0, 1, 1, 2, 3, 5, 8, 14))
        title = self.words(1, 12).capitalize()
        head = f"<h1>{title}</h1>"
        body.append(self.pick(head, head, head, f"<header>{head}</header>", f"<h2>{title}</h2>", f"<h1>{title}.</h1>"))
        for _ in range(n):
            x = self.r.random()
            if x < 0.72:
                body.append(self.paragraph())
            elif x < 0.8:
                body.append(f"<h{(k := self.r.randint(2, 4))}>{self.words(1, 7)}</h{k}>")
            elif x < 0.86:
                body.append("<ul>" + "".join(f"<li>{self.inline(self.sentence())}</li>" for _ in range(self.r.randint(1, 6))) + "</ul>")
            elif x < 0.9:
                body.append(f"<blockquote><p>{self.prose(3)}</p></blockquote>")
            elif x < 0.93:
                body.append(f"<figure><img src='x.png'><figcaption>{self.sentence()}</figcaption></figure>")
            elif x < 0.95:
                body.append("<table>" + "".join(f"<tr><td>{self.word()}</td><td>{self.words(1, 4)}</td></tr>" for _ in range(self.r.randint(1, 5))) + "</table>")
            elif x < 0.97:
                body.append(f"<pre>{self.words(3, 20)}</pre>")
            else:
                inner = self.pick(self.ad, self.share, self.form, self.notice, self.sidebar)()
                body.append(f'<div data-main="0">{inner}</div>' if self.chance(0.3) else inner.replace(" ", ' data-main="0" ', 1) if inner[: inner.index(">")].count(" ") else inner[: inner.index(">")] + ' data-main="0"' + inner[inner.index(">") :])
        inner = "\n".join(body) if self.chance(0.3) else "".join(body)
        kind = self.pick("article", "article", "article", "article", "main", "div", "section")
        attr = "" if kind in ("article", "main") and self.chance(0.7) else " " + self.pick("class", "id") + f'="{self.pick("article", "content", "post", "entry-content", "main", "story", "article-body", "post-content")}"'
        return f"<{kind}{attr}{labelled}>{inner}</{kind}>"

    def page(self) -> str:
        top = [self.pick(self.nav, self.nav, self.header)() for _ in range(self.r.choice((0, 1, 1, 1, 2)))]
        top += [self.pick(self.ad, self.ad, self.notice, self.form, self.sidebar)() for _ in range(self.r.choice((0, 1, 1, 2)))]
        end = [self.pick(self.comments, self.sidebar, self.ad, self.form, self.share, self.notice)() for _ in range(self.r.choice((0, 0, 1, 2, 3)))]
        end += [self.footer() for _ in range(self.r.choice((0, 1, 1, 1)))]
        if self.chance(0.2):
            self.r.shuffle(top)
        main = self.main(' data-main="1"')
        if self.chance(0.3):
            side = self.sidebar() if self.chance(0.5) else ""
            c = self.pick("container", "wrapper", "page", "content", "main", "layout")
            main = f'<div class="{c}">' + self.pick(main + side, side + main) + "</div>"
        if self.chance(0.06):
            main = ""
        body = "".join(top) + main + "".join(end)
        ending = self.pick("</body></html>", "</body></html>", "</body></html>", "", "</html>")
        return f'<!DOCTYPE html><html lang="x"><head><meta charset="utf-8"><title>{self.words(1, 8)}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head><body>{body}{ending}'


def training_pages(n: int, seed: int) -> Iterator[str]:
    for i in range(n):
        yield _Writer(random.Random(seed * 1_000_003 + i)).page()
