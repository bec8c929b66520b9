"""Labelled pages: paragraphs of a sample laid out in markup of many kinds, each part's role known.

An attribute `data-main` carries the role to the reader; it is no feature.
"""

from __future__ import annotations

import html
import random

# How sites name the parts of a page.
CONTENT = "content post entry article story body text main page prose markdown read primary single copy detail".split()
MENU = "nav menu navbar navigation topnav links breadcrumb breadcrumbs toolbar tabs pagination pager".split()
HEADER = "header masthead banner top topbar branding logo hero site".split()
FOOTER = "footer bottom copyright legal colophon credits imprint site".split()
SIDE = "sidebar aside side rail widget widgets related recommended popular trending archive tags secondary".split()
ADVERT = "ad ads advert advertisement adsense sponsored sponsor promo promotion banner commercial dfp".split()
NOTICE = "cookie cookies notice consent gdpr alert popup modal overlay warning privacy toast announcement".split()
FORM = "form search newsletter subscribe signup login contact register".split()
COMMENT = "comment comments reply replies discussion disqus respond feedback responses thread reviews".split()
SHARE = "share social sharing follow byline meta tools print buttons".split()


class Layout:
    def __init__(self, paragraphs: list[str], seed: int) -> None:
        self.r, self.paragraphs = random.Random(seed), paragraphs or ["a b c."]

    def say(self, low: int, high: int) -> str:
        """Some words of the sample."""
        words = self.r.choice(self.paragraphs).split()
        n, at = self.r.randint(low, high), self.r.randrange(max(len(words), 1))
        return html.escape(" ".join((words * 2)[at : at + n]) or "a")

    def named(self, names: list[str]) -> str:
        if self.r.random() < 0.12:
            return ""
        picked = "-".join(self.r.sample(names, self.r.choice([1, 1, 2])))
        return f' {self.r.choice(["class", "class", "id"])}="{picked}"'

    def part(self, tags: str, names: list[str], inside: str, main: int = 0) -> str:
        tag = self.r.choice(tags.split())
        return f'<{tag}{self.named(names)} data-main="{main}">{inside}</{tag}>'

    def links(self, low: int = 2, high: int = 9) -> str:
        items = [f'<a href="#">{self.say(1, 3)}</a>' for _ in range(self.r.randint(low, high))]
        style = self.r.random()
        if style < 0.6:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return " | ".join(items) if style < 0.8 else "".join(f"<div>{x}</div>" for x in items)

    def prose(self) -> str:
        text = html.escape(self.r.choice(self.paragraphs))
        if self.r.random() < 0.2:
            text = self.say(1, 8) + self.r.choice([".", ":", ""])
        if self.r.random() < 0.2:
            text += f' <a href="#">{self.say(1, 4)}</a> {self.say(2, 12)}.'
        if self.r.random() < 0.15:
            text = f"<b>{text}<br>"
        return text

    def content(self) -> str:
        out = [f"<h{self.r.choice([1, 1, 2])}>{self.say(2, 12)}</h1>"] if self.r.random() < 0.85 else []
        for _ in range(self.r.randint(1, 12)):
            kind = self.r.random()
            if kind < 0.7:
                out.append(f"<p>{self.prose()}" + "</p>" * (self.r.random() < 0.8))
            elif kind < 0.76:
                out.append(f"<h{self.r.randint(2, 4)}>{self.say(1, 7)}</h2>")
            elif kind < 0.81:
                out.append("<ul>" + "".join(f"<li>{self.say(2, 25)}</li>" for _ in range(self.r.randint(2, 5))) + "</ul>")
            elif kind < 0.85:
                out.append(f"<blockquote><p>{self.prose()}</p></blockquote>")
            elif kind < 0.88:
                out.append(f"<figure><img src=x><figcaption>{self.say(3, 12)}</figcaption></figure>")
            elif kind < 0.91:
                out.append("<table>" + "".join(f"<tr><td>{self.say(1, 4)}</td><td>{self.say(1, 9)}</td></tr>" for _ in range(3)) + "</table>")
            elif kind < 0.94:
                out.append(f"<div>{self.prose()}</div>")
            else:
                out.append(self.r.choice([self.advert, self.share, self.related, self.form])())
        if self.r.random() < 0.2:
            out.append(self.comments())
        return "".join(out)

    def advert(self) -> str:
        return self.part("div div aside section ins p", ADVERT, self.r.choice([self.say(3, 25) + ".", f'<a href="#">{self.say(2, 10)}</a>', f"<p>{self.say(4, 30)}.</p>"]))

    def share(self) -> str:
        return self.part("div ul p span", SHARE, self.r.choice([self.links(2, 4), self.say(2, 6)]))

    def related(self) -> str:
        return self.part("aside div section", SIDE, f"<h3>{self.say(1, 3)}</h3>" + self.links() + self.r.choice(["", f"<p>{self.say(5, 30)}.</p>"]))

    def form(self) -> str:
        return f'<form{self.named(FORM)} data-main="0"><label>{self.say(1, 4)}</label><input><p>{self.say(3, 15)}.</p><button>{self.say(1, 2)}</button></form>'

    def notice(self) -> str:
        return self.part("div div section aside dialog p", NOTICE, f"<p>{self.say(5, 35)}.</p><button>{self.say(1, 2)}</button>")

    def comments(self) -> str:
        one = lambda: self.part("div li article p", COMMENT, f"<b>{self.say(1, 2)}</b> <p>{self.prose()}</p>")
        return self.part("section div ol div", COMMENT, f"<h3>{self.say(1, 3)}</h3>" + "".join(one() for _ in range(self.r.randint(1, 6))))

    def header(self) -> str:
        return self.part("header header div", HEADER, self.r.choice([f"<p>{self.say(1, 5)}</p>", f"<h1>{self.say(1, 4)}</h1>", ""]) + self.r.choice(["", self.links()]))

    def menu(self) -> str:
        return self.part("nav nav div ul", MENU, self.links())

    def footer(self) -> str:
        return self.part("footer footer footer div", FOOTER, f"<p>&copy; {self.say(1, 12)}.</p>" if self.r.random() < 0.6 else f"&copy; {self.say(1, 4)} &middot; {self.say(4, 20)}." + self.r.choice(["", self.links()]))

    def page(self) -> str:
        before = [p for p, often in ((self.header, 0.5), (self.menu, 0.8), (self.notice, 0.4), (self.advert, 0.5), (self.form, 0.2), (self.related, 0.2)) if self.r.random() < often]
        after = [p for p, often in ((self.comments, 0.4), (self.related, 0.4), (self.advert, 0.3), (self.form, 0.2), (self.share, 0.2), (self.footer, 0.85), (self.notice, 0.2)) if self.r.random() < often]
        tag = self.r.choice("article article main div div section td".split())
        inner = f'<{tag}{self.named(CONTENT)} data-main="1">{self.content()}</{tag}>'
        if self.r.random() < 0.4:
            inner = f"<div{self.named(CONTENT)}>{inner}</div>"
        return "<html><body>" + "".join(p() for p in before) + inner + "".join(p() for p in after) + "</body></html>"
