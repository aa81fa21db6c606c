"""Generated web pages of many layouts whose main text is known, for fitting and testing extraction models."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator

#: Stands in every run of main text, and nowhere else.
SIGN = "⁣"
SYLLABLES = "an be con de er fa go hi in jo ka lo mi no os pe qua ri so ta un ve wi xo yu za ther ing tion ment ou é ü ñ".split()


class Writer:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.plain = self.r.random() < 0.2  # class names that say nothing
        self.sloppy = self.r.random() < 0.4  # end tags left out
        self.upper = self.r.random() < 0.08
        self.short = self.r.choice([0.0, 0.1, 0.4])  # share of paragraphs of a few words

    def word(self) -> str:
        return "".join(self.r.choice(SYLLABLES) for _ in range(self.r.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def sentence(self, low: int = 4, high: int = 22) -> str:
        found = self.words(low, high).split()
        if len(found) > 8 and self.r.random() < 0.6:
            found[len(found) // 2] += ","
        return " ".join(found).capitalize() + self.r.choice([".", ".", ".", "!", "?"])

    def prose(self, low: int, high: int) -> str:
        return " ".join(self.sentence() for _ in range(self.r.randint(low, high))).replace("n ", "n &amp; " if self.r.random() < 0.02 else "n ")

    def attrs(self, *names: str) -> str:
        if self.plain:
            return f' class="{self.r.choice("abcdefgh")}{self.r.randint(1, 99)}"' if self.r.random() < 0.5 else ""
        name = self.r.choice(names)
        key = self.r.choice(["class", "class", "id"])
        return f' {key}="{name}"' if self.r.random() < 0.9 else ""

    def tag(self, name: str, inside: str, attrs: str = "") -> str:
        shown = name.upper() if self.upper else name
        if self.sloppy and name in ("p", "li") and self.r.random() < 0.6:
            return f"<{shown}{attrs}>{inside}\n"
        return f"<{shown}{attrs}>{inside}</{shown}>" + self.r.choice(["", "\n"])

    def link(self, low: int = 1, high: int = 4) -> str:
        shown = self.words(low, high) if self.r.random() < 0.6 else self.sentence(low, high)
        return f'<a href="/{self.word()}">{shown}</a>'

    def links(self, low: int, high: int) -> str:
        n = self.r.randint(low, high)
        kind = self.r.random()
        if kind < 0.6:
            return self.tag("ul", "".join(self.tag("li", self.link()) for _ in range(n)))
        if kind < 0.8:
            return self.r.choice([" | ", " ", " &middot; "]).join(self.link() for _ in range(n))
        return "".join(self.tag("div", self.link()) for _ in range(n))

    # Boilerplate.

    def menu(self) -> str:
        if self.r.random() < 0.55:
            return self.tag("nav", self.links(3, 9), self.attrs("nav", "main-nav", "navbar") if self.r.random() < 0.5 else "")
        return self.tag("div", self.links(3, 9), self.attrs("menu", "nav", "navigation", "topbar", "navbar"))

    def header(self) -> str:
        inside = self.tag(self.r.choice(["div", "h1", "span", "a", "p"]), self.words(1, 4), self.attrs("logo", "site-title", "brand"))
        if self.r.random() < 0.5:
            inside += self.tag("p", self.sentence(3, 10), self.attrs("tagline", "site-description"))
        if self.r.random() < 0.6:
            inside += self.menu()
        if self.r.random() < 0.3:
            inside += self.search()
        if self.r.random() < 0.7:
            return self.tag("header", inside, self.attrs("header", "site-header", "masthead") if self.r.random() < 0.5 else "")
        return self.tag("div", inside, self.attrs("header", "masthead", "site-header", "top"))

    def footer(self) -> str:
        inside = f"&copy; {self.word()}.example {self.r.choice(['2019', '2021', ''])} &middot; {self.sentence(3, 12)}"
        if self.r.random() < 0.5:
            inside = self.tag("p", inside)
        if self.r.random() < 0.5:
            inside += self.links(2, 8)
        if self.r.random() < 0.3:
            inside += self.tag("div", self.tag("h4", self.words(1, 3)) + self.tag("p", self.prose(1, 2)), self.attrs("about", "widget"))
        if self.r.random() < 0.7:
            return self.tag("footer", inside, self.attrs("footer", "site-footer") if self.r.random() < 0.4 else "")
        return self.tag("div", inside, self.attrs("footer", "foot", "copyright", "bottom"))

    def sidebar(self) -> str:
        boxes = ""
        for _ in range(self.r.randint(1, 4)):
            kind = self.r.random()
            head = self.tag(self.r.choice(["h3", "h4", "div"]), self.words(1, 3)) if self.r.random() < 0.8 else ""
            if kind < 0.4:
                boxes += self.tag("div", head + self.links(3, 8), self.attrs("widget", "related", "popular", "recent-posts"))
            elif kind < 0.7:
                boxes += self.tag("div", head + self.tag("p", self.prose(1, 3)), self.attrs("widget", "about", "author-box", "promo"))
            else:
                boxes += self.r.choice([self.advert, self.newsletter, self.search])()
        if self.r.random() < 0.6:
            return self.tag("aside", boxes, self.attrs("sidebar", "side", "complementary") if self.r.random() < 0.5 else "")
        return self.tag("div", boxes, self.attrs("sidebar", "side", "rail", "widgets", "secondary"))

    def advert(self) -> str:
        inside = self.r.choice([self.sentence(3, 12), self.tag("p", self.prose(1, 2)), self.link(3, 8), self.sentence(2, 6) + " " + self.link()])
        names = ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-box", "banner-ad", "adsbox")
        return self.r.choice(["", "<!-- ad -->"]) + self.tag(self.r.choice(["div", "div", "aside", "ins", "section"]), inside, self.attrs(*names))

    def notice(self) -> str:
        inside = self.tag(self.r.choice(["p", "div", "span"]), self.prose(1, 3)) + (self.tag("button", self.words(1, 2)) if self.r.random() < 0.6 else "")
        if self.r.random() < 0.3:
            inside += self.link()
        names = ("cookie", "cookie-notice", "consent", "gdpr-banner", "notice", "alert", "modal", "popup", "overlay")
        kind = self.r.random()
        if kind < 0.15:
            return self.tag("dialog", inside, self.attrs(*names))
        return self.tag(self.r.choice(["div", "section", "aside"]), inside, ' role="dialog"' + self.attrs(*names) if kind < 0.3 else self.attrs(*names))

    def search(self) -> str:
        return self.tag("form", f'{self.r.choice(["", "<label>" + self.word() + "</label>"])}<input name="q">{self.tag("button", self.word())}', self.attrs("search", "search-form"))

    def newsletter(self) -> str:
        inside = self.tag("p", self.prose(1, 2)) + '<input type="email"><input type="submit">' + self.tag("label", self.words(1, 5))
        if self.r.random() < 0.7:
            return self.tag("form", inside, self.attrs("newsletter", "subscribe", "signup"))
        return self.tag("div", self.tag("h4", self.words(2, 4)) + self.tag("form", inside), self.attrs("newsletter", "subscribe"))

    def comments(self) -> str:
        def one() -> str:
            inside = self.tag(self.r.choice(["b", "span", "div", "cite"]), self.words(1, 2), self.attrs("author", "comment-author"))
            inside += "".join(self.tag("p", self.prose(1, 4)) for _ in range(self.r.randint(1, 2)))
            if self.r.random() < 0.4:
                inside += self.tag("a", self.word(), ' href="#"')
            return self.tag(self.r.choice(["li", "div", "article"]), inside, self.attrs("comment", "comment-body", "reply"))

        inside = self.tag(self.r.choice(["h2", "h3", "div"]), self.words(1, 3)) if self.r.random() < 0.8 else ""
        inside += "".join(one() for _ in range(self.r.randint(1, 6)))
        if self.r.random() < 0.5:
            inside += self.tag("form", "<textarea></textarea><input>" + self.tag("button", self.word()), self.attrs("comment-form", "respond"))
        return self.tag(self.r.choice(["section", "div", "ol", "aside"]), inside, self.attrs("comments", "comment-list", "commentlist", "responses", "discussion"))

    def share(self) -> str:
        return self.tag("div", " ".join(self.link(1, 2) for _ in range(self.r.randint(2, 5))), self.attrs("share", "social", "social-share", "tags"))

    def related(self) -> str:
        inside = self.tag("h3", self.words(1, 3)) + self.links(3, 6)
        return self.tag(self.r.choice(["div", "section", "aside"]), inside, self.attrs("related", "recommended", "more", "related-posts"))

    def hidden(self) -> str:
        return self.tag("div", self.prose(1, 2), self.r.choice([' style="display: none"', " hidden", ' aria-hidden="true"']))

    def noscript(self) -> str:
        return self.tag("noscript", self.r.choice(["x", self.sentence(4, 12), '<img src="/p.gif" alt="">', self.tag("div", self.prose(1, 2), self.attrs("notice", "warning"))]))

    # Main text.

    def main_prose(self, low: int = 1, high: int = 7) -> str:
        text = SIGN + (self.sentence(1, 3) if self.r.random() < self.short else self.prose(low, high))
        if self.r.random() < 0.25:
            found = text.split(" ")
            at = self.r.randrange(len(found))
            wrap = self.r.choice(["b", "em", "i", "strong", "a", "code", "span"])
            attrs = ' class="' + self.r.choice(["hl", "link", "external", "term", "note", self.word()]) + '"' if self.r.random() < 0.3 else ""
            found[at] = f'<{wrap}{" href=/x" if wrap == "a" else ""}{attrs}>{found[at]}</{wrap}>'
            text = " ".join(found)
        if self.r.random() < 0.15:
            text = text.replace(". ", ".<br>", 1)
        if self.r.random() < 0.08:
            text = f"<b>{text}"
        return text

    def article(self, inside_first: str) -> str:
        parts = [inside_first] if inside_first else []
        paragraph = self.r.choice(["p"] * 8 + ["div", "br"])
        few = self.r.choice([1, 1, 2, 3, 4, 5, 6, 8, 12, 20, 40])
        for _ in range(few):
            kind = self.r.random() if few > 3 or self.r.random() < 0.6 else self.r.uniform(0.8, 1.0)  # short ones of every kind
            if kind < 0.72:
                prose = self.main_prose()
                parts.append(prose + "<br><br>" if paragraph == "br" else self.tag(paragraph, prose))
            elif kind < 0.8:
                parts.append(self.tag(self.r.choice(["h2", "h3"]), SIGN + self.words(2, 7)))
            elif kind < 0.87:
                parts.append(self.tag(self.r.choice(["ul", "ol"]), "".join(self.tag("li", self.main_prose(1, 2)) for _ in range(self.r.randint(2, 6)))))
            elif kind < 0.92:
                parts.append(self.tag("blockquote", self.tag("p", self.main_prose(1, 3)) if self.r.random() < 0.5 else self.main_prose(1, 3)))
            elif kind < 0.94:
                rows = "".join(self.tag("tr", "".join(self.tag("td", SIGN + self.words(1, 4)) for _ in range(3))) for _ in range(self.r.randint(2, 4)))
                parts.append(self.tag("table", rows))
            elif kind < 0.96:
                inside = SIGN + self.r.choice([self.words(3, 15), "\n".join(self.words(1, 8) for _ in range(self.r.randint(2, 8)))])
                parts.append(self.tag("pre", self.tag("code", inside) if self.r.random() < 0.4 else inside))
            else:
                parts.append(self.tag("figure", "<img src=x>" + self.tag("figcaption", SIGN + self.sentence())))
            if self.r.random() < 0.07:
                parts.append(self.r.choice([self.advert, self.newsletter, self.related, self.share, self.notice, self.hidden])())
        return "".join(parts)

    def page(self) -> str:
        title = SIGN + self.words(2, 9).capitalize()
        head = f'<head><meta charset="utf-8"><title>{title}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head>'
        heading = self.tag(self.r.choice(["h1", "h1", "h1", "h2"]), title) if self.r.random() < 0.85 else ""
        if heading and self.r.random() < 0.12:
            heading = self.tag("header", heading)
        text = self.article(heading)
        kind = self.r.random()
        if kind < 0.45:
            text = self.tag("article", text, self.attrs("post", "article", "entry") if self.r.random() < 0.5 else "")
        elif kind < 0.8:
            text = self.tag("div", text, self.attrs("content", "post", "entry-content", "article-body", "story", "text", "main-content"))
        elif kind < 0.9:
            text = self.tag("section", text, self.attrs("content", "post", "article"))
        tail = "".join(make() for make, odds in ((self.share, 0.2), (self.related, 0.25), (self.comments, 0.35), (self.advert, 0.15)) if self.r.random() < odds)
        if self.r.random() < 0.5:
            text = self.tag(self.r.choice(["main", "div", "div"]), text + tail, self.attrs("main", "content", "page", "wrapper", "container"))
        else:
            text += tail
        side = self.sidebar() if self.r.random() < 0.4 else ""
        middle = side + text if self.r.random() < 0.3 else text + side
        if self.r.random() < 0.3:
            middle = self.tag("div", middle, self.attrs("container", "wrapper", "row", "page"))
        top = [make() for make, odds in ((self.header, 0.5), (self.menu, 0.6), (self.notice, 0.3), (self.advert, 0.35), (self.hidden, 0.05)) if self.r.random() < odds]
        self.r.shuffle(top)
        bottom = [make() for make, odds in ((self.footer, 0.8), (self.notice, 0.1), (self.newsletter, 0.1)) if self.r.random() < odds]
        script = "<script>track('</div>')</script>" + self.noscript() if self.r.random() < 0.3 else ""
        end = "" if self.sloppy else "</body></html>"
        return f'<!DOCTYPE html><html lang="en">{head}<body>{"".join(top)}{middle}{script}{"".join(bottom)}{end}'


def labelled_pages(n: int, seed: int) -> Iterator[tuple[str, Callable[[str], bool]]]:
    """Pages, each with a test that tells whether a run of its text is main text."""
    for k in range(n):
        yield Writer(seed * 1_000_003 + k).page(), lambda text: SIGN in text
