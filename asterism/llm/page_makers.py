"""Invented web pages whose main text is known, to fit the extractor to."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator

PAGES, SEED = 900, 23
# a character that marks main text; it is in no page that is not invented
MARK = "\ue000"

_SYLLABLES = "ba be di do en er fa ge hi in ka le ma mo na ne on or pa re sa si ta te un ve za".split()
_MAIN_CLASSES = ["content", "article-body", "post", "entry-content", "main-content", "story", "text", "x1", "c-42", ""]
# headings: of parts that aren't main text, and such words in ones that are
_TITLES = {
    "comment": ["Comments", "3 comments", "Reader comments", "Leave a reply", "Discussion", "Replies"],
    "more": ["Related articles", "Share this", "More stories", "Recommended", "Popular"],
}
_MAIN_TITLES = ["Discussion", "Related work", "Comments on the method", "More on this", "Popular views"]
# plain elements around a part
_WRAPS = [0] * 9 + [1, 1, 2, 3, 4, 6, 8]
_OTHER = {
    "nav": ["nav", "menu", "navbar", "breadcrumbs", "x2", ""],
    "header": ["header", "masthead", "topbar", "x3", ""],
    "footer": ["footer", "site-footer", "bottom", "x4", ""],
    "side": ["sidebar", "widget", "aside", "rail", "x5"],
    "ad": ["ad", "ads", "advert", "sponsored", "promo", "banner-ad"],
    "notice": ["cookie", "notice", "consent", "alert", "gdpr-banner"],
    "comment": ["comments", "comment-list", "discussion", "replies"],
    "more": ["related", "share", "social", "recommended"],
}


class Maker:
    """One page; ``main`` text is marked, all other text isn't."""

    def __init__(self, rng: random.Random):
        self.rng = rng

    def words(self, low: int, high: int) -> str:
        rng = self.rng
        words = ["".join(rng.choices(_SYLLABLES, k=rng.randint(1, 4))) for _ in range(rng.randint(low, high))]
        for i in range(0, len(words), rng.randint(4, 14)):
            words[i] = words[i].capitalize()
            if i:
                words[i - 1] += rng.choice([".", ".", ",", "?", "!"])
        return " ".join(words)

    def sentence(self, low: int, high: int) -> str:
        return self.words(low, high).rstrip(".,") + self.rng.choice([".", ".", "", "!"])

    def main(self, low: int, high: int) -> str:
        text = self.sentence(low, high)
        if self.rng.random() < 0.1:  # noisy text is main text, too
            text = " ".join(w + self.rng.choice(["&amp;&amp;&amp;", "%%%", "***", "$$$"]) for w in text.split())
        return MARK + text

    def tag(self, name: str, kind: str, inner: str, prose: bool = False) -> str:
        """An element of a kind; with ``prose`` that may hold sentences, if its name or class tells the kind."""
        css = self.rng.choice(_OTHER[kind])
        if prose and (name != "div" or css[1:].isalpha()):
            inner = self.furniture(inner)
        attribute = f' {self.rng.choice(["class", "id"])}="{css}"' if css else ""
        return f"<{name}{attribute}>{inner}</{name}>"

    def wrapped(self, inner: str) -> str:
        times = self.rng.choice(_WRAPS)
        return "<div>" * times + inner + "</div>" * times

    def prose(self) -> str:
        """Sentences as main text has them, but of a part that isn't."""
        rng = self.rng
        each = [f"<p>{self.sentence(4, rng.choice([12, 30, 60]))}</p>" for _ in range(rng.choice([1, 1, 2, 3]))]
        if rng.random() < 0.3:
            each.insert(0, f"<h{rng.randint(1, 4)}>{self.words(1, 4)}</h{rng.randint(1, 4)}>")
        return self.wrapped("".join(each))

    def furniture(self, inner: str) -> str:
        """What is in a menu, header, footer or form: links or a line, prose, or both."""
        kind = self.rng.random()
        if kind < 0.55:
            return inner
        return self.prose() if kind < 0.75 else self.wrapped(inner) + self.prose() if kind < 0.9 else self.prose() + inner

    def links(self, low: int, high: int) -> str:
        one = lambda: f'<a href="/{self.rng.randint(1, 99)}">{self.words(1, 3)}</a>'
        each = [one() for _ in range(self.rng.randint(low, high))]
        if self.rng.random() < 0.6:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in each) + "</ul>"
        return self.rng.choice([" ", " | ", ""]).join(each)

    def paragraph(self) -> str:
        rng = self.rng
        text = self.main(1, rng.choice([4, 20, 60, 120]))
        kind = rng.random()
        if kind < 0.01:
            return f"<h2>{MARK}{rng.choice(_MAIN_TITLES)}</h2><p>{text}</p>"
        if kind < 0.06:
            return f"<h{rng.randint(2, 4)}>{self.main(1, 8)}</h{rng.randint(2, 4)}>"
        if kind < 0.1:
            return "<ul>" + "".join(f"<li>{self.main(1, 14)}</li>" for _ in range(rng.randint(2, 6))) + "</ul>"
        if kind < 0.13:
            return f"<blockquote><p>{text}</p></blockquote>"
        if kind < 0.15:
            row = lambda: "<tr>" + "".join(f"<td>{self.main(1, 3)}</td>" for _ in range(3)) + "</tr>"
            return f"<table>{''.join(row() for _ in range(rng.randint(2, 5)))}</table>"
        if kind < 0.17:
            return f"<pre>{text}</pre>"
        if kind < 0.3:
            return f"<p><b>{text}<br>"
        if kind < 0.36:
            return f'<p>{text} <a href="/x">{self.main(1, 3)}</a> {self.main(1, 9)}</p>'
        return f"<p>{text}" + ("</p>" if rng.random() < 0.9 else "")

    def article(self) -> str:
        rng = self.rng
        parts = [self.paragraph() for _ in range(rng.choice([1, 2, 3, 6, 12, 25]))]
        if rng.random() < 0.25:
            inner = self.wrapped(self.sentence(2, 20)) if rng.random() < 0.6 else self.prose()
            aside = self.wrapped(self.tag(rng.choice(["div", "aside"]), "ad", inner))
            parts.insert(rng.randint(0, len(parts)), aside)
        if rng.random() < 0.1:
            parts.append(self.tag("div", "more", self.links(2, 5)))
        if rng.random() < 0.85:
            title = f"<h1>{self.main(1, 12)}</h1>"
            parts.insert(0, f"<header>{title}</header>" if rng.random() < 0.08 else title)
        if rng.random() < 0.12:  # no element for the article alone
            return "".join(parts)
        name = rng.choice(["article", "article", "article", "main", "div", "div", "section"])
        css = rng.choice(_MAIN_CLASSES) if name in ("div", "section") else rng.choice(["", "", "post"])
        inner = "".join(parts)
        inner = self.wrapped(inner)
        return f'<{name} class="{css}">{inner}</{name}>' if css else f"<{name}>{inner}</{name}>"

    def comments(self) -> str:
        each = "".join(
            self.rng.choice(["<li>{}</li>", "<div class=\"comment\"><p>{}</p></div>"]).format(self.sentence(3, 50))
            for _ in range(self.rng.randint(1, 8))
        )
        title = f"<h3>{self.words(1, 2)}</h3>"
        if self.rng.random() < 0.5:  # told by its heading alone
            return f"<section><h3>{self.rng.choice(_TITLES['comment'])}</h3>{self.wrapped(each)}</section>"
        return self.tag(self.rng.choice(["div", "section", "ul"]), "comment", title + self.wrapped(each))

    def more(self) -> str:
        if self.rng.random() < 0.4:
            return f"<div><h3>{self.rng.choice(_TITLES['more'])}</h3>{self.links(2, 6)}</div>"
        return self.tag("div", "more", self.links(2, 6))

    def form(self) -> str:
        inner = f'<label>{self.words(1, 4)}</label><input name="q"><button>{self.words(1, 2)}</button>'
        return f'<form action="/s">{self.furniture(inner)}</form>'

    def page(self) -> str:
        rng = self.rng
        sentence = lambda: self.sentence(1, 25)
        before = [
            (0.85, lambda: self.tag(rng.choice(["nav", "nav", "div"]), "nav", self.links(2, 14), True)),
            (0.4, lambda: self.tag(rng.choice(["header", "header", "div"]), "header", sentence() + self.links(0, 4), True)),
            (0.5, lambda: self.tag("div", "ad", sentence())),
            (0.25, lambda: self.tag("div", "notice", self.wrapped(f"<p>{sentence()}</p>"))),
            (0.15, self.form),
        ]
        after = [
            (0.3, self.comments),
            (0.3, lambda: self.tag(rng.choice(["aside", "div"]), "side", f"<h3>{sentence()}</h3>{self.links(2, 8)}")),
            (0.15, lambda: self.tag("aside", "side", self.prose())),
            (0.2, self.more),
            (0.2, lambda: self.tag("div", "ad", sentence())),
            (0.15, self.form),
        ]
        parts = [self.wrapped(make()) for share, make in before if rng.random() < share]
        rng.shuffle(parts)
        tail = [self.wrapped(make()) for share, make in after if rng.random() < share]
        rng.shuffle(tail)
        end = f"&copy; {self.words(1, 2)} &middot; {sentence()}"
        end = self.wrapped(self.tag(rng.choice(["footer", "footer", "div"]), "footer", end, True))
        article = self.article()
        article = self.wrapped(article) if article.startswith(("<article", "<main")) else article
        body = "".join([*parts, article, *tail, end if rng.random() < 0.9 else ""])
        if rng.random() < 0.2:
            body = f'<div class="{rng.choice(["page", "wrapper", "container", "x9"])}">{body}</div>'
        head = f"<head><title>{sentence()}</title><style>p{{margin:0}}</style><script>track(1);</script></head>"
        return f"<!DOCTYPE html><html>{head}<body>{body}" + ("</body></html>" if rng.random() < 0.9 else "")


def training_pages(pages: int = PAGES, seed: int = SEED) -> Iterator[tuple[str, Callable[[str], bool]]]:
    """Pages, each with a test of whether a text of it is main text."""
    rng = random.Random(seed)
    for _ in range(pages):
        yield Maker(rng).page(), lambda text: MARK in text
