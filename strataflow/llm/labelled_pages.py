"""Labelled web pages for training, made by rule.

A page is a site frame around an article. Everything inside ``data-label="1"`` is content, unless an element
inside says ``data-label="0"``. Frames, names of classes, and the length of texts vary; texts are
random syllables, so that only structure can be learned.
"""

from __future__ import annotations

import random

_SYLLABLES = "an ba ce do en fi gu ha in jo ka le mi no or pa re si to un ve wi yo za".split()
_CONTENT = ["article", "main", "section class=\"entry-content\"", "div class=\"post-content\"", "div id=\"content\"",
            "div class=\"article-body\"", "div class=\"story\"", "div class=\"text\"", "td class=\"content\"", "div", "section"]


class _Writer:
    def __init__(self, rng: random.Random):
        self.rng = rng

    def words(self, low: int, high: int) -> str:
        r = self.rng
        return " ".join("".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(r.randint(low, high)))

    def sentences(self, low: int = 1, high: int = 5) -> str:
        out = []
        for _ in range(self.rng.randint(low, high)):
            out.append(self.words(1, 22).capitalize() + self.rng.choice([".", ".", ".", "!", "?", "", " ***", "!!"]))
        return " ".join(out)

    def links(self, low: int = 2, high: int = 8) -> str:
        items = "".join(f'<li><a href="/{self.words(1, 1)}">{self.words(1, 3)}</a></li>' for _ in range(self.rng.randint(low, high)))
        return f"<ul>{items}</ul>"

    def inline(self) -> str:
        text = self.sentences()
        mark = self.rng.choice(["", "", "", "b", "em", "strong", "a href=\"/x\"", "code"])
        return f"<{mark}>{self.words(1, 3)}</{mark.split()[0]}> {text}" if mark else text

    def body_block(self) -> str:
        r = self.rng
        return r.choice([
            *[lambda: f"<p>{self.inline()}</p>"] * 8,
            lambda: f"<p>{self.words(1, 3).capitalize()}.</p>",
            lambda: f"<p>{r.choice(['Copyright', '©', 'All rights reserved.'])} {r.choice([self.words(1, 3), ''])}</p>",
            lambda: f"<p>{self.inline()}<br>{self.sentences()}",
            lambda: f"<p><b>{self.sentences(1, 1)}<br><p>{self.sentences()}</p>",
            lambda: f"<h{r.randint(2, 4)}>{self.words(1, 8)}</h2>",
            lambda: "<ul>" + "".join(f"<li>{self.sentences(1, 2)}</li>" for _ in range(r.randint(1, 5))) + "</ul>",
            lambda: f"<blockquote><p>{self.sentences()}</p></blockquote>",
            lambda: f"<pre>{self.sentences()}</pre>",
            lambda: f"<table><tr><td>{self.words(1, 4)}</td><td>{self.words(1, 6)}</td></tr></table>",
            lambda: f"<figure><img src=\"a.png\"><figcaption>{self.sentences(1, 1)}</figcaption></figure>",
        ])()

    def aside(self) -> str:
        """A piece that is not content, wherever it stands."""
        r = self.rng
        name = lambda *names: r.choice(["class", "id"]) + f'="{r.choice(names)}"'
        return r.choice([
            lambda: f"<nav>{self.links()}</nav>",
            lambda: f"<div {name('menu', 'main-menu', 'navigation', 'nav-bar', 'topnav')}>{self.links()}</div>",
            lambda: f"<div {name('ad', 'ads', 'advert', 'advertisement', 'ad-slot', 'promo', 'sponsored', 'banner')}>{self.sentences(1, 2)}</div>",
            lambda: f"<aside><h3>{self.words(1, 3)}</h3>{r.choice([self.links(), f'<p>{self.sentences()}</p>'])}</aside>",
            lambda: f"<div {name('sidebar', 'side', 'widget', 'right-rail', 'sidebar-left')}><h3>{self.words(1, 3)}</h3>"
                    f"{r.choice([self.links(), f'<p>{self.sentences()}</p>'])}</div>",
            lambda: f"<div {name('cookie-notice', 'cookie-banner', 'gdpr', 'consent', 'notice', 'alert', 'popup', 'site-notice')}>"
                    f"<p>{self.sentences(1, 3)}</p></div>",
            lambda: f"<div role=\"alert\"><p>{self.sentences(1, 2)}</p></div>",
            lambda: f"<form><label>{self.words(1, 3)}</label><input name=\"q\"><p>{self.sentences(1, 1)}</p></form>",
            lambda: f"<div {name('newsletter', 'subscribe', 'signup', 'login', 'search')}><p>{self.sentences(1, 2)}</p></div>",
            lambda: f"<{r.choice(['section', 'div'])} {name('comments', 'comment-list', 'reader-comments', 'responses', 'replies', 'discussion')}>"
                    f"<h3>{self.words(1, 2)}</h3>" + "".join(
                        f"<{r.choice(['div class=\"comment\"', 'li class=\"comment\"', 'div', 'article class=\"comment\"'])}>"
                        f"<p>{self.sentences()}</p></div>" for _ in range(r.randint(1, 4))) + "</section></div>",
            lambda: f"<div {name('related', 'related-posts', 'recommended', 'trending', 'teaser')}>{self.links()}</div>",
            lambda: f"<div {name('share', 'social', 'share-bar', 'toolbar')}><a href=\"#\">{self.words(1, 1)}</a> <a href=\"#\">{self.words(1, 1)}</a></div>",
            lambda: f"<div {name('breadcrumb', 'breadcrumbs', 'pagination', 'pager')}><a href=\"/\">{self.words(1, 1)}</a> / {self.words(1, 3)}</div>",
        ])()

    def page(self) -> str:
        r = self.rng
        head = f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title><style>p{{}}</style></head><body>"
        top = r.choice([
            lambda: f"<nav>{self.links()}</nav>",
            lambda: f"<header><h2>{self.words(1, 3)}</h2><p>{self.sentences(1, 1)}</p>{self.links()}</header>",
            lambda: f"<header><a href=\"/\">{self.words(1, 2)}</a></header><nav>{self.links()}</nav>",
            lambda: f"<div class=\"header\"><h2>{self.words(1, 3)}</h2>{self.links()}</div>",
            lambda: f"<div id=\"masthead\">{self.words(1, 4)}</div>",
            lambda: "",
        ])()
        container = r.choice([_CONTENT[0]] * 6 + _CONTENT)
        title = f"<h1>{self.words(1, 10).capitalize()}</h1>" if r.random() < 0.85 else ""
        blocks = [title] + [self.body_block() for _ in range(r.choice([0, 1, 2, 4, 8, 14]))]
        if r.random() < 0.3:
            blocks.insert(r.randint(0, len(blocks)), self.hidden(self.aside()))
        inner = "".join(blocks)
        content = f'<{container} data-label="1">{inner}</{container.split()[0]}>'
        if container.startswith("td"):
            content = f"<table><tr>{content}<td class=\"sidebar\">{self.links()}</td></tr></table>"
        if r.random() < 0.08:  # a page without any frame
            return r.choice([head, "<html><body>", ""]) + content
        wrap = r.choice(["", "", "", "div class=\"wrapper\"", "main", "div id=\"page\""])
        before = [self.aside() for _ in range(r.choice([0, 0, 1, 1, 2]))]
        after = [self.aside() for _ in range(r.choice([0, 0, 1, 2]))]
        middle = "".join(before) + content + "".join(after)
        if wrap:
            middle = f"<{wrap}>{middle}</{wrap.split()[0]}>"
        foot = r.choice([
            lambda: f"<footer>&copy; {self.words(1, 2)} &middot; {self.sentences(1, 1)}</footer>",
            lambda: f"<footer><p>{self.sentences(1, 2)}</p>{self.links()}</footer>",
            lambda: f"<div class=\"footer\"><p>Copyright {self.words(1, 3)}</p></div>",
            lambda: f"<div id=\"footer\">{self.links()}</div>",
            lambda: "",
        ])()
        return head + top + middle + foot + r.choice(["</body></html>", "</body></html>", ""])

    @staticmethod
    def hidden(piece: str) -> str:
        """The same piece inside an article, labelled as not content."""
        at = piece.index(">")
        return f'{piece[:at]} data-label="0"{piece[at:]}'


def labelled_pages(count: int, seed: int = 11) -> list[str]:
    writer = _Writer(random.Random(seed))
    return [writer.page() for _ in range(count)]
