"""Labelled pages: layouts with known main text, written out from rules. The main text's element carries data-main, and
what stands in it without belonging to it data-aside. Some pages take class names that tell nothing."""

from __future__ import annotations

import random
import re

UNNAMED = 0.15  # share of the pages whose class names are made up

#: Class names by what they hold; one of a group is drawn for each page.
NAMES = {
    "menu": ["nav", "menu", "navbar", "main-menu", "site-nav", "breadcrumbs", "topnav", "toc-menu"],
    "header": ["header", "site-header", "masthead", "top-bar", "page-header"],
    "footer": ["footer", "site-footer", "bottom", "copyright", "page-footer", "legal"],
    "side": ["sidebar", "side", "widget", "aside", "right-col", "rail"],
    "ad": ["ad", "ads", "advert", "banner-ad", "sponsored", "promo", "advertisement", "ad-slot"],
    "notice": ["cookie-notice", "notice", "consent", "alert", "gdpr", "cookie-bar", "popup", "modal"],
    "comment": ["comments", "comment-list", "comment", "reply", "discussion", "responses", "respond"],
    "form": ["newsletter", "subscribe", "signup", "search-form", "login"],
    "share": ["share", "social", "share-buttons", "follow-us"],
    "related": ["related", "recommended", "more-stories", "read-next", "also-like", "popular"],
    "content": ["content", "post", "entry-content", "article-body", "story", "main-text", "post-body", "article", "body-text"],
    "plain": ["row", "inner", "wrap", "container", "box", "col", "block", "c1"],
}


def _words(r: _Page, low: int, high: int) -> str:
    return " ".join("".join(r.choice("aeioubcdfghklmnprstvwxyz") for _ in range(r.randint(1, 9))) for _ in range(r.randint(low, high)))


def _sentence(r: _Page, low: int, high: int) -> str:
    return _words(r, low, high).capitalize() + "."


#: Words of a paragraph; an article keeps to one of these, or takes any.
PARAGRAPHS = ((1, 4), (3, 9), (8, 20), (15, 40), (30, 90), (60, 200))


def _paragraph(r: _Page, size: tuple[int, int] | None = None) -> str:
    text = _sentence(r, *(size or r.choice(PARAGRAPHS)))
    if r.random() < 0.25:
        text += f' <a href="/{_words(r, 1, 1)}">{_words(r, 1, 4)}</a> {_sentence(r, 3, 12)}'
    if r.random() < 0.2:
        text = f"<{(t := r.choice(['b', 'em', 'i', 'strong', 'span']))}>{_words(r, 1, 6)}</{t}> " + text
    return text


def _links(r: _Page, n: int) -> str:
    return "".join(f'<li><a href="/{_words(r, 1, 1)}">{_words(r, 1, 3)}</a></li>' for _ in range(n))


class _Page(random.Random):
    unnamed = False

    def name(self, group: str) -> str:
        return "x" + "".join(self.choice("bcdfghjklmnpqrstvwxz0123456789") for _ in range(6)) if self.unnamed else self.choice(NAMES[group])


def _named(r: _Page, group: str, tag: str, body: str) -> str:
    name = r.name(group)
    return f'<{tag} {r.choice(["class", "class", "id"])}="{name}">{body}</{tag}>'


def _boiler(r: _Page, group: str) -> str:
    prose = f"<p>{_sentence(r, 3, 25)}</p>" if r.random() < 0.6 else _sentence(r, 3, 25)
    if group == "menu":
        body = f"<ul>{_links(r, r.randint(3, 9))}</ul>" if r.random() < 0.8 else " ".join(f'<a href="#">{_words(r, 1, 2)}</a>' for _ in range(5))
        return f"<nav>{body}</nav>" if r.random() < 0.5 else _named(r, group, r.choice(["div", "ul", "nav"]), body)
    if group == "header":
        body = f'<a href="/">{_words(r, 1, 3)}</a>' + (f"<p>{_words(r, 2, 8)}</p>" if r.random() < 0.5 else "")
        return f"<header>{body}</header>" if r.random() < 0.6 else _named(r, group, "div", body)
    if group == "footer":
        body = f"&copy; {_words(r, 1, 3)} &middot; " + prose
        return f"<footer>{body}</footer>" if r.random() < 0.6 else _named(r, group, "div", body)
    if group == "side":
        body = f"<h3>{_words(r, 1, 3)}</h3>" + (f"<ul>{_links(r, 5)}</ul>" if r.random() < 0.5 else prose)
        return f"<aside>{body}</aside>" if r.random() < 0.6 else _named(r, group, "div", body)
    if group == "comment":
        body = "".join(f'<{r.choice(["div", "li", "p"])}>{_words(r, 1, 2)}: {_sentence(r, 4, 40)}' for _ in range(_many(r, 4)))
        return _named(r, group, r.choice(["div", "section", "ul", "ol"]), f"<h3>{_words(r, 1, 2)}</h3>" * (r.random() < 0.5) + body)
    if group == "form":
        body = f'<label>{_words(r, 1, 4)}</label><input name="q"><button>{_words(r, 1, 2)}</button>' + prose * (r.random() < 0.4)
        return f"<form>{body}</form>" if r.random() < 0.7 else _named(r, group, "div", f"<form>{body}</form>")
    if group in ("related", "share"):
        return _named(r, group, r.choice(["div", "section", "ul"]), f"<ul>{_links(r, r.randint(2, 5))}</ul>")
    return _named(r, group, r.choice(["div", "div", "section", "p", "aside"]), prose)  # ad, notice


def _many(r: _Page, most: int) -> int:
    """Mostly up to `most`, sometimes several times as many, seldom very many."""
    k = r.random()
    return r.randint(1, most) if k < 0.75 else r.randint(most, 6 * most) if k < 0.96 else r.randint(10 * most, 20 * most)


def _content(r: _Page) -> str:
    out = [f"<h1>{_words(r, 2, 10)}</h1>"] if r.random() < 0.85 else []
    size = r.choice([None, None, *PARAGRAPHS])
    for _ in range(_many(r, 9)):
        k = r.random()
        if k < 0.7:
            out.append(f"<p>{_paragraph(r, size)}" + ("</p>" if r.random() < 0.85 else "<br>"))
        elif k < 0.78:
            out.append(f"<h2>{_words(r, 1, 8)}</h2>")
        elif k < 0.86:
            out.append("<ul>" + "".join(f"<li>{_sentence(r, 2, 15)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
        elif k < 0.9:
            out.append(f"<blockquote><p>{_sentence(r, 8, 30)}</p></blockquote>")
        elif k < 0.93:
            out.append("<table>" + "".join(f"<tr><td>{_words(r, 1, 3)}</td><td>{_words(r, 1, 3)}</td></tr>" for _ in range(3)) + "</table>")
        elif k < 0.96:
            out.append(f'<figure><img src="x"><figcaption>{_sentence(r, 3, 12)}</figcaption></figure>')
        elif k < 0.98:
            out.append(f"<pre>{_words(r, 3, 20)}</pre>")
        else:
            out.append(f"<div>{_paragraph(r, size)}</div>")
        if r.random() < 0.5 / (1 + len(out)):
            out.append(re.sub(r"^<\w+", r"\g<0> data-aside", _boiler(r, r.choice(["ad", "share", "related", "notice", "form"]))))
    body = "".join(out)
    k = r.random()
    if k < 0.5:
        return f"<article data-main>{body}</article>"
    if k < 0.6:
        return f'<main data-main>{body}</main>'
    name = r.name("content")
    inner = f'<div class="{name}" data-main>{body}</div>'
    return f"<article>{_boiler(r, 'share')}{inner}</article>" if k < 0.7 else inner


def labelled_page(seed: int, unnamed: bool | None = None) -> str:
    """The page of a number; `unnamed` decides about made-up class names, else chance does."""
    r = _Page(seed)
    by_chance = r.random() < UNNAMED
    r.unnamed = by_chance if unnamed is None else unnamed
    before = [_boiler(r, g) for g in r.sample(["header", "menu", "notice", "ad", "form", "side"], r.randint(1, 4))]
    after = [_boiler(r, g) for g in r.sample(["footer", "side", "comment", "related", "ad", "share", "menu", "notice"], r.randint(1, 5))]
    main = _content(r)
    if r.random() < 0.4:
        main = f'<div class="{r.name("plain")}">{main}{after.pop() if r.random() < 0.5 else ""}</div>'
    head = f'<head><meta charset="utf-8"><title>{_words(r, 1, 8)}</title><style>p{{}}</style><script>var a="<p>";</script></head>'
    return f"<!DOCTYPE html><html>{head}<body>{''.join(before)}{main}{''.join(after)}</body></html>"
