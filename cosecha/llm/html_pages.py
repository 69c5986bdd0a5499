"""Labelled pages to train the extractor on: layouts of many kinds, filled with invented words, with known main text.

A page is built as a list of (is it main text, markup) parts, so every label is true by construction.
"""

from __future__ import annotations

import random

SYLLABLES = ["ba", "ko", "ri", "sen", "ta", "mu", "lo", "vi", "dar", "el", "on", "pra", "is", "ne", "tu"]


def _words(rng: random.Random, low: int, high: int) -> str:
    words = ["".join(rng.choices(SYLLABLES, k=rng.choice([1, 2, 2, 3]))) for _ in range(rng.randint(low, high))]
    return (" ".join(words)).capitalize()


def _prose(rng: random.Random) -> str:
    kind = rng.random()
    if kind < 0.15:
        return _words(rng, 1, 4) + rng.choice([".", "", "!"])
    if kind < 0.25:
        return " | ".join(_words(rng, 1, 2) for _ in range(rng.randint(3, 12)))
    return " ".join(_words(rng, 3, 25) + rng.choice([".", ".", "?", "***"]) for _ in range(rng.randint(1, 6)))


def _links(rng: random.Random, tag: str = "li") -> list[str]:
    return [f'<{tag}><a href="/{i}">{_words(rng, 1, 3)}</a></{tag}>' for i in range(rng.randint(2, 8))]


def _menu(rng: random.Random) -> str:
    box = rng.choice(["<nav>{}</nav>", '<div class="menu">{}</div>', '<div id="navigation">{}</div>', '<ul class="nav breadcrumb">{}</ul>', '<div role="navigation">{}</div>'])
    return box.format("<ul>" + "".join(_links(rng)) + "</ul>")


def _header(rng: random.Random) -> str:
    return rng.choice(["<header>{}</header>", '<div id="header">{}</div>', '<div class="site-header top-bar">{}</div>', '<div role="banner">{}</div>']).format(f"<p>{_words(rng, 1, 6)}</p>" + rng.choice(["", _menu(rng)]))


def _footer(rng: random.Random) -> str:
    text = rng.choice(["&copy; 2024 {}", "{} &middot; {}", "<p>{}</p><p>{}</p>", "<p>Copyright {}</p>"]).format(_prose(rng), _words(rng, 2, 20) + ".")
    return rng.choice(["<footer>{}</footer>", '<div id="footer">{}</div>', '<div class="page-footer legal">{}</div>', '<div role="contentinfo">{}</div>']).format(text)


def _aside(rng: random.Random) -> str:
    inner = rng.choice([f"<h3>{_words(rng, 1, 3)}</h3><ul>{''.join(_links(rng))}</ul>", f"<p>{_prose(rng)}</p>"])
    return rng.choice(["<aside>{}</aside>", '<div class="sidebar">{}</div>', '<div id="side-bar">{}</div>', '<section class="related">{}</section>', '<div class="widget">{}</div>', '<div role="complementary">{}</div>']).format(inner)


def _advert(rng: random.Random) -> str:
    box = rng.choice(['<div class="ad">{}</div>', '<div class="ads">{}</div>', '<div class="advert banner">{}</div>', '<p class="sponsored">{}</p>', '<div id="promo">{}</div>', '<ins class="advertisement">{}</ins>'])
    return box.format(rng.choice([_words(rng, 2, 12) + ".", f"<p>{_prose(rng)}</p>", f'<a href="/x">{_words(rng, 1, 6)}</a>']))


def _notice(rng: random.Random) -> str:
    box = rng.choice(['<div class="cookie-notice">{}</div>', '<div id="consent">{}</div>', '<div class="notice">{}</div>', '<div class="modal popup">{}</div>', '<div class="newsletter subscribe">{}</div>', '<div role="alert">{}</div>', "<dialog>{}</dialog>"])
    return box.format(f"<p>{_prose(rng)}</p>" + rng.choice(["", "<button>OK</button>"]))


def _form(rng: random.Random) -> str:
    return f'<form action="/s"><label>{_words(rng, 1, 3)}</label><input name="q"><select><option>{_words(rng, 1, 1)}</option></select><button>{_words(rng, 1, 2)}</button><p>{_words(rng, 2, 10)}</p></form>'


def _comments(rng: random.Random) -> str:
    one = lambda: rng.choice([f'<div class="comment"><b>{_words(rng, 1, 2)}</b><p>{_prose(rng)}</p></div>', f'<li class="reply"><p>{_prose(rng)}</p></li>'])
    inner = f"<h3>{_words(rng, 1, 3)}</h3>" * rng.randint(0, 1) + "".join(one() for _ in range(rng.randint(1, 4)))
    return rng.choice(['<section class="comments">{}</section>', '<div id="comments">{}</div>', '<ol class="comment-list">{}</ol>', '<div class="discussion responses">{}</div>']).format(inner)


def _share(rng: random.Random) -> str:
    return rng.choice(['<div class="share social">{}</div>', '<p class="meta tags">{}</p>']).format("".join(_links(rng, "span")))


def _block(rng: random.Random) -> str:
    text = _prose(rng)
    kind = rng.random()
    if kind < 0.6:
        cut = text.split(" ")
        k = rng.randrange(len(cut))
        text = " ".join(cut[:k] + [rng.choice(["<b>{}</b>", "<em>{}</em>", '<a href="/y">{}</a>', "<span>{}</span>", "<b>{}", "{}<br>"]).format(cut[k])] + cut[k + 1 :])
        return f"<p>{text}</p>"
    if kind < 0.7:
        return f"<p>{text}"
    if kind < 0.78:
        return f"<h2>{_words(rng, 1, 8)}</h2>"
    if kind < 0.85:
        return "<ul>" + "".join(f"<li>{_prose(rng)}</li>" for _ in range(rng.randint(1, 4))) + "</ul>"
    if kind < 0.9:
        return f"<blockquote>{text}</blockquote>"
    if kind < 0.95:
        return f"<table><tr><td>{_words(rng, 1, 4)}</td><td>{_words(rng, 1, 4)}</td></tr></table>"
    return f"<pre>{text}</pre>"


def labelled_page(rng: random.Random) -> list[tuple[bool | None, str]]:
    """(main text or not, markup); None marks markup without text, which opens or closes a box."""
    page: list[tuple[bool | None, str]] = []
    extra = [_menu, _header, _advert, _notice, _form, _aside, _share]
    for make in rng.sample(extra, rng.randint(0, 4)):
        page.append((False, make(rng)))
    boxes = rng.choice([
        ["<article>"], ["<article>"], ["<main>"], ["<main>", "<article>"], ['<div id="content">'], ['<div class="post entry-content">'],
        ['<div class="wrapper">', '<div class="article-body">'], ['<div role="main">'], ['<section class="story text">'], ['<div class="row">', "<article>"], ["<div>"], [],
    ])
    page += [(None, b) for b in boxes]
    if rng.random() < 0.8:
        page.append((True, rng.choice(["<h1>{}</h1>", "<h1>{}</h1>", '<h1 class="title">{}</h1>', "<h2>{}</h2>"]).format(_words(rng, 1, 14))))
    for _ in range(rng.randint(1, 14)):
        page.append((True, _block(rng)))
        if boxes and rng.random() < 0.08:
            page.append((False, rng.choice([_advert, _aside, _share, _form, _notice])(rng)))
    if boxes and rng.random() < 0.15:
        page.append((False, _comments(rng)))
    page += [(None, "</" + b[1:].split(" ")[0].rstrip(">") + ">") for b in reversed(boxes)]
    for make in rng.sample([_comments, _aside, _advert, _notice, _form, _menu], rng.randint(0, 3)) + [_footer] * (rng.random() < 0.85):
        page.append((False, make(rng)))
    return page
