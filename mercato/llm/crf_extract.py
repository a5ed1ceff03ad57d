"""Main text of web pages by a linear-chain conditional random field.

A page is cut into leaf blocks (text between block-level tags); each has features of
its ancestors' tags, classes and ids and of its text.  A CRF over the sequence,
trained on labelled pages, decides by Viterbi decoding which blocks are main text.

Labelled pages come from two places: templates below, whose main elements carry a
mark, and a bounded sample of the table itself, whose landmark elements
(``article``, ``main`` against ``nav``, ``footer``, ...) say what is what.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import map_rows

SAMPLE_PAGES = 200  # of the table, by the hash of the page; bounds the training
MOST_CHARS, MOST_BLOCKS = 200_000, 400  # of a page of the sample
EPOCHS = 25

# HTML elements.
BLOCK_TAGS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html iframe label legend li main menu
nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN_TAGS = frozenset("script style template head title textarea select".split())  # never text of an article
RAW_TAGS = frozenset("script style textarea title".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HEAD_TAGS = frozenset("html head base basefont bgsound link meta title noscript noframes script style template".split())
ENDS_P = BLOCK_TAGS - {"body", "html", "head", "button", "label", "legend", "summary", "caption", "option"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/><]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/><]*)([^<>]*)>", re.S)  # a quote that never ends
_ATTRIBUTE = re.compile(r"(=?[^\s/=]+|=)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']\S*))?)?")
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[a-z]+")


class Block(NamedTuple):
    text: str
    path: tuple[str, ...]  # ancestors' tags from the root
    names: frozenset[str]  # words of their classes, ids and roles
    linked: int  # characters inside links
    main: bool | None  # the mark of a labelled page


def blocks_of(page: str | None) -> list[Block]:
    """Leaf blocks with text, in page order, in one pass over the page."""
    text = page or ""
    out: list[Block] = []
    stack: list[tuple[str, frozenset[str], bool | None]] = []
    parts: list[str] = []
    linked = hidden = links = heads = 0

    def flush():
        nonlocal linked
        if parts:
            joined = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
            if joined:
                marks = [m for _, _, m in stack if m is not None]
                out.append(Block(joined, tuple(t for t, _, _ in stack),
                                 frozenset().union(*(n for _, n, _ in stack)), linked, marks[-1] if marks else None))
            parts.clear()
        linked = 0

    def pop():
        nonlocal hidden, links, heads
        tag = stack[-1][0]
        if tag in BLOCK_TAGS:
            flush()
        hidden -= tag in HIDDEN_TAGS
        links -= tag == "a"
        heads -= tag == "head"
        stack.pop()

    def close(tags, limit=()):
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] in tags:
                while len(stack) > depth:
                    pop()
                return
            if stack[depth][0] in limit:
                return

    at = 0
    while True:
        m = _TOKEN.search(text, at)
        chunk = text[at:m.start() if m else len(text)]
        if heads and stack[-1][0] == "head" and chunk.strip(" \t\n\r\f"):
            close({"head"})
        if chunk and not hidden:
            parts.append(chunk)
            linked += len(chunk) if links else 0
        if not m:
            break
        at = m.end()
        closing, tag, attributes = m.group(1, 2, 3) if m[2] else m.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            close({tag})
            continue
        if heads and tag not in HEAD_TAGS:
            # </head> is optional: whatever can't be in a head ends it, but what a
            # noscript or template of it holds, only a body does
            while heads and (tag in ("body", "frameset") or not any(t in ("noscript", "template") for t, _, _ in stack)):
                close({"head"})
        if tag in ENDS_P:
            close({"p"}, limit=("table", "td", "th", "article", "section", "div", "body"))
        if tag in CLOSES:
            close(CLOSES[tag], limit=("ul", "ol", "dl", "table", "select"))
        if tag in BLOCK_TAGS:
            flush()
        if tag == "br" and not hidden:
            parts.append(" ")
        if tag in VOID_TAGS:
            continue
        names, mark = set(), None
        seen: dict[str, str] = {}
        for a in _ATTRIBUTE.finditer(attributes):
            seen.setdefault(a[1].lower(), (a[2] or a[3] or a[4] or "").lower())
        if "data-main" in seen:
            mark = seen["data-main"] == "1"
        if "hidden" in seen:
            names.add("#hidden")
        for a in ("class", "id", "role"):
            if a in seen:
                names.update(_NAME.findall(seen[a]))
        if attributes.endswith("/") and tag not in BLOCK_TAGS:
            continue
        stack.append((tag, frozenset(names), mark))
        hidden += tag in HIDDEN_TAGS
        links += tag == "a"
        heads += tag == "head"
        if tag in RAW_TAGS:  # nothing inside is markup
            end = re.compile(rf"</{tag}\b", re.I).search(text, at)
            at = end.start() if end else len(text)
    while stack:
        pop()
    flush()
    return out


# Words of classes and ids that tell the kind of an element.
KINDS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager tabs toc",
    "header": "header masthead topbar branding logo banner",
    "footer": "footer foot copyright colophon legal imprint",
    "side": "sidebar side aside widget related recommended popular trending teaser",
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion adsense",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay toast warning",
    "form": "form newsletter subscribe signup login search contact",
    "comment": "comment comments respond discussion disqus replies reply",
    "share": "share social sharing follow tags meta byline author",
    "main": "article content main post entry story text body page",
}
KIND_OF = {w: k for k, words in KINDS.items() for w in words.split()}


def features(blocks: list[Block]) -> list[list[str]]:
    """Features of each block; all of them are names of yes-or-no facts."""
    n, out = len(blocks), []
    for i, b in enumerate(blocks):
        t, words = b.text, b.text.count(" ") + 1
        tags = set(b.path)
        own = b.path[-1] if b.path else ""
        density = b.linked / max(1, len(t))
        f = ["bias", f"own={own}", f"len={min(7, len(t).bit_length() - 1)}", f"words={min(6, words.bit_length())}",
             f"links={0 if not b.linked else 1 if density < 0.3 else 2 if density < 0.8 else 3}"]
        f += [f"in={x}" for x in tags if x not in ("html", "body", "div", "span", "p", "b", "i", "a")]
        kinds = {KIND_OF[x] for x in b.names if x in KIND_OF}
        f += [f"kind={k}" for k in kinds]
        if "#hidden" in b.names:
            f.append("hidden")
        if not kinds and not tags & {"article", "main", "nav", "header", "footer", "aside", "form"}:
            f.append("plain")
        if t[-1] in ".!?…:\"”»。":
            f.append("ends")
        if t.count(",") + t.count(".") >= 3:
            f.append("prose")
        if "©" in t or "copyright" in t.lower():
            f.append("copyright")
        if i == 0:
            f.append("first")
        if i == n - 1:
            f.append("last")
        if own in ("h1", "h2", "h3") and i + 1 < n and len(blocks[i + 1].text) > 80:
            f.append("heads")
        out.append(f)
    return out


# ------------------------------------------------------------------ the field
class Field(NamedTuple):
    weights: dict[str, float]  # of label 1 over label 0
    moves: tuple[float, float, float, float]  # 00, 01, 10, 11


def viterbi(field: Field, page: list[list[str]]) -> list[int]:
    """The likeliest labels of a page's blocks."""
    if not page:
        return []
    get = field.weights.get
    m00, m01, m10, m11 = field.moves
    s0, s1, back = 0.0, sum(get(f, 0.0) for f in page[0]), []
    for feats in page[1:]:
        e = sum(get(f, 0.0) for f in feats)
        a, b, c, d = s0 + m00, s1 + m10, s0 + m01, s1 + m11
        back.append((int(b > a), int(d > c)))
        s0, s1 = max(a, b), max(c, d) + e
    label = int(s1 > s0)
    labels = [label]
    for pair in reversed(back):
        label = pair[label]
        labels.append(label)
    return labels[::-1]


def train(pages: list[tuple[list[list[str]], list[int]]], epochs: int = EPOCHS, rate: float = 0.3,
          ridge: float = 1e-4) -> Field:
    """Maximum likelihood by stochastic gradients (AdaGrad); the gradient is the
    difference of the labels and the marginals of forward-backward."""
    weights: dict[str, float] = {}
    squares: dict[str, float] = {}
    moves, move_sq = np.zeros((2, 2)), np.full((2, 2), 1e-8)
    order, deal = list(range(len(pages))), random.Random(7)
    for _ in range(epochs):
        deal.shuffle(order)
        for k in order:
            feats, y = pages[k]
            if not feats:
                continue
            e = [sum(weights.get(f, 0.0) for f in fs) for fs in feats]
            n = len(e)
            alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
            alpha[0] = (0.0, e[0])
            for t in range(1, n):
                alpha[t] = np.logaddexp(alpha[t - 1][0] + moves[0], alpha[t - 1][1] + moves[1]) + (0.0, e[t])
            for t in range(n - 2, -1, -1):
                ahead = beta[t + 1] + (0.0, e[t + 1])
                beta[t] = np.logaddexp(moves[:, 0] + ahead[0], moves[:, 1] + ahead[1])
            z = np.logaddexp(*alpha[-1])
            p1 = np.exp(alpha[:, 1] + beta[:, 1] - z)
            grad = np.zeros((2, 2))
            for t in range(n - 1):
                pair = alpha[t][:, None] + moves + (beta[t + 1] + (0.0, e[t + 1]))[None, :] - z
                grad -= np.exp(pair)
                grad[y[t], y[t + 1]] += 1
            move_sq += grad ** 2
            moves += rate * grad / np.sqrt(move_sq)
            for fs, label, p in zip(feats, y, p1):
                g = label - float(p)
                for f in fs:
                    w = weights.get(f, 0.0)
                    gf = g - ridge * w
                    squares[f] = squares.get(f, 1e-8) + gf * gf
                    weights[f] = w + rate * gf / math.sqrt(squares[f])
    return Field(weights, tuple(float(x) for x in moves.ravel()))


# ------------------------------------------------------------------ labelled pages
#: Templates: {L} a long paragraph, {S} a sentence, {W} a few words.  Elements with
#: data-main="1" are main text, all others are not.
TEMPLATES = (
    '<body><nav><ul><li><a href="/">{W}</a></li><li><a>{W}</a></li><li><a>{W}</a></li></ul></nav><div class="ad">{S}</div>'
    '<article data-main="1"><h1>{W}</h1><p><b>{S}<br><p>{L}</p><p>{L}</p></article><footer>&copy; {W}</footer>',
    '<body><header><a>{W}</a><p>{W}</p></header><div id="content" data-main="1"><h1>{W}</h1><p>{L}</p><h2>{W}</h2><p>{L}</p>'
    '<ul><li>{S}</li><li>{S}</li></ul></div><aside><h3>{W}</h3><p>{S}</p><a>{W}</a></aside><footer><p>{W}</p><a>{W}</a></footer>',
    '<body><div class="cookie-notice">{S}<button>{W}</button></div><div class="navbar"><a>{W}</a><a>{W}</a></div>'
    '<main data-main="1"><h1>{W}</h1><p>{S}</p><blockquote>{L}</blockquote><p>{L}</p></main>'
    '<section class="comments" id="comments"><h3>{W}</h3><div class="comment"><p>{S}</p></div><div class="comment"><p>{L}</p></div></section>'
    '<div class="footer">© {W}</div>',
    '<body><div id="header"><h1>{W}</h1><p>{W}</p></div><div id="menu"><ul><li><a>{W}</a></li><li><a>{W}</a></li></ul></div>'
    '<div class="post"><div class="entry" data-main="1"><h2>{W}</h2><p>{L}</p><p>{S}</p><p>{L}</p></div>'
    '<div class="share"><a>{W}</a><a>{W}</a></div></div><div id="sidebar"><h4>{W}</h4><p>{L}</p><p>{S}</p></div>'
    '<form class="newsletter"><label>{W}</label><p>{S}</p></form><div id="footer"><p>{S}</p></div>',
    '<body><div><a>{W}</a> | <a>{W}</a> | <a>{W}</a></div><div data-main="1"><p>{L}</p><p>{L}</p><p>{S}</p></div><div>{W} © {W}</div>',
    '<body><header class="site-header"><div class="logo">{W}</div></header><article><div data-main="1"><h1>{W}</h1><p>{L}</p><p>{L}</p></div>'
    '<div class="advert">{S}</div><div data-main="1"><p>{L}</p><table><tr><td>{W}</td><td>{W}</td></tr></table></div>'
    '<aside class="related"><h4>{W}</h4><a>{W}</a><a>{W}</a></aside></article><footer><nav><a>{W}</a></nav><p>{S}</p></footer>',
    '<body><div class="alert notice"><p>{L}</p></div><div role="main" data-main="1"><h1>{W}</h1><p>{L}</p><pre>{S}</pre><p>{L}</p></div>'
    '<ol class="comment-list"><li class="comment"><p>{L}</p></li><li class="comment"><p>{S}</p></li></ol><form><p>{S}</p><button>{W}</button></form>',
    '<body><nav class="breadcrumb"><a>{W}</a><a>{W}</a></nav><div class="sponsored"><p>{L}</p></div><section class="article-body" data-main="1">'
    '<h1>{W}</h1><p>{L}</p><h3>{W}</h3><p>{L}</p><figure><figcaption>{S}</figcaption></figure></section><div class="widget"><p>{L}</p></div>'
    '<footer class="legal"><p>{L}</p></footer>',
    '<body><header><nav><a>{W}</a><a>{W}</a></nav></header><article data-main="1"><header><h1>{W}</h1></header><p>{L}</p></article>'
    '<aside class="sidebar"><p>{L}</p><form class="search"><label>{W}</label></form></aside><footer><p>&copy; {W} {S}</p></footer>',
    '<html><body data-main="1"><h1>{W}</h1><p>{L}</p><p>{S}</p><p>{L}</p></body></html>',
    '<p data-main="1">{S}<p data-main="1">{S}<p data-main="1">{L}',
)
_WORDS = ("lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore "
          "magna aliqua enim ad minim veniam quis nostrud").split()


def template_pages(copies: int = 12) -> list[str]:
    """The templates, each filled ``copies`` times with words of seeded lengths."""
    r = random.Random(11)

    def words(low, high):
        return " ".join(r.choice(_WORDS) for _ in range(r.randint(low, high)))

    def sentence(low, high):
        return words(low, high).capitalize() + "."

    fill = {"{W}": lambda: words(1, 6), "{S}": lambda: sentence(4, 20),
            "{L}": lambda: " ".join(sentence(5, 18) for _ in range(r.randint(1, 9)))}
    return [re.sub(r"\{[WSL]\}", lambda m: fill[m[0]](), t) for t in TEMPLATES for _ in range(copies)]


_LANDMARKS = {"article", "main", "nav", "footer", "aside", "header", "section"}


def without_landmarks(blocks: list[Block], names: bool = False) -> list[Block]:
    """The blocks as they would be on a page of the same make whose landmark elements
    are plain ``div``s (and, unless ``names``, whose classes and ids say nothing)."""
    return [b._replace(path=tuple("div" if t in _LANDMARKS else t for t in b.path),
                       names=b.names if names else frozenset()) for b in blocks]


def landmark_labels(blocks: list[Block]) -> list[int] | None:
    """Labels of a page that has an ``article`` or ``main``; None for others."""
    if not any({"article", "main"} & set(b.path) for b in blocks):
        return None
    out = []
    for b in blocks:
        tags = list(b.path)
        inside = max((i for i, t in enumerate(tags) if t in ("article", "main")), default=-1)
        kinds = {KIND_OF.get(x) for x in b.names} & {"menu", "side", "advert", "notice", "form", "comment"}
        out.append(int(inside >= 0 and not kinds and not set(tags[inside:]) & {"nav", "aside", "form"}))
    return out


def fit(pages: DataFrame, html_col: str = "html") -> Field:
    """The field trained on the templates and on SAMPLE_PAGES of ``pages``, of at most
    MOST_CHARS characters and MOST_BLOCKS blocks.  Each sampled page is learnt three times: as
    it is, with plain elements for its landmarks, and without class names as well, so that the field
    tells main text from the rest where pages have no landmarks."""
    total = max(1, pages.count())
    share = min(1_000_000, -(-SAMPLE_PAGES * 2_000_000 // total))  # twice the sample, so that few rows are sorted
    sample = (pages.select(F.col(f"`{html_col}`").alias("html")).where(F.length("html") < MOST_CHARS)
              .select("html", F.xxhash64("html").alias("h")).where(F.expr(f"pmod(h, 1000000) < {share}"))
              .orderBy("h").limit(SAMPLE_PAGES).collect())
    labelled = []
    for page in template_pages():
        blocks = blocks_of(page)
        labelled.append((features(blocks), [int(bool(b.main)) for b in blocks]))
    for r in sample:
        blocks = blocks_of(r.html)
        labels = landmark_labels(blocks)
        if labels is not None and len(blocks) <= MOST_BLOCKS:
            for seen in (blocks, without_landmarks(blocks, names=True), without_landmarks(blocks)):
                labelled.append((features(seen), labels))
    return train(labelled)


# ------------------------------------------------------------------ operator
def main_text(page: str | None, field: Field) -> str:
    blocks = blocks_of(page)
    return "\n".join(b.text for b, keep in zip(blocks, viterbi(field, features(blocks))) if keep)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            field: Field | None = None) -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks) per row of ``pages``.

    Null or empty html gives the empty text, as does a page without main text.
    Repeated rows give repeated results, null ids and URLs are passed on, other
    columns play no part, and an empty table gives an empty result.  Very long pages are
    cut into blocks in one pass, in linear time.
    """
    use = field or fit(pages, html_col)

    def run(batches):
        for b in batches:
            found = [blocks_of(x) for x in b["html"]]
            texts = ["\n".join(k.text for k, keep in zip(x, viterbi(use, features(x))) if keep) for x in found]
            yield {"page_id": b["page_id"], "url": b["url"], "text": texts, "n_chars": [len(t) for t in texts],
                   "n_blocks": [len(x) for x in found]}

    url = F.col(f"`{url_col}`") if url_col in pages.columns else F.lit(None).cast("string")
    narrow = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), url.alias("url"),
                          F.col(f"`{html_col}`").alias("html"))
    return map_rows(narrow, run, "page_id long, url string, text string, n_chars long, n_blocks int")
