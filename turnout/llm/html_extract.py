"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block element.  Elements that are never main text (menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles, reader comments) leave empty lines.  The
block at a line is the text length, links excepted, of the ``WINDOW`` lines from it on.  Where blocks rise from nothing
above ``SURGE`` characters, main text starts (surge point); it lasts until a block is empty (dive point).
The text between the points is kept, and all that stands between two such runs (menus excepted); so are headings
directly before the first and closing sentences directly after the last.

Inside a marked article a run of text surges however short it is, and a block dives only where its lines are all there
and all links: so ``WINDOW`` or more lines of nothing but links in a row are a menu and go, and all other text stays.

What a class only hints at (a widget, something social) goes only where other main text is left.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from turnout.llm.common import map_arrow, text_slices

WINDOW = 3
SURGE = 80
MENU_SHARE = 0.8  # inside an article, a line with more of its text in links is all link
LINK_SHARE = 0.5  # outside an article, a line with more of its text in links is a menu, or a paragraph or heading between runs of text

BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section "
                   "summary table tbody td tfoot th thead title tr ul".split())
DROPPED = frozenset("nav header footer aside form menu dialog button select datalist label noscript template iframe object canvas svg "
                    "math audio video figure head title".split())
# part of an article's text where they stand in one
ARTICLE_TEXT = frozenset("figure label button math".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())  # their content has no markup
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
MAIN = frozenset(["article", "main"])
# elements whose end also ends a dropped element in them that was never closed
CONTAINERS = BLOCKS - {"p", "li", "dd", "dt", "tr", "td", "th", "hr"}
# words of class, id or role that mark other elements as no main text
MARKED = frozenset("ad ads adv advert advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies cookiebar consent gdpr "
                   "notice notices notification alert popup modal overlay newsletter subscribe subscription signup paywall menu navbar "
                   "nav navigation breadcrumb breadcrumbs sidenav topnav toc pagination pager sidebar aside rail widget widgets comment comments commentlist commentform disqus "
                   "reply replies respond responses footer copyright share sharing social related recommended recommendations search login".split())
MARKED_OUTSIDE = MARKED | frozenset(["header", "masthead", "topbar", "toolbar"])
# inside an article a whole class or role has to name a menu, header, footer, sidebar, notice, advert, form or the comments ...
MARKED_INSIDE = frozenset("menu menus nav navbar navigation sidenav topnav breadcrumb breadcrumbs toc pagination pager masthead topbar footer contentinfo copyright "
                          "sidebar complementary cookie cookies cookiebar consent gdpr notice notices ad ads adv advert adverts advertisement "
                          "advertisements advertising adsense sponsor sponsored promo form search comment comments commentlist commentform disqus reply replies".split())
# ... in words that only say what kind of box it is
BOXES = frozenset("area article banner bar block body bottom box container content entry global inner item items left link links list login "
                  "main modal newsletter outer overlay page panel popup post primary reader readers right secondary section signup site slot "
                  "subscribe thread top unit user widget wrap wrapper".split())
COMMENT_IDS = frozenset(["comments", "respond", "disqus_thread"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TAG = re.compile(r"""<!--(?:.*?-->|.*\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_MARK = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_CLOSED = re.compile(r"""[.!?…]["'”’»)]*\Z""")
_QUOTED = re.compile(r""""[^"]*"|'[^']*'""")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|\Z)", re.I)
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
IN_MAIN, IN_ARTICLE = 1, 2


def page_lines(html: str, hints: bool = True) -> tuple[list[str], list[int], list[int], list[str]]:
    """Lines of a page ('' for what is dropped), the characters of each that are link text, whether it stands in an
    article or else in the main element, and the block element it is directly in ('' behind one).  Without ``hints``
    only a whole class or role that names a kind of page part drops an element."""
    lines, linked, inside, blocks = [], [], [], []
    block = ""
    words: list[str] = []
    in_link = link_chars = articles = mains = 0
    stack: list[str] = []  # open elements
    skip = -1              # place in the stack of the dropped element that is open

    def close_line() -> None:
        nonlocal link_chars
        if words:
            lines.append(" ".join(unescape("".join(words)).split()))
            linked.append(link_chars)
            inside.append(IN_ARTICLE if articles else IN_MAIN if mains else 0)
            blocks.append(block)
            words.clear()
            link_chars = 0

    def valley() -> None:
        close_line()
        lines.extend([""] * WINDOW)
        linked.extend([0] * WINDOW)
        inside.extend([0] * WINDOW)
        blocks.extend([""] * WINDOW)

    at, end = 0, len(html)
    while at < end:
        tag = _TAG.search(html, at)
        stop = tag.start() if tag else end
        if stop > at and skip < 0:
            text = html[at:stop]
            words.append(text)
            if in_link:
                link_chars += len(text.strip())
        if not tag:
            break
        at = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        if not name:
            continue
        closing = bool(tag[1] or tag[4])
        attributes = tag[3] or tag[6] or ""
        if name in RAW and not closing:
            close = re.compile(rf"</{name}\b[^>]*>", re.I).search(html, at)
            at = close.end() if close else end
            if name != "title" and skip < 0:
                words.append(" ")
            continue
        if closing:
            k = len(stack) - 1
            while k >= 0 and stack[k] != name:
                k -= 1
            if skip >= 0:
                if k > skip or k < 0 or k < skip and name not in CONTAINERS:
                    del stack[k if k > skip else len(stack):]
                    continue
                # the dropped element ends, or its parent does and it was never closed
                skip = -1
            if k >= 0:
                del stack[k:]
            if name in BLOCKS:
                close_line()
                block = ""
            elif name == "a":
                in_link = 0
            if name == "article" and articles or name == "main" and mains:
                articles, mains = articles - (name == "article"), mains - (name == "main")
                if not articles and not mains:
                    valley()
            continue
        whole = name in VOID or attributes.endswith("/")
        if name in BLOCKS and stack and stack[-1] == "p" and len(stack) - 1 != skip:
            stack.pop()  # a block ends an open paragraph
        if skip >= 0:
            if name in MAIN and not articles and not mains and stack[skip] not in ("noscript", "template"):
                del stack[skip:]  # an element that was never closed ends where the article starts
                skip = -1
            else:
                if not whole:
                    stack.append(name)
                continue
        if not whole:
            stack.append(name)
            in_main = bool(articles or mains)
            if name in DROPPED and not (in_main and name in ARTICLE_TEXT) or attributes and _marked(name, attributes, in_main, hints):
                valley()
                skip = len(stack) - 1
                continue
        if name == "br":
            words.append(" ")
        elif name == "a":
            in_link = 1
        elif name in BLOCKS:
            close_line()
            block = name
            if name in MAIN:
                if not articles and not mains:
                    valley()
                articles, mains = articles + (name == "article"), mains + (name == "main")
    close_line()
    return lines, linked, inside, blocks


def _marked(name: str, attributes: str, in_article: bool, hints: bool = True) -> bool:
    if name in ("html", "body", "article", "main") and not in_article:
        return False
    found = [(a[1].lower(), a[2] or a[3] or a[4] or "") for a in _ATTRIBUTE.finditer(attributes)]
    if _HIDDEN.search(_QUOTED.sub('""', attributes)) or any(k == "style" and _NO_DISPLAY.search(v) for k, v in found):
        return True
    if in_article or not hints:
        return any(_marks_inside(name, k, v) for k, v in found)
    return any(token.lower() in MARKED_OUTSIDE for m in _MARK.finditer(attributes) for token in _TOKEN.findall(m[1] or m[2] or m[3] or ""))


def _marks_inside(name: str, attribute: str, value: str) -> bool:
    if attribute == "id":  # ids are slugs of headings, so only those that pages give to reader comments count
        return name not in HEADINGS and value.lower() in COMMENT_IDS
    if attribute not in ("class", "role"):
        return False
    for whole in value.split():
        words = {w.lower() for w in _TOKEN.findall(whole)}
        if name == "span" and words == {"comment"}:  # of coloured program text
            continue
        if words & MARKED_INSIDE and words <= MARKED_INSIDE | BOXES:
            return True
    return False


def main_text(html: str | None) -> str:
    """The main text of a page: blocks in page order joined by a line break; '' if there is none."""
    return _text_of(*page_lines(html or "")) or _text_of(*page_lines(html or "", hints=False))


def _block_sums(lengths: np.ndarray) -> np.ndarray:
    """At every line, the length of the WINDOW lines from it on."""
    total = np.concatenate([[0], np.cumsum(lengths), np.full(WINDOW, lengths.sum())])
    return total[WINDOW:WINDOW + len(lengths)] - total[:len(lengths)]


def _text_of(lines: list[str], linked: list[int], inside: list[int], elements: list[str]) -> str:
    kind = max((k for line, k in zip(lines, inside) if line), default=0)  # the article, if there is text in one
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    links = np.minimum(np.array(linked, dtype=np.int64), lengths)
    if kind:
        own = np.array([k == kind for k in inside]) & (lengths > 0)
        plain = np.where(links > MENU_SHARE * lengths, 0, lengths)
        # a dive: WINDOW lines that are all there and of which nothing is plain text
        dive = (_block_sums(plain) == 0) & (_block_sums(own.astype(np.int64)) == WINDOW)
        menu = np.zeros(len(lines), bool)
        for k in range(WINDOW):
            menu[k:] |= dive[:len(dive) - k] if k else dive
        kept = own & ~menu if (own & ~menu).any() else own
        return "\n".join(lines[i] for i in np.flatnonzero(kept))
    # menus count as empty
    text = [line if n <= LINK_SHARE * len(line) else "" for line, n in zip(lines, linked)]
    if not any(text):
        return ""
    lengths = np.fromiter(map(len, text), np.int64, len(text))
    blocks = _block_sums(lengths)
    # runs between an empty block and the next one: from surge to dive
    full = np.flatnonzero(blocks > 0)
    runs = np.split(full, np.flatnonzero(np.diff(full) > 1) + 1)
    kept = [r for r in runs if blocks[r].max() > SURGE]
    if not kept:
        kept = [max(runs, key=lambda r: lengths[r].sum())]
        return "\n".join(text[i] for r in kept for i in range(r[0], min(r[-1] + WINDOW, len(text))) if text[i])
    full = [i for i, line in enumerate(lines) if line]
    first = next(k for k, i in enumerate(full) if i >= kept[0][0] and text[i])
    last = max(k for k, i in enumerate(full) if i < kept[-1][-1] + WINDOW and text[i])
    own = [lines[i] for i in full[first:last + 1] if text[i] or elements[i] == "p" or elements[i] in HEADINGS]
    while first and elements[full[first - 1]] in HEADINGS:
        first -= 1
        own.insert(0, lines[full[first]])
    while last + 1 < len(full) and elements[full[last + 1]] == "p" and text[full[last + 1]] and _CLOSED.search(text[full[last + 1]]):
        last += 1
        own.append(lines[full[last]])
    return "\n".join(own)


def _extractor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, pages in text_slices(batches, "html"):
        texts = [main_text(p) for p in pages]
        yield pa.RecordBatch.from_arrays([rows.column("page_id"), rows.column("url"), pa.array(texts, pa.string()),
                                          pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text (main text, '' if none) and n_chars (its code points) of every page.

    A null or empty page has no text.  One row per input row, repeated rows and null ids included; other
    columns are dropped.  Pages of any length are taken whole; a page may be cut off anywhere.
    """
    return map_arrow(pages.select("page_id", "url", "html"), _extractor, "page_id long, url string, text string, n_chars long")
