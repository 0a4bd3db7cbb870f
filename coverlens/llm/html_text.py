"""Main text of web pages by tag-path ratios.

A page is read once into text blocks, each with the path of open elements from the root.  Per path the text's length and
punctuation are added up over the page and set against the number of its nodes; the ratios are smoothed over blocks in page order with
their neighbours, fused and weighted, and a path is kept if that reaches a share of the page's highest.  What the markup says enters as a weight: none for elements that
are never article text by their meaning (navigation, forms, scripts, page headers and footers, and those whose class, id or role says
menu, advert, notice, comments and the like); if the page marks its article (``article``, ``main``), ``INSIDE`` for paths within it and
``OUTSIDE`` for others.  The ratio can overrule the mark: a path outside is kept from 0.8 of the highest ratio inside on, one
inside goes below the share.  Headings inside a marked article are short by nature and count ``HEADING`` times.  What is short by nature too, such as
lists and tables, follows its neighbours: blocks below the share that stand between kept blocks of the article and hold no link are kept, and
those of a list or table after the last kept block.  Within an article a class marks only if all its words say so (``share-buttons``,
not ``share-price``); another one with such a word counts as ``OUTSIDE`` and is kept by its ratio or its neighbours.

Null, empty and text-free pages give an empty text.  Broken markup is read as far as it goes: unclosed elements end with their
parent, stray ends are passed over.  Nothing is cut; very long pages cost time in proportion.  Repeated rows give equal texts; other
columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMOOTH = 0.25  # weight of each neighbour
INSIDE, OUTSIDE = 4.0, 0.4  # weights of a path within a marked article and beside it
HEADING = 8.0  # further weight of a heading within one, not counted for the highest
LOOSE = "?"  # in a path: an element within an article that only some word of its class marks
SHARE = 0.08  # of the highest weighted ratio, below which a path is no content

# Element names of HTML by their meaning.
RAW = frozenset("script style template noscript textarea title iframe svg math object select canvas xmp noframes".split())
NEVER = RAW | frozenset("head nav footer aside form button header menu dialog label input option fieldset figcaption".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("html head body caption tbody td tfoot th thead tr".split())
SELF_CLOSING = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]), "body": frozenset(["head"]),
}
FENCE = frozenset("ul ol dl table html body div section article main td th".split())
ARTICLE = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
# Words of class, id and role values that mark what is no article text.
MARKS = frozenset(
    "ad ads advert advertisement advertising banner sponsor sponsored promo promoted menu nav navigation navbar breadcrumb breadcrumbs sidebar "
    "comment comments disqus reply replies cookie cookies consent notice notification alert popup modal newsletter subscribe signup login "
    "related share sharing social footer masthead topbar toolbar pagination pager widget copyright legal disclaimer hidden complementary "
    "contentinfo search".split()
)

# Words that say nothing about an element's meaning: a class of these and at least one mark is a mark.
NEUTRAL = frozenset(
    "area article articles bar block bottom box button buttons container content count counter field form group header icon icons inner item items "
    "left line link links list main media message outer page panel post right row section site slot text title top unit user wrap wrapper".split()
)
BESIDE = frozenset("li dt dd td th caption pre blockquote".split())  # elements whose text is short by nature

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_MARKED = re.compile(r"""(?:^|\s)(?:class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")
_POINT = re.compile(r"[.,;:!?…。，、；：！？]")


def _marked(name: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element's class, id, role or label holds a word that marks, and whether one of them says nothing else."""
    if not attributes or name in ("html", "body", "article", "main"):
        hidden = bool(attributes and _HIDDEN.search(attributes))
        return hidden, hidden
    if _HIDDEN.search(attributes):
        return True, True
    values = [[w.lower() for w in _WORD.findall(v)] for value in _MARKED.findall(attributes) for v in value.strip("\"'").split()]
    some = [v for v in values if not MARKS.isdisjoint(v)]
    return bool(some), any(all(w in MARKS or w in NEUTRAL or w.isdigit() for w in v) for v in some)


def text_blocks(page: str) -> list[tuple[str, str, bool]]:
    """(text, path, inside an article) of each block in page order, without what is never article text."""
    open_: list[tuple[str, bool, bool, str]] = []  # name, left out, in an article, path
    found: list[tuple[str, str, bool]] = []
    parts: list[str] = []
    state = ["", False, False]  # path of the block's first text, whether there is some, in an article

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text:
            found.append((text, state[0], state[2]))
        parts.clear()
        state[1] = False

    def put(raw: str) -> None:
        if not raw:
            return
        out, article, path = (open_[-1][1], open_[-1][2], open_[-1][3]) if open_ else (False, False, "")
        if out:
            return
        text = html.unescape(raw)
        if not state[1]:
            state[:] = [path, not text.isspace(), article]
        parts.append(text)

    def end(upto: int) -> None:
        if any(name in BLOCK for name, *_ in open_[upto:]):
            flush()
        del open_[upto:]

    at = 0
    while at < len(page):
        token = _TOKEN.search(page, at)
        if token is None:
            put(page[at:])
            break
        put(page[at : token.start()])
        at = token.end()
        name = (token.group(2) or "").lower()
        if not name:
            continue
        if token.group(1):
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] == name:
                    end(i)
                    break
                if open_[i][0] in ("td", "th", "table") and name not in ("table", "tr", "tbody", "thead", "tfoot", "html", "body"):
                    break
            continue
        if name in VOID:
            if name in ("br", "wbr"):
                put(" " if name == "br" else "")
            elif name == "hr":
                flush()
            continue
        if name in BLOCK:
            flush()
        if name in CLOSES_P:
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] == "p":
                    end(i)
                    break
                if open_[i][0] in FENCE:
                    break
        for i in range(len(open_) - 1, -1, -1):
            if open_[i][0] in SELF_CLOSING.get(name, ()):
                end(i)
                break
            if open_[i][0] in FENCE:
                break
        if name in RAW:  # its content is no markup
            close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = close.end() if close else len(page)
            continue
        out, article, path = (open_[-1][1], open_[-1][2], open_[-1][3]) if open_ else (False, False, "")
        attributes = token.group(3)
        article = article or name in ARTICLE
        # A header inside an article holds its title; a page's holds menus.
        never = name in NEVER and not (name in ("header", "figcaption") and article)
        some, firm = _marked(name, attributes)
        loose = LOOSE if some and not firm and article else ""
        open_.append((name, out or never or (firm if article else some), article, f"{path}/{name}{loose}"))
    flush()
    return found


def fused_ratios(found: list[tuple[str, str, bool]]) -> list[float]:
    """The fused, smoothed ratio of each block's path."""
    length, points, nodes = defaultdict(int), defaultdict(int), defaultdict(int)
    for text, path, _ in found:
        length[path] += len(text)
        points[path] += len(_POINT.findall(text))
        nodes[path] += 1

    def smoothed(values: list[float]) -> list[float]:
        padded = [values[0], *values, values[-1]] if values else []
        return [SMOOTH * a + (1 - 2 * SMOOTH) * b + SMOOTH * c for a, b, c in zip(padded, padded[1:], padded[2:], strict=False)]

    by_length = smoothed([length[p] / math.sqrt(nodes[p]) for _, p, _ in found])
    by_points = smoothed([(points[p] + 0.5) / math.sqrt(nodes[p]) for _, p, _ in found])
    fused = [math.sqrt(a * b) for a, b in zip(by_length, by_points, strict=True)]
    # One value a path: the mean over its blocks.
    total: dict[str, float] = defaultdict(float)
    for (_, path, _), value in zip(found, fused, strict=True):
        total[path] += value
    return [total[path] / nodes[path] for _, path, _ in found]


def main_text(page: str | None) -> str:
    found = text_blocks(page or "")
    if not found:
        return ""
    marked = any(inside for _, _, inside in found)

    def weight(path: str, inside: bool) -> float:
        return 1.0 if not marked else INSIDE if inside and LOOSE not in path else OUTSIDE

    weighted = [r * weight(path, inside) for r, (_, path, inside) in zip(fused_ratios(found), found, strict=True)]
    least = SHARE * max(weighted)

    def heading(path: str) -> float:
        return 1.0 if HEADINGS.isdisjoint(path.split("/")) else HEADING

    kept = [w * (heading(path) if inside else 1.0) >= least for (_, path, inside), w in zip(found, weighted, strict=True)]
    return "\n".join(text for (text, _, _), k in zip(found, _with_neighbours(found, kept), strict=True) if k)


def _with_neighbours(found: list[tuple[str, str, bool]], kept: list[bool]) -> list[bool]:
    """Also the blocks of an article that hold no link and stand between kept ones of it, and lists and tables after the last."""
    out = list(kept)
    at = 0
    while at < len(found):
        stop = at
        while stop < len(found) and not kept[stop] and found[stop][2] and "a" not in found[stop][1].split("/"):
            stop += 1
        if stop > at and at > 0 and kept[at - 1] and found[at - 1][2]:
            followed = stop < len(found) and kept[stop] and found[stop][2]
            for i in range(at, stop):
                path = found[i][1]
                out[i] = followed or (LOOSE not in path and not BESIDE.isdisjoint(path.split("/")))
        at = max(stop, at + 1)
    return out


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of ``pages`` (page_id, url, html)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    chosen = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return chosen.mapInArrow(read, "page_id long, url string, text string, n_chars long")
