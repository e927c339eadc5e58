"""Main text of web pages by the line-block distribution.

Markup is stripped so that every block element is one line, and the lines' text lengths are summed
over a sliding window. A region begins where the sum surges above the threshold, back to the gap
before it, and ends where the sum dives to nothing; the regions' lines are the main text. This
decides on every page. Tags and class names only change the lengths that are summed:

- Lines of menus, footers, forms and the like, and of blocks whose class or id says so, count as
  empty lines, and as many as a window has, so the sum dives there. A mark around the page's
  ``main``, or around the one article with the bulk of its text, is layout and is void; so is one
  that may name layout, on a block with the bulk of the text that isn't marked otherwise.
- ``article`` and ``main`` have gaps around them. Where the regions that surge in articles hold the
  bulk of what surges, the lines of the others count as empty too.

Windows are also judged across the gaps, since what stood there is gone, and what lies between
regions that surge is kept.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate, groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import lean, row_ranges

WINDOW = 3
THRESHOLD = 86
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
RAW = frozenset("script style noscript template iframe svg textarea select title head".split())
ASIDE = frozenset("nav footer aside form dialog menu button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of a class or id that mark what isn't part of the article.
MARKS = re.compile(r"(?<![^\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notice|popup|modal|newsletter|subscribe|sidebar|side-bar|widget|menu|nav\w*|breadcrumbs?|footer|masthead|site-header|page-header|topbar|comments?|comment-list|disqus|replies|respond|share|sharing|social|related|recommended|pagination|pager)(?![^\s_-])", re.I)
#: Of these, what may also name layout around the article.
LAYOUT = frozenset("sidebar side-bar widget share sharing social related recommended".split())
#: Bytes of HTML whose texts are returned in one batch.
SLICE_BYTES = 8 << 20
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"<>]*\"|'[^'<>]*'|[^'\">])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
ATTRIBUTE = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
SPACE = re.compile(r"\s+")


def tokens_of(page: str) -> list[tuple[str, str, bool, str]]:
    """``(text before, name, whether it ends, attributes)`` of each tag; an empty name is a break or the page's end."""
    out: list[tuple[str, str, bool, str]] = []
    # Beyond the last > there is no tag. A search that ends there meets one from every <, so its cost is linear.
    at, size, last, headless, text = 0, len(page), page.rfind(">") + 1, False, ""
    while at < size:
        found = TOKEN.search(page, at, last) if at < last else None
        if not found:
            text += page[at:].partition("<!--")[0]
            break
        text += page[at : found.start()]
        at = found.end()
        if found[0].startswith("<!--") and not found[0].endswith("-->"):
            break
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        ending, rest = bool(found[1] or found[4]), found[3] or found[6] or ""
        if name in RAW and not ending and not rest.rstrip().endswith("/"):
            end = None if headless and name == "head" else re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            headless |= name == "head" and not end
            at = end.end() if end else (at if name == "head" else size)
            if name == "svg":
                continue
            name, rest = "", ""
        out.append((text, name, ending, rest))
        text = ""
    out.append((text, "", False, ""))
    return out


def lines_of(page: str) -> list[tuple[str, bool]]:
    """Each block's text and whether it stands in an article; lines that count as empty are empty texts."""
    out: list[tuple[str, bool]] = []
    buffer: list[str] = []
    article = 0

    def close(gap: bool = False):
        text = SPACE.sub(" ", html.unescape("".join(buffer))).strip()
        buffer.clear()
        if text:
            out.append((text, article > 0))
        if gap:
            out.extend([("", article > 0)] * WINDOW)

    tokens = tokens_of(page)

    def marks(i: int) -> list[str]:
        rest = tokens[i][3]
        return [x.lower() for m in ATTRIBUTE.finditer(rest) for x in MARKS.findall(m[1] or m[2] or m[3] or "")] if rest else []

    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    mains: list[int] = []
    bodies: list[int] = []
    mass = [0]
    for i, (text, name, ending, rest) in enumerate(tokens):
        mass.append(mass[-1] + len(text.strip()))
        if name in BLOCKS or name in ASIDE:
            if not ending and name in ("article", "main"):
                mains.append(i)
                if name == "main":
                    bodies.append(i)
            if ending and opened.get(name):
                ends[opened[name].pop()] = i
            elif not ending and not rest.rstrip().endswith("/"):
                opened.setdefault(name, []).append(i)

    # At most one article and those around it hold the bulk; one that is never closed ends where the next begins.
    own = [(k, ends.get(k, after)) for k, after in zip(mains, [*mains[1:], len(tokens) - 1], strict=False)]
    bulk = [(k, end) for k, end in own if 2 * (mass[end + 1] - mass[k + 1]) > mass[-1]]

    # Text outside of what can only be furniture.
    plain, until = [0], -1
    for i, (text, name, ending, _) in enumerate(tokens):
        plain.append(plain[-1] + (len(text.strip()) if i > until else 0))
        if i >= until and not ending and (name in ASIDE or name == "header" or name in BLOCKS and not LAYOUT.issuperset(marks(i))):
            until = ends.get(i, i)

    def wraps(i: int, name: str) -> bool:
        """Whether the block is layout: around a ``main``, around the one article with the bulk of the page's text, or itself that bulk."""
        if name in ASIDE and name != "form" or name == "header":
            return False
        end = ends.get(i, len(tokens) - 1)
        if name != "article" and bisect_left(bodies, i) < bisect_left(bodies, end):
            return True
        held = not mains or bisect_left(mains, i) < bisect_left(mains, end)
        if held and name not in ASIDE and i in ends and 2 * (plain[end + 1] - plain[i + 1]) > plain[-1] and LAYOUT.issuperset(marks(i)):
            return True
        return any(i <= k < end and 2 * (mass[min(own, end) + 1] - mass[k + 1]) > mass[-1] for k, own in reversed(bulk))

    i = 0
    while i < len(tokens):
        text, name, ending, rest = tokens[i]
        buffer.append(text)
        if not name:
            close()
        elif not ending and name not in VOID and name != "main":
            marked = name in BLOCKS and name != "body" and bool(marks(i))
            if (name in ASIDE or name == "header" and not article or marked) and not wraps(i, name):
                close(gap=True)
                if i in ends:
                    i = ends[i] + 1
                elif rest.rstrip().endswith("/"):
                    i += 1
                else:  # never closed: what follows is read again from the next article on
                    after = bisect_left(mains, i + 1)
                    i = mains[after] if after < len(mains) else len(tokens)
                    if i < len(tokens):
                        tokens[i] = ("", *tokens[i][1:])
                continue
        if name in ("article", "main"):
            close(gap=True)
            article = max(0, article + (-1 if ending else 1))
        elif name in BLOCKS:
            close()
        elif name == "br":
            buffer.append(" ")
        i += 1
    close()
    return out


def main_text(page: str, window: int = WINDOW, threshold: int = THRESHOLD) -> str:
    lines = lines_of(page)
    length = [len(text) for text, _ in lines]
    block = [sum(length[i : i + window]) for i in range(len(length))]
    part = list(accumulate(int(a[1] != b[1]) for a, b in zip(lines[:1] + lines, lines, strict=False)))
    # What stood in a gap is gone, so lines on both sides of it are neighbours too, unless an article begins or ends there.
    near: set[int] = set()
    for _, own in groupby((i for i, n in enumerate(length) if n), key=part.__getitem__):
        full = list(own)
        for k in range(max(1, len(full) - window + 1)):
            if sum(length[i] for i in full[k : k + window]) > threshold:
                near.update(full[k : k + window])
    regions: list[tuple[list[str], bool, bool, int]] = []
    at = 0
    while at < len(lines):
        if not length[at]:
            at += 1
            continue
        end, surge = at, False
        while end < len(lines) and block[end]:
            surge |= block[end] > threshold or end in near
            end += 1
        regions.append(([text for text, _ in lines[at:end] if text], surge, lines[at][1], part[at]))
        at = end
    last = {k: i for i, (_, surge, _, k) in enumerate(regions) if surge}
    begun: set[int] = set()
    for i, (own, surge, inside, k) in enumerate(regions):
        begun |= {k} if surge else set()
        regions[i] = (own, surge or k in begun and i < last[k], inside, k)
    size = lambda own: sum(len(text) for text in own)
    if not any(surge for _, surge, _, _ in regions):
        return "\n".join(max((own for own, _, _, _ in regions), key=size, default=[]))
    # The tags are a hint: regions that surge in articles go alone if they hold the bulk of what surges, and a page's
    # only article isn't lost where just other regions surge.
    alone = len({k for _, _, inside, k in regions if inside}) == 1 and not any(surge and inside for _, surge, inside, _ in regions)
    kept = [(own, inside) for own, surge, inside, _ in regions if surge or inside and alone]
    inner = [own for own, inside in kept if inside]
    if 2 * sum(map(size, inner)) > sum(size(own) for own, _ in kept):
        return "\n".join(text for own in inner for text in own)
    return "\n".join(text for own, _ in kept for text in own)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last in row_ranges(batch.column(2), SLICE_BYTES):
            part = batch.slice(first, last - first)
            texts = [main_text(x or "") for x in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"])


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id_col, url_col, text, n_chars)`` for each row: the article's blocks joined by newlines.

    Null or empty pages, and pages without text, give an empty text. If no region surges above the
    threshold, the longest one is kept. Repeated rows are returned as often as they come; other
    columns are ignored. Broken markup is read as far as it goes.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(lambda it: lean(_extract(it)), "id long, url string, text string, n_chars long").toDF(id_col, url_col, "text", "n_chars")
