"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one for each block. Lines that are menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles or comments by their element or class count as empty, so they leave
gaps. Text lengths are summed over sliding windows of lines: where a sum rises from nothing the text surges, where
windows stay empty it dives, and what lies between is kept. On pages with an ``article`` or ``main`` only
its lines count; on others, stretches that are lists of links are dropped: at least ``LINKS`` links with
more than half of the characters.

Null or empty pages give an empty text. Whole pages are read; nothing is capped. Rows are independent:
repeated rows give repeated results, no rows give none, and other columns stay unread.
"""

from __future__ import annotations

import html as entities
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|head|textarea|select|iframe|object)\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<![^>]*>|<\?[^>]*>", re.S | re.I)
# fixed values: elements inside a line, elements without an end, elements and words that name what is no main text
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br img".split())
EMPTY = frozenset("br hr img input meta link wbr area base col embed source track".split())
ASIDE = frozenset("nav footer aside form button dialog menu".split())
NAMES = frozenset("ad ads advert adverts advertisement banner sponsor sponsored promo promotion cookie cookies consent gdpr notice newsletter subscribe subscription popup modal overlay sidebar related recommended menu nav navbar navigation breadcrumb breadcrumbs header masthead footer comment comments disqus respond replies share sharing social widget login signup search".split())
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
SPACE = re.compile(r"\s+")
WORD = re.compile(r"[a-z0-9]+")
WINDOW = 3
#: Without an article: a stretch of so many links may be a list of links.
LINKS = 3


def lines(page: str) -> tuple[list[str], list[bool], bool, dict[int, list[str]]]:
    """Text by block, whether it lies in an article, whether there is one, and by block the texts of its links. Lines of other parts are empty."""
    out: list[str] = [""]
    inside: list[bool] = [False]
    links: dict[int, list[str]] = {}
    linked = False
    skip, depth, article, had, last = "", 0, 0, False, 0
    for m in TOKEN.finditer(page):
        if not skip:
            out[-1] += page[last : m.start()]
            if linked and not page[last : m.start()].isspace():
                links.setdefault(len(out) - 1, [""])[-1] += page[last : m.start()]
        last = m.end()
        name = (m[3] or "").lower()
        if m[1]:
            name = m[1].lower()
            if name in INLINE:
                continue
            if not skip:
                out.append("")
                inside.append(article > 0)
            continue
        if not name:
            continue
        close = m[2] == "/"
        if skip:
            if name == skip and name not in EMPTY:
                depth += -1 if close else 1
                if not depth:
                    skip = ""
                    out += [""] * WINDOW + [""]
                    inside += [article > 0] * (WINDOW + 1)
            elif name in ("article", "main") and not close:  # an end is missing before it
                skip = ""
            if skip or name not in ("article", "main"):
                continue
        if name in INLINE:
            if name == "a":
                linked = not close and "href" in m[4].lower()
                if linked:
                    links.setdefault(len(out) - 1, []).append("")
            if name == "br":
                out[-1] += " "
            if close or name in EMPTY or not m[4] or not _boilerplate(m[4]):
                continue
        if name in ("article", "main"):
            had |= not close
            article = max(0, article + (-1 if close else 1))
        elif not close and name not in EMPTY and name not in ("html", "body") and (name in ASIDE or name == "header" and not article or m[4] and _boilerplate(m[4])):
            skip, depth, linked = name, 1, False
            continue
        linked = False  # an end may be missing
        out.append("")
        inside.append(article > 0)
    if not skip:
        out[-1] += page[last:]
    return [SPACE.sub(" ", entities.unescape(x)).strip() if x and not x.isspace() else "" for x in out], inside, had, links


def _boilerplate(attributes: str) -> bool:
    return any(NAMES.intersection(WORD.findall((a or b or c).lower())) for a, b, c in NAMED.findall(attributes))


def main_text(page: str | None) -> str:
    if not page:
        return ""
    text, inside, had, links = lines(page)
    if had and any(t for t, a in zip(text, inside) if a):
        text = [t if a else "" for t, a in zip(text, inside)]
        links = {}
    sizes = [len(t) for t in text]
    sums = [sum(sizes[i : i + WINDOW]) for i in range(len(sizes))]
    stretches, surge = [], None
    for i, total in enumerate([*sums, 0]):
        if total and surge is None:
            surge = i
        elif not total and surge is not None:
            stretches.append((surge, i))
            surge = None
    return "\n\n".join(t for a, b in stretches if not _listed(sizes, links, a, b) for t in text[a:b] if t)


def _listed(sizes: list[int], links: dict[int, list[str]], a: int, b: int) -> bool:
    """Whether lines a to b are a list of links."""
    found = [len(SPACE.sub(" ", entities.unescape(x)).strip()) for i in range(a, b) if sizes[i] for x in links.get(i, ())]
    return sum(n > 0 for n in found) >= LINKS and 2 * sum(found) > sum(sizes[a:b])


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars."""

    def texts(batches):
        for batch in batches:
            found = [main_text(p) for p in batch["html"]]
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": found})

    rows = pages.select(F.col(page_id).cast("string").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    return rows.mapInPandas(texts, "page_id string, url string, text string").select(F.col("page_id").cast(pages.schema[page_id].dataType).alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))
