"""Main-text extraction by line-block distribution.

Markup is stripped into lines, one for each block. A line's length is its text outside of links; lines of menus, headers,
footers, sidebars, notices, adverts, forms and reader comments have length 0. The lengths are summed over sliding windows
of lines. A surge point is where a window's sum rises over the limit, a dive point where it has fallen to nothing; the
text between them is kept whole, and so are the lines around it up to the next gap, which stands where such a container
or an article begins or ends. The limit is LIMIT characters, or half of the page's own fullest window if that is less.

Where a page marks an article, stretches outside of it go, and any text at all, that of links too, is a surge inside. A
`main` without an article counts as one if it holds half of the page's text. A class, id or role marks a container if one of
its words is a mark and the others only say what shape it has: `cookie-notice` and `ad-box`, but not `social-history`. A
container that only these mark counts as text if it holds more than half of the page's: then it is the page's own wrapper.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm.common import table

#: Lines of a window; characters that a window must exceed at most where no article is marked.
WINDOW, LIMIT = 3, 86

#: Names of HTML elements, and words in class, id and role attributes.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot thead title tr ul".split())
SPACES = frozenset("br td th wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg math".split())
OUT = frozenset("head nav aside footer form dialog menu button select datalist fieldset object audio video canvas".split())
ARTICLE = frozenset("article main".split())
MARKS = frozenset(
    "ad ads adsense advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies disqus footer login menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted related reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: Words that say what shape a container has and not what it holds.
SHAPES = frozenset("area bar block bottom box button col column container content desktop fixed footer form group header inner item items left link links list main mobile module nav outer panel right row section slot sticky top unit wrap wrapper".split())

_TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)(?:>|\Z)""", re.S)
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORDS = re.compile(r"[a-z0-9]+")


def _marks(name: str) -> bool:
    words = _WORDS.findall(name.lower())
    return not MARKS.isdisjoint(words) and all(w in MARKS or w in SHAPES or w.isdigit() or len(w) == 1 for w in words)


def _marked(attributes: str) -> bool:
    return bool(attributes) and any(_marks(name) for value in _NAMED.findall(attributes) for name in value.strip("\"'").split())


class Line:
    """A line of text: its length outside of links, the container that leaves it out (0: none), and whether it is in an
    article (2), only in a main part (1) or in neither (0)."""

    __slots__ = ("text", "free", "out", "article")

    def __init__(self, text: str, free: int, out: int, article: int):
        self.text, self.free, self.out, self.article = text, free, out, article


def lines_of(page: str) -> tuple[list[Line], list[bool]]:
    """The page's lines in order, gaps as WINDOW blank lines, and of each container that leaves lines out whether its tag does."""
    lines: list[Line] = []
    parts: list[str] = []
    by_tag = [False]
    articles = mains = links = free = 0
    out: tuple[str, int] | None = None  # the element that is left out, and how many of its name are open

    def close() -> None:
        nonlocal free
        if text := " ".join("".join(parts).split()):
            lines.append(Line(text, min(free, len(text)), len(by_tag) - 1 if out else 0, 2 if articles else 1 if mains else 0))
        parts.clear()
        free = 0

    def gap() -> None:
        close()
        lines.extend(Line("", 0, 0, 0) for _ in range(WINDOW))

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        end = m.start() if m else n
        if end > at:
            text = entities.unescape(page[at:end])
            parts.append(text)
            if not links:
                free += len(text)
        if not m:
            break
        at = m.end()
        closing, name, attributes = m[1], (m[2] or "").lower(), m[3] or ""
        if not name:
            continue
        if not closing and name in RAW and not attributes.endswith("/"):
            found = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = found.end() if found else n
            continue
        if name == "a":
            links = 0 if closing else 1
        elif name in BLOCKS:
            links = 0
        if out is not None:
            done = False
            if name == out[0]:
                left = out[1] + (-1 if closing else name not in VOID)
                done = left <= 0
                if not done:
                    out = (name, left)
            elif not closing and (name == "body" or out[0] != "head" and name in ARTICLE and not _marked(attributes) and out[0] not in ("section", "div", "ul", "ol")):
                done = True  # an element that was never closed
            if done:
                gap()
                out = None
            if not done or closing:
                if name in SPACES:
                    parts.append(" ")
                elif name in BLOCKS:
                    close()
                continue
        if name in SPACES:
            parts.append(" ")
        elif name in ARTICLE and not (not closing and _marked(attributes)):
            gap()
            step = -1 if closing else 1
            if name == "main":
                mains = max(0, mains + step)
            else:
                articles = max(0, articles + step)
        elif not closing and name not in VOID and (name in OUT or name == "header" and not (articles or mains) or name not in ("html", "body") and _marked(attributes)):
            gap()
            out = (name, 1)
            by_tag.append(name in OUT or name == "header")
        elif name in BLOCKS:
            close()
    close()
    return lines, by_tag


def counted(lines: list[Line], by_tag: list[bool]) -> list[bool]:
    """Whether a line counts: no container leaves it out, or a marked one that holds more than half of the page's text."""
    held = [0] * len(by_tag)
    for line in lines:
        held[line.out] += line.free
    text = sum(h for h, tag in zip(held, by_tag) if not tag)
    counts = [i == 0 or not tag and 2 * held[i] > text for i, tag in enumerate(by_tag)]
    return [counts[line.out] for line in lines]


def between(lengths: list[int], limit: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """The stretches of lines from a surge point to its dive point, end exclusive."""
    sums = [0] * (len(lengths) + 1)
    for i, x in enumerate(lengths):
        sums[i + 1] = sums[i] + x
    over = [sums[min(i + window, len(lengths))] - sums[i] for i in range(len(lengths))]
    out, i = [], 0
    while i < len(lengths):
        if over[i] > limit:
            j = i
            while j < len(lengths) and over[j] > 0:
                j += 1
            out.append((i, j))
            i = j
        else:
            i += 1
    return out


def main_text(page: str) -> str:
    lines, by_tag = lines_of(page)
    counts = counted(lines, by_tag)
    lengths = [line.free if c else 0 for line, c in zip(lines, counts)]
    articles, mains = (sum(x for line, x in zip(lines, lengths) if line.article >= k) for k in (2, 1))
    if articles or mains and 2 * mains >= sum(lengths):
        lengths, limit = [len(line.text) if line.article and c else 0 for line, c in zip(lines, counts)], 0
    else:
        fullest = max((sum(lengths[i : i + WINDOW]) for i in range(len(lengths))), default=0)
        limit = min(LIMIT, fullest // 2)
    kept: list[str] = []
    done = 0
    for a, b in between(lengths, limit):
        while a > done and lines[a - 1].text:
            a -= 1
        while b < len(lines) and lines[b].text:
            b += 1
        a, done = max(a, done), max(b, done)
        kept += [line.text for line in lines[a:b] if line.text]
    return "\n\n".join(kept)


def extracted(html: Column) -> Column:
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            yield pa.array([main_text(page or "") for page in pages.to_pylist()], pa.string())

    extract.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(extract, "string")(html.cast("string"))


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """`pages` with `text`, the main text, in place of the html column.

    A null or empty page, and one without text outside of links and left-out containers, has an empty text. Pages are read whole and judged one by one, repeated
    ones too; an empty table gives no rows. The caller's other columns stay, but for one named `text`.
    """
    return pages.withColumn("text", extracted(F.col(html))).drop(*([html] if html != "text" else []))


def digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op5_html: every page of `pages`."""
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
