"""Words from glyphs: lines of a page, phantom spaces go, then gaps in a line part its words.

A page's glyphs are one row, a column of theirs an array, so that no glyph is moved or sorted as a row of its own. Tasks get
batches of pages and work on all their glyphs at once; only pages whose lines can't be told by their heights alone are gone
through glyph by glyph.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from folioforge.operators.layout import CENTRE, INSIDE, LOOK_BACK, PAGE, RATIO, rows_of

#: Shares of a space's width that lie over the glyph before it, or (for a second space) over the one behind it,
#: and by how much a space may stick out of a glyph that holds it.
OVER_LEFT, OVER_RIGHT, SLACK = 0.5, 0.25, 0.05
#: The least gap between words, its share of the row's median width, and the width of a row without any.
LEAST_GAP, GAP_SHARE, USUAL_WIDTH = 0.8, 0.35, 4.0
BLANK = re.compile("[ \t\n\x0b\f\r\x1c-\x1f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
BOX = ("x0", "x1", "top", "bottom", "size")
WORDS = "row int, words array<struct<word: int, text: string, x0: double, x1: double, top: double, bottom: double, size: double>>"
#: Fixed value: glyphs that a task works on at once, if a page has no more of them.
AT_ONCE = 200_000


def pages_of_glyphs(chars: DataFrame, page: Sequence[str] = PAGE, stream: str = "seq") -> DataFrame:
    """A row for each page of `chars` (page, seq, text, x0, x1, top, bottom, size), with the columns of its glyphs as arrays in
    the order of the stream."""
    fields = [F.col(stream).alias("_at"), "text", *[F.col(c).cast("double").alias(c) for c in BOX]]
    some = chars.groupBy(*page).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("_g"))
    return some.select(*page, *[F.col(f"_g.{c}").alias(c) for c in ("text", *BOX)])


def _order(*keys: np.ndarray) -> np.ndarray | slice:
    """The order by keys, the first one first, equals as they stand; what is in order already isn't sorted."""
    behind, same = np.zeros(max(len(keys[0]) - 1, 0), bool), np.ones(max(len(keys[0]) - 1, 0), bool)
    for k in keys:
        behind |= same & (k[1:] < k[:-1])
        same &= k[1:] == k[:-1]
    return np.lexsort(keys[::-1]) if behind.any() else slice(None)


def _starts(group: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, int)


def _least(values: np.ndarray, page: np.ndarray) -> np.ndarray:
    """The least value of each page up to the last one, whose values stand together; 1 without any."""
    at, out = _starts(page), np.ones(page[-1] + 1, int)
    out[page[at]] = np.minimum.reduceat(values, at)
    return out


def _medians(values: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    """The median of the values of each of the groups 0 to n - 1, which stand together; NaN without any."""
    out = np.full(n, np.nan)
    if not len(values):
        return out
    at = _starts(group)
    least, most = np.minimum.reduceat(values, at), np.maximum.reduceat(values, at)
    out[group[at]] = least
    if (least != most).any():
        vary = np.zeros(n, bool)
        vary[group[at[least != most]]] = True
        values, group = values[vary[group]], group[vary[group]]
        order = np.lexsort((values, group))
        values, group = values[order], group[order]
        at = _starts(group)
        size = np.diff(np.r_[at, len(group)])
        out[group[at]] = (values[at + (size - 1) // 2] + values[at + size // 2]) / 2
    return out


def _bands(page: np.ndarray, top: np.ndarray, bottom: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line of each glyph, pages that need a closer look). Glyphs of one top are a line, numbered over all pages.

    `rows_of` gives the same lines where a page's glyphs of one top have one bottom and no line is near enough to one of the
    LOOK_BACK above it to take its glyphs; the others need the closer look.
    """
    order = _order(page, top)
    p, t, b = page[order], top[order], bottom[order]
    opens = np.r_[True, (p[1:] != p[:-1]) | (t[1:] != t[:-1])]
    band = np.cumsum(opens) - 1
    line = np.empty(len(page), int)
    line[order] = band
    at = np.flatnonzero(opens)
    of, head, foot = p[at], t[at], b[at]
    high = foot - head
    near = ~(high > 0)
    for d in range(1, LOOK_BACK + 1):
        mine, other = slice(d, None), slice(None, -d)
        large, small = np.maximum(high[mine], high[other]), np.minimum(high[mine], high[other])
        centre = np.abs((head[mine] + foot[mine]) - (head[other] + foot[other])) / 2 <= CENTRE * large
        lower = high[mine] < high[other]
        inner, outer = (np.where(lower, head[mine], head[other]), np.where(lower, foot[mine], foot[other])), (np.where(lower, head[other], head[mine]), np.where(lower, foot[other], foot[mine]))
        inside = (small < large) & (outer[0] - INSIDE * large <= inner[0]) & (inner[1] <= outer[1] + INSIDE * large)
        near[mine] |= (of[mine] == of[other]) & ((centre & (large <= RATIO * np.maximum(1e-9, small))) | inside)
    return line, np.unique(np.r_[of[near], p[b != foot[band]]])


def _lines(page: np.ndarray, box: dict[str, np.ndarray]) -> np.ndarray:
    """The line of each glyph, numbered over all pages from the top of the first one."""
    line, close = _bands(page, box["top"], box["bottom"])
    if not len(close):
        return line
    row = line - _least(line, page)[page]
    for p in close:
        low, high = np.searchsorted(page, [p, p + 1])
        some = [dict(zip(BOX, values), at=at) for at, values in enumerate(zip(*[box[c][low:high].tolist() for c in BOX]), low)]
        for n, found in enumerate(rows_of(some)):
            row[[g["at"] for g in found.words]] = n
    rows = 1 - _least(-row, page)
    return (np.cumsum(rows) - rows)[page] + row


def _phantom(line: np.ndarray, blank: np.ndarray, x0: np.ndarray, x1: np.ndarray) -> np.ndarray:
    """Spaces, in stream order, that lie by more than half over the glyph before them, or, as the second of two spaces, by more
    than a quarter over the one behind them."""
    at = np.flatnonzero(blank)
    before, behind = np.maximum(at - 1, 0), np.minimum(at + 1, len(line) - 1)
    letter = lambda other: (other != at) & (line[other] == line[at]) & ~blank[other]
    over = lambda other: np.minimum(x1[at], x1[other]) - np.maximum(x0[at], x0[other])
    width = np.maximum(x1[at] - x0[at], 0.01)
    return at[np.where(letter(before), over(before) > OVER_LEFT * width, letter(behind) & (over(behind) > OVER_RIGHT * width))]


def _held(line: np.ndarray, blank: np.ndarray, x0: np.ndarray, x1: np.ndarray) -> np.ndarray:
    """Spaces, in order of x0, that the next letter on either side holds."""
    at, place = np.flatnonzero(blank), np.arange(len(line))
    left = np.maximum.accumulate(np.where(blank, -1, place))[at]
    right = np.minimum.accumulate(np.where(blank, len(line), place)[::-1])[::-1][at]

    def holds(other: np.ndarray) -> np.ndarray:
        there = (other >= 0) & (other < len(line))
        o = np.where(there, other, 0)
        return there & (line[o] == line[at]) & (x0[at] >= x0[o] - SLACK) & (x1[at] <= x1[o] + SLACK)

    return at[holds(left) | holds(right)]


def _parted(line: np.ndarray, g: dict[str, np.ndarray], texts: pa.Array) -> tuple[np.ndarray, pa.StructArray]:
    """(line of each word, words) of glyphs in order of x0: a word ends where the gap to the next glyph is larger than the bound.

    The bound is GAP_SHARE of the line's median width, LEAST_GAP at least. Blanks inside a word are one; words of blanks only
    are left out. size is the median of the sizes above zero, null without one.
    """
    lines = int(line[-1]) + 1
    wide = g["x1"] > g["x0"]
    width = _medians((g["x1"] - g["x0"])[wide], line[wide], lines)
    bound = np.maximum(LEAST_GAP, np.where(np.isnan(width), USUAL_WIDTH, width) * GAP_SHARE)
    opens = np.r_[True, (line[1:] != line[:-1]) | ~(g["x0"][1:] - g["x1"][:-1] <= bound[line[1:]])]
    at, word = np.flatnonzero(opens), np.cumsum(opens) - 1
    of = line[at]
    number = np.arange(len(at)) - np.flatnonzero(np.r_[True, of[1:] != of[:-1]])[np.cumsum(np.r_[False, of[1:] != of[:-1]])]
    ends = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4)
    text = pa.StringArray.from_buffers(len(at), pa.py_buffer(np.r_[ends[at], ends[-1:]]), texts.buffers()[2])
    text = pc.utf8_trim(pc.replace_substring_regex(text, "[ \t\n\x0b\f\r]{2,}", " "), " ")
    sized = g["size"] > 0
    size = _medians(g["size"][sized], word[sized], len(at))
    values, which = np.unique(size, return_inverse=True)
    size = np.array([v if np.isnan(v) else float(Decimal(repr(float(v))).quantize(Decimal("0.01"), ROUND_HALF_UP)) for v in values])[which]
    box = [np.minimum.reduceat(g["x0"], at), np.maximum.reduceat(g["x1"], at), np.minimum.reduceat(g["top"], at), np.maximum.reduceat(g["bottom"], at)]
    words = pa.StructArray.from_arrays([pa.array(number, pa.int32()), text, *map(pa.array, box), pa.array(size, from_pandas=True)], ["word", "text", *BOX])
    some = np.asarray(pc.not_equal(text, ""))
    return of[some], words.filter(pa.array(some))


def _words(pages: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.ListArray]:
    """(page, row, words) of each line of a batch of pages, which have a glyph at least."""
    column = {c: pages[c] for c in ("text", *BOX)}
    counts = np.asarray(pc.fill_null(pc.list_value_length(column["text"]), 0))
    page = np.repeat(np.arange(len(counts)), counts)
    flat = {c: v.flatten() for c, v in column.items()}
    texts = pc.fill_null(flat.pop("text"), "").cast(pa.string())
    g = {c: v.to_numpy(zero_copy_only=False) for c, v in flat.items()}
    line = _lines(page, g)
    known = texts.dictionary_encode()
    blank = np.array([bool(BLANK.fullmatch(t)) for t in known.dictionary.to_pylist()], bool)[known.indices.to_numpy()]
    first = _least(line, page)
    of_line = np.zeros(int(line.max()) + 1, int)
    of_line[line] = page
    place, x0, x1 = np.arange(len(line)), g["x0"], g["x1"]

    def put(order: np.ndarray | slice) -> None:
        nonlocal line, blank, place, x0, x1
        if isinstance(order, np.ndarray):
            line, blank, place, x0, x1 = line[order], blank[order], place[order], x0[order], x1[order]

    for keys, gone in ((lambda: (line,), _phantom), (lambda: (line, x0), _held)):
        put(_order(*keys()))
        if blank.any() and len(off := gone(line, blank, x0, x1)):
            stays = np.ones(len(line), bool)
            stays[off] = False
            put(stays)
    if len(place) != len(page) or (place[1:] < place[:-1]).any():
        texts, g = pc.take(texts, pa.array(place)), {c: g[c][place] for c in ("top", "bottom", "size")}
    of, words = _parted(line, {**g, "x0": x0, "x1": x1}, texts)
    at = _starts(of)
    return of_line[of[at]], of[at] - first[of_line[of[at]]], pa.ListArray.from_arrays(pa.array(np.r_[at, len(of)], pa.int32()), words)


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch's pages, about AT_ONCE glyphs at a time; those without any are left out."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(batch["text"]), 0)))
    low = 0
    while low < len(ends):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + AT_ONCE, "right")))
        if ends[high - 1] > before:
            yield batch.slice(low, high - low)
        low = high


def lines_of_pages(pages: DataFrame, page: Sequence[str] = PAGE) -> DataFrame:
    """(page, row, words) of pages as `pages_of_glyphs` gives them; words, from left to right, have their number in the line,
    text and box. Lines are numbered from the top of their page; one without a word has no row.

    A space that is printed over a letter goes: first, in the order of the stream, if it lies by more than half over the glyph
    before it, or, as the second of two spaces, by more than a quarter over the one behind it; then, in order of x0, if the next
    letter on either side holds it. Coordinates aren't null.
    """
    schema = pages.select(*page).schema
    for f in _parse_datatype_string(WORDS).fields:
        schema = schema.add(f)
    into = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _portions(batch):
                of, row, words = _words(some)
                keys = [some[c].take(pa.array(of)) for c in page]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(row, pa.int32()), words.cast(into.field("words").type)], schema=into)

    return pages.mapInArrow(run, schema)


def words_of_glyphs(chars: DataFrame, page: Sequence[str] = PAGE, stream: str = "seq") -> DataFrame:
    """(page, row, word, text, x0, x1, top, bottom, size): words from a page's glyphs, a row each."""
    return lines_of_pages(pages_of_glyphs(chars, page, stream), page).select(*page, "row", F.inline("words"))
