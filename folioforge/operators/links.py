"""Notes that a page's links point to, and recognised words put back into the lines that they were left out of.

Rectangles are met on a grid: a glyph lies in one cell, a rectangle is spread over the cells that it covers, so that the join
is an equality and a pair is met once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.operators.folds import Row, folded
from folioforge.operators.layout import PAGE

#: Room around a link, share of the body's size up to which a glyph may be a mark, characters from which on a
#: page is body, and what begins a numbered unit.
PAD, SMALL, BODY_CHARS = 1.5, 0.92, 1200
UNIT = r"^\d{1,4}\s+[A-ZÀÂÄÉÈÊËÎÏÔÖÙÛÜÇ]"
STARTS = r"^(\d{1,3})\.\s+"
#: Room above and below a line, and the distance within which left-over words share a row.
ROOM, ROW = 2.0, 4.0
CELL = 16.0


def body_pages(lines: DataFrame, page: Sequence[str] = PAGE, least: int = BODY_CHARS, unit: str = UNIT, note_max: float | None = None, note_min: float | None = None) -> DataFrame:
    """(page, seed, body) from lines (page, text, size): seed pages are searched for links, body pages are no notes.

    A page has BODY_CHARS characters or more, or two numbered units. Where a bound for the most frequent size of notes is
    given, the size decides: at most note_max, or at least note_min, and the page is notes whatever its length.
    """
    modal = F.mode(F.when(F.col("size") > 0, F.round("size", 1)), deterministic=True)
    of = lines.groupBy(*page).agg(F.sum(F.char_length("text")).alias("_n"), modal.alias("_size"), F.sum(F.when(F.regexp_like(F.trim("text"), F.lit(unit)), 1).otherwise(0)).alias("_units"))
    small = F.lit(False)
    if note_max is not None:
        small = small | F.coalesce(F.col("_size") <= note_max, F.lit(False))
    if note_min is not None:
        small = small | F.coalesce(F.col("_size") >= note_min, F.lit(False))
    long = F.col("_n") >= least
    return of.select(*page, (long & ~small).alias("seed"), ((long | (F.col("_units") >= 2)) & ~small).alias("body"))


def _cells(low: Column, high: Column) -> Column:
    return F.explode(F.sequence(F.floor(low / CELL), F.floor(high / CELL)))


def link_marks(links: DataFrame, glyphs: DataFrame, page: Sequence[str] = PAGE, size_max: float | None = None, pad: float = PAD) -> DataFrame:
    """(page, link, target, mark, number): the small glyphs inside each link, and the first number that they show.

    links: (page, link, x0, y0, x1, y1, target, height), with y from the page's foot; glyphs: (page, text, x0, x1, top,
    bottom, size), with top from its head. Small is size_max at most, else SMALL of the page's most frequent size. A link
    without glyphs has an empty mark and no number.
    """
    known = glyphs.where(F.col("size").isNotNull())
    if size_max is None:
        caps = known.where("size > 0").groupBy(*page).agg((F.mode(F.round("size", 1), deterministic=True) * SMALL).alias("_cap"))
        known = known.join(caps, list(page))
    small = known.where(F.col("size") <= (F.lit(size_max) if size_max is not None else F.col("_cap")))
    at = small.select(*page, F.col("text").alias("_t"), F.col("x0").alias("_x0"), F.col("x1").alias("_x1"), F.col("top").alias("_top"), F.col("bottom").alias("_bottom"), F.floor(F.col("x0") / CELL).alias("_cx"), F.floor(F.col("top") / CELL).alias("_cy"))
    box = links.withColumns({"_l": F.col("x0") - pad, "_r": F.col("x1") + pad, "_a": F.col("height") - F.col("y1") - pad, "_z": F.col("height") - F.col("y0") + pad})
    spread = box.withColumn("_cx", _cells(F.col("_l"), F.greatest("_l", "_r"))).withColumn("_cy", _cells(F.col("_a"), F.greatest("_a", "_z")))
    inside = spread.join(at, [*page, "_cx", "_cy"]).where("_x0 >= _l and _x1 <= _r and _top >= _a and _bottom <= _z")
    text = F.trim(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_x0", "_t"))), lambda g: g["_t"]), ""))
    marks = inside.groupBy(*page, "link").agg(text.alias("mark"))
    out = links.join(marks, [*page, "link"], "left").withColumn("mark", F.coalesce("mark", F.lit("")))
    return out.select(*page, "link", "target", "mark", F.regexp_extract("mark", r"\d{1,4}", 0).try_cast("int").alias("number"))


def note_texts(lines: DataFrame, book: Sequence[str] = ("book_id",), page: str = "page_seq") -> DataFrame:
    """(book, page, number, text) of pages of notes: lines (book, page, line_no, text).

    A page on which two lines or more begin with `n. ` is cut there, the last of equal numbers counts, and what stands before
    the first goes to the last note of the page before, if that was cut as well. The row without a number is the whole page.
    """
    where = [*book, page]
    order = Window.partitionBy(*where).orderBy("line_no")
    begins = F.regexp_like("text", F.lit(STARTS))
    cut = lines.withColumn("_k", F.sum(F.when(begins, 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = lambda: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: F.trim(x["text"])), " ")
    whole = lines.groupBy(*where).agg(F.trim(joined()).alias("text"), F.sum(F.when(begins, 1).otherwise(0)).alias("_n"))
    parts = cut.groupBy(*where, "_k").agg(F.trim(joined()).alias("_t")).join(whole.select(*where, "_n"), where).where("_n >= 2")
    notes = parts.where("_k > 0").select(*where, "_k", "_n", F.regexp_extract("_t", STARTS, 1).cast("int").alias("number"), F.regexp_replace("_t", STARTS, "").alias("text"))
    # The page before in the run of pages, cut or not, tells whether a head has a note to go to.
    pages = whole.withColumn("_before", F.lag(F.when(F.col("_n") >= 2, F.col(page))).over(Window.partitionBy(*book).orderBy(page))).where("_n >= 2 and _before is not null")
    heads = parts.where("_k = 0").select(*where, F.col("_t").alias("_head")).join(pages.select(*where, "_before"), where).select(*book, F.col("_before").alias(page), "_head")
    ended = notes.join(heads, where, "left").withColumn("text", F.when((F.col("_k") == F.col("_n")) & (F.coalesce("_head", F.lit("")) != ""), F.concat("text", F.lit(" "), "_head")).otherwise(F.col("text")))
    last = ended.groupBy(*where, "number").agg(F.max_by("text", "_k").alias("text"))
    return last.unionByName(whole.select(*where, F.lit(None).cast("int").alias("number"), "text"))


def notes_from_links(marks: DataFrame, lines: DataFrame, pages: DataFrame, book: Sequence[str] = ("book_id",), page: str = "page_seq") -> DataFrame:
    """(book, page, number, text): the notes that the marks of seed pages point to, once for each number of a page.

    marks: `link_marks`; lines: (book, page, line_no, text); pages: `body_pages`. A target that is body is a cross-reference
    and no note. A mark takes the target page's note of its number, else the page's whole text; one without a text goes.
    """
    seeds = pages.where("seed").select(*book, page)
    body = pages.where("body").select(*book, F.col(page).alias("target"))
    some = marks.where(F.col("number").isNotNull()).join(seeds, [*book, page], "left_semi").join(body, [*book, "target"], "left_anti")
    targets = some.select(*book, F.col("target").alias(page)).distinct()
    texts = note_texts(lines.join(targets, [*book, page], "left_semi"), book, page)
    first = some.groupBy(*book, page, "number").agg(F.min_by("target", "link").alias("target"))
    own = texts.where(F.col("number").isNotNull()).select(*book, F.col(page).alias("target"), "number", F.col("text").alias("_own"))
    whole = texts.where(F.col("number").isNull()).select(*book, F.col(page).alias("target"), F.col("text").alias("_whole"))
    found = first.join(own, [*book, "target", "number"], "left").join(whole, [*book, "target"], "left")
    text = F.coalesce(F.nullif(F.col("_own"), F.lit("")), F.col("_whole"), F.lit(""))
    return found.select(*book, page, "number", text.alias("text")).where("text <> ''")


def _rows(patches: Iterable[Row]) -> Iterator[Row]:
    """`new_row`: words whose tops are within ROW of a row's first one share it."""
    row, first = -1, None
    for p in patches:
        if first is None or abs(first - p["top"]) > ROW:
            row, first = row + 1, p["top"]
        yield dict(p, new_row=row)


def placed_patches(patches: DataFrame, lines: DataFrame, page: Sequence[str] = PAGE) -> DataFrame:
    """Recognised words (page, patch, text, x0, x1, top, bottom) with the line that they belong to, or a row of their own.

    `line_no`: of the lines (page, line_no, top, bottom) around the word's middle the one that it overlaps most, ties to the
    first. `new_row`: the others are lines that the text layer lacks; a page's are numbered from the top.
    """
    middle = (F.col("top") + F.col("bottom")) / 2
    spread = lines.select(*page, "line_no", (F.col("top") - ROOM).alias("_a"), (F.col("bottom") + ROOM).alias("_z")).withColumn("_cell", _cells(F.col("_a"), F.greatest("_a", "_z")))
    near = patches.withColumn("_cell", F.floor(middle / CELL)).join(spread, [*page, "_cell"]).where(middle.between(F.col("_a"), F.col("_z")))
    overlap = F.least("_z", "bottom") - F.greatest("_a", "top")
    best = near.where(overlap > 0).groupBy(*page, "patch").agg(F.max(F.struct(overlap.alias("o"), (-F.col("line_no")).alias("n"))).alias("_b")).select(*page, "patch", (-F.col("_b.n")).alias("line_no"))
    known = patches.join(best, [*page, "patch"], "left")
    alone = folded(known.where("line_no is null"), page, ["top", "x0"], _rows, "new_row int")
    return known.where("line_no is not null").withColumn("new_row", F.lit(None).cast("int")).unionByName(alone)


def spliced(words: DataFrame, patches: DataFrame, lines: DataFrame, page: Sequence[str] = PAGE) -> DataFrame:
    """(page, line_no, new_row, text, x0, x1): lines with the recognised words in their places, and the new rows."""
    there = words.select(*page, "line_no", F.lit(None).cast("int").alias("new_row"), "text", "x0", "x1")
    both = there.unionByName(placed_patches(patches, lines, page).select(*page, "line_no", "new_row", "text", "x0", "x1"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "x1", "text"))), lambda w: w["text"]), " ")
    return both.groupBy(*page, "line_no", "new_row").agg(text.alias("text"), F.min("x0").alias("x0"), F.max("x1").alias("x1"))
