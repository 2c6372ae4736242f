"""A book's type area measured: what a profile is drafted from."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.operators.layout import PAGE

#: Fewest lines of a page, characters of a body line, of a note line, most of a foot line; differences of size.
FEWEST, LONG, NOTE, SHORT, SAME, SMALLER = 5, 40, 25, 40, 0.4, 0.6
#: Least gap above the page's usual one, the share of the body in which notes are sought, room at a body's edge.
GAP, TAIL, ROOM = 4.0, 0.25, 2.0
#: What a draft names where a book shows nothing.
HEAD_BAND, NOTE_BAND, FOLIO_BAND = 0.06, 0.70, 0.10


def sizes(lines: DataFrame) -> DataFrame:
    """(book_id, size, chars): how much text is set in each size, on pages of at least FEWEST lines."""
    full = F.count("*").over(Window.partitionBy(*PAGE)) >= FEWEST
    some = lines.where(F.trim("text") != "").withColumn("_full", full).where("_full and size > 0")
    return some.groupBy("book_id", F.round("size", 2).alias("size")).agg(F.sum(F.char_length("text")).alias("chars"))


def measured(lines: DataFrame) -> DataFrame:
    """`lines` (book_id, page_seq, line_no, text, x0, x1, top, bottom, size, height) of the pages that can be measured, with
    `part` (head, body or foot), the page's `left` and `right` edge and the book's `body_size`.

    The body size is that of most text, ties to the least. Lines at the top of a page that are parted from the next one by
    more than the page's median gap and GAP are its head, those at its end likewise its foot; the gap counts as GAP at least
    and a page's last line is no head, its first no foot. Pages of fewer than FEWEST lines, or without a long line in the
    body's size, are left out. All windows are over the page, so lines are shuffled once.
    """
    most = sizes(lines).groupBy("book_id").agg(F.max_by("size", F.struct("chars", -F.col("size"))).alias("body_size"))
    page, w = Window.partitionBy(*PAGE), Window.partitionBy(*PAGE).orderBy("top", "line_no")
    back = Window.partitionBy(*PAGE).orderBy(F.desc("top"), F.desc("line_no"))
    out = lines.where(F.trim("text") != "").join(most, "book_id").withColumns({"_n": F.count("*").over(page), "_after": F.lead("top").over(w) - F.col("bottom"), "_before": F.col("top") - F.lag("bottom").over(w)})
    body = (F.abs(F.col("size") - F.col("body_size")) < SAME) & (F.char_length("text") > LONG)
    out = out.where(F.col("_n") >= FEWEST).withColumns({"left": F.median(F.when(body, F.col("x0"))).over(page), "right": F.median(F.when(body, F.col("x1"))).over(page), "_cut": F.greatest(F.lit(0.0), F.median("_after").over(page)) + GAP})
    wide = lambda c: F.coalesce(F.col(c) > F.col("_cut"), F.lit(False))
    out = out.withColumns({"_head": F.min(wide("_after")).over(w), "_foot": F.min(wide("_before")).over(back)}).where("left is not null")
    part = F.when(F.col("_head"), "head").when(F.col("_foot"), "foot").otherwise("body")
    return out.withColumn("part", part).drop("_n", "_after", "_before", "_cut", "_head", "_foot")


def probed(lines: DataFrame, words: DataFrame) -> DataFrame:
    """One row for each book that can be measured: bands and counts over all its pages, and a draft of the profile's bounds.

    words: (book_id, page_seq, text, x0, x1). Shares are of the page's height. A page's notes are the lines of more than NOTE
    characters, smaller than the body by SMALLER, in the last quarter of its body. margin_left and margin_right count numbers
    outside the edges, folios the foot lines that are a number.
    """
    page = Window.partitionBy(*PAGE)
    inner = F.col("part") != "foot"
    found = measured(lines).withColumns({"_end": F.max(F.when(inner, F.col("bottom"))).over(page), "_top": F.min(F.when(F.col("part") != "head", F.col("top"))).over(page)})
    span = F.when(F.col("_end") > F.col("_top"), F.col("_end") - F.col("_top")).otherwise(F.col("height"))
    note = (F.col("top") > F.col("_end") - TAIL * span) & (F.col("size") < F.col("body_size") - SMALLER) & (F.char_length("text") > NOTE)
    head, foot = F.col("part") == "head", F.col("part") == "foot"
    folio = foot & F.regexp_like(F.trim("text"), F.lit(r"^\d{1,4}$"))
    of = lambda c, what: F.when(c, what)
    pages = found.groupBy(*PAGE).agg(
        F.first("body_size").alias("body_size"),
        F.first("left").alias("left"),
        F.first("right").alias("right"),
        F.max(of(head, F.col("top") / F.col("height"))).alias("head"),
        F.min(F.col("_top") / F.col("height")).alias("body"),
        F.min(of(foot, F.col("bottom") / F.col("height"))).alias("foot"),
        F.min(of(foot, (F.col("bottom") - ROOM) / F.col("height"))).alias("folio_edge"),
        F.min(of(note, F.col("top") / F.col("height"))).alias("note"),
        F.median(of(note, F.col("size"))).alias("note_size"),
        F.sum(F.when(folio, 1).otherwise(0)).alias("folios"),
    )
    number = words.where(F.regexp_like("text", F.lit(r"^\d{1,4}$"))).join(pages.select(*PAGE, "left", "right"), list(PAGE))
    margin = number.groupBy("book_id").agg(F.sum(F.when(F.col("x1") < F.col("left") - ROOM, 1).otherwise(0)).alias("margin_left"), F.sum(F.when((F.col("x1") >= F.col("left") - ROOM) & (F.col("x0") > F.col("right") + ROOM), 1).otherwise(0)).alias("margin_right"))
    out = pages.groupBy("book_id").agg(F.count("*").alias("pages"), F.first("body_size").alias("body_size"), F.max("head").alias("head"), F.min("body").alias("body"), F.min("foot").alias("foot"), F.min("folio_edge").alias("_edge"), F.min("note").alias("note"), F.median("note_size").alias("note_size"), F.sum("folios").alias("folios"))
    out = out.join(margin, "book_id", "left").withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("margin_left", "margin_right")})
    draft = {
        "header_band": F.round(F.coalesce((F.col("head") + F.col("body")) / 2, F.lit(HEAD_BAND)), 3),
        "bottom_band": F.round(F.coalesce(F.col("note") - 0.03, F.lit(NOTE_BAND)), 2),
        "note_size_max": F.round(F.col("note_size") + 0.2, 1),
        "folio_band": F.round(F.coalesce(1 - F.col("_edge"), F.lit(FOLIO_BAND)), 2),
    }
    return out.withColumns(draft).drop("_edge")
