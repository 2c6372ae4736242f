"""Margin numbers: which numbers stand beside the text, by the edges of the page's own body."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.operators.layout import PAGE

#: Characters of a line and lines of a page from which on edges are taken; room between body and margin.
LONG, LINES, PAD, WIDE_PAD = 40, 4, 2.0, 8.0
#: What counts as a number, and as a number of section and margin; what parts the latter from the text.
NUMBER, COMPOSITE, NBSP = r"^\d{1,4}$", r"^(\d{1,3})\s?/\s?(\d{1,3})$", "\u00a0"


def line_texts(words: DataFrame, line: Sequence[str] = (*PAGE, "line_no"), keep: Column | None = None) -> DataFrame:
    """(line, text, x0, x1): the words of each line from left to right; with `keep` only those for which it holds."""
    some = words.where(keep) if keep is not None else words
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "word", "text"))), lambda w: w["text"]), " ")
    return some.groupBy(*line).agg(F.trim(text).alias("text"), F.min("x0").alias("x0"), F.max("x1").alias("x1"))


def body_edges(words: DataFrame, page: Sequence[str] = PAGE, number: str = NUMBER, least: int = LINES) -> DataFrame:
    """(page, left, right): median edges of lines of more than LONG characters, numbers left out.

    A margin number would else draw the edge to itself. Pages of fewer than `least` such lines have no row.
    """
    other = ~F.regexp_like(F.trim("text"), F.lit(number))
    size = F.sum(F.char_length("text") + 1) - 1
    lines = words.groupBy(*page, "line_no").agg(size.alias("_n"), F.min(F.when(other, F.col("x0"))).alias("_l"), F.max(F.when(other, F.col("x1"))).alias("_r"))
    long = lines.where((F.col("_n") > LONG) & F.col("_l").isNotNull())
    return long.groupBy(*page).agg(F.median("_l").alias("left"), F.median("_r").alias("right"), F.count("*").alias("_lines")).where(F.col("_lines") >= least).drop("_lines")


def side_of(page: Column, side: str) -> Column:
    """left, right or both; outer and inner change with the page's parity."""
    if side in ("outer", "inner"):
        recto = F.pmod(page, F.lit(2)) == 1
        return F.when(recto == F.lit(side == "outer"), "right").otherwise("left")
    return F.lit(side)


def _ends(page: Sequence[str]) -> tuple[Column, Column]:
    line = Window.partitionBy(*page, "line_no")
    return F.row_number().over(line.orderBy("x0", "word")) == 1, F.row_number().over(line.orderBy(F.desc("x0"), F.desc("word"))) == 1


def margin_numbers(words: DataFrame, page: Sequence[str] = PAGE, side: str = "both", pad: float = PAD, x_range: tuple[float, float] | None = None, corridors: DataFrame | None = None) -> DataFrame:
    """`words` (page, line_no, word, text, x0, x1) with `is_margin`: a number of one to four digits beside the text.

    By the page's own edges only a line's first word left of the body and its last one right of it count, `pad` apart; pages
    without edges have none. x_range takes numbers whose middle lies in it instead, on every page. corridors (book, parity,
    low, high), such as `pages.margin_corridors` finds, do so for each book and parity.
    """
    number = F.regexp_like(F.regexp_replace(F.trim("text"), r"^[.)]+|[.)]+$", ""), F.lit(NUMBER))
    middle = (F.col("x0") + F.col("x1")) / 2
    if x_range is not None:
        return words.withColumn("is_margin", number & middle.between(*x_range))
    if corridors is not None:
        of = corridors.groupBy(page[0], "parity").agg(F.collect_list(F.struct("low", "high")).alias("_corridors"))
        near = words.withColumn("parity", F.pmod(page[-1], F.lit(2))).join(of, [page[0], "parity"], "left")
        inside = F.coalesce(F.exists("_corridors", lambda c: middle.between(c["low"], c["high"])), F.lit(False))
        return near.withColumn("is_margin", number & inside).drop("parity", "_corridors")
    first, last = _ends(page)
    edged = words.withColumns({"_first": first, "_last": last}).join(body_edges(words, page), list(page), "left")
    where = side_of(F.col(page[-1]), side)
    left = where.isin("left", "both") & F.col("_first") & (F.col("x1") <= F.col("left") - pad)
    right = where.isin("right", "both") & F.col("_last") & (F.col("x0") >= F.col("right") + pad)
    return edged.withColumn("is_margin", number & F.coalesce(left | right, F.lit(False))).drop("_first", "_last", "left", "right")


def composite_numbers(words: DataFrame, max_section: int, page: Sequence[str] = PAGE, pad: float = WIDE_PAD) -> DataFrame:
    """(page, line_no, text, moved): lines whose margin number `a/b` stands at their start, parted by a no-break space.

    It is the line's first word left of the body or its last one right of it, with 1 <= a <= max_section; the left one goes
    first. The no-break space tells it from a reference that a line happens to begin with.
    """
    word = F.struct("x0", "word", "text", "x1")
    lines = words.groupBy(*page, "line_no").agg(F.array_sort(F.collect_list(word)).alias("_w"))
    w, t = F.col("_w"), lambda x: F.trim(x["text"])
    other = F.filter(w, lambda x: ~F.regexp_like(t(x), F.lit(COMPOSITE)))
    size = F.aggregate(w, F.lit(-1), lambda n, x: n + F.coalesce(F.char_length(x["text"]) + 1, F.lit(0)))
    sided = lines.withColumns({"_l": F.array_min(other["x0"]), "_r": F.array_max(other["x1"]), "_n": size})
    long = (F.col("_n") > LONG) & F.col("_l").isNotNull()
    of_page = Window.partitionBy(*page)
    edged = sided.withColumns({"left": F.median(F.when(long, F.col("_l"))).over(of_page), "right": F.median(F.when(long, F.col("_r"))).over(of_page)})
    fits = lambda x: F.regexp_like(t(x), F.lit(COMPOSITE)) & F.regexp_extract(t(x), COMPOSITE, 1).try_cast("int").between(1, max_section)
    first, last = F.element_at(w, 1), F.element_at(w, -1)
    left = fits(first) & (first["x1"] <= F.col("left") - pad)
    right = fits(last) & (last["x0"] >= F.col("right") + pad)
    part = lambda x, n: F.regexp_extract(t(x), COMPOSITE, n).try_cast("int").cast("string")
    plain = lambda x: F.concat(part(x, 1), F.lit("/"), part(x, 2))
    moved = F.when(left, plain(first)).when(right, plain(last))
    rest = F.when(left, F.slice(w, F.lit(2), F.size(w) - 1)).when(right, F.slice(w, F.lit(1), F.size(w) - 1)).otherwise(w)
    told = edged.select(*page, "line_no", moved.alias("moved"), F.array_join(rest["text"], " ").alias("_rest"))
    return told.select(*page, "line_no", F.when(F.col("moved").isNotNull(), F.concat("moved", F.lit(NBSP), "_rest")).otherwise(F.col("_rest")).alias("text"), "moved")
