"""Page-model repairs that work on lines of many pages at once: windows over (book, page, line)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.operators.sequence import islands

BOOK, PAGE = ("book_id",), ("book_id", "page_seq")
#: Shares of small and of numbered lines that make a page of endnotes, and its least number of lines.
SMALL_SHARE, NUMBERED_SHARE, LINES = 0.9, 0.3, 4
#: Width of a bin, hits, pages and share of body text that make a margin corridor.
BIN, HITS, PAGES, QUIET = 6.0, 5, 3, 0.05


def without_folios(pages: DataFrame, folio: str = "printed_page") -> DataFrame:
    return pages.withColumn(folio, F.lit(None).cast(pages.schema[folio].dataType))


def without_marked(lines: DataFrame, mark: str, lines_only: bool = False, page: Sequence[str] = PAGE) -> DataFrame:
    """Pages that hold the mark, in either case, lose all lines; with lines_only the marked lines go."""
    hit = F.contains(F.lower("text"), F.lit(mark.lower()))
    if lines_only:
        return lines.where(~hit)
    return lines.withColumn("_hit", F.max(hit).over(Window.partitionBy(*page))).where(~F.col("_hit")).drop("_hit")


def endnote_pages(lines: DataFrame, small: float, book: Sequence[str] = BOOK, page: str = "page_seq") -> DataFrame:
    """(book, page) of endnotes: almost all lines are small and many are numbered; neighbouring pages of small lines join them.

    A run of consecutive small pages counts as a whole if one of its pages is a seed.
    """
    numbered = F.regexp_like("text", F.lit(r"^\s*\d{1,4}[.)\s]"))
    shares = lines.groupBy(*book, page).agg(F.avg(F.when(F.col("size") <= small, 1.0).otherwise(0.0)).alias("_small"), F.avg(F.when(numbered, 1.0).otherwise(0.0)).alias("_numbered"), F.count("*").alias("_n"))
    petit = shares.where(F.col("_small") >= SMALL_SHARE)
    order = Window.partitionBy(*book).orderBy(page)
    opens = F.coalesce(F.col(page) - F.lag(page).over(order) > 1, F.lit(True))
    runs = petit.withColumn("_opens", opens).withColumn("_run", islands(F.col("_opens"), book, [page]))
    seed = (F.col("_numbered") >= NUMBERED_SHARE) & (F.col("_n") >= LINES)
    return runs.withColumn("_seed", F.max(seed).over(Window.partitionBy(*book, "_run"))).where("_seed").select(*book, page)


def wrapped_headings(lines: DataFrame, size_min: float, size_max: float, page: Sequence[str] = PAGE, near: float = 1.6, alike: float = 0.3) -> DataFrame:
    """Consecutive heading lines of one size, close to each other, made one line; the geometry is the first one's."""
    order = Window.partitionBy(*page).orderBy("line_no")
    heading = F.col("size").between(size_min, size_max)
    before = lambda c: F.lag(c).over(order)
    gap = F.col("top") - before("top")
    goes_on = heading & before("_heading") & (F.abs(F.col("size") - before("size")) <= alike) & (gap > 0) & (gap <= near * (F.col("bottom") - F.col("top")))
    marked = lines.withColumn("_heading", heading).withColumn("_opens", ~F.coalesce(goes_on, F.lit(False)))
    marked = marked.withColumn("_group", islands(F.col("_opens"), page, ["line_no"]))
    joined = marked.groupBy(*page, "_group").agg(F.min("line_no").alias("line_no"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"]), " ").alias("text"), F.min_by("top", "line_no").alias("top"), F.max("bottom").alias("bottom"), F.min_by("size", "line_no").alias("size"))
    return joined.drop("_group")


def margin_corridors(words: DataFrame, book: Sequence[str] = BOOK, page: str = "page_seq") -> DataFrame:
    """(book, parity, low, high): bins beside the text that hold numbers on several pages and hardly any letters.

    Bins are BIN points wide; neighbouring ones are merged; the corridor is half a bin wider on either side.
    """
    number = F.regexp_like("text", F.lit(r"^\d{1,4}$"))
    mass = F.when(F.regexp_like("text", F.lit(r"\p{L}")), F.col("x1") - F.col("x0")).otherwise(0.0)
    bins = words.groupBy(*book, F.pmod(page, F.lit(2)).alias("parity"), F.floor(F.col("x0") / BIN).alias("bin")).agg(F.sum(F.when(number, 1).otherwise(0)).alias("hits"), F.count_distinct(F.when(number, F.col(page))).alias("pages"), F.sum(mass).alias("mass"))
    side = ["book_id" if book == BOOK else c for c in book] + ["parity"]
    most = F.max("mass").over(Window.partitionBy(*side))
    quiet = bins.withColumn("_most", most).where((F.col("hits") >= HITS) & (F.col("pages") >= PAGES) & (F.col("mass") < QUIET * F.col("_most")))
    opens = F.coalesce(F.col("bin") - F.lag("bin").over(Window.partitionBy(*side).orderBy("bin")) > 1, F.lit(True))
    runs = quiet.withColumn("_opens", opens).withColumn("_run", islands(F.col("_opens"), side, ["bin"]))
    return runs.groupBy(*side, "_run").agg(((F.min("bin") - 0.5) * BIN).alias("low"), ((F.max("bin") + 1.5) * BIN).alias("high"), F.sum("hits").alias("hits")).drop("_run")


def number_to_front(text: Column, x0: Column, x_min: float, pattern: str = r"\d{1,4}") -> Column:
    """A line whose last word is a margin number beyond x_min gets it at its start; x0 is the last word's."""
    last = F.regexp_extract(text, rf"\s({pattern})$", 1)
    return F.when((last != "") & (x0 >= x_min), F.concat(last, F.lit(" "), F.regexp_replace(text, rf"\s{pattern}$", ""))).otherwise(text)


def glued(text: Column, gap: Column, mark: Column, most: float = 1.8) -> Column:
    """A footnote mark behind a word, with a space unless the gap is small."""
    return F.concat(text, F.when(gap <= most, F.lit("")).otherwise(F.lit(" ")), mark)
