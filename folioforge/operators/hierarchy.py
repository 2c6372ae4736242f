"""Tables of contents against a book's lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions.python import similarity
from folioforge.functions.text import spaced_key
from folioforge.operators.sequence import carried_back

#: Pages to either side, least ratio, characters of the heads that are compared.
AROUND, LEAST, PREFIX, CONTAINED = 1, 0.72, 20, 60


def anchored(entries: DataFrame, lines: DataFrame, book: Sequence[str] = ("book_id",), around: int = AROUND, least: float = LEAST) -> DataFrame:
    """`entries` (book, entry, title, page) with `line_no`, `ratio` and `by_page` of the line that fits best on the pages around.

    lines: (book, page, line_no, line), and `printed_page` where folios are known; a page without one is the median offset of
    folio and page away from its page number. A line whose first 60 characters hold the title's first 20 has the ratio 1; of
    equal ratios the first line wins. Below `least` the ratio stays and the line is the page's first one (`by_page`), or -1
    where the entry's page lies before all known folios, else null. Entries are spread to the pages around, so the join is an
    equality; a page's lines are the candidates. A title without letters or digits gets no line.
    """
    there = lines.select(*book, "line_no", spaced_key(F.col("line")).alias("_line"), *[F.col(c).alias(f"_{c}") for c in ("page", "printed_page") if c in lines.columns])
    first_known = None
    if "_printed_page" in there.columns:
        offsets = there.where("_printed_page is not null").groupBy(*book).agg(F.median(F.col("_printed_page") - F.col("_page")).alias("_offset"), F.min("_printed_page").alias("_known"))
        there = there.join(offsets, list(book), "left").withColumn("_page", F.coalesce("_printed_page", (F.col("_page") + F.coalesce("_offset", F.lit(0))).cast("int")))
        first_known = offsets.select(*book, "_known")
    there = there.select(*book, "_page", "line_no", "_line")
    near = entries.withColumn("_page", F.explode(F.sequence(F.col("page") - around, F.col("page") + around)))
    pairs = near.withColumn("_title", spaced_key(F.col("title"))).join(there, [*book, "_page"], "left")
    title, line = F.col("_title"), F.col("_line")
    holds = F.contains(F.substring(line, 1, CONTAINED), F.substring(title, 1, PREFIX))
    ratio = F.when((title == "") | (F.coalesce(line, F.lit("")) == ""), None).when(holds, F.lit(1.0)).otherwise(similarity(title, line))
    best = pairs.withColumn("_ratio", ratio).groupBy(*entries.columns).agg(F.max(F.when(F.col("_ratio").isNotNull(), F.struct("_ratio", (-F.col("line_no")).alias("n")))).alias("_b"), F.min(F.when(F.col("_page") == F.col("page"), F.col("line_no"))).alias("_first"), F.first("_title").alias("_title"))
    best = best.join(first_known, list(book), "left") if first_known is not None else best.withColumn("_known", F.lit(None).cast("int"))
    found, any_title = F.coalesce(F.col("_b._ratio") >= least, F.lit(False)), F.col("_title") != ""
    at_page = F.coalesce("_first", F.when(F.col("page") < F.col("_known"), F.lit(-1)))
    return best.select(*entries.columns, F.when(any_title, F.when(found, -F.col("_b.n")).otherwise(at_page)).alias("line_no"), F.when(any_title, F.round(F.coalesce("_b._ratio", F.lit(0.0)), 2)).alias("ratio"), (any_title & ~found).alias("by_page"))


def ancestor_path(entries: DataFrame, book: Sequence[str], order: str, depth: str = "depth", title: str = "title", levels: int = 6) -> DataFrame:
    """Each entry with the titles above it in the tree that depths and order describe."""
    from folioforge.operators.sequence import heading_stack

    return heading_stack(entries, book, [order], depth, title, levels)


def inherited_pages(entries: DataFrame, book: Sequence[str], order: str, page: str = "printed_page") -> DataFrame:
    """An entry without a page takes the next entry's."""
    return entries.withColumn(page, carried_back(F.col(page), book, [order]))


def act_ranges(outline: DataFrame, book: Sequence[str], page: str = "page") -> DataFrame:
    """Top nodes with their last page: the one before the next node's."""
    return outline.withColumn("last_page", F.lead(page).over(Window.partitionBy(*book).orderBy(page)) - 1)


def running_head(lines: DataFrame, page: Sequence[str], order: str, patterns: Sequence[str]) -> DataFrame:
    """(page, section): the first pattern that fits the page's first line that isn't blank decides."""
    first = lines.where(F.trim("line") != "").groupBy(*page).agg(F.min_by("line", order).alias("head"))
    found: list[Column] = [F.nullif(F.regexp_extract("head", p, 1), F.lit("")) for p in patterns]
    return first.select(*page, "head", F.coalesce(*found).alias("section"))
