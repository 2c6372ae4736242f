"""A printed table of contents in two columns, from placed words: titles on the left, page numbers on the right."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.operators import folds
from folioforge.operators.layout import PAGE
from folioforge.operators.sequence import carried_back

#: Points within which words share a row, characters of an entry, what leads to a page number, what ends a row.
TOLERANCE, LEAST = 3.0, 4
LEADERS, TAIL, EDGES = r"(?:\s*[.·…]){3,}\s*", r"\s(\d{1,4})$", r"^[ .·]+|[ .·]+$"


def rows(words: DataFrame, page: Sequence[str] = PAGE, tolerance: float = TOLERANCE) -> DataFrame:
    """(page, row, text, x0, top): words no lower than `tolerance` under their row's first one, joined from left to right."""

    def step(some):
        row, start = -1, None
        for word in some:
            if start is None or word["top"] - start > tolerance:
                row, start = row + 1, word["top"]
            yield dict(word, row=row)

    placed = folds.folded(words.select(*page, "text", "x0", "top"), page, ["top", "x0"], step, "row int")
    first = F.array_sort(F.collect_list(F.struct("x0", "text", "top")))
    return placed.groupBy(*page, "row").agg(first.alias("_w")).select(*page, "row", F.array_join(F.transform("_w", lambda w: w["text"]), " ").alias("text"), F.col("_w")[0]["x0"].alias("x0"), F.col("_w")[0]["top"].alias("top"))


def entries(words: DataFrame, right: float, markers: Sequence[tuple[str, str, int]], page: Sequence[str] = PAGE, tolerance: float = TOLERANCE, indents: Sequence[tuple[float, float, int]] = ()) -> DataFrame:
    """(page, row, depth, marker, number, title, printed_page, inherited, rel_x) of words (page, text, x0, top).

    A row that begins at `right` or beyond is a number of the nearest title row, ties to the upper one, if that is at most
    twice the tolerance away; else it's left out. markers: (pattern, name, depth), the first that a row begins with counts,
    its first group is the number; rows without one aren't entries. indents: (from, to, depth) of the row's x go before the
    markers' depths. An entry without a page takes the next one's in the book; the last ones may have none.
    """
    every = rows(words, page, tolerance).withColumn("_number", F.col("x0") >= right)
    by = Window.partitionBy(*page).orderBy("row")
    back = Window.partitionBy(*page).orderBy(F.desc("row"))
    title = F.when(~F.col("_number"), F.struct("row", "top"))
    # Rows go down the page, so the nearest title is the last one above or the first one below.
    near = every.withColumns({"_up": F.last(title, ignorenulls=True).over(by), "_down": F.last(title, ignorenulls=True).over(back)})
    up, down = (F.abs(F.col(f"{c}.top") - F.col("top")) for c in ("_up", "_down"))
    host = F.when(F.coalesce(up <= down, up.isNotNull()), F.col("_up")).otherwise(F.col("_down"))
    numbers = near.where("_number").withColumn("_host", host).where(F.abs(F.col("_host.top") - F.col("top")) <= 2 * tolerance)
    added = numbers.groupBy(*page, F.col("_host.row").alias("row")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "text"))), lambda r: r["text"]), " ").alias("_added"))
    joined = every.where("not _number").join(added, [*page, "row"], "left")
    text = F.trim(F.regexp_replace(F.concat_ws(" ", "text", "_added"), LEADERS, " "))
    kind, number, depth, bare = F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("int"), F.col("_text")
    for pattern, name, level in reversed(markers):
        fits, opens = F.regexp_like("_text", F.lit(f"^(?:{pattern})")), f"^(?:{pattern})"
        kind, depth = F.when(fits, name).otherwise(kind), F.when(fits, level).otherwise(depth)
        number = F.when(fits, F.regexp_extract("_text", opens, 1)).otherwise(number)
        bare = F.when(fits, F.regexp_replace("_text", opens, "")).otherwise(bare)
    for low, high, level in indents:
        depth = F.when((F.col("x0") >= low) & (F.col("x0") < high), level).otherwise(depth)
    out = joined.withColumn("_text", text).where(F.char_length("_text") >= LEAST).withColumn("_page", F.nullif(F.regexp_extract("_text", TAIL, 1), F.lit("")).cast("int"))
    out = out.withColumn("_text", F.regexp_replace("_text", TAIL, "")).withColumns({"marker": kind, "number": number, "depth": depth, "title": F.regexp_replace(bare, EDGES, "")}).where("marker is not null")
    book = list(page[:-1])
    return out.withColumn("printed_page", carried_back(F.col("_page"), book, [page[-1], "row"])).select(*page, "row", "depth", "marker", "number", "title", "printed_page", F.col("_page").isNull().alias("inherited"), F.round("x0").cast("int").alias("rel_x"))
