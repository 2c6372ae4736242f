"""Numbers and their headings that a page's setting has parted: the heading stands above its number, or below it and maybe
on the next page."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.operators.layout import PAGE

#: What is a number alone on its line, the least sizes of headings above and below, lines looked at below.
NUMBER, SIZE_ABOVE, SIZE_BELOW, AHEAD = r"^\d{1,4}$", 11.0, 13.0, 3


def _any(text: Column, patterns: Sequence[str]) -> Column:
    found = F.lit(False)
    for pattern in patterns:
        found = found | F.regexp_like(text, F.lit(pattern))
    return found


def joined_above(lines: DataFrame, number: str, size_min: float = SIZE_ABOVE, most: int = 1, head_start: str | None = None, skip: Sequence[str] = (), page: Sequence[str] = PAGE, order: str = "line_no") -> DataFrame:
    """`lines` (page, order, text, size, top, x0, x1), a number followed by the heading above it; the heading's lines go.

    A heading is up to `most` lines in a row just above the number, each at least size_min large, not empty, no number and
    none of `skip`. With head_start its first line matches that: lines over the first such line stay where they are, and
    without one there is no heading. `joined` is the number of lines taken; the line's box covers them. A size of null is
    small, a text of null is empty. One sort of each page, and frames of `most` lines.
    """
    text = F.trim(F.coalesce("text", F.lit("")))
    is_number = F.regexp_like(text, F.lit(number))
    fits = (F.coalesce("size", F.lit(0.0)) >= size_min) & (text != "") & ~is_number & ~_any(text, skip)
    starts = F.regexp_like(text, F.lit(head_start)) if head_start else F.lit(True)
    w = Window.partitionBy(*page).orderBy(order)
    marked = lines.withColumns({"_t": text, "_number": is_number, "_fits": fits, "_starts": starts, "_at": F.row_number().over(w)})
    above = F.collect_list(F.struct("_at", "_t", "_fits", "_starts", "top", "x0", "x1")).over(w.rowsBetween(-most, -1))
    wall = F.coalesce(F.array_max(F.transform(F.filter("_above", lambda l: ~l["_fits"]), lambda l: l["_at"])), F.lit(0))
    run = marked.withColumn("_above", F.when(F.col("_number"), above)).withColumn("_run", F.filter("_above", lambda l: l["_at"] > wall))
    first = F.array_min(F.transform(F.filter("_run", lambda l: l["_starts"]), lambda l: l["_at"]))
    run = run.withColumn("_first", first).withColumn("_head", F.coalesce(F.filter("_run", lambda l: l["_at"] >= F.col("_first")), F.filter("_run", lambda l: F.lit(False))))
    taker = F.first(F.when(F.col("_number"), F.struct("_first")), ignorenulls=True).over(w.rowsBetween(1, most))
    joined = F.when(F.col("_number"), F.greatest(F.coalesce(F.size("_head"), F.lit(0)), F.lit(0))).otherwise(0)
    of_head = lambda c: F.col("_head").getField(c)
    ends = {"top": F.least("top", F.array_min(of_head("top"))), "x0": F.least("x0", F.array_min(of_head("x0"))), "x1": F.greatest("x1", F.array_max(of_head("x1")))}
    boxes = {c: F.when(F.col("joined") > 0, end).otherwise(F.col(c)) for c, end in ends.items()}
    whole = F.when(F.col("joined") > 0, F.concat_ws(" ", "_t", F.array_join(F.transform("_head", lambda l: l["_t"]), " "))).otherwise(F.col("text"))
    out = run.withColumns({"joined": joined, "_taken": F.coalesce(taker["_first"] <= F.col("_at"), F.lit(False)) & ~F.col("_number")})
    return out.where(~F.col("_taken")).withColumns({"text": whole, **boxes}).select(*lines.columns, "joined")


def joined_below(lines: DataFrame, number: str = NUMBER, size_min: float = SIZE_BELOW, ahead: int = AHEAD, book: Sequence[str] = PAGE[:1], order: Sequence[str] = (PAGE[-1], "line_no")) -> DataFrame:
    """`lines` (book, order, text, size), a number followed by the next line with text, on its page or the next; that line goes.

    Both are at least size_min large, so a small number, a note's mark, stays alone. The heading is looked for among the next
    `ahead` lines; the first one with text decides. A number before another number stays alone, so that no text is lost.
    `joined` marks the numbers that have their heading. Null sizes are small, null texts empty. One sort of each book.
    """
    text = F.trim(F.coalesce("text", F.lit("")))
    large = F.coalesce("size", F.lit(0.0)) >= size_min
    w = Window.partitionBy(*book).orderBy(*order)
    marked = lines.withColumns({"_t": text, "_number": large & F.regexp_like(text, F.lit(number)), "_heads": large & (text != "") & ~F.regexp_like(text, F.lit(number))})
    seen = F.when(F.col("_t") != "", F.struct("_t", "_number", "_heads"))
    after, before = F.coalesce(*[F.lead(seen, k).over(w) for k in range(1, ahead + 1)]), F.coalesce(*[F.lag(seen, k).over(w) for k in range(1, ahead + 1)])
    near = marked.withColumns({"_after": after, "_before": before})
    joined = F.col("_number") & F.coalesce(F.col("_after._heads"), F.lit(False))
    taken = F.col("_heads") & F.coalesce(F.col("_before._number"), F.lit(False))
    out = near.withColumns({"joined": joined, "_taken": taken}).where("not _taken")
    return out.withColumn("text", F.when(F.col("joined"), F.concat_ws(" ", "_t", "_after._t")).otherwise(F.col("text"))).select(*lines.columns, "joined")


def restored(lines: DataFrame, printed: DataFrame, number: str = NUMBER, size_min: float = SIZE_BELOW, page: Sequence[str] = PAGE, order: str = "line_no") -> DataFrame:
    """`lines` of the page model, with numbers that the file still has (`printed`: page, order, text, size) and the model lost.

    A number alone on a printed line of at least size_min is lost if no line of its page in the model begins with it. It goes
    before the first line of the model's page that is equal to the next printed line with text; failing that, before the
    first line of the book's next page in the model. Several numbers for one line stand in their printed order; one without a
    place is left out. `restored` counts a line's numbers. A page of the model is one row on the way, nothing larger is.
    """
    *book, at = page
    w = Window.partitionBy(*page).orderBy(order)
    text = F.trim(F.coalesce("text", F.lit("")))
    raw = printed.select(*page, order, text.alias("_t"), F.coalesce("size", F.lit(0.0)).alias("_s")).where("_t <> ''")
    raw = raw.withColumn("_next", F.lead("_t").over(w)).where((F.col("_s") >= size_min) & F.regexp_like("_t", F.lit(number)))
    own = lines.groupBy(*page).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("line"), text.alias("t")))).alias("_lines"))
    follow = Window.partitionBy(*book).orderBy(at)
    own = own.withColumns({"_page": F.lead(at).over(follow), "_line": F.lead(F.col("_lines")[0]["line"]).over(follow)})
    lost = raw.join(own, list(page)).where(~F.exists("_lines", lambda l: F.startswith(l["t"], F.col("_t"))))
    same = F.array_min(F.transform(F.filter("_lines", lambda l: l["t"] == F.col("_next")), lambda l: l["line"]))
    placed = lost.select(*book, F.when(same.isNotNull(), F.col(at)).otherwise(F.col("_page")).alias(at), F.coalesce(same, F.col("_line")).alias(order), F.struct(F.col(at).alias("p"), F.col(order).alias("o"), "_t").alias("_n"))
    by_line = placed.where(F.col(order).isNotNull()).groupBy(*page, order).agg(F.array_sort(F.collect_list("_n")).alias("_ns"))
    out = lines.join(by_line, [*page, order], "left")
    whole = F.when(F.col("_ns").isNotNull(), F.concat_ws(" ", F.array_join(F.transform("_ns", lambda n: n["_t"]), " "), F.ltrim("text"))).otherwise(F.col("text"))
    return out.withColumns({"text": whole, "restored": F.greatest(F.coalesce(F.size("_ns"), F.lit(0)), F.lit(0))}).select(*lines.columns, "restored")
