"""Page layout: words with coordinates -> lines, columns, margins, folios and note blocks.

Coordinates are points from the top left corner. What depends on a page's rows as a whole (clustering, reading order)
is one pass per page in Python, a page being a few thousand words; everything else is expressions and windows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

PAGE = ("book_id", "page_seq")
#: Shares of heights within which words share a line, and of sizes that may.
CENTRE, RATIO, INSIDE, REACH, LOOK_BACK = 0.45, 1.6, 0.35, 3.0, 3
#: Fixed value: pages whose lines a task gives out together.
AT_ONCE = 100


class _Row:
    """A growing line: its box is that of the words so far."""

    def __init__(self, word: dict):
        self.words = [word]
        self.box(word)

    def box(self, word: dict) -> None:
        self.top, self.bottom = (min(self.top, word["top"]), max(self.bottom, word["bottom"])) if len(self.words) > 1 else (word["top"], word["bottom"])

    def takes(self, word: dict) -> bool:
        height, mine = word["bottom"] - word["top"], self.bottom - self.top
        apart = abs((word["top"] + word["bottom"]) - (self.top + self.bottom)) / 2
        if apart <= CENTRE * max(height, mine) and max(height, mine) <= RATIO * max(1e-9, min(height, mine)):
            return True
        # A raised or lowered small word beside the line, whichever of the two comes first from the top.
        beside = min(min(abs(word["x0"] - w["x1"]), abs(w["x0"] - word["x1"])) for w in self.words[-2:] + self.words[:1])
        (top, bottom, small), (head, foot, large) = sorted([(word["top"], word["bottom"], height), (self.top, self.bottom, mine)], key=lambda x: x[2])
        return small < large and head - INSIDE * large <= top and bottom <= foot + INSIDE * large and beside <= REACH * large

    def add(self, word: dict) -> None:
        self.words.append(word)
        self.box(word)


def rows_of(words: list[dict]) -> list[_Row]:
    """The lines that words or glyphs stand in, from top to bottom."""
    rows: list[_Row] = []
    for word in sorted(words, key=lambda w: (w["top"], w["x0"])):
        for row in reversed(rows[-LOOK_BACK:]):
            if row.takes(word):
                row.add(word)
                break
        else:
            rows.append(_Row(word))
    return sorted(rows, key=lambda r: (r.top, min(w["x0"] for w in r.words)))


def lines_of_words(words: list[dict]) -> list[dict]:
    """Lines from top to bottom, each with its words from left to right."""
    out = []
    for row in rows_of(words):
        some = sorted(row.words, key=lambda w: w["x0"])
        sizes = sorted(w["size"] for w in some)
        out.append({"text": " ".join(w["text"] for w in some), "x0": some[0]["x0"], "x1": max(w["x1"] for w in some), "top": row.top, "bottom": row.bottom, "size": (sizes[(len(sizes) - 1) // 2] + sizes[len(sizes) // 2]) / 2})
    return out


def pages_of_words(words: DataFrame, page: Sequence[str] = PAGE) -> DataFrame:
    """(page, words): a row for each page of `words` (page, text, x0, x1, top, bottom, size)."""
    fields = ["text", *[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(c) for c in ("x0", "x1", "top", "bottom", "size")]]
    return words.groupBy(*page).agg(F.collect_list(F.struct(*fields)).alias("words"))


def lines_on_pages(pages: DataFrame, page: Sequence[str] = PAGE) -> DataFrame:
    """(page, line_no, text, x0, x1, top, bottom, size) from pages of words. Pages stay where they are, in batches."""
    schema = pages.select(*page).schema
    for f in T._parse_datatype_string("line_no int, text string, x0 double, x1 double, top double, bottom double, size double").fields:
        schema = schema.add(f)
    into = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), AT_ONCE):
                some = batch.slice(low, AT_ONCE)
                found = [(at, i, line) for at in range(len(some)) for i, line in enumerate(lines_of_words(some["words"].slice(at, 1).flatten().to_pylist()))]
                keys = [some[c].take(pa.array([at for at, _, _ in found], pa.int32())) for c in page]
                numbers = pa.array([i for _, i, _ in found], pa.int32())
                columns = [pa.array([line[f.name] for _, _, line in found], f.type) for f in list(into)[len(page) + 1 :]]
                yield pa.RecordBatch.from_arrays([*keys, numbers, *columns], schema=into)

    return pages.mapInArrow(run, schema)


def cluster_lines(words: DataFrame, page: Sequence[str] = PAGE) -> DataFrame:
    """(page, line_no, text, x0, x1, top, bottom, size) from words (page, text, x0, x1, top, bottom, size)."""
    return lines_on_pages(pages_of_words(words, page), page)


def _single(rows: pd.DataFrame, dx: float, dy: float) -> pd.DataFrame:
    """One page's glyphs without twins of kept ones, which lie at most dx to the left and dy above or below."""
    rows = rows.sort_values(["x0", "top"], kind="stable")
    kept: dict[str, list[tuple[float, float]]] = {}
    stays = []
    for text, x, top in zip(rows["text"], rows["x0"], rows["top"]):
        near = kept.setdefault(text, [])
        while near and x - near[0][0] > dx:
            near.pop(0)
        twin = any(abs(top - t) <= dy for _, t in near)
        stays.append(not twin)
        if not twin:
            near.append((x, top))
    return rows[stays]


def deduplicated(chars: DataFrame, dx: float = 1.2, dy: float = 3.0, page: Sequence[str] = PAGE) -> DataFrame:
    """Glyphs without those that repeat a kept one of the same text within dx and dy, as a double-printed layer does.

    Which glyph is kept depends on those kept before it, so a page is gone through in order of x: one task for each page.
    """
    return chars.groupBy(*page).applyInPandas(lambda rows: _single(rows, dx, dy), chars.schema)


def in_column(chars: DataFrame, low: float, high: float) -> DataFrame:
    return chars.where((F.col("x0") >= low) & (F.col("x0") < high))


def halves(chars: DataFrame, width: str = "width") -> DataFrame:
    """A scanned spread as two pages: the right half's x starts over, and `half` tells them apart."""
    right = F.col("x0") >= F.col(width) / 2
    shift = F.when(right, F.col(width) / 2).otherwise(0.0)
    return chars.withColumns({"half": F.when(right, 1).otherwise(0), "x0": F.col("x0") - shift, "x1": F.col("x1") - shift})


def without_bands(lines: DataFrame, header: float, footer: float, height: str = "height") -> DataFrame:
    """Lines between the bands, which are shares of the height from the top."""
    return lines.where((F.col("bottom") > F.col(height) * header) & (F.col("top") < F.col(height) * footer))


def without_junk(lines: DataFrame, patterns: Sequence[str], band: float = 0.12, height: str = "height", folio: str = "printed_page") -> DataFrame:
    """Blank lines, matches, and lone numbers in the bands go; the latter only if the folio is unknown or that number."""
    text = F.trim("text")
    lone = F.regexp_like(text, F.lit(r"^\d{1,4}$")) & ((F.col("bottom") <= F.col(height) * band) | (F.col("top") >= F.col(height) * (1 - band)))
    named = F.col(folio).isNull() | (F.col(folio) == text.try_cast("int"))
    junk = (text == "") | (lone & named)
    for p in patterns:
        junk = junk | F.regexp_like("text", F.lit(f"(?i){p}"))
    return lines.where(~junk)


def folios(lines: DataFrame, page: Sequence[str] = PAGE, band: float = 0.12, height: str = "height") -> DataFrame:
    """(page, printed_page, folio_line): the first line in a band that is a number, or a Roman one, which has no value."""
    text = F.trim("text")
    inside = (F.col("bottom") <= F.col(height) * band) | (F.col("top") >= F.col(height) * (1 - band))
    number, roman = F.regexp_like(text, F.lit(r"^\d{1,4}$")), F.regexp_like(text, F.lit(r"^(?i)[ivxlcdm]+$"))
    first = F.min(F.struct("line_no", F.when(number, text.try_cast("int")).alias("n")))
    return lines.where(inside & (number | roman)).groupBy(*page).agg(first.alias("_f")).select(*page, F.col("_f.n").alias("printed_page"), F.col("_f.line_no").alias("folio_line"))


def notes_apart(lines: DataFrame, bottom_band: float = 0.70, note_max: float | None = None, page: Sequence[str] = PAGE, height: str = "height") -> DataFrame:
    """`lines` with `is_note`: low on the page and small. Without a bound it is the page's median size less 1.5."""
    most = F.lit(note_max) if note_max is not None else F.median("size").over(Window.partitionBy(*page)) - 1.5
    return lines.withColumn("is_note", (F.col("top") >= F.col(height) * bottom_band) & F.coalesce(F.col("size") <= most, F.lit(False)))


def body_edges(lines: DataFrame, book: Sequence[str] = ("book_id",), page: str = "page_seq", least: int = 40) -> DataFrame:
    """(book, parity, left, right): most frequent rounded edges of long lines on odd and even pages; ties to the least."""
    long = lines.where(F.char_length("text") > least)
    return long.groupBy(*book, F.pmod(page, F.lit(2)).alias("parity")).agg(F.mode(F.round("x0"), deterministic=True).alias("left"), F.mode(F.round("x1"), deterministic=True).alias("right"))


def nearest_line(tokens: DataFrame, lines: DataFrame, page: Sequence[str] = PAGE) -> DataFrame:
    """Each margin token with the line of its page whose top is nearest, ties to the upper one."""
    pairs = tokens.join(lines.select(*page, F.col("line_no"), F.col("top").alias("_top")), list(page))
    best = F.min(F.struct(F.abs(F.col("top") - F.col("_top")), "line_no"))
    return pairs.groupBy(*tokens.columns).agg(best.alias("_b")).select(*tokens.columns, F.col("_b.line_no").alias("line_no"))


def host_line(marks: DataFrame, lines: DataFrame, page: Sequence[str] = PAGE, least: float = 0.5) -> DataFrame:
    """Each footnote mark with the line that it overlaps most, by half of its height or more; ties: nearest x, last line."""
    pairs = marks.join(lines.select(*page, "line_no", F.col("top").alias("_t"), F.col("bottom").alias("_b"), F.col("x0").alias("_x")), list(page))
    overlap = F.least("bottom", "_b") - F.greatest("top", "_t")
    best = F.max(F.struct(overlap.alias("o"), (-F.abs(F.col("x0") - F.col("_x"))).alias("d"), F.col("line_no").alias("line_no")))
    return pairs.where(overlap >= least * (F.col("bottom") - F.col("top"))).groupBy(*marks.columns).agg(best.alias("_m")).select(*marks.columns, F.col("_m.line_no").alias("line_no"))


def uncovered(recognised: DataFrame, words: DataFrame, page: Sequence[str] = PAGE, slack: float = 2.0, least: float = 70.0) -> DataFrame:
    """Recognised words of enough confidence whose centre lies in no word of the text layer."""
    x, y = (F.col("r.x0") + F.col("r.x1")) / 2, (F.col("r.top") + F.col("r.bottom")) / 2
    on = [F.col(f"r.{c}") == F.col(f"w.{c}") for c in page] + [x >= F.col("w.x0"), x <= F.col("w.x1"), y >= F.col("w.top") - slack, y <= F.col("w.bottom") + slack]
    return recognised.where(F.col("conf") >= least).alias("r").join(words.alias("w"), on, "left_anti")


def case_widths(chars: DataFrame, book: Sequence[str] = ("book_id",)) -> DataFrame:
    """(book, fontname, letter, upper): the upper-case width of letters that come in two widths in a case-broken font."""
    width = F.round((F.col("x1") - F.col("x0")) / F.col("size"), 3)
    seen = chars.where(F.lower("text") != F.upper("text")).groupBy(*book, "fontname", F.lower("text").alias("letter")).agg(F.max(width).alias("upper"), F.min(width).alias("lower"), F.count_distinct(width).alias("n"))
    return seen.where("n >= 2 and upper >= 1.04 * lower").select(*book, "fontname", "letter", "upper")


def case_repaired(chars: DataFrame, book: Sequence[str] = ("book_id",)) -> DataFrame:
    """Lower-case glyphs of upper-case width become upper case. The table of widths has a row for a font and letter."""
    width = (F.col("x1") - F.col("x0")) / F.col("size")
    table = case_widths(chars, book).withColumnRenamed("letter", "_letter")
    joined = chars.withColumn("_letter", F.lower("text")).join(table, [*book, "fontname", "_letter"], "left")
    return joined.withColumn("text", F.when(F.abs(width - F.col("upper")) <= 0.006, F.upper("text")).otherwise(F.col("text"))).select(*chars.columns)


def two_columns(words: DataFrame, split: float, gutter: float = 6.0, page: Sequence[str] = PAGE) -> DataFrame:
    """Lines in reading order: a line across the gutter closes a block; inside a block the left column comes first."""
    side = F.when((F.col("x0") < split - gutter) & (F.col("x1") > split + gutter), 0).when(F.col("x1") <= split + gutter, 1).otherwise(2)
    lines = cluster_lines(words.withColumn("_side", side), [*page, "_side"])
    across = F.sum(F.when(F.col("_side") == 0, 1).otherwise(0)).over(Window.partitionBy(*page).orderBy("top", "x0"))
    block = across * 2 - F.when(F.col("_side") == 0, 1).otherwise(0)
    return lines.withColumn("_block", block).withColumn("line_no", F.row_number().over(Window.partitionBy(*page).orderBy("_block", "_side", "top", "x0")) - 1).drop("_block", "_side")


def on_lines(lines: Column, edit) -> Column:
    """An array of line structs with each text edited; the geometry stays."""
    return F.transform(lines, lambda line: line.withField("text", edit(line["text"])))


def split_at(lines: Column, pattern: str) -> Column:
    """Lines cut before the first match that isn't at their start; both halves keep the geometry."""
    at = lambda t: F.regexp_instr(F.substr(t, F.lit(2)), F.lit(pattern))

    def cut(line: Column) -> Column:
        n = at(line["text"])
        return F.when(n > 0, F.array(line.withField("text", F.substr(line["text"], F.lit(1), n)), line.withField("text", F.substr(line["text"], n + 1)))).otherwise(F.array(line))

    return F.flatten(F.transform(lines, cut))
