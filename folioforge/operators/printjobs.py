"""Print jobs of an online commentary -> numbered units: each job ends with a block that says how to cite it, and so which
numbers it holds. The numbers printed beside the text cut it; the announced ones decide which of them count."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.operators import cards
from folioforge.operators.margins import LINES, LONG, NUMBER
from folioforge.operators.sequence import carried_forward, islands

#: Lines behind a block's first that may belong to it, room between body and margin, between body and hanging
#: numbers, the largest size of a raised number and the least one of a note's text, what a note's size is below the body's,
#: and characters of a line from which on it takes a number that stands alone above it.
BLOCK, PAD, HANGS, RAISED, NOTE_SIZE, SMALLER, TAKES = 6, 4.0, 8.0, 9.0, 9.5, 0.5, 20
#: Fixed value: a note's number as the first word of its line.
HANGING = r"^(\d{1,3})\s+(\S.*)$"


@dataclass(frozen=True)
class Print:
    """What the jobs of a database look like, as patterns: the first line of a block; the full citation, with a group each
    for section and announced numbers; the short one; lines of the printout; a page's head and what goes on from it."""

    opens: str = r"^Zitiervorschl[aä]ge?:?$"
    cites: str = r"§+\s*(\d+[a-zä]?(?:\s(?:Abs|Nr|S)\.\s*\d+[a-z]?)*)(?:\s*Rn\.\s*([0-9][0-9\s,–-]*))?\s*$"
    short: str = r"^\w+/[^,]{1,60}\s\w+\s(?:Vor\s*)?§+\s*\d"
    junk: str = r"^https?://|^©\s|^\d+\s*von\s*\d+\s"
    head: str = r"^\d{1,2}\.\s*Auflage\s*\d{4}$"
    tail: str = r"^.{0,50}\s(?:BGB|EGBGB|HGB)$"
    edition: str = r"\d{1,2}\.\s*Aufl\.\s*\d{4},"


def _median(value: Column, when: Column, keys: Sequence[str]) -> Column:
    """Median over a job's rows for which `when` holds; null where there are fewer than LINES."""
    w = Window.partitionBy(*keys)
    some = F.when(when, value)
    return F.when(F.count(some).over(w) >= LINES, F.median(some).over(w))


def split(lines: DataFrame, look: Print = Print(), book: Sequence[str] = ("book_id",), order: Sequence[str] = ("page_seq", "line_no")) -> DataFrame:
    """`lines` (book, order, text, ...) with `job`, `section` and `announced`, without the blocks and what isn't text.

    A block begins with a line that `opens` matches, and the next BLOCK lines belong to it as long as each is a citation or
    part of the printout. The block closes the job before it; the last full citation in it counts. Lines behind the last
    block are a job without a citation. Then the printout's lines go, page heads, and a head's tail right behind it. Null
    texts are empty. One sort of each book; blocks are joined back by book and job.
    """
    text = F.coalesce("text", F.lit(""))
    full = F.regexp_like(text, F.lit(look.cites)) & F.regexp_like(text, F.lit(look.edition))
    junk = F.regexp_like(text, F.lit(look.junk))
    kind = F.when(F.regexp_like(text, F.lit(look.opens)), "open").when(full, "full").when(F.regexp_like(text, F.lit(look.short)), "short").when(junk, "junk").otherwise("text")
    w = Window.partitionBy(*book).orderBy(*order)
    marked = lines.withColumns({"_kind": kind, "_at": F.row_number().over(w)})
    wall = F.when(F.col("_kind").isin("open", "text"), F.struct("_at", "_kind"))
    marked = marked.withColumns({"_wall": carried_forward(wall, book, ["_at"]), "job": islands(F.col("_kind") == "open", book, ["_at"])})
    inside = (F.col("_wall._kind") == "open") & (F.col("_at") - F.col("_wall._at") <= BLOCK)
    marked = marked.withColumn("_block", F.coalesce(inside, F.lit(False)))
    said = marked.where("_block and _kind = 'full'").groupBy(*book, (F.col("job") - 1).alias("job")).agg(F.max_by("text", "_at").alias("_cite"))
    body = marked.where("not _block and _kind <> 'junk'")
    heads = F.regexp_like(text, F.lit(look.head))
    goes_on = ~heads & F.regexp_like(text, F.lit(look.tail))
    last = F.last(F.when(~goes_on, heads), ignorenulls=True).over(Window.partitionBy(*book, "job").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1))
    kept = body.withColumn("_gone", heads | (goes_on & F.coalesce(last, F.lit(False)))).where("not _gone")
    cite = lambda g: F.nullif(F.trim(F.regexp_extract("_cite", look.cites, g)), F.lit(""))
    return kept.join(said, [*book, "job"], "left").withColumns({"section": cite(1), "announced": cite(2)}).select(*lines.columns, "job", "section", "announced")


def announced(numbers: Column) -> Column:
    """`9-12, 14` -> [{9, 12}, {14, 14}]; what is neither number nor rising range is left out. Ranges stay ranges."""
    ends = F.transform(F.split(F.coalesce(numbers, F.lit("")), ","), lambda p: F.split(F.trim(p), r"\s*[-–]\s*"))
    pairs = F.transform(ends, lambda e: F.struct(F.get(e, 0).try_cast("int").alias("low"), F.get(e, F.size(e) - 1).try_cast("int").alias("high"), F.size(e).alias("n")))
    return F.transform(F.filter(pairs, lambda p: (p["n"] <= 2) & (p["low"] <= p["high"])), lambda p: F.struct(p["low"].alias("low"), p["high"].alias("high")))


def apparatus(lines: DataFrame, job: Sequence[str] = ("book_id", "job"), order: Sequence[str] = ("page_seq", "line_no")) -> DataFrame:
    """A job's `lines` (job, order, text, size, x0) with `is_note`: from the first line on that a note's number opens.

    That is a small number alone on its line before an indented line of a note's size, or a line that begins with a number
    left of the body, in smaller type. A raised number whose line isn't indented is text.
    """
    w = Window.partitionBy(*job).orderBy(*order)
    size = F.coalesce("size", F.lit(99.0))
    long = F.char_length("text") > LONG
    hanging = F.regexp_like("text", F.lit(HANGING))
    alone = F.regexp_like("text", F.lit(NUMBER)) & (size <= RAISED)
    indented = (F.lead("x0").over(w) >= F.col("x0") + HANGS) & (F.coalesce(F.lead("size").over(w), F.lit(0.0)) >= NOTE_SIZE)
    seen = lines.withColumns({"_left": _median(F.col("x0"), long & ~hanging, job), "_size": _median(F.col("size"), long & (F.col("size") > 0), job), "_alone": alone & indented})
    anchor = F.col("_alone") | (hanging & (F.col("x0") <= F.col("_left") - HANGS) & (size <= F.col("_size") - SMALLER))
    return seen.withColumn("is_note", islands(F.coalesce(anchor, F.lit(False)), job, order) > 0).drop("_alone", "_size")


def note_lines(lines: DataFrame) -> DataFrame:
    """The apparatus with hanging numbers on lines of their own (`part` 0 and 1), as `folds.page_notes` reads them."""
    cut = F.regexp_like("text", F.lit(HANGING)) & F.coalesce(F.col("x0") <= F.col("_left") - HANGS, F.lit(False))
    parts = F.when(cut, F.array(F.regexp_extract("text", HANGING, 1), F.regexp_extract("text", HANGING, 2))).otherwise(F.array("text"))
    notes = lines.where("is_note").withColumn("_parts", parts)
    return notes.select(*[c for c in lines.columns if c not in ("text", "_left", "is_note")], F.posexplode("_parts").alias("part", "text"))


def numbered(lines: DataFrame, job: Sequence[str] = ("book_id", "job"), order: Sequence[str] = ("page_seq", "line_no")) -> DataFrame:
    """Body lines (job, order, text, x0, x1, size, words array<struct<text, x0, x1>>) with `rn`, their margin number.

    A number is a long line's last word right of the job's edge (the median right end of its long lines), and leaves the line;
    or it stands alone there, leaves, and counts for the next line of more than TAKES characters, unless another one does.
    A line's own number goes first. Jobs without an edge have no numbers.
    """
    number = lambda c: F.regexp_like(c, F.lit(NUMBER))
    wordy = F.exists(F.split("text", " "), lambda t: ~number(t))
    long = F.char_length("text") > LONG
    end = F.array_max(F.transform("words", lambda w: F.struct(w["x1"].alias("x1"), w["x0"].alias("x0"), w["text"].alias("text"))))
    edged = lines.withColumns({"_edge": _median(F.col("x1"), long & wordy, job) + PAD, "_end": end})
    own = long & number("_end.text") & (F.col("_end.x0") >= F.col("_edge"))
    alone = number("text") & (F.col("x0") >= F.col("_edge"))
    takes = F.char_length("text") > TAKES
    edged = edged.withColumns({"_own": F.coalesce(own, F.lit(False)), "_alone": F.coalesce(alone, F.lit(False)), "_takes": takes})
    before = F.sum(F.when(F.col("_takes"), 1).otherwise(0)).over(Window.partitionBy(*job).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    edged = edged.withColumn("_run", F.coalesce(before, F.lit(0)))
    run = Window.partitionBy(*job, "_run")
    first = F.min(F.when(F.col("_alone"), F.struct(*order, F.col("text").alias("_n")))).over(run)
    edged = edged.withColumns({"_first": first, "_any": F.max("_takes").over(run)})
    here = F.struct(*[F.col(o) for o in order])
    gone = F.col("_alone") & F.col("_any") & here.eqNullSafe(F.struct(*[F.col(f"_first.{o}") for o in order]))
    rest = F.filter("words", lambda w: ~((w["x1"] == F.col("_end.x1")) & (w["x0"] == F.col("_end.x0")) & (w["text"] == F.col("_end.text"))))
    rn = F.when(F.col("_own"), F.col("_end.text")).when(F.col("_takes"), F.col("_first._n")).cast("int")
    out = edged.withColumns({"rn": rn, "_gone": gone, "words": F.when(F.col("_own"), rest).otherwise(F.col("words"))}).where("not _gone")
    return out.withColumn("text", F.when(F.col("_own"), F.array_join(F.transform("words", lambda w: w["text"]), " ")).otherwise(F.col("text"))).select(*lines.columns, "rn")


def raised(lines: DataFrame, job: Sequence[str] = ("book_id", "job"), order: Sequence[str] = ("page_seq", "line_no")) -> DataFrame:
    """Body lines where small numbers alone on their lines have gone into the next other line, at their place by x0.

    Those at a job's end stay. To be used behind `apparatus`, where such lines are notes.
    """
    alone = F.regexp_like("text", F.lit(NUMBER)) & (F.coalesce("size", F.lit(99.0)) <= RAISED)
    marked = lines.withColumn("_alone", alone)
    before = F.sum(F.when(F.col("_alone"), 0).otherwise(1)).over(Window.partitionBy(*job).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    run = Window.partitionBy(*job, "_run")
    marked = marked.withColumn("_run", F.coalesce(before, F.lit(0)))
    marked = marked.withColumns({"_up": F.flatten(F.collect_list(F.when(F.col("_alone"), F.col("words"))).over(run)), "_host": F.max(~F.col("_alone")).over(run)}).where("not (_alone and _host)")
    takes = ~F.col("_alone") & (F.size("_up") > 0)
    whole = F.array_sort(F.transform(F.concat("words", "_up"), lambda w: F.struct(w["x0"].alias("x0"), w["x1"].alias("x1"), w["text"].alias("text"))))
    return marked.withColumn("text", F.when(takes, F.array_join(F.transform(whole, lambda w: w["text"]), " ")).otherwise(F.col("text"))).select(*lines.columns)


def units(lines: DataFrame, job: Sequence[str] = ("book_id", "job"), order: Sequence[str] = ("page_seq", "line_no")) -> DataFrame:
    """(job, section, number, upto, how, text) from body lines (job, order, text, rn, section, announced).

    Numbers that the job doesn't announce, if it announces any, are none of its. The remaining ones cut the text (how margin);
    what stands before the first is a unit of the first announced number if that is smaller (citation), else part of the
    first unit. Without one in the margin a single announced number is the job's (citation), several make one unit with
    `upto` (range), and none makes unit 0 (opening). Units without text go. Numbers announced as ranges count as several.
    """
    # the first and last number announced, and whether a line's number is among them
    said = lines.withColumn("_said", announced(F.col("announced")))
    first, last = F.col("_said")[0]["low"], F.element_at("_said", -1)["high"]
    said = said.withColumns({"_first": F.when(F.size("_said") > 0, first), "_last": F.when(F.size("_said") > 0, last), "_one": (F.size("_said") == 1) & (F.get("_said", 0)["low"] == F.get("_said", 0)["high"])})
    fits = (F.size("_said") == 0) | F.exists("_said", lambda r: F.col("rn").between(r["low"], r["high"]))
    said = said.withColumn("rn", F.when(fits, F.col("rn")))
    said = said.withColumns({"_k": islands(F.col("rn").isNotNull(), job, order), "_start": F.first("rn", ignorenulls=True).over(Window.partitionBy(*job).orderBy(*[F.col(o) for o in order]).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    own_head = F.col("_first") < F.col("_start")
    said = said.withColumn("_unit", F.when(F.col("_start").isNull() | F.coalesce(own_head, F.lit(False)), F.col("_k")).otherwise(F.greatest("_k", F.lit(1))))
    line = F.struct(*order, F.coalesce("text", F.lit("")).alias("t"))
    of = said.groupBy(*job, "section", "_unit", "_first", "_last", "_one", "_start").agg(F.min(F.when(F.col("rn").isNotNull(), F.struct(*order, "rn")))["rn"].alias("_rn"), F.array_sort(F.collect_list(line)).alias("_l"))
    printed = F.col("_rn").isNotNull()
    how = F.when(printed, "margin").when(F.col("_start").isNotNull() | F.col("_one"), "citation").when(F.col("_first").isNotNull(), "range").otherwise("opening")
    text = F.trim(F.array_join(F.transform("_l", lambda l: l["t"]), "\n"))
    out = of.select(*job, "section", F.coalesce("_rn", "_first", F.lit(0)).alias("number"), F.when(how == "range", F.col("_last")).alias("upto"), how.alias("how"), text.alias("text"))
    return out.where("text <> ''")


def merged(units: DataFrame, book: Sequence[str] = ("book_id",)) -> DataFrame:
    """One unit for each (book, section, number, upto), the longest, of equal ones the first job's; ranges of which every
    number stands alone in the same section go. Sorted by nothing; `section_key` gives an order."""
    key = [*book, "section", "number", "upto"]
    best = units.groupBy(*key).agg(F.max_by(F.struct(*[c for c in units.columns if c not in key]), F.struct(F.char_length("text"), -F.col("job"))).alias("_u")).select(*key, "_u.*")
    spans = best.select(*book, F.coalesce("section", F.lit("")).alias("section"), "number", F.when(F.col("upto").isNotNull(), F.col("number")).alias("low"), F.col("upto").alias("high"))
    idle = cards.ranges_covered(spans, [*book, "section"]).select(*book, F.col("section").alias("_s"), F.col("low").alias("number"), F.col("high").alias("upto"))
    out = best.withColumn("_s", F.coalesce("section", F.lit("")))
    return out.join(idle, [*book, "_s", "number", "upto"], "left_anti").select(*units.columns)


def section_key(section: Column) -> Column:
    """Sorts `9` before `9a` before `10`; sections without a number come last, by name."""
    number = F.regexp_extract(section, r"^(\d+)", 1).try_cast("int")
    letters = F.regexp_extract(section, r"^\d+([a-zä]*)", 1)
    return F.struct(F.coalesce(number, F.lit(10**6)).alias("number"), F.when(number.isNull(), section).otherwise(letters).alias("rest"))
