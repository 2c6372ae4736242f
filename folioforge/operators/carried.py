"""Notes whose numbers go on counting from page to page: the reading of a page depends on the page before."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.operators.folds import Row, folded
from folioforge.operators.layout import PAGE

#: The forms of a note's mark, and registers whose files are cited as `5 Ob 142/68`.
MARKS = {"paren": r"\((\d{1,%d})\)", "bracket": r"\[(\d{1,%d})\]", "dot": r"(\d{1,%d})\.", "close": r"(\d{1,%d})\)"}
FORMS = {"any": ("paren", "bracket", "dot", "close"), "paren": ("paren",), "bracket": ("bracket",), "dot": ("dot",)}
REGISTERS = ("Ob", "ObA", "ObS", "Präs", "Nc", "Fsc", "Ds", "Nd")

#: A page's lines and the last number before it -> its notes and the last number after it.
Reader = Callable[[Sequence[str], int], tuple[list[dict], int]]
NOTE = "note int, number int, text string, carried boolean"


def reader(form: str = "any", most_step: int = 0, most_digits: int = 3) -> Reader:
    """How a page is read, with the last number of the pages before it.

    A mark of the form with text behind it opens a note, and so does a bare number before text where the form is any, unless
    it is a file number; a number alone on its line is the number of the next line that opens none. Other lines go on with
    the note at hand; before the first note they are a `carried` one without a number. Blank lines count for nothing.

    most_step 0: marks and lone numbers always count, bare numbers only above the last one. Else each must lie at most
    most_step above the last one, or below it where the number after it stands on the page too, as at a new chapter's start.
    The last number never falls within a page; the next page starts from the last note's.
    """
    digits = lambda pattern: pattern % most_digits
    marked = re.compile("(?:%s)\\s+(?=\\S)(.*)" % "|".join(digits(MARKS[m]) for m in FORMS[form]), re.S)
    alone = re.compile(digits(r"[(\[]?(\d{1,%d})[)\].]?"))
    bare = re.compile(digits(r"(\d{1,%d})\s+(?=\S)") + rf"(?!(?:{'|'.join(REGISTERS)})\s+\d)(.*)", re.S)

    def opening(line: str) -> tuple[int, str, bool] | None:
        """(number, text, whether it has a mark) of a line that may open a note."""
        if found := marked.fullmatch(line):
            *numbers, text = found.groups()
            return int(next(n for n in numbers if n)), text.strip(), True
        if found := bare.fullmatch(line):
            return int(found[1]), found[2].strip(), False
        return None

    def read(page: Sequence[str], last: int) -> tuple[list[dict], int]:
        lines = [line for line in ((t or "").strip() for t in page) if line]
        openings = [opening(line) for line in lines]
        here = {o[0] for o in openings if o}

        def follows(n: int, sure: bool) -> bool:
            if not most_step:
                return sure or n > last
            return last < n <= last + most_step or (n < last and n + 1 in here)

        notes: list[dict] = []
        waiting, going, after = None, False, last
        for line, opens in zip(lines, openings):
            lone = alone.fullmatch(line)
            if lone and follows(int(lone[1]), True):
                waiting, going = int(lone[1]), False
                continue
            if opens and (opens[2] or form == "any") and follows(opens[0], opens[2]):
                number, text = opens[:2]
            elif waiting is not None:
                number, text = waiting, line
            elif going:
                notes[-1]["text"] += f" {line}"
                continue
            else:
                number, text = None, line
            notes.append({"note": len(notes), "number": number, "text": text, "carried": number is None})
            waiting, going, last = None, True, max(last, number or 0)
            after = after if number is None else number
        return notes, after

    return read


def carried_notes(pages: DataFrame, read: Reader, page: Sequence[str] = PAGE, lines: str = "lines") -> DataFrame:
    """(page, note, number, text, carried) of pages (page, lines array<string>), one fold of each book in page order.

    Pages without lines give nothing and leave the count as it is. Pages of one number are an error of the caller's.
    """

    def step(rows: Iterable[Row]) -> Iterator[Row]:
        last = 0
        for row in rows:
            notes, last = read(row[lines] or (), last)
            yield from (dict(row, **n) for n in notes)

    return folded(pages.select(*page, lines), page[:-1], page[-1:], step, NOTE).drop(lines)


def tails_joined(notes: DataFrame, page: Sequence[str] = PAGE) -> DataFrame:
    """`notes` where a page's first note, if it has no number, goes to the last numbered note of the page just before.

    Without such a note there it stays. Both sides are joined by book and page; a page has one tail at most.
    """
    *book, at = page
    tail = F.col("carried") & (F.col("note") == 0)
    tails = notes.where(tail).select(*book, (F.col(at) - 1).alias(at), F.col("text").alias("_tail"))
    hosts = notes.where("number is not null").groupBy(*page).agg(F.max("note").alias("_host"))
    met = hosts.join(tails, list(page), "left")
    gone = met.where("_tail is not null").select(*book, (F.col(at) + 1).alias(at), F.lit(0).alias("note"), F.lit(True).alias("_gone"))
    out = notes.join(met, list(page), "left").join(gone, [*page, "note"], "left").where("_gone is null")
    whole = F.when((F.col("note") == F.col("_host")) & F.col("_tail").isNotNull(), F.trim(F.concat_ws(" ", "text", "_tail"))).otherwise(F.col("text"))
    return out.withColumn("text", whole).select(*notes.columns)
