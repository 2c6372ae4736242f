"""Which section a card or a note belongs to: by its hierarchy, by the next section's heading, by the export's chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.operators import cards as C
from folioforge.operators import folds
from folioforge.operators.layout import PAGE
from folioforge.operators.sequence import carried_back, islands

#: Sections named by number words and by Roman numbers, from 1 on.
NUMBER_WORDS = ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve")
ROMAN = ("i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x", "xi", "xii")
#: What opens a note, notes of digits only, characters that a card keeps, and the share of a page above which a
#: heading stands at its head.
NOTE, DIGITS, LEAST, PAGE_HEAD = r"^(\d{1,4})\.\s", r"^[\d\s.)]+$", 20, 0.125


def sectioned(cards: DataFrame, pattern: str, level: int = 0, words: bool = False, template: str = "{unit} {section}-{number}", renumber: bool = False, split_restarts: bool = False, book: Sequence[str] = ("book_id",), order: Sequence[str] = ("at",)) -> DataFrame:
    """`cards` (book, order, hierarchy, unit, number, external_id, ...) with section, address and id from their hierarchy.

    The section is the first group of `pattern` in the node at `level`; number words and Roman numbers become digits with
    `words`. renumber counts a section's cards from 1. split_restarts: a card goes to the first run of its section whose last
    number is smaller, and runs from the second on are sections of their own, `4.2`. Cards without the node keep what they
    have. The id keeps all before its last colon. One window, or one fold, of each section of a book.
    """
    key = F.regexp_extract(F.get("hierarchy", level), pattern, 1)
    found = F.coalesce(F.regexp_like(F.get("hierarchy", level), F.lit(pattern)), F.lit(False))
    if words:
        known = F.create_map(*[F.lit(x) for names in (NUMBER_WORDS, ROMAN) for k, name in enumerate(names, 1) for x in (name, str(k))])
        key = F.coalesce(F.get(F.map_values(F.map_filter(known, lambda k, v: k == F.lower(F.trim(key)))), 0), key)
    out = cards.withColumn("_key", F.when(found, key))
    if renumber:
        count = F.row_number().over(Window.partitionBy(*book, "_key").orderBy(*order)).cast(cards.schema["number"].dataType)
        out = out.withColumn("number", F.when(found, count).otherwise(F.col("number")))
    if split_restarts:
        out = folds.folded(out, [*book, "_key"], order, folds.restarts_split, "part int")
        out = out.withColumn("_key", F.when(F.col("_key").isNotNull() & (F.col("part") > 1), F.concat_ws(".", "_key", "part")).otherwise(F.col("_key"))).drop("part")
    named = F.col("_key").isNotNull()
    kept = lambda c: F.col(c) if c in cards.columns else F.lit(None).cast("string")
    address = C.templated(template, {"unit": F.rtrim(F.coalesce("unit", F.lit("")), F.lit(".")), "section": F.col("_key"), "number": F.col("number")})
    ident = F.concat(F.regexp_replace("external_id", ":[^:]*$", ""), F.lit(":"), "_key", F.lit("/"), F.coalesce(F.col("number").cast("string"), F.lit("")))
    return out.withColumns({"section": F.when(named, F.col("_key")).otherwise(kept("section")), "address": F.when(named, address).otherwise(kept("address")), "external_id": F.when(named, ident).otherwise(F.col("external_id"))}).drop("_key")


def retyped(cards: DataFrame, name: str = "Vorspann", sectionless: str | None = None) -> DataFrame:
    """`cards` (unit, unit_type, number, unit_number, section, address): number 0 is front matter of the type `name`.

    With `sectionless` a numbered card without a section loses its number, which isn't its own, and takes that for type and
    address; this also goes for number 0.
    """
    front = F.coalesce(F.col("number") == 0, F.lit(False))
    out = cards.withColumns({c: F.when(front, F.lit(name)).otherwise(F.col(c)) for c in ("unit", "unit_type")})
    if sectionless is None:
        return out
    loose = (F.coalesce("section", F.lit("")) == "") & F.col("number").isNotNull()
    new = {"unit": sectionless, "unit_type": sectionless, "address": sectionless, "unit_number": "", "number": None}
    return out.withColumns({c: F.when(loose, F.lit(v)).otherwise(F.col(c)) for c, v in new.items()})


def transferred(cards: DataFrame, switches: DataFrame, heading: str, book: Sequence[str] = ("book_id",), least: int = LEAST) -> DataFrame:
    """`cards` (book, id, page_start, page_end, top, text) where what stands behind the next section's heading goes to the heir.

    switches: (book, page, top, section), where a section begins. A card crosses the next one behind its own beginning if the
    card after it begins still later. It's cut where `heading`, a pattern with `{section}`, begins a line, at least `least`
    characters in; the tail goes before the next card's text, and pages follow: the card ends on the heading's page, or the
    one before if that stands at its head, and the heir begins there at the latest. `given` says how many characters went,
    null where a crossed heading wasn't found or there is no heir. A tail moves once. One sort of a book's cards and switches.
    """
    rows = cards.withColumns({"_page": F.col("page_start"), "_top": F.col("top"), "_side": F.lit(1), "_switch": F.lit(None).cast("string")})
    marks = switches.select(*book, F.col("page").alias("_page"), F.col("top").alias("_top"), F.lit(0).alias("_side"), F.col("section").alias("_switch"))
    both = rows.unionByName(marks, allowMissingColumns=True)
    next_switch = carried_back(F.when(F.col("_side") == 0, F.struct("_page", "_top", F.col("_switch").alias("section"))), book, ["_page", "_top", "_side"])
    w = Window.partitionBy(*book).orderBy("_page", "_top", "id")
    seen = both.withColumn("_next", next_switch).where("_side = 1").withColumn("_after", F.lead(F.struct("_page", "_top")).over(w))
    crosses = F.coalesce(F.col("_after") > F.struct(F.col("_next._page").alias("_page"), F.col("_next._top").alias("_top")), F.lit(False))
    before, behind = heading.split("{section}")
    pattern = F.concat(F.lit(f"(?m)(?=^{before}\\Q"), F.col("_next.section"), F.lit(f"\\E{behind})"))
    seen = seen.withColumn("_parts", F.when(crosses, F.split("text", pattern, 2)))
    cut = F.coalesce((F.size("_parts") == 2) & (F.char_length(F.get("_parts", 0)) >= least), F.lit(False))
    seen = seen.withColumn("_cut", cut).withColumn("_tail", F.when(F.col("_cut"), F.struct(F.trim(F.get("_parts", 1)).alias("text"), F.col("_next._page").alias("page"))))
    seen = seen.withColumn("_got", F.lag("_tail").over(w))
    own = F.when(F.col("_cut"), F.rtrim(F.regexp_replace(F.get("_parts", 0), r"\s+$", ""))).otherwise(F.col("text"))
    text = F.when(F.col("_got").isNotNull(), F.concat_ws("\n", "_got.text", own)).otherwise(own)
    end = F.when(F.col("_cut"), F.when(F.col("_next._top") > PAGE_HEAD, F.col("_next._page")).otherwise(F.col("_next._page") - 1)).otherwise(F.col("page_end"))
    given = F.when(F.col("_cut"), F.char_length(F.get("_parts", 1)))
    return seen.withColumns({"text": text, "page_end": end, "page_start": F.least("page_start", "_got.page"), "given": given}).select(*cards.columns, "given")


def chunk_notes(lines: DataFrame, opens: str, note: str = NOTE, page: Sequence[str] = PAGE, order: str = "line_no") -> DataFrame:
    """`lines` with `chunk` and `is_note`, for exports that put the notes of several pages behind the last of them.

    A chunk begins with a page on which a line matches `opens`; those lines go. Its notes begin with the first number that
    has its successor later in the chunk: a list in the text seldom counts on. A chunk without one has no notes.
    """
    *book, at = page
    text = F.trim(F.coalesce("text", F.lit("")))
    marked = lines.withColumns({"_head": F.regexp_like(text, F.lit(opens)), "_n": F.regexp_extract(text, note, 1).try_cast("int")})
    begins = F.max("_head").over(Window.partitionBy(*page)) & (F.row_number().over(Window.partitionBy(*page).orderBy(order)) == 1)
    marked = marked.withColumn("_first", begins)
    marked = marked.withColumn("chunk", islands(F.col("_first"), book, [at, order]))
    place = F.struct(F.col(at).alias("p"), F.col(order).alias("l"))
    numbers = marked.where("_n is not null").select(*book, "chunk", "_n", place.alias("_at"))
    last = numbers.groupBy(*book, "chunk", (F.col("_n") - 1).alias("_n")).agg(F.max("_at").alias("_last"))
    start = numbers.join(last, [*book, "chunk", "_n"]).where("_last > _at").groupBy(*book, "chunk").agg(F.min("_at").alias("_start"))
    out = marked.where("not _head").join(start, [*book, "chunk"], "left")
    return out.withColumn("is_note", F.coalesce(place >= F.col("_start"), F.lit(False))).select(*lines.columns, "chunk", "is_note")


def notes_to_body(lines: DataFrame, size_max: float) -> DataFrame:
    """`lines` (text, size, is_note) where note lines smaller than size_max are text again, which `moved` marks.

    A line of digits stays, since it is a note's number. Moved lines follow their page's text. Null sizes stay.
    """
    number = F.regexp_like(F.trim(F.coalesce("text", F.lit(""))), F.lit(DIGITS))
    moved = F.col("is_note") & F.coalesce(F.col("size") < size_max, F.lit(False)) & ~number
    return lines.withColumn("moved", moved).withColumn("is_note", F.col("is_note") & ~F.col("moved"))
