"""Cards and units: detection on line tables, assembly, notes, addresses, projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions.python import reflowed
from folioforge.operators.sequence import occurrence

#: The fields of the upload projection.
UPLOAD = ("external_id", "unit_number", "citation", "text", "hierarchy", "footnotes", "page_start", "page_end", "printed_page_start", "printed_page_end", "concept_ids")


def flow_units(lines: DataFrame, pattern: str, family: str, size_min: float | None = None, size_max: float | None = None) -> DataFrame:
    """Lines that a pattern opens; its first group is the number. A line without a size fails a bound."""
    out = lines.where(F.regexp_like("line", F.lit(f"^(?:{pattern})")))
    if size_min is not None:
        out = out.where(F.coalesce(F.col("size") >= size_min, F.lit(False)))
    if size_max is not None:
        out = out.where(F.coalesce(F.col("size") <= size_max, F.lit(False)))
    return out.withColumns({"family": F.lit(family), "raw": F.regexp_extract("line", f"^(?:{pattern})", 1), "strip": F.char_length(F.regexp_extract("line", f"^(?:{pattern})", 0))})


def page_units(lines: DataFrame, book: Sequence[str], page: str, order: str, family: str = "page") -> DataFrame:
    """The first line of each page; the page is the number."""
    first = F.row_number().over(Window.partitionBy(*book, page).orderBy(order))
    return lines.withColumn("_n", first).where("_n = 1").drop("_n").withColumns({"family": F.lit(family), "raw": F.col(page).cast("string"), "strip": F.lit(0)})


def heading_units(lines: DataFrame, book: Sequence[str], order: str, pattern: str, family: str = "heading") -> DataFrame:
    """Heading lines, numbered by the pattern's first group or else by their place in the book."""
    found = lines.where(F.regexp_like("line", F.lit(pattern)))
    number = F.nullif(F.regexp_extract("line", pattern, 1), F.lit(""))
    return found.withColumns({"family": F.lit(family), "raw": F.coalesce(number, occurrence(book, [order]).cast("string")), "strip": F.lit(0)})


def assembled(units: DataFrame, lengths: DataFrame, book: Sequence[str], start: str = "start", order: Sequence[str] = ("start", "family")) -> DataFrame:
    """One row for each line that units open: the first unit, those that it has absorbed, and where its text ends.

    lengths: (book, book_chars), where the last unit ends.
    """
    w = Window.partitionBy(*book).orderBy(start)
    each = units.groupBy(*book, start).agg(F.array_sort(F.collect_list(F.struct("family", "raw", "strip"))).alias("_units"))
    ends = each.withColumn("end", F.lead(start).over(w) - 1).join(lengths, list(book))
    first = F.col("_units")[0]
    return ends.select(*book, start, F.coalesce("end", "book_chars").alias("end"), first["family"].alias("family"), first["raw"].alias("raw"), first["strip"].alias("strip"), F.transform(F.slice("_units", F.lit(2), F.size("_units")), lambda u: F.concat_ws(" ", u["family"], u["raw"])).alias("contains_also"))


def overlapping(notes: DataFrame, units: DataFrame, book: Sequence[str], width: int = 4096) -> DataFrame:
    """`notes` with the unit that overlaps them most, ties to the first: (start, end) intervals of one book on both sides.

    Both sides are spread over bins of `width`, so that the join is an equality; a pair is judged in its first common bin.
    """
    bins = lambda df: F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(F.greatest("start", "end") / width)))
    left = notes.withColumn("_bin", bins(notes))
    right = units.select(*book, F.col("start").alias("_start"), F.col("end").alias("_end"), F.col("unit").alias("_unit"), bins(units).alias("_bin"))
    pairs = left.join(right, [*book, "_bin"]).where((F.col("_start") <= F.col("end")) & (F.col("_end") >= F.col("start")) & (F.col("_bin") == F.floor(F.greatest("start", "_start") / width)))
    most = F.max(F.struct((F.least("end", "_end") - F.greatest("start", "_start")).alias("overlap"), (-F.col("_start")).alias("first"), F.col("_unit").alias("unit")))
    return pairs.groupBy(*notes.columns).agg(most.alias("_m")).select(*notes.columns, F.col("_m.unit").alias("unit"))


def templated(template: str, fields: dict[str, Column]) -> Column:
    """`{name}` fields filled in; white space collapsed, none before commas or at the ends. An unknown field is an error."""
    import re

    parts = re.split(r"\{(\w+)\}", template)
    if unknown := {p for p in parts[1::2]} - fields.keys():
        raise KeyError(f"the template names unknown fields: {sorted(unknown)}")
    filled = F.concat(*[F.lit(p) if i % 2 == 0 else F.coalesce(fields[p].cast("string"), F.lit("")) for i, p in enumerate(parts)])
    return F.trim(F.regexp_replace(F.regexp_replace(filled, r"\s+", " "), " ,", ","))


def card_id(book: Column, family: Column, section: Column, number: Column) -> Column:
    return F.concat(book, F.lit(":"), family, F.lit(":"), F.when(F.coalesce(section, F.lit("")) != "", F.concat(section, F.lit("/"))).otherwise(F.lit("")), number.cast("string"))


def projected(cards: DataFrame, fields: Sequence[str] = UPLOAD) -> tuple[DataFrame, list[str]]:
    """The listed fields, null where a card table lacks one, and the names of the columns that go."""
    return cards.select(*[F.col(f) if f in cards.columns else F.lit(None).cast("string").alias(f) for f in fields]), sorted(set(cards.columns) - set(fields))


def gated(cards: DataFrame, stops: DataFrame, force: bool = False) -> DataFrame:
    """The cards, unless their quality report stops them."""
    if not force and not stops.isEmpty():
        raise ValueError("the quality report stops this book")
    return cards


def wire_footnotes(notes: Column) -> Column:
    """struct<notes, dropped>: notes with a text and an integer number; those without a number are counted."""
    some = F.filter(notes, lambda n: F.trim(F.coalesce(n["text"], F.lit(""))) != "")
    numbered = F.filter(some, lambda n: n["number"].try_cast("int").isNotNull())
    return F.struct(F.transform(numbered, lambda n: F.struct(n["number"].try_cast("int").alias("number"), n["text"].alias("text"))).alias("notes"), (F.size(some) - F.size(numbered)).alias("dropped"))


def ranges_covered(cards: DataFrame, book: Sequence[str], low: str = "low", high: str = "high", number: str = "number") -> DataFrame:
    """Range cards of which every number also stands alone in the same book and section."""
    ranges = cards.where(F.col(low).isNotNull() & (F.col(high) >= F.col(low)))
    single = cards.where(F.col(low).isNull()).select(*book, F.col(number).alias("_n")).distinct().withColumn("_there", F.lit(1))
    each = ranges.select(*book, low, high, F.explode(F.sequence(low, high)).alias("_n")).distinct()
    return each.join(single, [*book, "_n"], "left").groupBy(*book, low, high).agg(F.count("*").alias("_all"), F.count("_there").alias("_have")).where("_all = _have").drop("_all", "_have")


def reflow(cards: DataFrame, text: str = "text", lang: str = "en", again: bool = False) -> DataFrame:
    """Cards with running text, also in `hierarchy` and the texts of `footnotes` where a card table has them.

    Cards marked text_reflowed stay as they are, since a second run would join paragraphs; `again` takes them too.
    """
    done = F.coalesce(F.col("text_reflowed"), F.lit(False)) if "text_reflowed" in cards.columns and not again else F.lit(False)
    edit = reflowed(lang)
    out = {text: F.when(done, F.col(text)).otherwise(edit(F.col(text))), "text_reflowed": F.lit(True)}
    if "hierarchy" in cards.columns:
        out["hierarchy"] = F.when(done, F.col("hierarchy")).otherwise(reflowed(lang, many=True)(F.col("hierarchy")))
    if "footnotes" in cards.columns:
        texts = reflowed(lang, many=True)(F.transform("footnotes", lambda n: n["text"]))
        out["footnotes"] = F.when(done | F.col("footnotes").isNull(), F.col("footnotes")).otherwise(F.zip_with("footnotes", texts, lambda n, t: n.withField("text", t)))
    return cards.withColumns(out)


def unpaginated(cards: DataFrame) -> DataFrame:
    """Page cards without a folio are named by their file page: `frg.` in address and id."""
    bare = F.col("printed_page_start").isNull() & (F.col("unit_type") == "page")
    page = F.col("page_start").cast("string")
    return cards.withColumns({"address": F.when(bare, F.concat(F.lit("frg. "), page)).otherwise(F.col("address")), "external_id": F.when(bare, F.concat(F.substring_index("external_id", ":", 1), F.lit(":frg:"), page)).otherwise(F.col("external_id"))})
