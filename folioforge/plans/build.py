"""The composed build: a book's glyphs to addressed cards, by a profile, with a quality report that holds books back.

Every step is one of the operators. Body lines and cards are written at the borders between stages, so that what follows
reads them instead of going back to the glyphs, also after a lost executor. Books are groups of windows; nothing is
collected, and the tables of pages and meta data are joined by the book.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.functions import text as T
from folioforge.operators import cards as C
from folioforge.operators import folds, glyphs, hierarchy, layout, margins, qa
from folioforge.operators import sequence as S
from folioforge.sources import files

BOOK, PAGE = ["book_id"], ["book_id", "page_seq"]
MODES = ("flow", "margin", "heading", "page")
#: The templates where a profile names none.
ADDRESS, BARE_ADDRESS = "{section_prefix}{unit_type} {number}", "{unit_type} {number}"
CITATION = "{authors}, {title}, {edition}, {publisher}, {year}, {address}"
#: The reasons for which a number is in the report.
REPAIRED = ("repaired", "guessed", "unreadable", "repaired_by_neighbours")


@dataclass(frozen=True)
class Family:
    """One kind of units: how its numbers are found and what its addresses look like."""

    type: str
    id_prefix: str
    mode: str = "flow"
    pattern: str | None = None
    size_min: float | None = None
    size_max: float | None = None
    use_section: bool = True
    address_template: str | None = None


@dataclass(frozen=True)
class Profile:
    """What is particular about a kind of books."""

    id: str
    units: tuple[Family, ...]
    language: str | None = None
    jurisdiction: str | None = None
    margin_side: str = "both"
    margin_pad: float = margins.PAD
    margin_range: tuple[float, float] | None = None
    section_pattern: str | None = None
    section_anchor: str = "start"
    section_min_size: float | None = None
    address_template: str | None = None
    notes: str = "font_bottom"
    note_size_max: float | None = None
    bottom_band: float = 0.70
    folio_band: float = 0.12
    header_band: float = 0.0
    footer_band: float = 1.0
    junk: tuple[str, ...] = ()
    statutory: tuple[str, ...] = ()
    cross_refs: tuple[str, ...] = ()
    citation_template: str = CITATION

    @classmethod
    def of(cls, raw: Mapping) -> Profile:
        """From the nested form of a profile file. One `unit` in place of `units` is a list of one; mode flow is the default.

        No units, an unknown mode, a family of lines without a pattern, and what this build has no operator for (sections
        by a file's outline, notes by links or at the end) are errors.
        """
        known = {f.name for f in fields(Family)}
        units = raw.get("units") or ([raw["unit"]] if raw.get("unit") else [])
        families = tuple(Family(**{k: v for k, v in u.items() if k in known}) for u in units)
        if not families:
            raise ValueError("the profile names no units")
        for f in families:
            if f.mode not in MODES:
                raise ValueError(f"unknown mode of a unit: {f.mode}")
            if f.mode in ("flow", "heading") and not f.pattern:
                raise ValueError(f"units of the mode {f.mode} need a pattern")
        part = lambda name: raw.get(name) or {}
        section, margin, notes, junk, folio = part("address").get("section") or {}, part("margin"), part("footnotes"), part("junk"), part("printed_page")
        if section.get("mode", "none") not in ("pattern", "none"):
            raise ValueError(f"sections by {section['mode']} are not built here")
        if notes.get("mode", "font_bottom") not in ("font_bottom", "none"):
            raise ValueError(f"notes by {notes['mode']} are not built here")
        given = {
            "language": raw.get("language"),
            "jurisdiction": raw.get("jurisdiction"),
            "margin_side": margin.get("side"),
            "margin_pad": margin.get("pad"),
            "margin_range": tuple(margin["x_range"]) if margin.get("x_range") else None,
            "section_pattern": section.get("pattern") if section.get("mode") == "pattern" else None,
            "section_anchor": section.get("anchor"),
            "section_min_size": section.get("min_size"),
            "address_template": part("address").get("template"),
            "notes": notes.get("mode"),
            "note_size_max": notes.get("note_size_max"),
            "bottom_band": notes.get("bottom_band"),
            "folio_band": folio.get("band"),
            "header_band": junk.get("header_band"),
            "footer_band": junk.get("footer_band"),
            "junk": tuple(junk.get("patterns") or ()),
            "statutory": tuple(part("statutory").get("patterns") or ()),
            "cross_refs": tuple(part("cross_refs").get("patterns") or ()),
            "citation_template": part("citation").get("template"),
        }
        return cls(id=raw.get("id", ""), units=families, **{k: v for k, v in given.items() if v is not None})


def load_profile(path: str) -> Profile:
    """A profile from a YAML file (JSON is YAML too); without the yaml module only JSON is read."""
    with open(path, encoding="utf-8") as f:
        raw = f.read()
    try:
        from yaml import safe_load as load
    except ImportError:
        from json import loads as load
    return Profile.of(load(raw))


def stored(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """The rows from a table in the shared folder (at `path`, where one is given): a border between stages."""
    path = path or files.scratch(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def page_model(chars: DataFrame, pages: DataFrame, profile: Profile, place: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(lines, tokens) of pages of glyphs, as `glyphs.pages_of_glyphs` gives them, and pages (book_id, page_seq, width, height).

    lines: book_id, page_seq, line_no, text, x0, x1, top, bottom, size, width, height, printed_page, is_note. Folios, bands
    and junk are out; margin numbers are tokens (book_id, page_seq, word, text, top). Missing folios are filled from their
    neighbours; a book without any has none. A page that `pages` lacks has no lines. place: where the lines are written first.
    """
    words = F.col("words")
    if any(f.mode == "margin" for f in profile.units):
        each = glyphs.lines_of_pages(chars).select(*PAGE, F.col("row").alias("line_no"), F.inline("words"))
        each = stored(margins.margin_numbers(each, PAGE, profile.margin_side, profile.margin_pad, profile.margin_range), "words")
        tokens = each.where("is_margin").select(*PAGE, "word", F.regexp_replace(F.trim("text"), r"^[.)]+|[.)]+$", "").alias("text"), "top")
        word = F.struct("x0", "word", "text", "x1", "top", "bottom", "size")
        set_ = each.where("not is_margin").groupBy(*PAGE, "line_no").agg(F.array_sort(F.collect_list(word)).alias("words"))
    else:
        tokens = chars.where("false").select(*PAGE, F.lit(0).alias("word"), F.lit("").alias("text"), F.lit(0.0).alias("top"))
        set_ = glyphs.lines_of_pages(chars).withColumnRenamed("row", "line_no")
    size = pages.select(*PAGE, "width", "height")
    boxes = [F.array_min(words["x0"]).alias("x0"), F.array_max(words["x1"]).alias("x1"), F.array_min(words["top"]).alias("top"), F.array_max(words["bottom"]).alias("bottom"), T.median_of(words["size"]).alias("size")]
    lines = stored(set_.select(*PAGE, "line_no", F.array_join(words["text"], " ").alias("text"), *boxes).join(size, PAGE), "lines", place)
    found = layout.folios(lines, PAGE, profile.folio_band)
    known = S.filled_between(size.join(found, PAGE, "left").select(*PAGE, "printed_page"), BOOK, "page_seq", "printed_page").select(*PAGE, "printed_page")
    body = lines.join(found.select(*PAGE, F.col("folio_line").alias("line_no")), [*PAGE, "line_no"], "left_anti").join(known, PAGE)
    body = layout.without_junk(layout.without_bands(body, profile.header_band, profile.footer_band), profile.junk, profile.folio_band)
    if profile.notes == "none":
        return body.withColumn("is_note", F.lit(False)), tokens
    return layout.notes_apart(body, profile.bottom_band, profile.note_size_max, PAGE), tokens


def indexed(lines: DataFrame, profile: Profile) -> DataFrame:
    """Body lines with `i`, their place in the book, `start` and `end` in its text, and `section`.

    A section's number is the first group of its pattern, at the start of a line or anywhere; it holds until the next one.
    """
    order = ["page_seq", "line_no"]
    out = lines.where("not is_note").drop("is_note").withColumn("i", S.occurrence(BOOK, order) - 1).withColumn("start", S.offsets(F.char_length("text"), BOOK, order))
    out = out.withColumn("end", F.col("start") + F.char_length("text"))
    if profile.section_pattern is None:
        return out.withColumn("section", F.lit(None).cast("string"))
    pattern = f"^(?:{profile.section_pattern})" if profile.section_anchor == "start" else profile.section_pattern
    opens = F.regexp_like("text", F.lit(pattern))
    if profile.section_min_size is not None:
        opens = opens & (F.coalesce("size", F.lit(0.0)) >= profile.section_min_size)
    return out.withColumn("section", S.carried_forward(F.when(opens, F.regexp_extract("text", pattern, 1)), BOOK, ["i"]))


def found_units(index: DataFrame, tokens: DataFrame, profile: Profile) -> DataFrame:
    """(book_id, i, sub, rank, family, section, raw, strip, mode) of every family; rank is its place in the profile."""
    line = index.withColumn("line", F.col("text"))
    out = []
    for rank, f in enumerate(profile.units):
        if f.mode == "flow":
            hits = C.flow_units(line, f.pattern, f.id_prefix, f.size_min, f.size_max)
        elif f.mode == "heading":
            sized = line
            for bound, above in ((f.size_min, True), (f.size_max, False)):
                if bound is not None:
                    sized = sized.where(F.col("size") >= bound if above else F.col("size") <= bound)
            pattern = f"^(?:{f.pattern})"
            if re.compile(f.pattern).groups:
                hits = C.heading_units(sized, BOOK, "i", pattern, f.id_prefix)
            else:
                hits = sized.where(F.regexp_like("line", F.lit(pattern))).withColumns({"family": F.lit(f.id_prefix), "raw": S.occurrence(BOOK, ["i"]).cast("string"), "strip": F.lit(0)})
        elif f.mode == "page":
            hits = C.page_units(line, BOOK, "page_seq", "i", f.id_prefix).withColumn("raw", F.coalesce("printed_page", "page_seq").cast("string"))
        else:
            place = index.select(*PAGE, F.col("i").alias("line_no"), "top")
            near = layout.nearest_line(tokens, place, PAGE).withColumnRenamed("line_no", "i")
            at = near.join(index.select(*BOOK, "i", "section"), [*BOOK, "i"])
            sub = F.row_number().over(Window.partitionBy(*BOOK, "i").orderBy("top", "word")) - 1
            hits = at.withColumns({"family": F.lit(f.id_prefix), "raw": F.col("text"), "strip": F.lit(0), "sub": sub})
        if f.mode != "margin":
            hits = hits.withColumn("sub", F.lit(0))
        section = F.col("section") if f.use_section else F.lit(None).cast("string")
        out.append(hits.select(*BOOK, "i", "sub", F.lit(rank).alias("rank"), "family", section.alias("section"), "raw", "strip", F.lit(f.mode).alias("mode")))
    every = out[0]
    for more in out[1:]:
        every = every.unionByName(more)
    return every


def numbered(units: DataFrame) -> DataFrame:
    """Units with `number` and `action`; each series of a family in a section is read by itself, and unreadable ones stay
    in with a null number, for the report.

    A series of decimal numbers in which none stands where its neighbours want another one is read by expressions; only the
    others, whose next number depends on those read before, are folded.
    """
    series = [*BOOK, "family", "section"]

    def fold(rows):
        read = list(folds.audited(rows))
        mended = folds.repaired_by_neighbours([r for r in read if r["number"] is not None])
        told = (dict(r, action="repaired_by_neighbours") if r["number_raw"] is not None else r for r in mended)
        return chain((r for r in read if r["number"] is None), told)

    w = Window.partitionBy(*series).orderBy("i", "sub")
    n = F.when(F.regexp_like(F.trim("raw"), F.lit(r"^[0-9]{1,9}$")), F.trim("raw").cast("int"))
    before, behind = F.lag("number").over(w), F.lead("number").over(w)
    wanted = F.coalesce((F.col("number") != before + 1) & (behind == before + 2), F.lit(False))
    read = units.withColumn("number", n).withColumn("_odd", F.col("number").isNull() | wanted)
    read = read.withColumn("_odd", F.max("_odd").over(Window.partitionBy(*series)))
    plain = read.where("not _odd").drop("_odd").withColumn("action", F.lit("read"))
    return plain.unionByName(folds.folded(read.where("_odd").drop("_odd", "number"), series, ["i", "sub"], fold, "number int, action string"))


def assembled(index: DataFrame, units: DataFrame) -> DataFrame:
    """One row for each line that units open: the first unit, `absorbed` ones, text, pages, offsets, boxes.

    A unit ends with the line before the next unit of any family. Its lines know it by a running number, so a card's text is
    gathered by (book, unit) and only that card's lines meet in a task.
    """
    unit = F.struct("sub", "rank", "family", "section", "raw", "number", "strip", "mode", "action")
    opened = units.where("number is not null").groupBy(*BOOK, "i").agg(F.array_sort(F.collect_list(unit)).alias("_u"))
    lines = index.drop("section").join(opened, [*BOOK, "i"], "left").withColumn("unit", S.islands(F.col("_u").isNotNull(), BOOK, ["i"])).where("unit > 0")
    box = [F.round(v, 4) for v in (F.least(F.lit(1.0), F.min(F.col("x0") / F.col("width"))), F.least(F.lit(1.0), F.min(F.col("top") / F.col("height"))), F.greatest(F.lit(0.0), F.max(F.col("x1") / F.col("width"))), F.greatest(F.lit(0.0), F.max(F.col("bottom") / F.col("height"))))]
    by_page = lines.groupBy(*BOOK, "unit", "page_seq").agg(
        F.first("_u", ignorenulls=True).alias("_u"),
        F.collect_list(F.struct("i", "text")).alias("_t"),
        F.array(*box).alias("bbox"),
        F.min("i").alias("i"),
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.first("printed_page").alias("printed_page"),
    )
    page = F.struct("page_seq", "start", "end", "printed_page", "bbox")
    each = by_page.groupBy(*BOOK, "unit").agg(F.first("_u", ignorenulls=True).alias("_u"), F.array_sort(F.flatten(F.collect_list("_t"))).alias("_t"), F.array_sort(F.collect_list(page)).alias("_p"), F.min("i").alias("i"))
    first, pages = F.col("_u")[0], F.col("_p")
    text = F.array_join(F.transform("_t", lambda x: x["text"]), "\n")
    names = ("rank", "family", "section", "number", "mode", "action")
    return each.select(
        *BOOK,
        "unit",
        "i",
        *[first[n].alias(n) for n in names],
        F.trim(F.regexp_replace(F.substr(text, first["strip"] + 1), r"^\s+|\s+$", "")).alias("text"),
        F.transform(F.slice("_u", F.lit(2), F.size("_u")), lambda u: F.struct(u["family"].alias("family"), u["number"].alias("number"))).alias("absorbed"),
        (pages[0]["start"] + first["strip"]).alias("char_start"),
        F.element_at(pages, -1)["end"].alias("char_end"),
        pages[0]["page_seq"].alias("page_start"),
        F.element_at(pages, -1)["page_seq"].alias("page_end"),
        pages[0]["printed_page"].alias("printed_page_start"),
        F.element_at(pages, -1)["printed_page"].alias("printed_page_end"),
        F.transform(pages, lambda p: F.struct(p["page_seq"].alias("page"), p["bbox"].alias("bbox"))).alias("bbox"),
        F.transform(pages, lambda p: F.struct(p["page_seq"].alias("page_seq"), (p["end"] - p["start"]).alias("chars"))).alias("_on"),
    )


def attached(units: DataFrame, lines: DataFrame) -> DataFrame:
    """`units` with `footnotes` (page, number, text): of the units on a note's page the first whose text has its number by
    itself, else the one with most of the page. A unit's text is asked once for all notes of its pages."""
    notes = folds.folded(lines.where("is_note").select(*PAGE, "line_no", "text"), PAGE, ["line_no"], folds.page_notes, "number int, unparsed boolean")
    notes = stored(notes.withColumn("note", S.occurrence(PAGE, ["line_no"])), "notes")
    on = units.select(*BOOK, "unit", F.size("_on").alias("_pages"), F.explode("_on").alias("_o")).select(*BOOK, "unit", "_o.page_seq", "_o.chars")
    alone = F.count("*").over(Window.partitionBy(*PAGE, "note")) == 1
    pairs = notes.select(*PAGE, "note", "number").join(on, PAGE).withColumn("_alone", alone)
    asked = pairs.where("not _alone and number is not null").groupBy(*BOOK, "unit").agg(F.collect_list(F.struct("page_seq", "note", "number")).alias("_asked"))
    named = units.select(*BOOK, "unit", "text").join(asked, [*BOOK, "unit"])
    there = F.filter("_asked", lambda a: F.regexp_like(F.col("text"), F.concat(F.lit(r"(?<!\d)"), a["number"].cast("string"), F.lit(r"(?!\d)"))))
    marked = named.select(*BOOK, "unit", F.explode(there).alias("_a")).select(*BOOK, "unit", "_a.page_seq", "_a.note", F.lit(1).alias("_marked"))
    best = F.max(F.struct(F.coalesce("_marked", F.lit(0)).alias("marked"), F.when(F.col("_marked").isNull(), F.col("chars")).alias("chars"), (-F.col("unit")).alias("unit")))
    chosen = pairs.join(marked, [*PAGE, "unit", "note"], "left").groupBy(*PAGE, "note").agg(best.alias("_b")).select(*PAGE, "note", (-F.col("_b.unit")).alias("unit"))
    note = F.struct(F.col("page_seq").alias("page"), F.coalesce("number", F.lit(1_000_000)).alias("_n"), "note", "number", "text")
    own = notes.join(chosen, [*PAGE, "note"]).groupBy(*BOOK, "unit").agg(F.array_sort(F.collect_list(note)).alias("_f"))
    out = units.join(own, [*BOOK, "unit"], "left")
    some = F.transform("_f", lambda n: F.struct(n["page"].alias("page"), n["number"].alias("number"), n["text"].alias("text")))
    empty = F.expr("cast(array() as array<struct<page: int, number: int, text: string>>)")
    return out.withColumn("footnotes", F.coalesce(some, empty)).drop("_f", "_on")


def with_hierarchy(units: DataFrame, index: DataFrame, toc: DataFrame | None, levels: int = 6) -> DataFrame:
    """`units` with `hierarchy`, the titles above their first line. toc: (book_id, entry, depth, title, page)."""
    if toc is None:
        return units.withColumn("hierarchy", F.expr("cast(array() as array<string>)"))
    place = index.select(*BOOK, F.col("page_seq").alias("page"), F.col("i").alias("line_no"), F.col("text").alias("line"), "printed_page")
    entries = hierarchy.anchored(toc.select(*BOOK, "entry", "depth", "title", "page"), place).where("line_no is not null")
    stack = S.heading_stack(entries, BOOK, ["page", "depth", "entry"], "depth", "title", levels)
    last = S.keep_one(stack.select(*BOOK, F.col("line_no").cast("int").alias("i"), "page", "depth", "entry", "hierarchy"), [*BOOK, "i"], ["page", "depth", "entry"], last=True)
    out = S.as_of(units.withColumn("i", F.col("i").cast("int")), last.select(*BOOK, "i", "hierarchy"), BOOK, "i", "hierarchy")
    return out.withColumn("hierarchy", F.coalesce("hierarchy", F.expr("cast(array() as array<string>)")))


def _by_family(profile: Profile, value) -> Column:
    out = F.lit(None)
    for rank, f in enumerate(profile.units):
        out = F.when(F.col("rank") == rank, value(f)).otherwise(out)
    return out


def addressed(units: DataFrame, meta: DataFrame, profile: Profile) -> DataFrame:
    """Cards of units: ids, address and citation by the profile's templates, references. meta: one row for each book, with
    book_id and any of authors (array), title, edition, publisher, year; other plain columns can be named in the citation.
    A book without a row has blanks."""
    plain = {f.name: F.col(f"_m.{f.name}") for f in meta.schema.fields if f.dataType.typeName() not in ("array", "map", "struct") and f.name != "book_id"}
    joined = units.join(meta.select("book_id", F.struct(*[c for c in meta.columns if c != "book_id"], F.lit(True).alias("_there")).alias("_m")), BOOK, "left")
    section = F.nullif("section", F.lit(""))
    unit_type = _by_family(profile, lambda f: F.lit(f.type))
    named = {
        "unit_type": unit_type,
        "number": F.col("number"),
        "section": section,
        "section_prefix": F.when(section.isNotNull(), F.concat(F.lit("§ "), section, F.lit(" "))),
        "page": F.col("printed_page_start"),
        "hierarchy": F.array_join("hierarchy", "/"),
    }

    def address(f: Family) -> Column:
        with_section = f.address_template or profile.address_template or ADDRESS
        return F.when(section.isNotNull(), C.templated(with_section, named)).otherwise(C.templated(f.address_template or BARE_ADDRESS, named))

    ends = lambda c: F.regexp_replace(c, r"^[ ,]+|[ ,]+$", "")
    out = joined.withColumn("address", ends(_by_family(profile, address)))
    blank = {k: F.lit("") for k in ("authors", "title", "edition", "publisher", "year")}
    authors = {"authors": F.array_join("_m.authors", ", ")} if "authors" in meta.columns else {}
    cited = blank | plain | authors | {"address": F.col("address"), "unit_type": unit_type, "unit": F.col("number"), "number": F.col("number"), "section": section}
    out = out.withColumn("citation", ends(C.templated(profile.citation_template, cited)))
    prefix = {f.id_prefix: f.type for f in profile.units}
    kinds = F.create_map(*[F.lit(x) for pair in prefix.items() for x in pair])
    others = F.transform("absorbed", lambda a: F.struct(C.card_id(F.col("book_id").cast("string"), a["family"], section, a["number"]).alias("external_id"), kinds[a["family"]].alias("unit_type"), a["number"].alias("number")))
    refs = lambda patterns: T.find_all(F.col("text"), list(patterns)) if patterns else F.expr("cast(array() as array<string>)")
    return out.select(
        C.card_id(F.col("book_id").cast("string"), F.col("family"), section, F.col("number")).alias("external_id"),
        *BOOK,
        unit_type.alias("unit_type"),
        "family",
        "number",
        "section",
        "address",
        "citation",
        "text",
        "hierarchy",
        "footnotes",
        refs(profile.statutory).alias("statutory_refs"),
        refs(profile.cross_refs).alias("cross_refs"),
        others.alias("contains_also"),
        "page_start",
        "page_end",
        "printed_page_start",
        "printed_page_end",
        "char_start",
        "char_end",
        "bbox",
        F.col("mode").alias("detection_mode"),
        F.lit(profile.id).alias("profile"),
        F.lit(profile.language).alias("language"),
        F.lit(profile.jurisdiction).alias("jurisdiction"),
    )


@dataclass(frozen=True)
class Built:
    """A build's tables: cards, the body's lines, and all units with what was done to their numbers."""

    cards: DataFrame
    index: DataFrame
    units: DataFrame


def build(chars: DataFrame, pages: DataFrame, meta: DataFrame, profile: Profile, toc: DataFrame | None = None) -> Built:
    """Cards of all books of a profile. Books without body lines or units have none, and the report tells.

    chars are glyphs, a row each, or pages of them. Blank glyph tables give empty cards; null texts of glyphs count as no glyph.
    """
    paged = chars.schema["text"].dataType.typeName() == "array"
    spark, first = chars.sparkSession, files.scratch(chars.sparkSession, "lines")
    lines, tokens = page_model(chars if paged else glyphs.pages_of_glyphs(chars.where("text is not null")), pages, profile, first)
    lines = stored(lines, "body")
    files.drop(spark, first)
    index = stored(indexed(lines, profile), "index")
    units = stored(numbered(found_units(index, tokens, profile)), "units")
    place = files.scratch(spark, "assembled")
    cards = stored(addressed(with_hierarchy(attached(stored(assembled(index, units), "assembled", place), lines), index, toc), meta, profile), "cards")
    files.drop(spark, place)
    return Built(cards, index, units)


def report(built: Built, books: DataFrame) -> DataFrame:
    """One row for each of `books` (book_id): the figures of its cards, its numbers' repairs, and `stops`, a list of reasons.

    Reasons: no_cards, continuity and coverage below their bounds, duplicates. cards_without_offsets counts null offsets,
    absorbed_units those that share a card.
    """
    cards = built.cards
    series = [*BOOK, "family", "section"]
    chars = built.index.groupBy(*BOOK).agg(F.max("end").alias("book_chars"))
    n = F.char_length("text")
    of_cards = cards.groupBy(*BOOK).agg(
        F.count("*").alias("cards"),
        F.sum(F.size("footnotes")).alias("footnotes"),
        F.sum(F.when(F.size("hierarchy") == 0, 1).otherwise(0)).alias("without_hierarchy"),
        F.sum(F.when(F.col("char_start").isNull() | F.col("char_end").isNull(), 1).otherwise(0)).alias("cards_without_offsets"),
        F.sum(F.size("contains_also")).alias("absorbed_units"),
        F.min(n).alias("shortest"),
        F.max(n).alias("longest"),
    )
    of_numbers = built.units.groupBy(*BOOK).agg(*[F.sum(F.when(F.col("action") == a, 1).otherwise(0)).alias(a) for a in REPAIRED])
    doubled = qa.duplicates(cards, series, "number").groupBy(*BOOK).agg(F.count("*").alias("duplicates"))
    joined = qa.continuity(cards, BOOK, series, "number").select(*BOOK, "missing", F.col("share").alias("continuity"))
    covered = qa.coverage(cards, chars, BOOK).select(*BOOK, "book_chars", F.col("share").alias("coverage"))
    out = books.select(*BOOK).distinct()
    for part in (of_cards, of_numbers, doubled, joined, covered):
        out = out.join(part, BOOK, "left")
    zeros = ["cards", "footnotes", "without_hierarchy", "cards_without_offsets", "absorbed_units", *REPAIRED, "duplicates", "missing"]
    out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zeros})
    why = [(F.col("cards") == 0, "no_cards"), (F.col("continuity") < qa.CONTINUITY, "continuity"), (F.col("coverage") < qa.COVERAGE, "coverage"), (F.col("duplicates") > 0, "duplicates")]
    return out.withColumn("stops", F.array_compact(F.array(*[F.when(c, name) for c, name in why])))


def released(cards: DataFrame, figures: DataFrame, strict: bool = True, named: int = 20) -> DataFrame:
    """The cards, if no book of the report has an address twice: the receiver would refuse the whole file.

    strict: else an error that names some of the books; otherwise those books' cards are held back.
    """
    held = figures.where("duplicates > 0").select(*BOOK)
    if not strict:
        return cards.join(held, BOOK, "left_anti")
    some = [r["book_id"] for r in held.orderBy("book_id").limit(named).collect()]
    if some:
        raise ValueError(f"addresses occur twice in books {some}{' and others' if len(some) == named else ''}")
    return cards


def standard(chars: DataFrame, pages: DataFrame, meta: DataFrame, profile: Profile, toc: DataFrame | None = None, strict: bool = True, reflow: bool = True) -> tuple[DataFrame, DataFrame]:
    """(cards, report): page model, notes, folios, cards, hierarchy, running text, and the gate on duplicates, in this order."""
    built = build(chars, pages, meta, profile, toc)
    cards = C.reflow(built.cards, lang=profile.language or "en") if reflow else built.cards
    figures = stored(report(Built(cards, built.index, built.units), pages), "report")
    return released(cards, figures, strict), figures
