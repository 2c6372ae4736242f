"""Known answers of the composed build, on pages set by hand."""

import os

import pytest
from pyspark.sql import functions as F

from folioforge.operators import folds, glyphs
from folioforge.plans import build as B

GLYPH = "book_id string, page_seq int, seq int, text string, x0 double, x1 double, top double, bottom double, size double"
PAGES = "book_id string, page_seq int, width double, height double"
META = "book_id string, authors array<string>, title string, year int"


def setting(spark, books):
    """Glyphs and pages of {book: [[(text, top, size, x)]]}: pages of lines, a character five points wide."""
    rows, pages = [], []
    for book, some in books.items():
        for p, lines in enumerate(some):
            pages.append((book, p, 600.0, 700.0))
            for line in lines:
                text, top, size, x = (*line, 100.0)[:4] if len(line) == 3 else line
                rows += [(book, p, len(rows) + k, c, x + 5.0 * k, x + 5.0 * k + 5, top, top + 10, size) for k, c in enumerate(text) if c != " "]
    meta = [(book, ["A", "B"], "T", 2020) for book in books]
    return spark.createDataFrame(rows, GLYPH), spark.createDataFrame(pages, PAGES), spark.createDataFrame(meta, META)


def profile(**more):
    return B.Profile.of({"id": "p", "units": [{"type": "Rn.", "id_prefix": "rn", "pattern": r"#(\w+) "}]} | more)


def page(*texts, folio=None, notes=()):
    """Body lines from the top, small note lines low on the page, and a folio at its foot."""
    body = [(t, 100.0 + 20 * i, 10.0) for i, t in enumerate(texts)]
    return body + [(t, 560.0 + 12 * i, 7.0) for i, t in enumerate(notes)] + ([(folio, 680.0, 10.0)] if folio else [])


def built(spark, books, prof=None, toc=None):
    return B.build(*setting(spark, books), prof or profile(), toc)


def test_cards_over_pages_with_notes_and_folios(spark):
    books = {"b": [page("before", "#1 one", "more", "#2 two has 7 here", folio="41", notes=["6. six", "7. seven"]), page("two goes on", "to its end", notes=["1. own"])]}
    cards = {r["number"]: r for r in built(spark, books, profile(citation={"template": "{authors}, {title} {year} , {address}"}, statutory={"patterns": [r"t[a-z]o"]})).cards.collect()}
    assert sorted(cards) == [1, 2]
    one, two = cards[1], cards[2]
    assert (one["text"], two["text"]) == ("one\nmore", "two has 7 here\ntwo goes on\nto its end")
    assert (one["external_id"], one["address"], one["citation"]) == ("b:rn:1", "Rn. 1", "A, B, T 2020, Rn. 1")
    assert (one["char_start"], one["char_end"], two["char_start"]) == (len("before\n#1 "), len("before\n#1 one\nmore"), len("before\n#1 one\nmore\n#2 "))
    assert (two["page_start"], two["page_end"], two["printed_page_start"], two["printed_page_end"]) == (0, 1, 41, 42)
    notes = lambda c: [(n["page"], n["number"], n["text"]) for n in c["footnotes"]]
    # 7 stands in the second unit; 6 in neither, so it goes to the one with most of the page; the next page is the second's.
    assert notes(two) == [(0, 6, "six"), (0, 7, "seven"), (1, 1, "own")] and notes(one) == []
    assert two["statutory_refs"] == ["two"]
    assert [b["page"] for b in two["bbox"]] == [0, 1] and one["bbox"][0]["bbox"] == [0.1667, 0.1714, round(130 / 600, 4), round(150 / 700, 4)]


def test_sections_restart_numbers_and_families_share_lines(spark):
    prof = B.Profile.of({
        "units": [{"type": "Rn.", "id_prefix": "rn", "pattern": r"#(\d+) "}, {"type": "Fall", "id_prefix": "fall", "pattern": r"#\d+ Case (\d+)", "use_section": False}],
        "address": {"section": {"mode": "pattern", "pattern": r"§(\d+)", "min_size": 11.0}, "template": "{section_prefix}{unit_type} {number}"},
    })
    lines = [("§1 head", 100.0, 12.0), ("#1 Case 1 a", 120.0, 10.0), ("§9 is cited", 140.0, 10.0), ("§2 head", 160.0, 12.0), ("#1 b", 180.0, 10.0)]
    out = built(spark, {"b": [lines]}, prof)
    cards = {r["external_id"]: r for r in out.cards.collect()}
    assert sorted(cards) == ["b:rn:1/1", "b:rn:2/1"] and cards["b:rn:1/1"]["address"] == "§ 1 Rn. 1"
    assert [(c["external_id"], c["unit_type"]) for c in cards["b:rn:1/1"]["contains_also"]] == [("b:fall:1/1", "Fall")]
    figures = B.report(out, spark.createDataFrame([("b",), ("none",)], "book_id string")).orderBy("book_id").collect()
    assert (figures[0]["absorbed_units"], figures[0]["duplicates"], figures[1]["cards"], figures[1]["stops"]) == (1, 0, 0, ["no_cards"])


def test_margin_numbers_open_units(spark):
    text = "a line of the body that is long enough to give the page its edges"
    lines = [(text, 100.0 + 20 * i, 10.0) for i in range(6)] + [("1", 100.0, 10.0, 40.0), ("2", 161.0, 10.0, 40.0)]
    prof = B.Profile.of({"unit": {"type": "Rn.", "id_prefix": "rn", "mode": "margin"}})
    cards = built(spark, {"b": [lines]}, prof).cards.orderBy("number").collect()
    assert [(c["number"], c["text"]) for c in cards] == [(1, "\n".join([text] * 3)), (2, "\n".join([text] * 3))]


def test_numbers_are_read_repaired_and_reported(spark):
    """An expected reading, one digit between agreeing neighbours, an unreadable number, and a plain series beside them."""
    rows = [("b", i, 0, 0, "rn", "1", raw, 0, "flow") for i, raw in enumerate(["9", "l0", "41", "12", "xyw"])]
    rows += [("b", i, 0, 0, "rn", None, raw, 0, "flow") for i, raw in enumerate(["3", "5", "4"])] + [("b", 9, 0, 0, "rn", "", "", 0, "flow")]
    units = spark.createDataFrame(rows, "book_id string, i int, sub int, rank int, family string, section string, raw string, strip int, mode string")
    got = B.numbered(units)
    of = lambda s: [(r["number"], r["action"]) for r in got.where(F.col("section").eqNullSafe(s)).orderBy("i").collect()]
    assert of("1") == [(9, "read"), (10, "repaired"), (11, "repaired_by_neighbours"), (12, "read"), (None, "unreadable")]
    assert of(None) == [(3, "read"), (5, "read"), (4, "read")] and of("") == [(None, "unreadable")]


def test_plain_series_are_as_folded_ones(spark):
    import random

    rng = random.Random(3)
    rows = [("b", i, 0, 0, "rn", str(s), str(n if rng.random() < 0.8 else rng.randint(1, 40)), 0, "flow") for s in range(60) for i, n in enumerate(range(1, rng.randint(2, 16)))]
    schema = "book_id string, i int, sub int, rank int, family string, section string, raw string, strip int, mode string"
    got = {(r["section"], r["i"]): r["number"] for r in B.numbered(spark.createDataFrame(rows, schema)).collect()}
    for s in range(60):
        series = [dict(zip(("book_id", "i", "sub", "rank", "family", "section", "raw", "strip", "mode"), r)) for r in rows if r[5] == str(s)]
        want = {(str(s), r["i"]): r["number"] for r in folds.repaired_by_neighbours(folds.validated(series))}
        assert {k: v for k, v in got.items() if k[0] == str(s)} == want


def test_hierarchy_from_contents(spark):
    toc = spark.createDataFrame([("b", 0, 0, "PART ONE", 41), ("b", 1, 1, "First title", 41), ("b", 2, 0, "PART TWO", 42)], "book_id string, entry int, depth int, title string, page int")
    books = {"b": [page("Part one", "First title", "#1 one", folio="41"), page("more", "Part two", "#2 two", folio="42")]}
    cards = built(spark, books, toc=toc).cards.orderBy("number").collect()
    assert [c["hierarchy"] for c in cards] == [["PART ONE", "First title"], ["PART TWO"]]


def test_duplicates_stop_the_pipeline(spark):
    books = {"good": [page("#1 a text of more than fifty characters, as units have", "#2 another text of more than fifty characters, as units have")], "twice": [page("#1 a text of more than fifty characters, as units have", "#1 another text of more than fifty characters, as units have")]}
    cards, figures = B.standard(*setting(spark, books), profile(), strict=False)
    assert {r["book_id"] for r in cards.collect()} == {"good"}
    assert {r["book_id"]: r["stops"] for r in figures.collect()} == {"good": [], "twice": ["duplicates"]}
    with pytest.raises(ValueError, match="twice"):
        B.standard(*setting(spark, books), profile())


def test_known_share_of_a_book_with_a_gap(spark):
    """186 cards with a step from 98 to 116: 17 missing, 0.9163, stopped for it."""
    numbers = [n for n in range(1, 204) if not 98 < n < 116]
    pages = [page(*[f"#{n} a text of more than fifty characters, as units have" for n in numbers[i : i + 20]]) for i in range(0, len(numbers), 20)]
    out = built(spark, {"b": pages})
    row = B.report(out, spark.createDataFrame([("b",)], "book_id string")).first()
    assert (row["cards"], row["missing"], row["continuity"], row["stops"]) == (186, 17, 0.9163, ["continuity"])


def test_empty_tables_and_profiles_that_fail(spark):
    glyphs, pages, meta = setting(spark, {"b": [page("#1 a")]})
    assert B.build(glyphs.limit(0), pages, meta, profile()).cards.count() == 0
    assert B.build(glyphs, pages.limit(0), meta.limit(0), profile()).cards.count() == 0
    with pytest.raises(ValueError, match="no units"):
        B.Profile.of({"id": "p"})
    with pytest.raises(ValueError, match="unknown mode"):
        B.Profile.of({"units": [{"type": "a", "id_prefix": "a", "mode": "odd"}]})
    with pytest.raises(ValueError, match="pattern"):
        B.Profile.of({"units": [{"type": "a", "id_prefix": "a"}]})


def test_profiles_from_files(tmp_path):
    path = tmp_path / "p.yaml"
    path.write_text('{"id": "p", "unit": {"type": "Rn.", "id_prefix": "rn", "pattern": "x", "note": 1}, "margin": {"side": "outer", "x_range": [1, 2]}}')
    got = B.load_profile(str(path))
    assert (got.units[0].mode, got.margin_side, got.margin_range) == ("flow", "outer", (1, 2))


def test_contents_in_two_columns(spark):
    """A number a little lower than its title, one far from any, leaders, a missing page, and a row without a marker."""
    from folioforge.operators import contents

    words = [("§ 1. First . . . .", 50.0, 10.0), ("7", 400.0, 14.0), ("§ 2. Second ..... 9", 50.0, 30.0), ("a) inner", 80.0, 50.0), ("99", 400.0, 63.0), ("not an entry", 50.0, 80.0), ("§ 3. Third", 50.0, 100.0), ("12", 400.0, 101.0), ("§ 4. Last", 50.0, 120.0)]
    frame = spark.createDataFrame([("b", 0, *w) for w in words], "book_id string, page_seq int, text string, x0 double, top double")
    markers = [(r"§\s*(\d+)\.\s*", "paragraph", 1), (r"([a-z])\)\s*", "lower", 4)]
    of = lambda df: [(r["number"], r["title"], r["depth"], r["printed_page"], r["inherited"]) for r in df.orderBy("row").collect()]
    want = [("1", "First", 1, 7, False), ("2", "Second", 1, 9, False), ("a", "inner", 4, 12, True), ("3", "Third", 1, 12, False), ("4", "Last", 1, None, True)]
    assert of(contents.entries(frame, 300.0, markers)) == want
    assert of(contents.entries(frame, 300.0, markers, indents=[(70.0, 90.0, 3)]))[2][2] == 3
    assert of(contents.entries(frame.limit(0), 300.0, markers)) == []


def test_pages_of_glyphs_build_like_glyphs(spark):
    """Glyphs of a page may be one row; tables between the first and the last stages don't stay in the shared folder."""
    chars, pages, meta = setting(spark, {"b": [page("#1 one", "more", folio="1", notes=["1. own"])], "c": [page("#1 three")]})
    want = B.build(chars, pages, meta, profile()).cards.orderBy("external_id").collect()
    place = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = set(os.listdir(place))
    assert B.build(glyphs.pages_of_glyphs(chars), pages, meta, profile()).cards.orderBy("external_id").collect() == want and len(want) == 2
    assert {f.split("-")[0] for f in set(os.listdir(place)) - before} == {"body", "index", "units", "notes", "cards"}
