"""Known answers of the page model: glyphs, margins, notes, reflow, anchoring."""

import duckdb
import pytest
from pyspark.sql import functions as F

from folioforge.functions import python as P
from folioforge.functions import text as T
from folioforge.operators import cards, folds, glyphs, hierarchy, links, margins
from folioforge.plans import books

GLYPH = "book_id string, page_seq int, seq int, text string, x0 double, x1 double, top double, bottom double, size double"


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def page_of(spark, some, top=100.0):
    return frame(spark, [("b", 0, i, t, float(a), float(b), top, top + 10, 10.0) for i, (t, a, b) in enumerate(some)], GLYPH)


def words(df):
    return [r["text"] for r in glyphs.words_of_glyphs(df).orderBy("row", "word").collect()]


def test_phantom_spaces(spark):
    """A space inside a ligature, the second of two between founts, one that was sorted behind its letter, and a true one."""
    assert words(page_of(spark, [("Th", 104.88, 115.59), (" ", 110.23, 112.5), ("e", 115.6, 120)])) == ["The"]
    assert words(page_of(spark, [("m", 0, 5), (" ", 5, 7), (" ", 7, 9), ("v", 8, 13)])) == ["m v"]
    assert words(page_of(spark, [("H", 0, 6), (" ", 6.5, 8), ("o", 6.2, 11)])) == ["Ho"]
    assert words(page_of(spark, [("a", 0, 5), (" ", 5, 7), ("b", 7, 12)])) == ["a b"]


def test_gaps_part_words(spark):
    assert words(page_of(spark, [("a", 0, 5), ("b", 5, 10), ("c", 13, 18)])) == ["ab", "c"]
    assert words(page_of(spark, [("a", 0, 5), ("b", 6.7, 11.7)])) == ["ab"]  # under 0.35 of the median width
    assert words(page_of(spark, [("i", 0, 1), ("j", 1.7, 2.7), ("k", 3.6, 4.6)])) == ["ij", "k"]  # never under 0.8
    assert words(page_of(spark, [(" ", 0, 5), (" ", 5, 10)])) == []
    two = page_of(spark, [("a", 0, 5)]).union(page_of(spark, [("b", 0, 5)], 120.0))
    assert words(two) == ["a", "b"] and words(two.limit(0)) == []


def margin_page(spark, long_lines=4):
    rows = []
    for line in range(6):
        long = line < long_lines
        rows += [(line, 1, "word" * (12 if long else 1), 50.0, 300.0), (line, 2, "7", 310.0, 316.0), (line, 3, "end", 320.0, 400.0)]
    rows += [(0, 0, "12.", 20.0, 30.0), (1, 4, "13)", 420.0, 430.0), (2, 0, "12345", 20.0, 30.0), (3, 0, "14", 40.0, 49.5), (4, 0, "3/15", 20.0, 30.0), (5, 4, "99/1", 420.0, 430.0), (0, 4, "4 / 07", 420.0, 430.0)]
    return frame(spark, [("b", 1, *r) for r in rows], "book_id string, page_seq int, line_no int, word int, text string, x0 double, x1 double")


def taken(df):
    return sorted(r["text"] for r in df.where("is_margin").collect())


def test_margin_numbers(spark):
    page = margin_page(spark)
    assert taken(margins.margin_numbers(page)) == ["12.", "13)"]
    assert taken(margins.margin_numbers(page, side="left")) == ["12."]
    assert taken(margins.margin_numbers(page, side="outer")) == ["13)"] and taken(margins.margin_numbers(page, side="inner")) == ["12."]
    assert taken(margins.margin_numbers(margin_page(spark, 3))) == []  # too few long lines for edges
    assert taken(margins.margin_numbers(page, x_range=(300, 320))) == ["7"] * 6
    corridors = frame(spark, [("b", 1, 15.0, 50.0), ("b", 0, 0.0, 999.0)], "book_id string, parity int, low double, high double")
    assert taken(margins.margin_numbers(page, corridors=corridors)) == ["12.", "14"]
    kept = margins.line_texts(margins.margin_numbers(page), keep=~F.col("is_margin")).where("line_no = 1").first()
    assert kept["text"].endswith("7 end") and (kept["x0"], kept["x1"]) == (50.0, 400.0)


def test_composite_numbers(spark):
    page = margin_page(spark).where(~F.col("text").isin("12.", "12345", "14", "13)"))
    got = {r["line_no"]: (r["moved"], r["text"]) for r in margins.composite_numbers(page, 40).collect()}
    assert got[4] == ("3/15", "3/15\u00a0word 7 end") and got[0][0] == "4/7" and got[0][1].startswith("4/7\u00a0word")
    assert got[5] == (None, "word 7 end 99/1") and got[1][0] is None


def run(step, texts, **more):
    return [(r["number"], r["text"]) for r in step([{"text": t, "page": 1, **more} for t in texts])]


def test_notes_of_a_page():
    assert run(folds.page_notes, ["stray", "1. first", "goes on", "(2) second", "3", "third", "[4] d", "5) e"]) == [(1, "first goes on"), (2, "second"), (3, "third"), (4, "d"), (5, "e")]
    assert run(folds.page_notes, ["7", "8. own"]) == [(8, "own")]
    assert run(folds.page_notes, ["[9]", "x"]) == [(9, "x")]
    assert run(folds.page_notes, ["1.no space", "1234. four digits"]) == [(None, "1.no space 1234. four digits")]
    assert run(folds.page_notes, ["a", " ", "b"]) == [(None, "a  b")] and run(folds.page_notes, []) == []


def rebuilt(pages, **more):
    rows = [{"page": p, "text": t} for p, texts in pages for t in texts]
    return [(r["page"], r["number"], r["text"], r["restarted"]) for r in folds.rebuilt_notes(**more)(rows)]


def test_rebuilt_notes():
    assert rebuilt([(1, ["lost", "1 See A.", "1987 goes on", "2. B"]), (2, ["3 C", "more"])], most_digits=3) == [(1, 1, "See A. 1987 goes on", False), (1, 2, "B", False), (2, 3, "C more", False)]
    # Two notes in a line: the next number and a capital; a page reference isn't one.
    assert rebuilt([(1, ["10 Cornish, p. 232. 11 Ibid., pp. 12 ff. 12 “So”."])]) == [(1, 10, "Cornish, p. 232.", False), (1, 11, "Ibid., pp. 12 ff.", False), (1, 12, "“So”.", False)]
    # A chapter counts anew without a 1 that was read: the page is read again from zero.
    assert rebuilt([(1, ["40 D"]), (2, ["2 E", "3 F"])]) == [(1, 40, "D", False), (2, 2, "E", True), (2, 3, "F", True)]
    assert rebuilt([(1, ["5", "five", "6", "7", "seven"])], marker_line=True) == [(1, 5, "five", False), (1, 7, "seven", False)]
    assert rebuilt([(1, ["nothing"])]) == []


def tail(lines, **more):
    rows = [{"text": t, "top": float(top), "bottom": float(top + high), "size": size, "height": 1000.0} for t, top, high, size in lines]
    return [r["text"] for r in folds.note_tail(rows, **more) if r["is_note"]]


def test_note_tails_of_scans():
    body = [(f"line {i}", 100 + 20 * i, 12, 10.0) for i in range(31)]
    assert tail([*body, ("text", 720, 12, 10.0), ("1) note", 740, 12, 10.0), ("more", 760, 12, 10.0)]) == ["1) note", "more"]
    gap = [("garbled", 760, 12, 8.0), ("more", 780, 12, 8.0)]
    assert tail([*body, *gap]) == ["garbled", "more"]
    assert tail([*body, ("C. Heading", 760, 12, 10.0), ("more", 780, 12, 10.0)]) == []  # a gap, but no notes behind it
    assert tail([*body, ("low", 720, 10, 9.0), ("lower", 740, 10, 9.0)]) == ["low", "lower"]
    assert tail([*body, ("low", 720, 10, 9.6), ("lower", 740, 10, 9.6)], note_max=9.4) == ["low", "lower"]
    assert tail([*body, ("one only", 720, 10, 8.0)]) == [] and tail([]) == []


def test_running_text():
    de, en = P.SUSPENDED["de"], P.SUSPENDED["en"]
    assert P.running("Rechts-\nordnung und Vor-\nund Nachteile hier", de) == "Rechtsordnung und Vor- und Nachteile hier"
    assert P.running("Vor-\nund", en) == "Vorund" and P.running("achter­\nliggende a­ b", en) == "achterliggende ab"
    long = "a line that is as long as all the others are"
    assert P.running(f"{long}\nshort end.\n{long}", en) == f"{long} short end.\n{long}"
    assert P.running(f"{long}.\nHeading\n{long}", en) == f"{long}.\nHeading\n{long}"
    items = f"{long}\n(a) first\n{long}\n{long}.\n12. second\n– third"
    assert P.running(items, en) == f"{long}\n(a) first\n{long} {long}.\n12. second\n– third"
    assert P.running(f"{long}\n\n{long}\x07\t x", en) == f"{long}\n{long} x" and P.running(" \n\t", en) == ""


def test_reflowed_cards(spark):
    df = frame(spark, [("a-\nb", ["x­\ny"], [(1, "n\no")], False), ("a-\nb", None, None, True), (None, [], [], None)], "text string, hierarchy array<string>, footnotes array<struct<number:int,text:string>>, text_reflowed boolean")
    rows = cards.reflow(df).collect()
    assert [(r["text"], r["hierarchy"], r["footnotes"] and r["footnotes"][0]["text"]) for r in rows] == [("ab", ["xy"], "n o"), ("a-\nb", None, None), (None, [], [])]
    assert cards.reflow(cards.reflow(df)).collect() == rows


def test_swallowed_cards():
    host = {"number": 1, "section": "s", "text": "one ", "page_end": 3, "printed_page_end": 10, "char_end": 5}
    row = {"number": 1, "section": "s", "text": "again ", "page_end": 4, "printed_page_end": 12, "char_end": 9}
    (got,) = folds.backward_merged(head="{section}/{number} ")([host, row])
    assert (got["text"], got["page_end"], got["printed_page_end"], got["char_end"]) == ("one \ns/1 again", 4, 12, 9)


def test_anchors(spark):
    lines = frame(spark, [("b", 1, 11, 0, "Intro words"), ("b", 1, 11, 1, "12 The Law of Property and more"), ("b", 2, None, 2, "Quite another matter"), ("b", 3, 13, 3, "The l4w of obligatlons")], "book_id string, page int, printed_page int, line_no int, line string")
    entries = frame(spark, [("b", 1, "The law of property and", 11), ("b", 2, "quite another", 12), ("b", 3, "The law of obligations", 12), ("b", 4, "Nothing alike at all here", 13), ("b", 5, "Before the start of it", 5), ("b", 6, "Far behind zzzz", 40), ("b", 7, "…", 11)], "book_id string, entry int, title string, page int")
    got = {r["entry"]: (r["line_no"], r["by_page"]) for r in hierarchy.anchored(entries, lines).collect()}
    assert got == {1: (1, False), 2: (2, False), 3: (3, False), 4: (3, True), 5: (-1, True), 6: (None, True), 7: (None, False)}


@pytest.mark.parametrize("raw, numbers", [("B", [3, 8]), ("1G", [15, 16]), ("D?7", [7]), ("12?", []), ("", []), ("SB3", [533, 538, 583, 588, 833, 838, 883, 888])])
def test_readings(raw, numbers):
    assert folds.readings(raw) == numbers


def test_readings_are_bounded():
    assert len(folds.readings("B" * 20)) == 128 and folds.readings("B" * 20)[0] == 3333333


def test_torn_ligatures(spark):
    row = spark.range(1).select(T.rejoin_ligatures(F.lit("a fi nal Th e e ffi cient fl ow of fish")))
    assert row.first()[0] == "a final The e efficient flow of fish" or row.first()[0].startswith("a final The")


def test_notes_from_links(spark):
    """A split page whose last note goes on over the page, a page that is one note, a cross-reference, a mark that is too large."""
    lines = [(1, 0, "x" * 1300, 10.0), (2, 0, "1. first", 8.0), (2, 1, "goes on", 8.0), (2, 2, "2. second", 8.0), (3, 0, "its tail", 8.0), (3, 1, "3. third", 8.0), (3, 2, "4. fourth", 8.0), (4, 0, "one note", 8.0), (4, 1, "whole", 8.0), (5, 0, "12 Droit", 8.0), (5, 1, "13 Autre", 8.0)]
    model = frame(spark, [("b", *r) for r in lines], "book_id string, page_seq int, line_no int, text string, size double")
    glyph = [("1", 10, 6.0), ("2", 30, 6.0), ("7", 50, 6.0), ("9", 70, 6.0), ("x", 90, 10.0), *[("y", 200 + k, 10.0) for k in range(6)], ("5", 110, 9.9)]
    chars = frame(spark, [("b", 1, t, float(x), x + 4.0, 100.0, 106.0, size) for t, x, size in glyph], "book_id string, page_seq int, text string, x0 double, x1 double, top double, bottom double, size double")
    rects = [(0, 10, 2), (1, 30, 2), (2, 50, 4), (3, 70, 5), (4, 110, 4), (5, 10, 4)]
    found = frame(spark, [("b", 1, n, x - 1.0, 693.0, x + 5.0, 701.0, to, 800.0) for n, x, to in rects], "book_id string, page_seq int, link int, x0 double, y0 double, x1 double, y1 double, target int, height double")
    marks = links.link_marks(found, chars)
    assert {r["link"]: (r["mark"], r["number"]) for r in marks.collect()} == {0: ("1", 1), 1: ("2", 2), 2: ("7", 7), 3: ("9", 9), 4: ("", None), 5: ("1", 1)}
    pages = links.body_pages(model)
    assert {(r["page_seq"]): (r["seed"], r["body"]) for r in pages.collect()} == {1: (True, True), 2: (False, False), 3: (False, False), 4: (False, False), 5: (False, True)}
    assert {r["page_seq"] for r in links.body_pages(model, note_max=8.0).where("body").collect()} == {1}
    got = {(r["page_seq"], r["number"]): r["text"] for r in links.notes_from_links(marks, model, pages).collect()}
    assert got == {(1, 1): "first goes on", (1, 2): "second", (1, 7): "one note whole"}
    assert {(r["page_seq"], r["number"]): r["text"] for r in links.note_texts(model.where("page_seq in (2, 3)")).where("number is not null").collect()} == {(2, 1): "first goes on", (2, 2): "second its tail", (3, 3): "third", (3, 4): "fourth"}


def test_patches_go_where_they_overlap_most(spark):
    import random

    rnd = random.Random(4)
    lines = [("b", p, n, t := n * 13.0 + rnd.random() * 6, t + 9.0 + rnd.random() * 5) for p in range(3) for n in range(12)]
    words = [("b", p, k, "w", rnd.random() * 300, 400.0, t := rnd.random() * 220 - 20, t + rnd.random() * 15) for p in range(3) for k in range(40)]
    got = links.placed_patches(frame(spark, words, "book_id string, page_seq int, patch int, text string, x0 double, x1 double, top double, bottom double"), frame(spark, lines, "book_id string, page_seq int, line_no int, top double, bottom double")).collect()
    for r in got:
        fits = [(min(b + 2, r["bottom"]) - max(t - 2, r["top"]), -n) for _, p, n, t, b in lines if p == r["page_seq"] and t - 2 <= (r["top"] + r["bottom"]) / 2 <= b + 2]
        best = max((f for f in fits if f[0] > 0), default=None)
        assert r["line_no"] == (None if best is None else -best[1]) and (r["new_row"] is None) == (best is not None)
    rows = sorted((r["page_seq"], r["top"], r["new_row"]) for r in got if r["new_row"] is not None)
    first = {}
    for p, top, n in rows:
        assert abs(first.setdefault((p, n), top) - top) <= 4
    assert len(got) == 120 and rows


def test_spliced_lines(spark):
    lines = frame(spark, [("b", 0, 0, 100.0, 110.0)], "book_id string, page_seq int, line_no int, top double, bottom double")
    words_ = frame(spark, [("b", 0, 0, "left", 0.0, 20.0), ("b", 0, 0, "right", 60.0, 80.0)], "book_id string, page_seq int, line_no int, text string, x0 double, x1 double")
    new = frame(spark, [("b", 0, 0, "mid", 30.0, 50.0, 101.0, 109.0), ("b", 0, 1, "title", 40.0, 90.0, 50.0, 60.0), ("b", 0, 2, "A", 0.0, 9.0, 53.0, 63.0)], "book_id string, page_seq int, patch int, text string, x0 double, x1 double, top double, bottom double")
    got = {(r["line_no"], r["new_row"]): (r["text"], r["x0"], r["x1"]) for r in links.spliced(words_, new, lines).collect()}
    assert got == {(0, None): ("left mid right", 0.0, 80.0), (None, 0): ("A title", 0.0, 90.0)}


def as_its_sql(spark, folder, name, texts):
    """A query's rows over documents of these texts, and its SQL's."""
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"source": F.lit("s"), "lang": F.lit("en")}).write.parquet(f"{folder}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{folder}/documents.parquet/*.parquet'")
    want = con.sql(books.ORACLES[name])
    got = books.QUERIES[name](spark, str(folder)).select(*want.columns)
    return sorted(map(tuple, got.collect())), sorted(want.fetchall())


def test_numbers_at_the_end_of_long_lines_are_text(spark, tmp_path):
    """A line longer than the page's others ends in a number, and one begins with a number."""
    texts = ["\n".join([f"{'word ' * 9}end"] * 4 + [f"{'word ' * 12}version 3.", f"1987 {'word ' * 9}end"] + [f"2 {'word ' * 12}"] * 6)]
    got, want = as_its_sql(spark, tmp_path, "margin_numbers", texts)
    assert got == want == [(0, 0, "0"), (0, 3, "3"), (0, 6, "6"), (0, 9, "9")]


def test_glyphs_of_more_lines_than_a_small_number_holds(spark, tmp_path):
    """A page of 2400 lines, and one without text: the place of a glyph in the stream was an int, and too large from line 1074 on."""
    got, want = as_its_sql(spark, tmp_path, "glyph_words", ["\n".join(["eine Zeile  mit ätzenden", " zwei Wörter\t"] * 1200), None, " \n"])
    assert got == want and len(got) == 2400


def moves(query):
    """How often a query's plan moves rows between tasks."""
    return query._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_words_with_their_lines_move_once(spark):
    assert moves(books.QUERIES["margin_composites"](spark, "/root/testdata/sf0.001")) == 1


def test_notes_lines_move_once(spark, tmp_path):
    """Texts move by their book alone; numbers go on over a hundred documents, and blank lines and no text count for nothing."""
    texts = {1: "a\n\nb\nc", 2: None, 3: "d\ne\nf\ng", 100: "h"}
    spark.createDataFrame([(k, v, "s") for k, v in texts.items()], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = books.note_lines(spark, str(tmp_path))
    assert moves(got) == moves(books.QUERIES["notes_rebuilt"](spark, str(tmp_path))) == 1
    assert sorted(map(tuple, got.collect())) == [("s", 1, 0, "1. a"), ("s", 1, 2, "b"), ("s", 1, 3, "3. c"), ("s", 3, 0, "4. d"), ("s", 3, 1, "e"), ("s", 3, 2, "f"), ("s", 3, 3, "7. g"), ("s", 100, 0, "1. h")]


def test_words_stay_with_their_page(spark, tmp_path):
    got, want = as_its_sql(spark, tmp_path, "cluster_lines", ["one  two\n\n three\t", None, "", " \n", "ä\x0bb\n" * 30])
    assert got == want and len(got) == 32
    assert moves(books.QUERIES["cluster_lines"](spark, str(tmp_path))) == 0
