"""Sections of cards and notes, and quality figures, with known answers."""

from pyspark.sql import functions as F

from folioforge.operators import qa, relational, sections

CARD = "book_id int, at int, hierarchy array<string>, unit string, number int, external_id string"


def shown(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_sections_from_the_hierarchy(spark):
    rows = [(1, 0, ["Part IV"], "Rn.", 426, "b:rn:426"), (1, 1, ["Part IV"], "Rn.", 116, "b:rn:116"), (1, 2, ["Part IV"], "Rn.", 427, "b:rn:427"), (1, 3, ["Part IV"], "Rn.", 117, "b:rn:117"),
            (1, 4, ["Part IV"], "Rn.", None, "b:rn:x"), (1, 5, None, "Rn.", 1, "b:rn:1"), (1, 6, ["Index"], "Rn.", 2, "b:rn:2"), (1, 7, ["Index"], "Rn.", 1, "b:rn:1b"), (1, 8, ["Part XX"], None, 5, "plain")]
    got = sections.sectioned(spark.createDataFrame(rows, CARD), r"^Part (\w+)", words=True, split_restarts=True).orderBy("at")
    assert shown(got, "section", "address", "external_id") == [
        ("4", "Rn 4-426", "b:rn:4/426"), ("4.2", "Rn 4.2-116", "b:rn:4.2/116"), ("4", "Rn 4-427", "b:rn:4/427"), ("4.2", "Rn 4.2-117", "b:rn:4.2/117"),
        ("4", "Rn 4-", "b:rn:4/"), (None, None, "b:rn:1"), (None, None, "b:rn:2"), (None, None, "b:rn:1b"), ("XX", "XX-5", "plain:XX/5")]
    again = sections.sectioned(spark.createDataFrame(rows, CARD), r"^Part (\w+)", renumber=True).orderBy("at")
    assert shown(again, "number") == [(1,), (2,), (3,), (4,), (5,), (1,), (2,), (1,), (1,)]
    assert sections.sectioned(spark.createDataFrame([], CARD), "(x)", split_restarts=True).count() == 0


def test_front_matter_and_cards_without_a_section(spark):
    rows = [(0, "5"), (3, "5"), (2019, None), (0, ""), (None, None)]
    cards = spark.createDataFrame([("Rn.", "Rn.", n, str(n), s, "a") for n, s in rows], "unit string, unit_type string, number int, unit_number string, section string, address string")
    assert shown(sections.retyped(cards), "unit_type", "number") == [("Vorspann", 0), ("Rn.", 3), ("Rn.", 2019), ("Vorspann", 0), ("Rn.", None)]
    assert shown(sections.retyped(cards, sectionless="Vorwort"), "unit_type", "number", "unit_number", "address") == [("Vorspann", 0, "0", "a"), ("Rn.", 3, "3", "a"), ("Vorwort", None, "", "Vorwort"), ("Vorwort", None, "", "Vorwort"), ("Rn.", None, "None", "a")]


def test_tails_go_to_the_heir(spark):
    own = "own text of enough length"
    rows = [(1, 0, 1, 2, 0.5, f"{own} \n§ 2. Heading\nmore"), (1, 1, 3, 3, 0.2, f"{own}, cites § 3. there"), (1, 2, 4, 4, 0.2, f"{own}\n§ 4. x"), (2, 0, 1, 1, 0.1, f"{own}\n§ 2. last"), (3, 0, 1, 1, 0.0, "short\n§ 2. x"), (3, 1, 2, 2, 0.0, None)]
    cards = spark.createDataFrame(rows, "book_id int, id int, page_start int, page_end int, top double, text string")
    switches = spark.createDataFrame([(1, 2, 0.1, "2"), (1, 3, 0.9, "3"), (2, 1, 0.5, "2"), (3, 1, 0.5, "2"), (9, 1, 0.0, "7")], "book_id int, page int, top double, section string")
    got = sections.transferred(cards, switches, r"§ {section}\.").orderBy("book_id", "id")
    assert shown(got, "page_start", "page_end", "text", "given") == [
        (1, 1, own, 17), (2, 3, f"§ 2. Heading\nmore\n{own}, cites § 3. there", None), (4, 4, f"{own}\n§ 4. x", None), (1, 1, f"{own}\n§ 2. last", None), (1, 1, "short\n§ 2. x", None), (2, 2, None, None)]
    assert shown(sections.transferred(cards, switches.where("false"), r"§ {section}\.").where("given is not null"), "id") == []


def test_notes_behind_their_chunk(spark):
    texts = [(0, 0, "Export"), (0, 1, "7. a list"), (0, 2, "1. b"), (1, 0, "2. c"), (1, 1, None), (2, 0, "x"), (2, 1, "Export"), (2, 2, "4. d"), (3, 0, "Export"), (3, 1, "1. e"), (4, 0, "2. f")]
    lines = spark.createDataFrame([(1, *t) for t in texts], "book_id int, page_seq int, line_no int, text string")
    got = sections.chunk_notes(lines, "^Export").orderBy("page_seq", "line_no")
    assert shown(got, "text", "chunk", "is_note") == [("7. a list", 1, False), ("1. b", 1, True), ("2. c", 1, True), (None, 1, True), ("x", 2, False), ("4. d", 2, False), ("1. e", 3, True), ("2. f", 3, True)]


def test_small_notes_are_text_but_for_numbers(spark):
    lines = spark.createDataFrame([("a", 4.5, True), ("12.)", 4.5, True), ("b", 4.8, True), ("c", None, True), ("d", 4.0, False), (None, 4.0, True)], "text string, size double, is_note boolean")
    assert shown(sections.notes_to_body(lines, 4.8), "is_note", "moved") == [(False, True), (True, False), (True, False), (True, False), (False, False), (False, True)]


def test_figures(spark):
    rows = spark.createDataFrame([("b", 1, "x", "i"), ("b", 2, "y", "i"), ("b", 3, None, None), ("b", 4, "y", "j"), ("b", 5, "x", None)], "book string, n int, v string, id string")
    assert sorted(shown(qa.tallies(rows, ["book"], ["v", "id"]), "column", "value", "n"), key=str) == [("id", "i", 2), ("id", "j", 1), ("id", None, 2), ("v", "x", 2), ("v", "y", 2), ("v", None, 1)]
    assert shown(qa.voted(rows, ["book"], "v", "n"), "v", "votes") == [("x", 2)]
    assert shown(qa.rising_share(rows, ["book"], [F.desc("n")], "n"), "steps", "share") == [(4, 0.0)]
    assert shown(qa.rising_share(rows.limit(1), ["book"], ["n"], "n"), "steps", "share") == [(0, None)]
    cards = spark.createDataFrame([("b", "i", "a\x02\n", [None, 1]), ("b", "i", None, None), ("b", None, "\x07\x08", [None])], "book string, external_id string, text string, note_numbers array<int>")
    assert shown(qa.look_first(cards, ["book"]), "control_characters", "id_collisions", "unnumbered_notes") == [(3, 1, 2)]
    expected = spark.createDataFrame([("b", "x", 2), ("b", "z", 1)], "book string, v string, expected int")
    assert sorted(shown(qa.against_expected(rows.where("v is not null"), expected, ["book"], "v"), "v", "cards", "expected", "fits")) == [("x", 2, 2, True), ("y", 2, 0, False), ("z", 0, 1, False)]


def test_vectors_and_places(spark):
    texts = spark.createDataFrame([("[1, 2.5]",), ("[1]",), ("[1,",), ('[1, "a"]',), ("{}",), (None,), ("[1, null]",)], "t string")
    assert [r[0] for r in texts.select(relational.vector_of(F.col("t"), 2)).collect()] == [[1.0, 2.5], None, None, None, None, None, None]
    cards = spark.createDataFrame([(1, None, 0.1), (2, 3, 0.5), (3, 3, None), (4, 2, 0.9)], "id int, page int, top double")
    assert [r.id for r in cards.orderBy(relational.card_place(cards.page, cards.top)).collect()] == [4, 3, 2, 1]
    pages = spark.createDataFrame([("b", k, None if k == 2 else k, k) for k in range(6)], "book string, id int, printed_page_start int, printed_page_end int")
    assert shown(relational.printed_page_batches(pages, ["book"], "id", 2).orderBy("id"), "id", "batch") == [(0, 0), (1, 0), (3, 1), (4, 1), (5, 2)]
