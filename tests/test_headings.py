"""Parted headings and carried notes with known answers, and the stream against the batch fold."""

import random

from folioforge.operators import carried, headings
from folioforge.streaming import events
from folioforge.streaming import notes as streamed

LINE = "book_id int, page_seq int, line_no int, text string, size double, top double, x0 double, x1 double"


def lines(spark, *texts, page=0):
    """(text, size) rows, or text alone for size 12."""
    rows = [(t, 12.0) if not isinstance(t, tuple) else t for t in texts]
    return spark.createDataFrame([(1, page, n, t, s, n * 10.0, 100.0 - n, 200.0 + n) for n, (t, s) in enumerate(rows)], LINE)


def shown(df):
    return [(r.page_seq, r.line_no, r.text) for r in df.orderBy("page_seq", "line_no").collect()]


def test_heading_above(spark):
    got = headings.joined_above(lines(spark, "Volume 1", "No Consideration", "Required", "1-136", ("small", 9.0), "1-137", "tail 1999", "Of Age", "1-138", None, "1-139"), r"^\d-\d{3}$", most=2, head_start="^[A-Z]", skip=["^Volume"])
    assert shown(got) == [(0, 0, "Volume 1"), (0, 3, "1-136 No Consideration Required"), (0, 4, "small"), (0, 5, "1-137"), (0, 6, "tail 1999"), (0, 8, "1-138 Of Age"), (0, 9, None), (0, 10, "1-139")]
    number = got.where("line_no = 3").first()
    assert (number.joined, number.top, number.x0, number.x1) == (2, 10.0, 97.0, 203.0)
    assert headings.joined_above(lines(spark, "a").where("false"), "^1$").count() == 0


def test_heading_below_and_over_the_page(spark):
    first, second = lines(spark, ("31", 13.0), ("Small", 9.0), ("31", 8.0), ("32", 13.0)), lines(spark, (" ", 13.0), ("Categories", 14.0), ("33", 13.0), ("34", 13.0), ("Goods", 13.0), ("35", 13.0), page=1)
    got = headings.joined_below(first.unionByName(second))
    assert shown(got) == [(0, 0, "31"), (0, 1, "Small"), (0, 2, "31"), (0, 3, "32 Categories"), (1, 0, " "), (1, 2, "33"), (1, 3, "34 Goods"), (1, 5, "35")]


def test_numbers_that_the_model_lost(spark):
    model = lines(spark, "7 there", "Heading", "x").unionByName(lines(spark, "next page", page=1))
    printed = lines(spark, ("7", 13.0), ("8", 13.0), ("Heading", 13.0), ("9", 8.0), ("10", 13.0)).unionByName(lines(spark, ("next page", 12.0), ("11", 13.0), page=1))
    assert shown(headings.restored(model, printed)) == [(0, 0, "7 there"), (0, 1, "8 Heading"), (0, 2, "x"), (1, 0, "10 next page")]


def read(pages, *how):
    last, out = 0, []
    for page in pages:
        notes, last = carried.reader(*how)(page, last)
        out.append([(n["number"], n["text"]) for n in notes])
    return out


def test_a_page_goes_on_from_the_page_before():
    assert read([["1. a", "b", "", "2 c"], ["d", "2 e", "3 f"]]) == [[(1, "a b"), (2, "c")], [(None, "d 2 e"), (3, "f")]]
    assert read([["(4)", "a", "[5] b", "5 Ob 142/68", "6) c"]]) == [[(4, "a"), (5, "b 5 Ob 142/68"), (6, "c")]]
    assert read([["5. a", "75. b", "6. c"]], "dot", 5) == [[(5, "a 75. b"), (6, "c")]]
    assert read([["8. a"], ["4. b", "5. c"], ["2. d"]], "any", 9) == [[(8, "a")], [(4, "b 5. c")], [(None, "2. d")]]
    assert read([["1449. a", "(3) b"]], "dot", 0, 4) == [[(1449, "a (3) b")]]
    assert read([[], [None, " "]]) == [[], []]


PAGES = "book_id int, page_seq int, lines array<string>"


def books():
    rng = random.Random(5)
    word = lambda: rng.choice(["a", "b.", "9 c", "12. d", "(3) e", "", "4", "5 Ob 1/2"])
    return [(b, p, [f"{p + k}. n" if rng.random() < 0.4 else word() for k in range(rng.randint(0, 5))] if rng.random() < 0.9 else None) for b in range(6) for p in range(8)]


def test_stream_equals_batch_whatever_the_order_and_the_repeats(spark, tmp_path):
    rows, take = books(), carried.reader("any", 4)
    want = sorted(map(tuple, carried.carried_notes(spark.createDataFrame(rows, PAGES), take).collect()), key=str)
    assert any(r[-1] for r in want) and len({r[1] for r in want}) == 8
    shuffled = rows + rows[::3]
    random.Random(1).shuffle(shuffled)
    for i in range(4):
        spark.createDataFrame(shuffled[i::4], PAGES).coalesce(1).write.mode("append").parquet(str(tmp_path / "pages"))
    stream = events.replay(spark, str(tmp_path / "pages"), spark.createDataFrame([], PAGES))
    assert sorted(map(tuple, events.drained(streamed.carried_notes(stream, take), "append").collect()), key=str) == want


def test_tails_go_to_the_page_before(spark):
    rows = [(1, 0, ["1. a", "2. b"]), (1, 1, ["c", "3. d"]), (1, 2, ["e"]), (1, 3, ["f"]), (2, 0, ["g"]), (2, 2, ["1. h"])]
    got = carried.tails_joined(carried.carried_notes(spark.createDataFrame(rows, PAGES), carried.reader()))
    assert sorted((r.book_id, r.page_seq, r.number or 0, r.text) for r in got.collect()) == [(1, 0, 1, "a"), (1, 0, 2, "b c"), (1, 1, 3, "d e"), (1, 3, 0, "f"), (2, 0, 0, "g"), (2, 2, 1, "h")]
