"""Print jobs with known answers."""

from folioforge.operators import folds
from folioforge.operators import printjobs as J

LINE = "book_id int, page_seq int, line_no int, text string, x0 double, x1 double, size double, words array<struct<text: string, x0: double, x1: double>>"


def line(n, text, x0=100.0, x1=400.0, size=12.0, margin=None):
    words = [(text, x0, x1)] + ([(margin, 420.0, 430.0)] if margin else [])
    return 1, n // 20, n, f"{text} {margin}" if margin else text, x0, 430.0 if margin else x1, size, words


def long(k):
    return f"line {k} of a text that is long enough to count as body"


def cut(spark, rows):
    lines = J.split(spark.createDataFrame(rows, LINE))
    body = J.apparatus(lines)
    return body, J.units(J.raised(J.numbered(body.where("not is_note"))))


def found(units):
    return sorted((r.job, r.section, r.number, r.upto, r.how, r.text) for r in units.collect())


def test_blocks_close_jobs_and_printouts_go(spark):
    rows = [line(0, "12. Auflage 2025"), line(1, "Titel BGB"), line(2, "a"), line(3, "Zitiervorschläge:"), line(4, "W/B BGB § 5 Rn. 1"), line(5, "https://x"), line(6, "W/B, 9. Aufl. 2021, BGB § 5a Abs. 2 Rn. 1, 3-4"),
            line(7, "b BGB"), line(8, None), line(9, "Zitiervorschlag x"), line(10, "c")]
    got = [(r.job, r.line_no, r.section, r.announced) for r in J.split(spark.createDataFrame(rows, LINE)).orderBy("line_no").collect()]
    assert got == [(0, 2, "5a Abs. 2", "1, 3-4"), (1, 7, None, None), (1, 8, None, None), (1, 9, None, None), (1, 10, None, None)]


def test_announced_numbers(spark):
    df = spark.createDataFrame([("9-12, 14",), ("5–4, x",), (None,), ("1 - 3",)], "s string").select(J.announced("s").alias("a"))
    assert [[tuple(p) for p in r.a] for r in df.collect()] == [[(9, 12), (14, 14)], [], [], [(1, 3)]]


def test_four_ways_to_units(spark):
    body = [line(k, long(k)) for k in range(6)]
    marked = [line(0, long(0)), line(1, long(1), margin="7"), line(2, long(2)), line(3, long(3), margin="99"), line(4, long(4)), line(5, "8", 420.0, 430.0), line(6, long(6))]
    whole = "\n".join(long(k) for k in range(6))

    def job(rows, cite):
        return found(cut(spark, [*rows, line(10, "Zitiervorschläge"), line(11, f"W/B, 9. Aufl. 2021, BGB § 5{cite}")])[1])

    assert job(marked, " Rn. 6-8") == [(0, "5", 6, None, "citation", long(0)), (0, "5", 7, None, "margin", "\n".join(long(k) for k in (1, 2, 3, 4))), (0, "5", 8, None, "margin", long(6))]
    assert job(marked, " Rn. 7, 8")[0] == (0, "5", 7, None, "margin", "\n".join(long(k) for k in (0, 1, 2, 3, 4)))
    assert [u[2] for u in job(marked, "")] == [7, 8, 99]
    assert job(body, " Rn. 4") == [(0, "5", 4, None, "citation", whole)]
    assert job(body, " Rn. 4-6") == [(0, "5", 4, 6, "range", whole)]
    assert job(body, "") == [(0, "5", 0, None, "opening", whole)]


def test_notes_and_raised_numbers(spark):
    rows = [*[line(k, long(k)) for k in range(5)], line(5, "3", 150.0, 155.0, 7.0), line(6, "as said", 100.0, 140.0), line(7, "1", 70.0, 75.0, 8.0), line(8, "the note", 90.0, 300.0, 10.0),
            line(9, "2 the next one", 70.0, 300.0, 10.0), line(10, "goes on", 90.0, 300.0, 10.0)]
    body, units = cut(spark, rows)
    assert found(units)[0][5].split("\n")[-1] == "as said 3"
    notes = folds.folded(J.note_lines(body), ["book_id", "job"], ["page_seq", "line_no", "part"], folds.page_notes, "number int, unparsed boolean")
    assert sorted((r.number, r.text) for r in notes.collect()) == [(1, "the note"), (2, "the next one goes on")]


def test_the_longest_of_equal_units_stays_and_idle_ranges_go(spark):
    rows = [(1, 0, "5", 1, None, "margin", "aa"), (1, 1, "5", 1, None, "margin", "bbb"), (1, 2, "5", 2, None, "margin", "c"), (1, 3, "5", 2, None, "margin", "d"), (1, 4, "5", 1, 2, "range", "aa c"), (1, 5, "5", 2, 3, "range", "c d"), (1, 6, None, 0, None, "opening", "x")]
    units = spark.createDataFrame(rows, "book_id int, job int, section string, number int, upto int, how string, text string")
    assert sorted(r.job for r in J.merged(units).collect()) == [1, 2, 5, 6]
    assert J.merged(units.where("false")).count() == 0
    keys = spark.createDataFrame([("10",), ("9a",), ("9",), ("x",), ("9b",)], "s string")
    assert [r.s for r in keys.orderBy(J.section_key(keys.s)).collect()] == ["9", "9a", "9b", "10", "x"]
