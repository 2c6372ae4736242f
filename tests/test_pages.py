from pyspark.sql import functions as F

from folioforge.operators import pages


def lines(spark, rows):
    return spark.createDataFrame([("b", *r) for r in rows], "book_id string, page_seq int, line_no int, text string, size double, top double, bottom double")


def test_marked_pages(spark):
    df = lines(spark, [(0, 0, "Draft COPY", 9.0, 0.0, 9.0), (0, 1, "text", 9.0, 10.0, 19.0), (1, 0, "fine", 9.0, 0.0, 9.0)])
    assert [r["text"] for r in pages.without_marked(df, "copy").collect()] == ["fine"]
    assert sorted(r["text"] for r in pages.without_marked(df, "copy", lines_only=True).collect()) == ["fine", "text"]


def test_endnote_pages_grow_from_a_seed(spark):
    rows = [(p, i, f"{i}. note" if p in (3, 8) else "small text", 8.0, i * 10.0, i * 10.0 + 8) for p in (2, 3, 4, 6) for i in range(5)]
    rows += [(7, i, "body", 11.0, i * 10.0, i * 10.0 + 8) for i in range(5)]
    assert sorted(r["page_seq"] for r in pages.endnote_pages(lines(spark, rows), 8.5).collect()) == [2, 3, 4]


def test_wrapped_headings(spark):
    df = lines(spark, [(0, 0, "A long", 14.0, 0.0, 14.0), (0, 1, "heading", 14.2, 18.0, 32.0), (0, 2, "Body", 10.0, 40.0, 50.0), (0, 3, "Next", 14.0, 60.0, 74.0), (0, 4, "far", 14.0, 100.0, 114.0)])
    assert [r["text"] for r in pages.wrapped_headings(df, 13.0, 15.0).orderBy("line_no").collect()] == ["A long heading", "Body", "Next", "far"]


def test_margin_corridors(spark):
    words = [("b", p, str(p * 10 + i), 20.0, 30.0) for p in range(2, 12, 2) for i in range(3)] + [("b", p, "word", x, x + 30.0) for p in range(2, 12, 2) for x in (60.0, 100.0, 140.0)] + [("b", 2, "7", 100.0, 105.0)]
    df = spark.createDataFrame(words, "book_id string, page_seq int, text string, x0 double, x1 double")
    assert [(r["parity"], r["low"], r["high"], r["hits"]) for r in pages.margin_corridors(df).collect()] == [(0, 15.0, 27.0, 15)]


def test_columns(spark):
    out = spark.range(1).select(pages.number_to_front(F.lit("some text 12"), F.lit(300.0), 250.0).alias("a"), pages.number_to_front(F.lit("some text 12"), F.lit(200.0), 250.0).alias("b"), pages.glued(F.lit("word"), F.lit(1.0), F.lit("3")).alias("c")).first()
    assert (out["a"], out["b"], out["c"]) == ("12 some text", "some text 12", "word3")
