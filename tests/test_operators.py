import random

import pytest
from pyspark.sql import functions as F

from folioforge.functions import python as P
from folioforge.functions import text as T
from folioforge.operators import cards, folds, hierarchy, layout, qa, relational, search
from folioforge.operators import sequence as S
from folioforge.plans import corpus
from folioforge.sources import files
from folioforge.streaming import events


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_text_functions(spark):
    lit = F.lit
    assert one(spark, T.expand_ligatures(lit("ﬁnal oﬃce"))) == "final office"
    assert one(spark, T.rejoin_ligatures(lit("the fi nal fl ow The fi"))) == "the final flow The fi"
    assert one(spark, T.tidy_article(lit("X. –1:101"))) == "X.–1:101"
    assert one(spark, T.repair_article_number(lit("l0S"))) == "105" and one(spark, T.repair_article_number(lit("lOSS"))) == "lOSS"
    assert one(spark, T.number_list(lit("9-12, 1"))) == [9, 10, 11, 12, 1] and one(spark, T.number_list(lit("x, 3"))) == [3]
    assert [one(spark, T.roman(lit(x))) for x in ("xiv", "MCMXC", "abc")] == [14, 1990, None]
    assert one(spark, T.authors(lit(" A ;; B; "))) == ["A", "B"]
    assert one(spark, T.pad_number(lit("Art. 7 b"), 3)) == "Art. 007 b" and one(spark, T.pad_number(lit("none"), 3)) == "none"
    assert one(spark, T.find_all(lit("Art 1, art 1, ART 2"), [r"art \d"])) == ["Art 1", "ART 2"]
    assert one(spark, T.trim_after(lit("x" * 50 + " CUT rest"), "CUT")) == "x" * 50 and one(spark, T.trim_after(lit("short CUT"), "CUT")) == "short CUT"
    assert one(spark, T.strip_lines(lit("keep me\ndrop\nand cut"), "^drop", "cut$")) == "keep me\nand "
    assert one(spark, T.scrubbed(lit("a\x01b\x02")))["removed"] == 2


def test_python_functions(spark):
    assert one(spark, P.slug(F.lit("Über Ähre & Öl"))) == "uber-ahre-ol"
    assert one(spark, P.join_hyphens(F.lit("Rechts-\nordnung Vor-\nund"))) == "Rechtsordnung Vor-\nund"
    assert one(spark, P.join_hyphens(F.lit("BGB-\nRGRK WESTER-\nMANN Rechts-\nStatt a-\nb-\nc --\nd"))) == "BGB-\nRGRK WESTERMANN Rechts-\nStatt ab-\nc --\nd"
    sign = one(spark, P.signature(b"k", F.lit("a")))
    assert len(sign) == 24 and one(spark, P.verified(b"k", F.lit("a"), F.lit(sign))) and not one(spark, P.verified(b"k", F.lit("b"), F.lit(sign)))
    words = [f"w{i}" for i in range(60)]
    assert one(spark, P.repeated_tail(F.lit("head " + " ".join(words)), F.lit(" ".join(words)))) == 5
    assert one(spark, P.repeated_tail(F.lit("a b"), F.lit("a b"))) is None


def test_fusion_order_and_limits(spark):
    lex = frame(spark, [(10, 1), (11, 2)], "id long, lexical_rank int")
    vec = frame(spark, [(12, 1), (11, 2)], "id long, vector_rank int")
    assert [r["id"] for r in search.page_of(search.fuse(lex, vec)).collect()] == [11, 10, 12]
    assert [r["id"] for r in search.page_of(search.fuse(vec.toDF("id", "lexical_rank"), lex.toDF("id", "vector_rank"))).collect()][0] == 11
    with pytest.raises(ValueError):
        search.page_of(lex, 0)
    with pytest.raises(ValueError):
        search.hybrid(lex, vec, " ", None)
    assert search.clamped(500) == 100 and search.clamped(0) == 1
    assert one(spark, search.snippet(F.lit("word  " * 100))).endswith("word…")


def test_upsert_and_patch(spark):
    old = frame(spark, [(1, "s", "a", "x", 3), (2, "s", None, "y", 3), (3, "s", "", "z", 3)], "id long, source_id string, external_id string, text string, created_at int")
    new = frame(spark, [(9, "s", "a", "new", 8), (8, "s", "", "more", 8), (7, "s", None, "more", 8)], old.schema)
    got = relational.upsert(old, new)
    assert sorted((r["id"], r["text"], r["created_at"]) for r in got.collect()) == [(1, "new", 3), (2, "y", 3), (3, "z", 3), (7, "more", 8), (8, "more", 8)]
    assert relational.upsert(got.where("external_id = 'a'"), new.where("external_id = 'a'")).collect() == got.where("external_id = 'a'").collect()
    with pytest.raises(relational.Rejected):
        relational.upsert(old, new.where("id = 9").union(new.where("id = 9")))
    patches = frame(spark, [("a", {"text": None}), ("q", {"text": "t"})], "external_id string, present map<string,string>")
    first = {r["external_id"]: (r["outcome"], r["text"]) for r in relational.patched(old, patches, "external_id", ["text"]).collect()}
    assert first == {"a": ("updated", None), "q": ("missing", "t")}
    done = relational.apply_patches(old, patches, "external_id", ["text"])
    assert [r["outcome"] for r in relational.patched(done, patches.limit(1), "external_id", ["text"]).collect()] == ["unchanged"]
    with pytest.raises(relational.Rejected):
        relational.patched(old, frame(spark, [("a", {"id": "4"})], patches.schema), "external_id", ["text"])


def test_source_resolution(spark):
    catalogue = frame(spark, [(1, "The Law!", ["A"]), (2, "the law", ["B"]), (3, "Other", ["C"])], "id int, title string, authors array<string>")
    items = frame(spark, [("x", "THE LAW", ["b"]), ("y", "other", ["Z"]), ("z", "the law", ["Q"])], "item string, title string, authors array<string>")
    assert {r["item"]: r["source_id"] for r in relational.resolve(items, catalogue).collect()} == {"x": 2, "y": 3, "z": None}


def test_quality_known_answers(spark):
    numbers = frame(spark, [("b", i) for i in range(1, 204) if not 99 <= i <= 115], "book string, number int")
    row = qa.continuity(numbers, ["book"], ["book"], "number").first()
    assert (row["cards"], row["missing"], row["share"]) == (186, 17, 0.9163)
    assert [tuple(r) for r in qa.gaps(numbers, ["book"], "number").collect()] == [("b", 98, 116, 17)]
    spans = frame(spark, [("b", 0, 10), ("b", 5, 12), ("b", 20, 25), ("b", 21, 22)], "book string, char_start int, char_end int")
    size = frame(spark, [("b", 40)], "book string, book_chars int")
    assert qa.coverage(spans, size, ["book"]).first()["covered_chars"] == 17
    assert sorted(tuple(r)[1:] for r in qa.holes(spans, size, ["book"]).collect()) == [(12, 20, 8), (25, 40, 15)]


def rows_of(step, rows):
    return list(step([dict(r) for r in rows]))


def test_folds():
    n = lambda *xs: [{"number": x, "text": str(x), "section": "s"} for x in xs]
    got = [r["number"] for r in rows_of(folds.repaired_by_neighbours, n(11, 72, 13, 14, 75, 16))]
    assert got == [11, 12, 13, 14, 15, 16]
    assert [r["number"] for r in rows_of(folds.rising(), n(1, 2, 9, 3, 6, 5))] == [1, 2, 3, 6]
    assert [(r["number"], r["text"]) for r in rows_of(folds.notes_repaired(), n(1, 2, 500, 3))] == [(1, "1"), (2, "2 500. 500"), (3, "3")]
    assert [(r["number"], r["text"]) for r in rows_of(folds.outliers_merged(), n(1, 2, 300, 3, 4))] == [(1, "1"), (2, "2\n300"), (3, "3"), (4, "4")]
    assert [(r["number"], r["text"]) for r in rows_of(folds.backward_merged(), n(1, 2, 1, 3))] == [(1, "1"), (2, "2\n1. 1"), (3, "3")]
    assert [r["part"] for r in rows_of(folds.restarts_split, n(1, 2, 1, 3, 2))] == [1, 1, 2, 1, 2]
    raw = [{"family": "f", "section": None, "raw": x} for x in ("1", "l2", "??", "13", "I4")]
    assert [(r["number"], r["action"]) for r in rows_of(folds.validated, raw)] == [(1, "read"), (12, "guessed"), (13, "read"), (14, "repaired")]
    marks = [{"candidate": c, "order_key": k} for c, k in [("a", 1), (None, None), ("q", 1), ("b", 2), ("x", 0)]]
    assert [r["section"] for r in rows_of(folds.rising_switches, marks)] == ["a", "a", "a", "b", "b"]
    cards_ = [{"text": "one 1 and 3", "note_numbers": [1, 2, 3]}, {"text": "then 4", "note_numbers": [4]}]
    assert [r["notes"] for r in rows_of(folds.notes_attached(), cards_)] == [[1, 2, 3], [4]]
    block = [{"text": t} for t in ("1. first", "goes on", "(2) second", "3", "third")]
    assert [(r["number"], r["text"]) for r in rows_of(folds.page_notes, block)] == [(1, "first goes on"), (2, "second"), (3, "third")]


def test_longest_rising_is_longest():
    rnd = random.Random(1)
    for _ in range(50):
        xs = [rnd.randrange(12) for _ in range(9)]
        got = [x for x, r in zip(xs, rows_of(folds.longest_rising, [{"chapter": 1, "number": x} for x in xs])) if r["in_lis"]]
        best = [1] * len(xs)
        for i in range(len(xs)):
            best[i] = 1 + max([best[j] for j in range(i) if xs[j] < xs[i]], default=0)
        assert got == sorted(set(got)) and len(got) == max(best)


def test_folded_does_not_depend_on_partitions(spark):
    df = frame(spark, [(b, i, (7 * i) % 11) for b in range(5) for i in range(30)], "book int, at int, number int")
    run = lambda d: sorted(map(tuple, folds.folded(d, ["book"], ["at"], folds.restarts_split, "part int").collect()))
    assert run(df.repartition(7)) == run(df.coalesce(1))


def test_layout(spark):
    words = [("b", 0, "Text", 10.0, 30.0, 100.0, 110.0, 10.0), ("b", 0, "here", 34.0, 50.0, 101.0, 111.0, 10.0), ("b", 0, "2", 51.0, 54.0, 99.0, 104.0, 5.0), ("b", 0, "next", 10.0, 30.0, 114.0, 124.0, 10.0)]
    w = frame(spark, words, "book_id string, page_seq int, text string, x0 double, x1 double, top double, bottom double, size double")
    assert [r["text"] for r in layout.cluster_lines(w).orderBy("line_no").collect()] == ["Text here 2", "next"]
    lines = frame(spark, [("b", 0, 0, "17", 5.0, 15.0, 100.0), ("b", 0, 1, "Body", 20.0, 30.0, 100.0), ("b", 1, 0, "xiv", 5.0, 9.0, 100.0)], "book_id string, page_seq int, line_no int, text string, top double, bottom double, height double")
    assert sorted(map(tuple, layout.folios(lines, band=0.2).collect())) == [("b", 0, 17, 0), ("b", 1, None, 0)]
    marks = frame(spark, [("b", 0, 19.0)], "book_id string, page_seq int, top double")
    assert layout.nearest_line(marks, lines).first()["line_no"] == 1
    twin = frame(spark, [("b", 0, 0, "a", 10.0, 5.0), ("b", 0, 1, "a", 10.5, 5.2), ("b", 0, 2, "a", 14.0, 5.0)], "book_id string, page_seq int, seq int, text string, x0 double, top double")
    assert [r["seq"] for r in layout.deduplicated(twin).orderBy("seq").collect()] == [0, 2]
    # A glyph is a twin of a kept one only; the bounds count as within.
    chain = frame(spark, [("b", 0, 0, "a", 10.0, 5.0), ("b", 0, 1, "a", 11.0, 5.0), ("b", 0, 2, "a", 12.0, 5.0), ("b", 0, 3, "b", 10.0, 5.0), ("b", 0, 4, "b", 11.25, 8.0), ("b", 0, 5, "b", 11.0, 8.0), ("b", 1, 6, "a", 10.0, 5.0)], "book_id string, page_seq int, seq int, text string, x0 double, top double")
    assert [r["seq"] for r in layout.deduplicated(chain).orderBy("seq").collect()] == [0, 2, 3, 4, 6]
    chars = frame(spark, [("b", "F", "a", 0.0, 5.0, 10.0), ("b", "F", "a", 0.0, 7.0, 10.0), ("b", "G", "a", 0.0, 7.0, 10.0)], "book_id string, fontname string, text string, x0 double, x1 double, size double")
    assert sorted(r["text"] for r in layout.case_repaired(chars).collect()) == ["A", "a", "a"]
    two = frame(spark, [("b", 0, t, x, x + 30.0, y, y + 10.0, 10.0) for t, x, y in [("L1", 10.0, 20.0), ("R1", 110.0, 20.0), ("L2", 10.0, 40.0), ("R2", 110.0, 40.0)]] + [("b", 0, "Head", 60.0, 140.0, 0.0, 10.0, 10.0)], w.schema)
    assert [r["text"] for r in layout.two_columns(two, 100.0).orderBy("line_no").collect()] == ["Head", "L1", "L2", "R1", "R2"]
    seen = frame(spark, [("b", 0, "x", 11.0, 29.0, 100.0, 110.0, 90.0), ("b", 0, "y", 80.0, 90.0, 100.0, 110.0, 90.0)], "book_id string, page_seq int, text string, x0 double, x1 double, top double, bottom double, conf double")
    assert [r["text"] for r in layout.uncovered(seen, w).collect()] == ["y"]
    split = spark.range(1).select(layout.split_at(F.array(F.struct(F.lit("one [p. 3] two").alias("text"))), r"\[p\. \d+\]").alias("l")).first()["l"]
    assert [x["text"] for x in split] == ["one ", "[p. 3] two"]


def test_cards(spark):
    assert one(spark, cards.templated(" {a} , § {b}  c", {"a": F.lit("x"), "b": F.lit(3)})) == "x, § 3 c"
    with pytest.raises(KeyError):
        cards.templated("{q}", {})
    assert one(spark, cards.reflowed("de")(F.lit("Rechts-\nordnung\nund Vor-\nund Nach\n\nneu"))) == "Rechtsordnung und Vor- und Nach\nneu"
    df = frame(spark, [("a-\nb c",)], "text string")
    assert cards.reflow(cards.reflow(df)).first()["text"] == cards.reflow(df).first()["text"] == "ab c"
    notes = spark.range(1).select(cards.wire_footnotes(F.expr("array(struct('1' as number, 'x' as text), struct('b' as number, 'y' as text), struct('2' as number, ' ' as text))")).alias("w")).first()["w"]
    assert notes["dropped"] == 1 and [n["number"] for n in notes["notes"]] == [1]
    kept, gone = cards.projected(df.withColumn("extra", F.lit(1)))
    assert gone == ["extra"] and "citation" in kept.columns
    with pytest.raises(ValueError):
        cards.gated(df, df)


def test_sequences(spark):
    pages = frame(spark, [("b", i, f) for i, f in enumerate([None, 11, None, 13, None, None, 20, 21])], "book string, page int, folio int")
    got = [r["folio"] for r in S.filled_between(pages, ["book"], "page", "folio").orderBy("page").collect()]
    assert got == [10, 11, 12, 13, 18, 19, 20, 21]
    lone = frame(spark, [("b", i, f) for i, f in enumerate([None, 11, None, 13, 99, None, 16])], "book string, page int, folio int")
    assert [r["folio"] for r in S.filled_between(lone, ["book"], "page", "folio").orderBy("page").collect()] == list(range(10, 17))
    heads = frame(spark, [("b", 0, 0, "A"), ("b", 1, 1, "B"), ("b", 2, None, None), ("b", 3, 0, "C"), ("b", 4, None, None)], "book string, at int, level int, title string")
    assert [r["hierarchy"] for r in S.heading_stack(heads, ["book"], ["at"], "level", "title", 2).orderBy("at").collect()] == [["A"], ["A", "B"], ["A", "B"], ["C"], ["C"]]
    small = frame(spark, [(1, i, s) for i, s in enumerate([True, False, True, True])], "b int, i int, small boolean")
    assert [r["f"] for r in small.withColumn("f", S.suffix_flag(F.col("small"), ["b"], ["i"])).orderBy("i").collect()] == [False, False, True, True]


def test_toc_anchors(spark):
    lines = frame(spark, [("b", 5, 50, "Something else"), ("b", 6, 60, "The law of sale"), ("b", 6, 61, "more text")], "book_id string, page int, line_no int, line string")
    entries = frame(spark, [("b", 1, "The Law of Sale", 5), ("b", 2, "Unrelated heading", 6)], "book_id string, entry int, title string, page int")
    assert sorted((r["entry"], r["line_no"], r["ratio"]) for r in hierarchy.anchored(entries, lines).collect()) == [(1, 60, 1.0), (2, 60, 0.39)]


def test_files(spark, tmp_path):
    df = frame(spark, [(1, "é", None), (2, "x", "y")], "id int, a string, b string")
    files.write_jsonl(df, f"{tmp_path}/out", ["id"])
    assert sorted(map(tuple, files.read_jsonl(spark, f"{tmp_path}/out", df.schema).collect())) == [(1, "é", None), (2, "x", "y")]
    book = tmp_path / "book"
    book.mkdir()
    assert files.load_cards(spark, f"file://{book}", df.schema) is None
    (book / "cards.jsonl").write_text('{"id": 1, "a": "l"}\n\n{"id": 2}\n')
    assert files.load_cards(spark, f"file://{book}", df.schema).count() == 2
    assert files.page_range("2-3, 9,2", 5) == [1, 2] and files.page_range("", 3) == [0, 1, 2]


def test_streamed_upsert_is_idempotent(spark, tmp_path):
    rows = frame(spark, [(u, i, f"t{i}") for i in range(40) for u in [i % 7]], "user_id int, event_id int, event_type string")
    rows.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = events.replay(spark, f"{tmp_path}/in", rows)
    for _ in range(2):
        events.upserting(stream, f"{tmp_path}/state", ["user_id"], "event_id").start().awaitTermination()
    assert len(list((tmp_path / "state").glob("v*"))) > 1
    last = events.newest(spark, f"{tmp_path}/state")
    assert sorted(map(tuple, last.collect())) == [(u, max(i for i in range(40) if i % 7 == u), f"t{max(i for i in range(40) if i % 7 == u)}") for u in range(7)]


def test_statutory_refs_reads_whole_texts_and_all_patterns(spark, tmp_path):
    texts = [(1, "x " * 1500 + "the Nation of section 12, THE nation, Section 12 and the station", "en"), (2, None, "en"), (3, "", "en")]
    frame(spark, texts, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["refs"] for r in corpus.QUERIES["statutory_refs"](spark, str(tmp_path)).collect()}
    assert got == {1: "section 12|Nation|section|station|the Nation|the station", 2: None, 3: ""}


def test_readings_of_misread_numbers():
    assert folds.readings("B") == [3, 8] and folds.readings("1G") == [15, 16] and folds.readings("D?7") == [7]
    assert folds.read_number("1B", 13) == (13, "repaired") and folds.read_number("1B", 99) == (13, "guessed")
    assert folds.read_number("42", 41) == (42, "read") and folds.read_number("xyw", 3) == (None, "unreadable")


def test_swallowed_cards_leave_their_notes():
    host, row = {"text": "a", "footnotes": None, "page_end": 3}, {"text": "b", "footnotes": [1, 2], "cross_refs": [], "page_end": 4}
    folds._into(host, row, "\n")
    assert host == {"text": "a\nb", "footnotes": [1, 2], "page_end": 4}


def test_lexical_terms_are_whole_tokens(spark):
    texts = [(1, "Tax taxes, TAX-law"), (2, "syntax law"), (3, "law2 tax"), (4, None), (5, "law tax; größer"), (6, "größertax law")]
    got = [(r["id"], r["score"]) for r in search.lexical_topk(frame(spark, texts, "id long, text string"), "Law, tax").collect()]
    assert got == [(1, round(2 / 3 + 0.5, 8)), (5, 1.0)] and search.lexical_topk(frame(spark, texts, "id long, text string"), "...").count() == 0
