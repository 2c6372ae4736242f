"""Queries of the corpus pipeline over the driver's tables: sequences, quality figures, text functions, cards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import text as T
from folioforge.operators import qa
from folioforge.operators import sequence as S
from folioforge.sources.tables import read

E_ORDER = ("ts", "event_id")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as books of lines, with offsets into the book's text."""
    rows = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    return rows.where("line <> ''").withColumn("start", S.offsets(F.char_length("line"), ["doc_id"], ["i"])).withColumn("end", F.col("start") + F.char_length("line"))


LINES = """lines AS (
  SELECT doc_id, i, line, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents) WHERE line <> '')"""


def pagemap(spark, sf_dir) -> DataFrame:
    """Pages of five lines with the stretch of text that they hold."""
    return lines(spark, sf_dir).groupBy("doc_id", F.floor(F.col("i") / 5).alias("page")).agg(F.min("start").alias("start"), F.max("end").alias("end"))


def events(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")


def section_carry_forward(spark, sf_dir) -> DataFrame:
    v = F.when(F.col("event_type") == "click", F.col("value"))
    return events(spark, sf_dir).select("event_id", S.carried_forward(v, ["user_id"], E_ORDER).alias("section"))


def section_backfill(spark, sf_dir) -> DataFrame:
    v = F.when(F.col("event_type") == "click", F.col("value"))
    return events(spark, sf_dir).select("event_id", S.carried_back(v, ["user_id"], E_ORDER).alias("section"))


def asof_section(spark, sf_dir) -> DataFrame:
    e = events(spark, sf_dir)
    switches = e.where("event_type = 'purchase'").select("user_id", "event_id", F.col("value").alias("section"))
    cards = e.where("event_type = 'view'").select("user_id", "event_id")
    return S.as_of(cards, switches, ["user_id"], "event_id", "section")


def export_segments(spark, sf_dir) -> DataFrame:
    seg = S.islands(F.col("event_type") == "purchase", ["user_id"], E_ORDER)
    return events(spark, sf_dir).withColumn("segment", seg).groupBy("user_id", "segment").agg(F.count("*").alias("n"))


def hierarchy_stack(spark, sf_dir) -> DataFrame:
    """Lines as positions: a line's length modulo 7 under 3 makes it a heading of that level."""
    level = F.when(F.char_length("line") % 7 < 3, F.char_length("line") % 7)
    rows = lines(spark, sf_dir).select("doc_id", "i", level.alias("level"), F.concat(F.lit("h"), F.col("i")).alias("title"))
    return S.heading_stack(rows, ["doc_id"], ["i"], "level", "title", 3).select("doc_id", "i", F.array_join("hierarchy", ">").alias("hierarchy"))


def series(spark, sf_dir) -> DataFrame:
    """Order lines as numbered units: the part key moves some numbers up, so that there are gaps and repeats."""
    number = (F.col("l_linenumber") + F.col("l_partkey") % 3).cast("int")
    return read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("family"), F.col("l_orderkey").alias("section"), number.alias("number"), F.col("l_partkey").alias("part"))


SERIES = "series AS (SELECT l_returnflag AS family, l_orderkey AS section, (l_linenumber + l_partkey % 3)::INT AS number, l_partkey AS part FROM lineitem)"


def sequence_breaks(spark, sf_dir) -> DataFrame:
    return S.breaks(series(spark, sf_dir), ["section"], ["part", "number", "family"], "number").select("section", "at", "before", "number", "kind")


def continuity_share(spark, sf_dir) -> DataFrame:
    return qa.continuity(series(spark, sf_dir), ["family"], ["family", "section"], "number")


def cards(spark, sf_dir) -> DataFrame:
    """Lines as cards with offsets into their book: every third and every fifth is ten characters longer, of the others half is missing."""
    end = F.expr("CASE WHEN i % 3 = 0 OR i % 5 = 0 THEN end + 10 ELSE start + char_length(line) div 2 END")
    return lines(spark, sf_dir).select("doc_id", "i", F.col("start").alias("char_start"), end.alias("char_end"), F.col("line").alias("text"))


def book_lengths(spark, sf_dir) -> DataFrame:
    return lines(spark, sf_dir).groupBy("doc_id").agg((F.max("end") + 10).alias("book_chars"))


CARDS = f"""{LINES},
cards AS (SELECT doc_id, i, start AS char_start, CASE WHEN i % 3 = 0 OR i % 5 = 0 THEN start + length(line) + 10 ELSE start + length(line) // 2 END AS char_end, line AS text FROM lines),
books AS (SELECT doc_id, max(start + length(line)) + 10 AS book_chars FROM lines GROUP BY doc_id),
merged AS (SELECT *, coalesce(max(char_end) OVER (PARTITION BY doc_id ORDER BY char_start, char_end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reach FROM cards)"""


def numbered_cards(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", F.concat_ws(":", "source", (F.col("n_chars") % 40).cast("string")).alias("external_id"), "text")


def dedupe_cross_book(spark, sf_dir) -> DataFrame:
    """The card with the most characters of each external id, ties to the first."""
    return S.keep_one(numbered_cards(spark, sf_dir).withColumn("_less", -F.col("n_chars")), ["external_id"], ["_less", "doc_id"]).select("external_id", "doc_id", "n_chars")


def drop_duplicate_pages(spark, sf_dir) -> DataFrame:
    head = F.substring(T.spaced_key(F.col("text")), 1, 200)
    return S.repeated_pages(read(spark, sf_dir, "documents").select("doc_id", "source", "text"), head, ["source"], "doc_id", ahead=400).select("doc_id", "duplicate_scan")


def folios(spark, sf_dir) -> DataFrame:
    """Events of a user as pages: a folio is printed on two of three, and wrong on a few."""
    page = F.row_number().over(S.Window.partitionBy("user_id").orderBy("event_id"))
    e = events(spark, sf_dir).select("user_id", page.alias("page"), "event_id")
    return e.withColumn("folio", F.when(F.col("event_id") % 3 != 0, F.col("page") + F.when(F.col("event_id") % 11 == 0, 5).otherwise(2)))


FOLIOS = """numbered AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id)::INT AS page, event_id FROM events),
folios AS (SELECT *, CASE WHEN event_id % 3 <> 0 THEN page + CASE WHEN event_id % 11 = 0 THEN 5 ELSE 2 END END AS folio FROM numbered)"""


def fill_constant_offset(spark, sf_dir) -> DataFrame:
    return S.filled_by_offset(folios(spark, sf_dir), ["user_id"], "page", "folio", drop_outliers=True).select("user_id", "page", "folio", "folio_filled")


def fill_sequential(spark, sf_dir) -> DataFrame:
    return S.filled_between(folios(spark, sf_dir), ["user_id"], "page", "folio").select("user_id", "page", "folio", "folio_approx")


def refs(spark, sf_dir) -> DataFrame:
    """Each order line refers to the line two further in its order."""
    return series(spark, sf_dir).select("family", "section", (F.col("number") + 2).alias("number"))


def runs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Two extractions of the documents: each has given some an id of its own; the second has moved some, and reads others differently."""
    first = numbered_cards(spark, sf_dir).select("doc_id", F.col("n_chars").alias("page_start"), "text")
    own = lambda n: F.when(F.col("doc_id") % n == 0, -1 - n * F.col("doc_id")).otherwise(F.col("doc_id"))
    second = first.withColumns({"page_start": F.when(F.col("doc_id") % 5 == 0, F.col("page_start") + 1).otherwise(F.col("page_start")), "text": F.when(F.col("doc_id") % 3 == 0, F.upper("text")).otherwise(F.col("text"))})
    return first.withColumn("doc_id", own(11)), second.withColumn("doc_id", own(7))


RUNS = """one AS (SELECT CASE WHEN doc_id % 11 = 0 THEN -1 - 11 * doc_id ELSE doc_id END AS doc_id, n_chars AS page_start, text FROM documents),
two AS (SELECT CASE WHEN doc_id % 7 = 0 THEN -1 - 7 * doc_id ELSE doc_id END AS doc_id, CASE WHEN doc_id % 5 = 0 THEN n_chars + 1 ELSE n_chars END AS page_start, CASE WHEN doc_id % 3 = 0 THEN upper(text) ELSE text END AS text FROM documents)"""


def regression_diff(spark, sf_dir) -> DataFrame:
    return qa.difference(*runs(spark, sf_dir), "doc_id", ["page_start"])


def crosscheck_sets(spark, sf_dir) -> DataFrame:
    return qa.crosscheck(*runs(spark, sf_dir), "doc_id")


def merge_missing_units(spark, sf_dir) -> DataFrame:
    return qa.merge_missing(*runs(spark, sf_dir), "doc_id", "second").select("doc_id", "merged_from")


def text_of(column, **names):
    """A query that puts every document's text through one function."""
    return lambda s, d: read(s, d, "documents").select("doc_id", column(F.col("text")).alias("text"))


def address(c):
    return F.concat(F.lit("Art. "), F.char_length(c).cast("string"), F.lit(" a"))


def stop_reasons(spark, sf_dir) -> DataFrame:
    share = qa.coverage(cards(spark, sf_dir), book_lengths(spark, sf_dir), ["doc_id"]).select("doc_id", F.col("share").alias("coverage"), F.lit(1.0).alias("continuity"))
    return qa.stops(share).select("doc_id", "stops")


def equal_pages(spark, sf_dir) -> DataFrame:
    return qa.equal_pages(read(spark, sf_dir, "documents"), ["lang"], "text", "doc_id")


def dead_pages(spark, sf_dir) -> DataFrame:
    pages = read(spark, sf_dir, "documents").select("source", "doc_id")
    length = F.when(F.col("doc_id") % 4 == 0, 20).otherwise(-1)  # a card may hold no page
    spans = pages.select("source", F.col("doc_id").alias("page_start"), (F.col("doc_id") + length).alias("page_end"))
    return qa.dead_pages(pages, spans, ["source"], "doc_id")


def footnote_figures(spark, sf_dir) -> DataFrame:
    n = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list("turn").alias("footnotes")).withColumn("lang", F.col("conv_id") % 3)
    return qa.footnote_figures(n.withColumn("footnotes", F.filter("footnotes", lambda t: t % 2 == 1)), ["lang"])


STATUTES = [r"section \d+", r"\b\w+tion\b", r"the \w+tion"]

QUERIES = {
    "line_index_offsets": lambda s, d: lines(s, d).select("doc_id", "i", "start", "end"),
    "pagemap": pagemap,
    "section_carry_forward": section_carry_forward,
    "section_backfill": section_backfill,
    "asof_section": asof_section,
    "export_segments": export_segments,
    "hierarchy_stack": hierarchy_stack,
    "sequence_breaks": sequence_breaks,
    "series_gaps": lambda s, d: qa.gaps(series(s, d), ["family", "section"], "number"),
    "series_duplicates": lambda s, d: qa.duplicates(series(s, d), ["section"], "number"),
    "continuity_share": continuity_share,
    "coverage_share": lambda s, d: qa.coverage(cards(s, d), book_lengths(s, d), ["doc_id"]),
    "coverage_holes": lambda s, d: qa.holes(cards(s, d), book_lengths(s, d), ["doc_id"]),
    "stop_reasons": stop_reasons,
    "lengths_stats": lambda s, d: qa.lengths(read(s, d, "documents"), ["lang"]),
    "depth_histogram": lambda s, d: qa.depth_histogram(read(s, d, "documents").withColumn("hierarchy", F.slice(F.split("text", r"\."), F.lit(1), F.col("doc_id").cast("int") % 5)), ["source"]),
    "footnote_figures": footnote_figures,
    "equal_pages": equal_pages,
    "dead_pages": dead_pages,
    "refs_unresolved": lambda s, d: qa.unresolved(refs(s, d), series(s, d), ["family", "section", "number"]),
    "refs_resolved": lambda s, d: qa.resolved_share(refs(s, d), series(s, d), ["family"], ["family", "section", "number"]),
    "regression_diff": regression_diff,
    "crosscheck_sets": crosscheck_sets,
    "merge_missing_units": merge_missing_units,
    "seeded_sample": lambda s, d: qa.seeded_sample(read(s, d, "documents").select("doc_id"), "doc_id", 50, 7),
    "duplicate_cards_keep_last": lambda s, d: S.keep_one(numbered_cards(s, d), ["external_id"], ["doc_id"], last=True).select("external_id", "doc_id"),
    "dedupe_cross_book": dedupe_cross_book,
    "mark_repeats": lambda s, d: S.mark_repeats(numbered_cards(s, d), "external_id", ["doc_id"]).select("doc_id", "external_id", "repeat_of"),
    "drop_duplicate_pages": drop_duplicate_pages,
    "fill_constant_offset": fill_constant_offset,
    "fill_sequential": fill_sequential,
    "strip_lines": text_of(lambda c: T.strip_lines(c, "^(Licensed|The)", r"\btoken\b")),
    "trim_after": text_of(lambda c: T.trim_after(c, "Licensed under")),
    "detab": text_of(T.detab),
    "expand_ligatures": text_of(lambda c: T.expand_ligatures(F.replace(c, F.lit("fi"), F.lit("ﬁ")))),
    "clean_characters": text_of(lambda c: T.clean_characters(F.translate(c, "\n", "\x02"))),
    "normal_key": text_of(lambda c: T.normal_key(c)),
    "pad_numbers": text_of(lambda c: T.pad_number(address(c), 6)),
    "normalize_address": text_of(lambda c: T.tidy_article(F.concat(F.lit("X. –"), F.char_length(c).cast("string")))),
    "repair_article_numbers": text_of(lambda c: T.repair_article_number(F.translate(F.char_length(c).cast("string"), "015", "OlS"))),
    "running_head": text_of(lambda c: T.without_page_number(F.concat_ws(" ", F.char_length(c).cast("string"), F.split(c, "\n")[0]))),
    "statutory_refs": lambda s, d: read(s, d, "documents").select("doc_id", F.array_join(T.find_all(F.col("text"), STATUTES), "|").alias("refs")),
}


def _text(expression: str) -> str:
    return f"SELECT doc_id, {expression} AS text FROM documents"


_W = "(PARTITION BY user_id ORDER BY ts, event_id"
_LEVEL = "CASE WHEN length(line) % 7 < 3 THEN length(line) % 7 END"

ORACLES = {
    "line_index_offsets": f'WITH {LINES} SELECT doc_id, i::INT AS i, start, start + length(line) AS "end" FROM lines',
    "pagemap": f'WITH {LINES} SELECT doc_id, i // 5 AS page, min(start) AS start, max(start + length(line)) AS "end" FROM lines GROUP BY ALL',
    "section_carry_forward": f"SELECT event_id, last_value(CASE WHEN event_type = 'click' THEN value END IGNORE NULLS) OVER {_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section FROM events",
    "section_backfill": f"SELECT event_id, first_value(CASE WHEN event_type = 'click' THEN value END IGNORE NULLS) OVER {_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS section FROM events",
    "asof_section": """SELECT v.user_id, v.event_id, p.value AS section FROM (SELECT * FROM events WHERE event_type = 'view') v
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON v.user_id = p.user_id AND v.event_id >= p.event_id""",
    "export_segments": f"SELECT user_id, segment, count(*) AS n FROM (SELECT user_id, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER {_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS segment FROM events) GROUP BY ALL",
    "hierarchy_stack": f"""WITH {LINES}, p AS (SELECT doc_id, i, {_LEVEL} AS level FROM lines),
l AS (SELECT doc_id, i, {", ".join(f"coalesce(max(CASE WHEN level = {n} THEN i END) OVER (PARTITION BY doc_id ORDER BY i), -1) AS p{n}" for n in range(3))} FROM p)
SELECT doc_id, i::INT AS i, concat_ws('>', CASE WHEN p0 >= 0 THEN 'h' || p0 END, CASE WHEN p1 >= 0 AND p1 > p0 THEN 'h' || p1 END, CASE WHEN p2 >= 0 AND p2 > p0 AND p2 > p1 THEN 'h' || p2 END) AS hierarchy FROM l""",
    "sequence_breaks": f"""WITH {SERIES}, o AS (SELECT section, number, lag(number) OVER w AS before, (row_number() OVER w)::INT AS "at" FROM series WINDOW w AS (PARTITION BY section ORDER BY part, number, family))
SELECT section, "at", before, number, CASE WHEN number < before THEN 'restart' WHEN number > before + 1 THEN 'gap' ELSE 'duplicate' END AS kind FROM o WHERE before IS NOT NULL AND number <> before + 1""",
    "series_gaps": f"""WITH {SERIES}, p AS (SELECT family, section, number AS "from", lead(number) OVER (PARTITION BY family, section ORDER BY number) AS "to" FROM (SELECT DISTINCT family, section, number FROM series))
SELECT *, "to" - "from" - 1 AS missing FROM p WHERE "to" - "from" > 1""",
    "series_duplicates": f"WITH {SERIES} SELECT section, number, count(*) AS n FROM series GROUP BY ALL HAVING count(*) > 1",
    "continuity_share": f"""WITH {SERIES}, p AS (SELECT family, number, lead(number) OVER (PARTITION BY family, section ORDER BY number) AS nxt FROM (SELECT DISTINCT family, section, number FROM series)),
m AS (SELECT family, sum(nxt - number - 1)::BIGINT AS missing FROM p WHERE nxt - number > 1 GROUP BY family)
SELECT family, count(*) AS cards, coalesce(any_value(missing), 0) AS missing, round(count(*) / (count(*) + coalesce(any_value(missing), 0)), 4) AS share FROM series LEFT JOIN m USING (family) GROUP BY family""",
    "coverage_share": f"""WITH {CARDS}, c AS (SELECT doc_id, sum(greatest(char_end - greatest(char_start, reach), 0))::BIGINT AS covered_chars FROM merged GROUP BY doc_id)
SELECT doc_id, book_chars, coalesce(covered_chars, 0) AS covered_chars, round(coalesce(covered_chars, 0) / book_chars, 4) AS share FROM books LEFT JOIN c USING (doc_id)""",
    "coverage_holes": f"""WITH {CARDS}, h AS (SELECT doc_id, reach AS "from", char_start AS "to" FROM merged WHERE char_start > reach
  UNION ALL SELECT doc_id, coalesce(m, 0), book_chars FROM books LEFT JOIN (SELECT doc_id, max(char_end) AS m FROM cards GROUP BY doc_id) USING (doc_id) WHERE coalesce(m, 0) < book_chars)
SELECT *, "to" - "from" AS chars FROM h""",
    "stop_reasons": f"""WITH {CARDS}, c AS (SELECT doc_id, sum(greatest(char_end - greatest(char_start, reach), 0)) AS n FROM merged GROUP BY doc_id)
SELECT doc_id, 'coverage' AS stops FROM books LEFT JOIN c USING (doc_id) WHERE round(coalesce(n, 0) / book_chars, 4) < 0.9""",
    "lengths_stats": "SELECT lang, median(length(text)) AS median, min(length(text))::INT AS min, max(length(text))::INT AS max, count(*) FILTER (length(text) < 20) AS too_short, count(*) FILTER (length(text) > 20000) AS too_long FROM documents GROUP BY lang",
    "depth_histogram": r"SELECT source, least(doc_id % 5, len(string_split(text, '.')))::INT AS depth, count(*) AS cards FROM documents GROUP BY ALL",
    "footnote_figures": """WITH n AS (SELECT conv_id % 3 AS lang, count(*) FILTER (turn % 2 = 1) AS n FROM conversations GROUP BY conv_id)
SELECT lang, round(avg(CASE WHEN n > 0 THEN 1 ELSE 0 END), 4) AS share, sum(n)::BIGINT AS total, median(n) AS per_card FROM n GROUP BY lang""",
    "equal_pages": "SELECT lang, min(doc_id) AS first, count(*) AS copies FROM documents WHERE trim(text) <> '' GROUP BY lang, text HAVING count(*) > 1",
    "dead_pages": "SELECT source, doc_id FROM documents p WHERE NOT EXISTS (SELECT 1 FROM documents c WHERE c.source = p.source AND c.doc_id % 4 = 0 AND p.doc_id BETWEEN c.doc_id AND c.doc_id + 20)",
    "refs_unresolved": f"WITH {SERIES} SELECT family, section, number + 2 AS number FROM series r WHERE NOT EXISTS (SELECT 1 FROM series u WHERE u.family = r.family AND u.section = r.section AND u.number = r.number + 2)",
    "refs_resolved": f"""WITH {SERIES}, u AS (SELECT DISTINCT family, section, number, 1 AS known FROM series),
r AS (SELECT s.family, count(*) AS refs_total, sum(CASE WHEN known IS NULL THEN 1 ELSE 0 END)::BIGINT AS unresolved FROM series s LEFT JOIN u ON u.family = s.family AND u.section = s.section AND u.number = s.number + 2 GROUP BY 1)
SELECT *, round(1 - unresolved / nullif(refs_total, 0), 4) AS resolved_share FROM r""",
    "regression_diff": f"""WITH {RUNS}, b AS (SELECT coalesce(one.doc_id, two.doc_id) AS doc_id, CASE WHEN two.doc_id IS NULL THEN 'lost' WHEN one.doc_id IS NULL THEN 'new' WHEN one.page_start <> two.page_start THEN 'moved' WHEN one.text <> two.text THEN 'text' END AS change FROM one FULL JOIN two ON one.doc_id = two.doc_id)
SELECT * FROM b WHERE change IS NOT NULL""",
    "crosscheck_sets": f"WITH {RUNS} SELECT CASE WHEN two.doc_id IS NULL THEN 'only_first' WHEN one.doc_id IS NULL THEN 'only_second' ELSE 'both' END AS place, count(*) AS n FROM one FULL JOIN two ON one.doc_id = two.doc_id GROUP BY 1",
    "merge_missing_units": f"WITH {RUNS} SELECT doc_id, NULL::VARCHAR AS merged_from FROM one UNION ALL SELECT doc_id, 'second' FROM two WHERE doc_id NOT IN (SELECT doc_id FROM one)",
    "seeded_sample": "SELECT doc_id FROM documents ORDER BY sha256(doc_id || ':7'), doc_id LIMIT 50",
    "duplicate_cards_keep_last": "SELECT source || ':' || (n_chars % 40) AS external_id, max(doc_id) AS doc_id FROM documents GROUP BY 1",
    "dedupe_cross_book": "SELECT external_id, doc_id, n_chars FROM (SELECT *, source || ':' || (n_chars % 40) AS external_id, row_number() OVER (PARTITION BY source, n_chars % 40 ORDER BY n_chars DESC, doc_id) AS k FROM documents) WHERE k = 1",
    "mark_repeats": """SELECT doc_id, e || CASE WHEN k > 1 THEN ' (' || k || ')' ELSE '' END AS external_id, CASE WHEN k > 1 THEN e END AS repeat_of
FROM (SELECT doc_id, source || ':' || (n_chars % 40) AS e, row_number() OVER (PARTITION BY source, n_chars % 40 ORDER BY doc_id) AS k FROM documents)""",
    "drop_duplicate_pages": r"""WITH k AS (SELECT doc_id, source, trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g'))[1:200] AS head FROM documents)
SELECT doc_id, length(head) >= 40 AND coalesce(lead(doc_id) OVER (PARTITION BY source, head ORDER BY doc_id) - doc_id <= 400, false) AS duplicate_scan FROM k""",
    "fill_constant_offset": f"""WITH {FOLIOS}, c AS (SELECT user_id, folio - page AS o, count(*) AS n FROM folios WHERE folio IS NOT NULL GROUP BY ALL),
m AS (SELECT user_id, o FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, o) AS k FROM c) WHERE k = 1)
SELECT user_id, page, CASE WHEN o IS NOT NULL AND folio - page IS DISTINCT FROM o THEN page + o ELSE folio END AS folio, o IS NOT NULL AND folio - page IS DISTINCT FROM o AS folio_filled FROM folios LEFT JOIN m USING (user_id)""",
    "fill_sequential": f"""WITH {FOLIOS}, n AS (SELECT *, last_value(folio - page IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l,
  first_value(folio - page IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY page ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r FROM folios),
k AS (SELECT user_id, page, CASE WHEN NOT (folio IS NOT NULL AND NOT (l IS NULL AND r IS NULL) AND folio - page IS DISTINCT FROM l AND folio - page IS DISTINCT FROM r) THEN folio END AS folio FROM n),
f AS (SELECT *, last_value(folio - page IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS b,
  first_value(folio - page IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY page ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS a FROM k)
SELECT user_id, page, CASE WHEN folio IS NOT NULL THEN folio ELSE page + coalesce(a, b) END AS folio, folio IS NULL AND a IS NOT NULL AND b IS NOT NULL AND a <> b AS folio_approx FROM f""",
    "strip_lines": _text(r"array_to_string([regexp_replace(l, '\btoken\b', '', 'g') for l in string_split(text, chr(10)) if NOT regexp_matches(l, '^(Licensed|The)')], chr(10))"),
    "trim_after": _text(r"CASE WHEN instr(text, 'Licensed under') > 40 THEN rtrim(text[1:instr(text, 'Licensed under') - 1], ' ') ELSE text END"),
    "detab": _text(r"trim(regexp_replace(text, '[\t\x{00A0}\x{202F} ]+', ' ', 'g'), ' ')"),
    "expand_ligatures": _text("text"),
    "clean_characters": _text("replace(text, chr(10), '')"),
    "normal_key": _text(r"regexp_replace(lower(text), '[^\p{L}\p{N}]+', '', 'g')"),
    "pad_numbers": _text("'Art. ' || lpad(length(text)::VARCHAR, greatest(6, length(length(text)::VARCHAR))::INT, '0') || ' a'"),
    "normalize_address": _text("'X.–' || length(text)"),
    "repair_article_numbers": _text("CASE WHEN length(length(text)::VARCHAR) = 3 THEN length(text)::VARCHAR ELSE translate(length(text)::VARCHAR, '015', 'OlS') END"),
    "running_head": _text(r"trim(regexp_replace(length(text) || ' ' || string_split(text, chr(10))[1], '^\s*\d{1,4}\s+|\s+\d{1,4}\s*$', '', 'g'), ' ')"),
    "statutory_refs": r"""WITH m AS (SELECT doc_id, list_concat(regexp_extract_all(text, 'section \d+', 0, 'i'), list_concat([x FOR x IN regexp_extract_all(regexp_replace(text, '[^\x00-\x7F\P{L}]', '_', 'g'), '\b\w+tion\b', 0, 'i') IF NOT contains(x, '_')], regexp_extract_all(text, 'the \w+tion', 0, 'i'))) AS m FROM documents),
e AS (SELECT doc_id, unnest(m) AS ref, unnest(range(len(m))) AS i FROM m), f AS (SELECT doc_id, arg_min(ref, i) AS ref, min(i) AS i FROM e GROUP BY doc_id, lower(ref)),
r AS (SELECT doc_id, string_agg(ref, '|' ORDER BY i) AS refs FROM f GROUP BY doc_id)
SELECT doc_id, CASE WHEN text IS NOT NULL THEN coalesce(refs, '') END AS refs FROM documents LEFT JOIN r USING (doc_id)""",
}
