"""Queries over the documents set as pages: parted headings, notes counted over pages, print jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.operators import carried, headings, printjobs
from folioforge.plans.builds import PRINTED
from folioforge.sources.files import scratch
from folioforge.sources.tables import read
from folioforge.streaming import events
from folioforge.streaming import notes as streamed


def book_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(book_id, n, line): a document's lines with a word, white space collapsed."""
    line = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("book_id"), F.posexplode(F.split("text", "\n")).alias("i", "line"))
    line = line.withColumn("line", F.trim(F.regexp_replace("line", r"[\x20\x09-\x0D]+", " "))).where("line <> ''")
    return line.select("book_id", (F.row_number().over(Window.partitionBy("book_id").orderBy("i")) - 1).alias("n"), "line")


def parted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten lines a page; of five the third is a number, the two before it may be large, and every seventh line is large."""
    n = F.col("n")
    text = F.when(n % 5 == 2, F.concat(F.lit("No. "), n.cast("string"))).when(n % 15 == 13, F.lit("")).otherwise(F.col("line"))
    size = F.when((n % 5 == 2) | ((n % 5 == 1) & (n % 3 != 0)) | ((n % 5 == 0) & (n % 2 == 0)) | (n % 7 == 0), 13.0).otherwise(9.0)
    box = {"top": n % 10 * 10.0, "x0": 100.0 - n % 4, "x1": 200.0 + n % 6}
    return book_lines(spark, sf_dir).select("book_id", F.expr("cast(n div 10 as int)").alias("page_seq"), n.alias("line_no"), text.alias("text"), size.alias("size"), *[c.alias(k) for k, c in box.items()])


def headings_above(spark, sf_dir) -> DataFrame:
    out = headings.joined_above(parted(spark, sf_dir), r"^No\. \d+$", most=2, head_start="^[A-Z]", skip=["^The "])
    return out.select("book_id", "line_no", "text", "joined", "top", "x0", "x1")


def headings_below(spark, sf_dir) -> DataFrame:
    return headings.joined_below(parted(spark, sf_dir), r"^No\. \d+$").select("book_id", "line_no", "text", "joined")


def numbers_restored(spark, sf_dir) -> DataFrame:
    """The model has lost the numbers of every other line."""
    printed = parted(spark, sf_dir)
    model = printed.where("not (line_no % 5 = 2 and line_no % 2 = 0)")
    return headings.restored(model, printed, r"^No\. \d+$").select("book_id", "page_seq", "line_no", "text", "restored")


def note_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six lines a page, every third one numbered but the first; the numbers begin anew after twenty, and one in four is far off."""
    n = F.col("n")
    number = F.when(n % 12 == 10, n * 37 % 400 + 1).when(n % 3 == 1, F.floor(n / 3) % 20 + 1)
    text = F.coalesce(F.concat(number.cast("string"), F.lit(". "), "line"), F.concat(F.lit("x "), "line"))
    rows = book_lines(spark, sf_dir).select("book_id", F.expr("cast(n div 6 as int)").alias("page_seq"), "n", text.alias("text"))
    return rows.groupBy("book_id", "page_seq").agg(F.array_sort(F.collect_list(F.struct("n", "text"))).alias("_l")).select("book_id", "page_seq", F.col("_l.text").alias("lines"))


READ = carried.reader("dot", 3)


def notes_carried(spark, sf_dir) -> DataFrame:
    return carried.carried_notes(note_pages(spark, sf_dir), READ)


def notes_carried_stream(spark, sf_dir) -> DataFrame:
    """The same pages as a stream, dealt over files by a hash, so that a book's pages come in several batches and out of order."""
    pages, place = note_pages(spark, sf_dir), scratch(spark, "note-pages")
    pages.repartition(12, F.xxhash64("book_id", "page_seq")).write.parquet(place)
    return events.drained(streamed.carried_notes(events.replay(spark, place, pages, files_per_trigger=4), READ), "append")


def note_tails_joined(spark, sf_dir) -> DataFrame:
    return carried.tails_joined(notes_carried(spark, sf_dir))


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as print jobs: twelve lines are one, its last two its block; of every four jobs the first has numbers in the
    margin and announces a range, the second announces one number, the third a range, the fourth none.

    A number in the margin of line 1 isn't announced; line 3's and 6's are. Sections hold four jobs each, and recur.
    """
    n, j = F.col("n"), F.expr("cast(n div 12 as int)")
    k = n % 12
    margin = F.when((j % 4 == 0) & (k == 1), "999").when((j % 4 == 0) & (k == 3), (j * 10 + 3).cast("string")).when((j % 4 == 0) & (k == 6), (j * 10 + 6).cast("string"))
    said = F.when(j % 4 == 0, F.format_string(" Rn. %d-%d", j * 10 + 2, j * 10 + 6)).when(j % 4 == 1, F.format_string(" Rn. %d", j * 10)).when(j % 4 == 2, F.format_string(" Rn. %d, %d", j * 10, j * 10 + 1)).otherwise("")
    section = (F.expr("cast(n div 48 as int)") % 3 + 1).cast("string")
    long = F.concat(F.rpad("line", 45, "."), F.lit(" x"))
    text = F.when(k == 10, "Zitiervorschläge").when(k == 11, F.concat(F.lit("W/B, 9. Aufl. 2021, BGB § "), section, said)).otherwise(F.concat_ws(" ", long, margin))
    body = F.struct(long.alias("text"), F.lit(100.0).alias("x0"), F.lit(400.0).alias("x1"))
    beside = F.struct(margin.alias("text"), F.lit(420.0).alias("x0"), F.lit(430.0).alias("x1"))
    return book_lines(spark, sf_dir).select("book_id", F.expr("cast(n div 40 as int)").alias("page_seq"), n.alias("line_no"), text.alias("text"), F.lit(100.0).alias("x0"), F.when(margin.isNotNull(), 430.0).otherwise(400.0).alias("x1"), F.lit(12.0).alias("size"), F.filter(F.array(body, beside), lambda w: w["text"].isNotNull()).alias("words"))


def job_units(spark, sf_dir) -> DataFrame:
    """The documents' jobs as units, without notes; the units are written once, since merging them reads them three times."""
    lines = printjobs.apparatus(printjobs.split(jobs(spark, sf_dir))).where("not is_note")
    units, place = printjobs.units(printjobs.raised(printjobs.numbered(lines))), scratch(spark, "job-units")
    units.write.parquet(place)
    return printjobs.merged(spark.read.schema(units.schema).parquet(place)).select("book_id", "job", "section", "number", "upto", "how", F.sha2("text", 256).alias("text_sha256"))


QUERIES = {
    "headings_above": headings_above,
    "headings_below": headings_below,
    "numbers_restored": numbers_restored,
    "notes_carried": notes_carried,
    "notes_carried_stream": notes_carried_stream,
    "note_tails_joined": note_tails_joined,
    "job_units": job_units,
}

NTH = PRINTED.split(",\nkinds AS")[0]
PARTED = f"""{NTH}, parted AS (SELECT book_id, (n // 10)::INT AS page_seq, n AS line_no, CASE WHEN n % 5 = 2 THEN 'No. ' || n WHEN n % 15 = 13 THEN '' ELSE line END AS text,
  CASE WHEN n % 5 = 2 OR (n % 5 = 1 AND n % 3 <> 0) OR (n % 5 = 0 AND n % 2 = 0) OR n % 7 = 0 THEN 13.0 ELSE 9.0 END AS size, n % 10 * 10.0 AS top, 100.0 - n % 4 AS x0, 200.0 + n % 6 AS x1 FROM nth),
kinds AS (SELECT *, regexp_matches(text, '^No\\. [0-9]+$') AS num FROM parted)"""
NOTES = f"""RECURSIVE {NTH}, l AS (SELECT book_id, n, (n // 6)::INT AS page_seq, line, (CASE WHEN n % 12 = 10 THEN n * 37 % 400 + 1 WHEN n % 3 = 1 THEN (n // 3) % 20 + 1 END)::INT AS c FROM nth),
p AS (SELECT *, list(c) FILTER (c IS NOT NULL) OVER (PARTITION BY book_id, page_seq) AS here FROM l),
r AS (SELECT book_id, n, page_seq, c, false AS acc, 0 AS last, 0 AS carry FROM p WHERE n = 0
  UNION ALL SELECT book_id, n, page_seq, c, acc, CASE WHEN acc THEN greatest(last, c) ELSE last END, CASE WHEN acc THEN c ELSE carry END
  FROM (SELECT *, coalesce((last < c AND c <= last + 3) OR (c < last AND list_contains(here, c + 1)), false) AS acc
    FROM (SELECT p.book_id, p.n, p.page_seq, p.c, p.here, CASE WHEN p.n % 6 = 0 THEN r.carry ELSE r.last END AS last, r.carry FROM r JOIN p ON p.book_id = r.book_id AND p.n = r.n + 1))),
g AS (SELECT r.*, line, sum(acc::INT) OVER (PARTITION BY r.book_id, r.page_seq ORDER BY r.n) AS g FROM r JOIN l USING (book_id, n)),
notes AS (SELECT book_id, page_seq, (g - min(g) OVER (PARTITION BY book_id, page_seq))::INT AS note, number, text, g = 0 AS carried FROM (
  SELECT book_id, page_seq, g, max(c) FILTER (acc) AS number, string_agg(CASE WHEN acc THEN line WHEN c IS NULL THEN 'x ' || line ELSE c || '. ' || line END, ' ' ORDER BY n) AS text FROM g GROUP BY ALL))"""

ORACLES = {
    "headings_above": f"""WITH {PARTED}, f AS (SELECT *, size >= 11 AND text <> '' AND NOT num AND NOT regexp_matches(text, '^The ') AS fits, regexp_matches(text, '^[A-Z]') AS starts FROM kinds),
w AS (SELECT *, coalesce(lag(fits) OVER o, false) AS f1, coalesce(lag(fits, 2) OVER o, false) AND coalesce(lag(fits) OVER o, false) AS f2, lag(starts) OVER o AS s1, lag(starts, 2) OVER o AS s2,
  lag(text) OVER o AS t1, lag(text, 2) OVER o AS t2, lag(top, 1) OVER o AS y1, lag(top, 2) OVER o AS y2, lag(x0) OVER o AS l1, lag(x0, 2) OVER o AS l2, lag(x1) OVER o AS r1, lag(x1, 2) OVER o AS r2
  FROM f WINDOW o AS (PARTITION BY book_id, page_seq ORDER BY line_no)),
k AS (SELECT *, CASE WHEN NOT num THEN 0 WHEN f2 AND s2 THEN 2 WHEN f1 AND s1 THEN 1 ELSE 0 END AS joined FROM w),
t AS (SELECT *, coalesce(lead(joined) OVER o, 0) >= 1 OR coalesce(lead(joined, 2) OVER o, 0) = 2 AS taken FROM k WINDOW o AS (PARTITION BY book_id, page_seq ORDER BY line_no))
SELECT book_id, line_no::INT AS line_no, CASE joined WHEN 2 THEN text || ' ' || t2 || ' ' || t1 WHEN 1 THEN text || ' ' || t1 ELSE text END AS text, joined, (CASE joined WHEN 2 THEN least(top, y1, y2) WHEN 1 THEN least(top, y1) ELSE top END)::DOUBLE AS top,
(CASE joined WHEN 2 THEN least(x0, l1, l2) WHEN 1 THEN least(x0, l1) ELSE x0 END)::DOUBLE AS x0, (CASE joined WHEN 2 THEN greatest(x1, r1, r2) WHEN 1 THEN greatest(x1, r1) ELSE x1 END)::DOUBLE AS x1 FROM t WHERE NOT taken""",
    "headings_below": f"""WITH {PARTED}, f AS (SELECT *, num AND size >= 13 AS opens, NOT num AND size >= 13 AND text <> '' AS heads, count(*) FILTER (text <> '') OVER (PARTITION BY book_id ORDER BY line_no) AS seen FROM kinds),
d AS (SELECT book_id, line_no AS spot, opens, heads, text, lead(line_no) OVER o AS next_at, lead(heads) OVER o AS next_heads, lead(text) OVER o AS next_text, lag(line_no) OVER o AS prev_at, lag(opens) OVER o AS prev_opens FROM f WHERE text <> '' WINDOW o AS (PARTITION BY book_id ORDER BY line_no)),
j AS (SELECT f.*, coalesce(f.opens AND next_heads AND next_at - spot <= 3, false) AS joined, coalesce(f.heads AND prev_opens AND spot - prev_at <= 3, false) AS taken, next_text FROM f LEFT JOIN d ON d.book_id = f.book_id AND d.spot = f.line_no)
SELECT book_id, line_no::INT AS line_no, CASE WHEN joined THEN text || ' ' || next_text ELSE text END AS text, joined FROM j WHERE NOT taken""",
    "numbers_restored": f"""WITH {PARTED}, model AS (SELECT * FROM kinds WHERE NOT (line_no % 5 = 2 AND line_no % 2 = 0)),
shown AS (SELECT *, lead(text) OVER (PARTITION BY book_id, page_seq ORDER BY line_no) AS nxt FROM kinds WHERE text <> ''),
lost AS (SELECT * FROM shown r WHERE num AND size >= 13 AND EXISTS (SELECT 1 FROM model m WHERE m.book_id = r.book_id AND m.page_seq = r.page_seq) AND NOT EXISTS (SELECT 1 FROM model m WHERE m.book_id = r.book_id AND m.page_seq = r.page_seq AND starts_with(m.text, r.text))),
firsts AS (SELECT book_id, page_seq, min(line_no) AS first FROM model GROUP BY book_id, page_seq),
pages AS (SELECT book_id, page_seq, lead(first) OVER (PARTITION BY book_id ORDER BY page_seq) AS after FROM firsts),
spots AS (SELECT l.book_id, l.line_no AS own, l.text, coalesce(min(m.line_no), any_value(p.after)) AS line_no FROM lost l JOIN pages p USING (book_id, page_seq) LEFT JOIN model m ON m.book_id = l.book_id AND m.page_seq = l.page_seq AND m.text = l.nxt GROUP BY l.book_id, l.line_no, l.text),
put AS (SELECT book_id, line_no, string_agg(text, ' ' ORDER BY own) AS numbers, count(*)::INT AS n FROM spots WHERE line_no IS NOT NULL GROUP BY ALL)
SELECT m.book_id, page_seq, m.line_no::INT AS line_no, CASE WHEN numbers IS NULL THEN text ELSE numbers || ' ' || text END AS text, coalesce(n, 0) AS restored FROM model m LEFT JOIN put USING (book_id, line_no)""",
    "notes_carried": f"WITH {NOTES} SELECT * FROM notes",
    "notes_carried_stream": f"WITH {NOTES} SELECT * FROM notes",
    "note_tails_joined": f"""WITH {NOTES}, host AS (SELECT book_id, page_seq, max(note) AS note FROM notes WHERE number IS NOT NULL GROUP BY ALL),
met AS (SELECT h.book_id, h.page_seq, h.note, t.text AS tail FROM host h JOIN notes t ON t.book_id = h.book_id AND t.page_seq = h.page_seq + 1 AND t.carried AND t.note = 0)
SELECT n.book_id, n.page_seq, n.note, number, CASE WHEN tail IS NULL THEN text ELSE text || ' ' || tail END AS text, carried FROM notes n LEFT JOIN met USING (book_id, page_seq, note)
WHERE NOT EXISTS (SELECT 1 FROM met WHERE met.book_id = n.book_id AND met.page_seq = n.page_seq - 1 AND n.carried AND n.note = 0)""",
    "job_units": f"""WITH {NTH}, l AS (SELECT book_id, n, n // 12 AS job, n % 12 AS k, rpad(line, 45, '.') || ' x' AS text, max(n) OVER (PARTITION BY book_id, n // 12) % 12 = 11 AS closed, ((n // 48) % 3 + 1)::VARCHAR AS own,
  least(count(*) OVER (PARTITION BY book_id, n // 12), 10) >= 4 AS edged FROM nth),
s AS (SELECT *, CASE WHEN closed THEN own END AS section, CASE WHEN NOT closed THEN 3 ELSE job % 4 END AS kind, job % 4 = 0 AND edged AS margin FROM l WHERE k < 10),
m AS (SELECT *, CASE WHEN margin AND k IN (3, 6) THEN job * 10 + k WHEN margin AND k = 1 AND NOT closed THEN 999 END AS rn FROM s),
c AS (SELECT *, count(rn) OVER (PARTITION BY book_id, job ORDER BY n) AS i, count(rn) OVER (PARTITION BY book_id, job) AS all_ FROM m),
u AS (SELECT book_id, job, section, kind, any_value(all_) AS marks, CASE WHEN kind = 0 OR all_ = 0 THEN i ELSE greatest(i, 1) END AS unit, arg_min(rn, n) FILTER (rn IS NOT NULL) AS rn,
  string_agg(CASE WHEN job % 4 = 0 AND NOT margin AND k IN (1, 3, 6) THEN text || ' ' || CASE k WHEN 1 THEN 999 ELSE job * 10 + k END ELSE text END, chr(10) ORDER BY n) AS text FROM c GROUP BY book_id, job, section, kind, unit),
v AS (SELECT book_id, job, section, coalesce(rn, CASE kind WHEN 0 THEN job * 10 + 2 WHEN 3 THEN 0 ELSE job * 10 END) AS number, CASE WHEN rn IS NULL AND kind = 2 THEN job * 10 + 1 END AS upto,
  CASE WHEN rn IS NOT NULL THEN 'margin' WHEN kind IN (0, 1) THEN 'citation' WHEN kind = 2 THEN 'range' ELSE 'opening' END AS how, trim(text) AS text FROM u)
SELECT book_id, job::BIGINT AS job, section, number::INT AS number, upto::INT AS upto, how, sha256(text) AS text_sha256
FROM (SELECT *, row_number() OVER (PARTITION BY book_id, section, number, upto ORDER BY length(text) DESC, job) AS best FROM v) WHERE best = 1""",
}
