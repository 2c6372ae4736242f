import random

import duckdb

from folioforge.llm import urlfilter


def test_verdicts_equal_sql(spark, tmp_path):
    rnd = random.Random(1)
    hosts = ["net", "NET", "example.net", "a.example.net", "xexample.net", "b.a.example.com", "org", "x.org.", ".net", "com:80", "", "é.org"]
    urls = [None, "", "x", "http://", *[f"{rnd.choice(['http', 'x'])}://{rnd.choice(hosts)}{rnd.choice(['', '/', '/en/', '/en', '/de/x', '/fr/?a', '?b/', '#/fr/'])}" for _ in range(300)]]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    got = urlfilter.digest(spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    want = con.sql(urlfilter.SQL).fetchall()
    assert sorted(map(tuple, got.select("page_id", "host", "path", "rule", "verdict").collect())) == sorted(want)


def test_nested_rules_and_ties(spark):
    rules = spark.createDataFrame([("block", "c", "/"), ("allow", "b.c", "/"), ("block", "a.b.c", "/x"), ("allow", "a.b.c", "/x"), ("block", "b.c", "/xyz/longer")], "verdict string, host string, path string")
    pages = spark.createDataFrame([(1, "h://z.c/"), (2, "h://q.b.c/"), (3, "h://a.b.c/xyz/longer"), (4, "h://a.b.c/x"), (5, "h://d/"), (5, "h://d/")], "page_id int, url string")
    got = {(r["page_id"], r["rule"], r["verdict"]) for r in urlfilter.judge(pages, rules, spread=2).collect()}
    assert got == {(1, "c/", "block"), (2, "b.c/", "allow"), (3, "b.c/xyz/longer", "block"), (4, "a.b.c/x", "block"), (5, None, "allow")}
    assert urlfilter.judge(pages, rules.limit(0)).where("verdict = 'allow'").count() == 6
    assert urlfilter.judge(pages.limit(0), rules).count() == 0


def test_messy(spark, messy):
    out = urlfilter.judge(messy.withColumnRenamed("text", "url"), urlfilter.rule_frame(spark))
    assert out.count() == messy.count() and out.where("host <> '' or rule is not null").count() == 0
