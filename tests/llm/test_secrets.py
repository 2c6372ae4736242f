import random
import re
import time

from pyspark.sql import functions as F

from folioforge.llm import secrets

RULES = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I), 2, 8), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16), ("hex", re.compile("[0-9a-f]+"), 0, 32), ("pem", re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"), 0, 1), ("forge", re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}"), 0, 1)]


def brute(text):
    found = [(m.start(), k, name, m.end()) for k, (name, rx, group, least) in enumerate(RULES) for m in rx.finditer(text or "") if len(m.group(group)) >= least]
    return ",".join(f"{name}:{a}:{b}" for a, _, name, b in sorted(found))


def texts():
    rnd = random.Random(3)
    parts = ["token", "PassWord", "api_key", "=", " ", ":", "'", '"', "secret", "abcdefgh", "a", "é", "😀", "AKIA", "ABCDEFGH1234", "0123456789abcdef", "\n", "ghp_", "z" * 20, "-----BEGIN RSA PRIVATE KEY-----"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(400)] + ["", None, "token=x " * 500, "token=abcdefgh12 " * 500]


def test_spans_equal_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    got = {r["doc_id"]: r["s"] for r in secrets.by_path(docs, secrets.scan(docs)).select("doc_id", secrets.listing(F.col("findings")).alias("s")).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts())}


def test_ledger_scans_only_what_it_lacks(spark):
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    whole = secrets.scan(docs)
    some = whole.withColumns({"scanned": F.array(F.lit("assign@1"), F.lit("hex@0")), "findings": F.expr("filter(findings, f -> f.rule = 'assign@1')")})
    assert secrets.scan(docs, some).exceptAll(whole).isEmpty()
    planted = whole.withColumn("findings", F.expr("array(struct('assign@1' as rule, 0L as start, 1L as end), struct('assign@0' as rule, 5L as start, 6L as end))"))
    kept = secrets.scan(docs, planted).select(F.explode("findings").alias("f")).select("f.rule", "f.start").distinct().collect()
    assert kept == [("assign@1", 0)]  # known pairs aren't scanned again, findings of an old version go


def test_many_matches_in_one_text(spark):
    """The cost grows with the matches: 200,000 in one text take seconds."""
    text = "\n".join(f"é {i:032x} token=abcdefgh{i}" for i in range(100_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    begun = time.monotonic()
    assert secrets.scan(docs).select(secrets.listing(F.col("findings"))).first()[0] == brute(text)
    assert time.monotonic() - begun < 30


def test_known_blobs_are_not_read_again(spark):
    """A blob whose pairs the ledger has in full comes from there, in one or several rows; new ones are scanned."""
    docs = spark.createDataFrame([(1, "token=abcdefgh1"), (2, "token=abcdefgh2"), (3, "token=abcdefgh2")], "doc_id long, text string")
    first = secrets.scan(docs.where("doc_id = 1")).withColumn("findings", F.expr("array(struct('hex@1' as rule, 7L as start, 8L as end))"))
    got = {r["blob"]: r["n"] for r in secrets.scan(docs, first.unionByName(first)).select("blob", secrets.listing(F.col("findings")).alias("n")).collect()}
    assert sorted(got.values()) == ["assign:0:15", "hex:7:8"]


def test_messy(messy, nothing):
    out = secrets.by_path(messy, secrets.scan(messy))
    assert out.count() == messy.count() and set(messy.columns) - {"text"} <= set(out.columns)
    assert secrets.by_path(nothing, secrets.scan(nothing)).count() == 0
