import math
import random
import re

import duckdb
from pyspark.sql import functions as F

from folioforge.llm import quality


def repeated(words):
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    return len({i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)})


def test_measures_equal_brute_force(spark):
    rnd = random.Random(2)
    texts = ["".join(rnd.choice(["a", "b", "the ", "# ", "\n", "\x0b", " ", "É", "9"]) for _ in range(rnd.randint(0, 160))) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("doc_id", "text", "'en' lang")
    for r in quality.judge(docs).collect():
        t = texts[r["doc_id"]]
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), repeated(w))


def test_windows_of_one_hash_are_compared(spark, monkeypatch):
    """With 14 bits of hash other windows share one in most texts, and the counts stay exact."""
    monkeypatch.setattr(quality, "_mask", lambda words: F.lit(-(1 << 50)).cast("bigint"))
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice("abcdefg") + rnd.choice(["", "h"]) for _ in range(300)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("doc_id", "text", "'en' lang")
    assert {r["doc_id"]: r["n_repeat_words"] for r in quality.judge(docs).collect()} == {i: repeated(t.split()) for i, t in enumerate(texts)}


def test_verdicts_equal_sql(spark, tmp_path):
    rnd = random.Random(4)
    common = quality.COMMON["en"]
    good = [" ".join(rnd.choice(common) if rnd.random() < 0.3 else "".join(rnd.choice("aeionst") for _ in range(rnd.randint(2, 7))) for _ in range(rnd.randint(60, 200))) for _ in range(40)]
    bad = ["".join(rnd.choice("XYZ!! ") for _ in range(900)) for _ in range(4)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(good + bad)], "doc_id long, text string, lang string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = quality.digest(spark, str(tmp_path)).toPandas()
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(quality.SQL).df()[list(got.columns)]
    assert sorted(map(tuple, got.values.tolist())) == sorted(map(tuple, want.values.tolist()))
    assert got[got.doc_id < 40].kept.all() and not got[got.doc_id >= 40].kept.any()
    assert quality.clean(docs).count() == int(got.kept.sum())


def test_divergence(spark):
    d = lambda a, b: spark.range(1).select(quality.divergence(F.array(*map(F.lit, a)), F.array(*map(F.lit, b)))).first()[0]
    assert d([1.0, 0.0], [0.0, 5.0]) == 1.0 and d([1.0, 2.0], [2.0, 4.0]) == 0.0 and d([0.0], [1.0]) is None
    assert math.isclose(d([1.0, 0.0], [1.0, 1.0]), math.sqrt(0.75 * math.log2(4 / 3) * 0 + (math.log2(4 / 3) + 0.5 * math.log2(2 / 3) + 0.5) / 2))


def test_messy(messy, nothing):
    out = quality.judge(messy)
    assert out.count() == messy.count()
    assert out.where("doc_id = 2 and n_words = 0 and base_failed and not kept and word_distance is null").count() == 1
    assert quality.clean(messy).columns == messy.columns
    assert quality.judge(nothing).count() == 0 and quality.clean(nothing).count() == 0
