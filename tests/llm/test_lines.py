import random

import duckdb
from pyspark.sql import functions as F

from folioforge.llm import lines


def corpus():
    rnd = random.Random(5)
    base = [" ".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 11))) for _ in range(40)]

    def changed(line):
        w, k = line.split(), rnd.random()
        i = rnd.randrange(len(w))
        if k < 0.3:
            w[i] = rnd.choice("abcde")
        elif k < 0.5:
            del w[i]
        elif k < 0.7:
            w.insert(i, rnd.choice("abcde"))
        return "  ".join(w)

    return [(i, "\n".join(changed(rnd.choice(base)) for _ in range(rnd.randint(0, 8)))) for i in range(200)] + [(500, None), (501, ""), (502, "\n\n")]


def test_repeats_equal_sql_and_leave_the_text(spark, tmp_path):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = lines.digest(spark, str(tmp_path)).toPandas()
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(lines.SQL).df()[list(got.columns)]
    assert sorted(map(tuple, got.values.tolist())) == sorted(map(tuple, want.values.tolist())) and (got.reason == "near").sum() > 50
    gone = {}
    for d, n in zip(got.doc_id, got.line_no):
        gone.setdefault(d, set()).add(n)
    left = {i: t if i not in gone else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) for i, t in corpus()}
    left = {i: t for i, t in left.items() if i not in gone or t.strip()}
    out = lines.dedup(docs.withColumn("n_chars", F.lit(0)), least=1).collect()
    assert {r["doc_id"]: r["text"] for r in out} == left
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in out)


def test_messy(messy, nothing):
    out = lines.dedup(messy)
    # The null id comes first: both rows of id 1 lose the line, and with it their text; 6 repeats 5.
    assert sorted(map(str, (r["doc_id"] for r in out.collect()))) == ["1", "2", "3", "4", "5", "7", "None", "None"]
    assert out.columns == messy.columns and lines.dedup(nothing).count() == 0


def test_short_lines_are_reported_and_kept(spark):
    docs = spark.createDataFrame([(1, "Yes\nSee below\none two three"), (2, " Yes \nSee  below\none two three"), (3, "\n \n")], "doc_id long, text string")
    found = sorted((r["doc_id"], r["line_no"], r["reason"], r["earlier"]["doc_id"]) for r in lines.repeats(docs).collect())
    assert found == [(2, 0, "equal", 1), (2, 1, "equal", 1), (2, 2, "equal", 1)]
    assert {r["doc_id"]: r["text"] for r in lines.dedup(docs).collect()} == {1: "Yes\nSee below\none two three", 2: " Yes \nSee  below", 3: "\n \n"}
