import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from folioforge.llm.common import materialize, table
from tests.llm.test_decontaminate import brute, words
from tests.llm.test_similar import brute_force

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_failed(text):
    w = WORD.findall(text or "")
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    counts = {}
    for g in grams:
        counts[g] = counts.get(g, 0) + 1
    repeated = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(3)}
    return len(w) < 50 or 100 * len(repeated) > 50 * len(w)


def test_stages_take_effect(spark):
    """Every stage against plain Python, on what its predecessor kept."""
    docs = table(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "tokenization"]
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    windows = {tuple(w[i : i + 10]) for _, t in items if len(w := words(t)) >= 10 for i in range(len(w) - 9)}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, before, SF), name)
        was, now = ({r["doc_id"]: r["text"] for r in d.select("doc_id", "text").collect()} if "text" in d.columns else None for d in (before, after))
        if name == "tokenization":
            assert after.count() == len(was) > 0
            break
        assert after.columns == docs.columns and now.keys() <= was.keys()
        if name == "quality":
            assert not any(base_failed(t) for t in now.values())
            assert len(now) > 0.9 * sum(not base_failed(t) for t in was.values())
        if name == "line_dedup":
            lines = [" ".join(WORD.findall(line)) for t in now.values() for line in t.split("\n")]
            long = [line for line in lines if len(line.split()) >= 3]
            assert len(long) == len(set(long)) and all(set(t.split("\n")) <= set(was[i].split("\n")) for i, t in now.items())
        if name == "near_dedup":
            assert set(now) == brute_force(list(was.items()))
        if name == "decontamination":
            hit = {i for i, t in was.items() if brute(t, [x for x in items if len(words(x[1])) < 10])[1] or any(tuple(words(t)[j : j + 10]) in windows for j in range(len(words(t))))}
            assert hit and set(now) == set(was) - hit
        before = after
    assert corpus_pipeline.run(spark, SF).count() == after.count()


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_messy_rows(spark, messy, nothing, empty):
    docs = (nothing if empty else messy).withColumns({"source": F.lit("s"), "n_chars": F.length("text")})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        got = out.collect()
        if name != "tokenization":
            assert out.columns == docs.columns
            assert not empty or not got
            assert empty or {r["doc_id"] for r in got} <= {None, *range(1, 8)}
        else:
            assert len(got) == docs.count()
