import random
import re

from folioforge.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        x = words(t)
        m = min(10, len(x))
        windows = {tuple(x[i : i + m]) for i in range(len(x) - m + 1)} if m else set()
        for i in range(len(w) - m + 1 if m else 0):
            if tuple(w[i : i + m]) in windows:
                hit |= set(range(i, i + m))
                found.add(str(item) if item is not None else "null")
    return len(w), len(hit), sorted(found)


def test_search_equals_brute_force(spark):
    rnd = random.Random(1)
    text = lambda n: " ".join(rnd.choice(["a", "B", "c9", "é"]) + rnd.choice(["", ".", "-"]) for _ in range(n))
    items = [(i, text(rnd.choice([0, 1, 2, 5, 9, 10, 11, 14]))) for i in range(12)] + [(None, "q r s t"), (3, None)]
    docs = [(i, text(rnd.randint(0, 120))) for i in range(60)] + [(99, None), (98, "x q r s t " * 3)]
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for block_bytes in (1 << 20, 40):
        got = {r["doc_id"]: (r["contamination"]["n_words"], r["contamination"]["n_hit"], r["contamination"]["items"]) for r in d.decontaminate(a, b, block_bytes=block_bytes).collect()}
        assert got == {i: brute(t, items) for i, t in docs}


def test_messy(spark, messy, nothing):
    items = spark.createDataFrame([(1, "looked at the dog in the yard"), (2, "")], "item_id long, text string")
    assert d.decontaminate(messy, items).where("contamination.n_hit > 0").count() == 3
    assert d.clean(messy, items).columns == messy.columns and d.clean(messy, items).count() == messy.count() - 3
    assert d.decontaminate(nothing, items).count() == 0
    assert d.clean(messy, items.limit(0)).count() == messy.count()
