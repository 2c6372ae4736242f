import zlib

from folioforge.llm import sharding as s


def test_places_and_sizes(spark):
    texts = [None, "", "é"] + [f"text {i} " * (i % 50) for i in range(3000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows, slot_map = s.shard(docs, shards=7, slots=256)
    got = rows.toPandas()
    assert len(got) == len(texts)
    for i, size, crc in zip(got.doc_id, got["size"], got.text_crc32):
        raw = (texts[i] or "").encode()
        assert (size, crc) == (len(raw) + 16, zlib.crc32(raw))
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    sums = got.groupby("shard")["size"].sum()
    assert len(sums) == 7 and sums.max() / sums.mean() < 1.01
    assert all(slot_map.shard_of[v] == h for v, h in zip(got.vslot, got["shard"]))


def test_map_is_edited(spark):
    sizes = [(7 * i) % 101 for i in range(512)]
    first = s.first_map(sizes, 8)
    wider = s.grown(first, sizes)
    assert {b for a, b in zip(first.shard_of, wider.shard_of) if a != b} == {8} and wider.version == 2
    assert abs(wider.loads(sizes)[8] - sum(sizes) / 9) < 101
    uneven = s.SlotMap(4, 8, tuple(v % 5 for v in range(512)))
    edited = s.rebalanced(uneven, sizes)
    loads = edited.loads(sizes)
    assert edited.version == 5 and max(loads) - min(loads) <= 0.05 * sum(sizes) / 8
    assert s.rebalanced(first, sizes) == first
    assert s.SlotMap.from_frame(edited.to_frame(spark).union(first.to_frame(spark))) == edited


def test_messy(messy, nothing):
    rows, _ = s.shard(messy, shards=3, slots=64)
    got = rows.toPandas()
    assert len(got) == messy.count() and all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    assert s.shard(nothing)[0].count() == 0
