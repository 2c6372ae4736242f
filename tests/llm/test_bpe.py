import random

from tokenizers import Tokenizer

from folioforge.llm import bpe


def expected(texts):
    t = Tokenizer.from_file(bpe.default_vocabulary())
    return [(b"".join(i.to_bytes(4, "little") for i in e.ids), t.decode(e.ids, skip_special_tokens=False)) for e in t.encode_batch(texts, add_special_tokens=False)]


def texts():
    rnd = random.Random(1)
    parts = [*"abcdefghijklmnop ABC'SsTtrRE123.,;!?  \n\t\x0b\x85\xa0\u2003\u2028\x1c\x1f\u200b", "ß", "é", "É", "Σ", "σ", "İ", "ı", "e\u0301", "日本", "😀", "½", "Ⅷ", "٣", "<|endoftext|>", "<|EndOfText|>", "ﬁ", "'ll", "'re", "aaaa", "\x00", "𝒳", "ǅ", "Ω", "ẞ"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(1500)] + ["", "a" * 3000, "aaaa aaa aa a", " ", "ΑΣ ΑΣΑ", "x" * 70 + " y"]


def test_encoding_equals_the_library():
    packed, written = bpe.Codec(bpe.default_vocabulary()).encode(texts())
    assert list(zip(packed, written)) == expected(texts())


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    codec = bpe.Codec(bpe.default_vocabulary())
    for t, want in zip(texts()[:200], expected(texts()[:200])):
        assert tuple(x[0] for x in codec.encode([t])) == want
    assert len(codec.packed) <= 150


def test_messy_and_decoding(messy, nothing):
    out = bpe.encode(messy)
    assert out.count() == messy.count() and out.where("doc_id = 2 and n_tokens = 0 and decoded = ''").count() == 1
    again = bpe.decode(out.withColumnRenamed("decoded", "was"))
    assert again.where("decoded <> was").count() == 0
    assert bpe.encode(nothing).count() == 0
