import pytest

from lakeloom.llm import bpe
from lakeloom.llm.queries import vocabulary

TEXTS = [
    None, "", " ", "\n", "a", "Hello world, it's fine.", "I'll don't WE'VE  x", "a   b\n\n\n c", "tabs\t\tand \t spaces \n",
    "<|endoftext|>x <|endoftext|>", "<|endoftext", "voilà le café", "日本 語\n\n  x", "🙂🙂 🙂", "   x", "\x1c y\x85 \x00 z",
    "x" * 30_000, "!'s" * 500, " ".join(f"w{i}" for i in range(20_000)), "a" * 70 + " " + "b" * 70, "é �", "12345 6,789.00%%%###",
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def test_same_as_the_library(spark, tokenizer):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] * 2
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    coded = bpe.decode(bpe.encode(frame, "text", vocabulary()), "ids", vocabulary())
    for r in coded.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids, r.text
        assert r.decoded == tokenizer.decode(ids, skip_special_tokens=False) == (r.text or "")


def test_few_remembered_fragments(tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    tool = bpe.Codec(open(vocabulary(), encoding="utf-8").read())
    texts = [t or "" for t in TEXTS]
    assert [r.tolist() for r in tool.encode(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_documents(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for r in bpe.encode(docs, "text", vocabulary()).select("text", "ids").collect():
        assert r.ids == tokenizer.encode(r.text or "", add_special_tokens=False).ids


def test_cuts_are_at_forced_pairs():
    tool = bpe.Codec(open(vocabulary(), encoding="utf-8").read())
    for a in range(0x21, 0x7F):
        assert not tool.inside[a, 0x20] and not tool.inside[a, 0x0A]
    assert tool.inside[ord("t"), ord("h")]


def test_decode_of_broken_bytes_and_null(spark, tokenizer):
    ids = [[tokenizer.get_vocab()["Ã"]], [], None]
    frame = spark.createDataFrame([(x,) for x in ids], "ids array<int>")
    got = [r.decoded for r in bpe.decode(frame, "ids", vocabulary()).collect()]
    assert sorted(got) == ["", "", tokenizer.decode(ids[0], skip_special_tokens=False)]


def test_empty_table(spark):
    assert bpe.encode(spark.createDataFrame([], "text string"), "text", vocabulary()).collect() == []


def test_other_vocabularies_are_refused(tmp_path):
    path = tmp_path / "v.json"
    path.write_text('{"model": {"type": "WordPiece"}, "pre_tokenizer": null, "added_tokens": []}')
    with pytest.raises(ValueError):
        bpe.Codec(path.read_text())

