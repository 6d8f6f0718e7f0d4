"""Byte-level BPE against the tokenizers library: exact ids, exact round trips."""

import hashlib
import random

import pyarrow.parquet as pq
import pytest

from voxloom.llm import bpe
from voxloom.llm.queries import QUERIES, vocabulary_path

DIR = "/root/testdata/sf0.001"
BITS = ["a", "aa", "e", " ", "  ", "\n", "\t \n", "the", "ing", "é", "ß", "😀", "漢字", "<|endoftext|>", "<|end", "1", "22", "²", "½", "!", "--", "=====", "▁", "'s", "'LL", "\u0085", " ", "ǅ", "٣", "क्षि", "\0", "\x1c", "_", "aaaaaaaa", "tion"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(vocabulary_path("byte_bpe_50k.json"))


def test_ids_and_texts_are_the_librarys(encoder, library):
    rng = random.Random(1)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 30))) for _ in range(4000)] + ["ab" * 20_000 + "x" * 3000, "a" * 9999]
    for t, ids in zip(texts, encoder.encode(texts), strict=True):
        want = library.encode(t, add_special_tokens=False).ids
        assert ids.tolist() == want, t
        assert encoder.decode(want) == library.decode(want, skip_special_tokens=False)
    for _ in range(500):  # cut characters and ids that are not there
        ids = [rng.randint(0, 50_300) for _ in range(rng.randint(0, 20))]
        assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_marks_as_plain_text(library):
    plain = bpe.Encoder(vocabulary_path("byte_bpe_50k.json"), special=False)
    library.encode_special_tokens = True
    try:
        for t in ("a<|endoftext|>b", "<|endoftext|>", " <|endoftext|> "):
            assert plain.encode([t])[0].tolist() == library.encode(t, add_special_tokens=False).ids
    finally:
        library.encode_special_tokens = False


def test_words_are_cut_as_the_library_cuts_them(library):
    """Every character that is cut here rather than by the library, in places where classes matter."""
    pre = library.pre_tokenizer
    settled = [c for c in map(chr, range(0x20000)) if not "\ud800" <= c <= "\udfff" and bpe.SETTLED.fullmatch(c)]
    assert len(settled) > 20_000
    for c in settled:
        t = f"a{c}1{c}! {c} b"
        assert bpe.WORDS.findall(t) == [t[i:j] for _, (i, j) in pre.pre_tokenize_str(t)], hex(ord(c))


def test_trie_is_depth_first():
    words = [b"tear", b"te", b"ten", b"a", b"teal", b"b"]
    assert list(bpe.trie(words)) == [(b"a", 0), (b"b", 0), (b"te", 0), (b"teal", 2), (b"tear", 3), (b"ten", 2)]


def test_small_cache_gives_the_same(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 3)
    monkeypatch.setattr(bpe, "CACHE_PAIRS", 5)
    enc = bpe.Encoder(vocabulary_path("byte_bpe_50k.json"))
    texts = ["some words and more words", "other words, these", None, "", "some words"] * 2
    for some in (texts[:3], texts[3:6], texts[6:]):
        for t, ids in zip(some, enc.encode(some), strict=True):
            assert ids.tolist() == library.encode(t or "", add_special_tokens=False).ids


def test_odd_tables(spark):
    path = vocabulary_path("byte_bpe_50k.json")
    rows = [(None, None, "x", 1), (1, "", "y", 2), (1, "one two", None, 3), (1, "one two", None, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, `a b` int")
    got = bpe.decoded(bpe.encoded(df, path), path)
    assert got.columns == ["doc_id", "a b", "ids", "text"]
    assert sorted((r["doc_id"] or 0, r["text"], len(r["ids"])) for r in got.collect()) == [(0, "", 0), (1, "", 0), (1, "one two", 2), (1, "one two", 2)]
    assert bpe.decoded(bpe.encoded(df.where("false"), path), path).collect() == []
    none = spark.createDataFrame([(1, None), (2, [-1, None, 99_999_999, 64])], "k int, ids array<int>")
    assert sorted((r["k"], r["text"]) for r in bpe.decoded(none, path).collect()) == [(1, None), (2, "a")]


def test_op11(spark, library):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {}
    for d in pq.read_table(f"{DIR}/documents.parquet").to_pylist():
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids
        want[d["doc_id"]] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
    got = QUERIES["op11_byte_bpe"](spark, DIR)
    assert got.schema.simpleString() == "struct<doc_id:bigint,n_tokens:bigint,ids_sha256:string,decoded_sha256:string>"
    assert {r["doc_id"]: tuple(r[1:]) for r in got.collect()} == want
