"""Alignment of two tokenizers against a plain walk over byte ranges."""

import hashlib
import random
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest

from voxloom.llm import align
from voxloom.llm.bpe import BYTE_OF
from voxloom.llm.queries import QUERIES, vocabulary_path

DIR = "/root/testdata/sf0.001"
A, B = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")
BITS = ["a", " ", "  ", "\n", "the", "ing ", "é", "ß", "😀", "漢字", "<|endoftext|>", "<s>", "<0x41>", "<unk>", "22", "²", "!", "--", "▁", "'s", "\u0085", "\xa0", "क्षि", "\0", "\r", "ﬁ", "tion"]


@pytest.fixture(scope="module")
def plain():
    """text -> (A ids, B ids, groups, links) by the libraries on whole texts and byte ranges."""
    import sentencepiece
    from tokenizers import Tokenizer

    ta, tb = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    ta.encode_special_tokens = True

    def spans(parts):
        out, at = [], 0
        for p in parts:
            out.append((at, at + len(p)))
            at += len(p)
        return out

    def one(text):
        if not text:
            return [], [], [], []
        a, b = ta.encode(" " + text, add_special_tokens=False).ids, tb.encode(text)
        pa = [bytes(BYTE_OF[c] for c in ta.id_to_token(i)) for i in a]
        pb = [bytes([int(tb.id_to_piece(i)[3:5], 16)]) if tb.is_byte(i) else tb.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not b"".join(pa) == b"".join(pb) == (" " + text).encode():
            return [], [], [], []
        sa, sb = spans(pa), spans(pb)
        cuts = sorted({e for _, e in sa} & {e for _, e in sb})
        groups = [([i for i, (s, e) in zip(a, sa, strict=True) if lo <= s and e <= hi], [i for i, (s, e) in zip(b, sb, strict=True) if lo <= s and e <= hi]) for lo, hi in zip([0, *cuts], cuts, strict=False)]
        links, j = [], 0
        for i, (s, e) in zip(a, sa, strict=True):
            while sb[j][1] <= s:
                j += 1
            k = j
            while k < len(sb) and sb[k][0] < e:
                links.append((i, b[k]))
                k += 1
        return a, b, groups, links

    return one


def rows_of(texts, plain):
    each = [plain(t) for t in texts]
    counts = Counter(x for *_, links in each for x in links)
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for a, b, groups, links in each:
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((len(a), len(b), len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


def odd_texts(n=400):
    rng = random.Random(3)
    return [None, "", " ", "  ", "\n", "a ", " a  ", *("".join(rng.choice(BITS) for _ in range(rng.randint(0, 25))) for _ in range(n)), "long" * 9000 + " x" * 9000]


def test_piece_encoder_is_the_librarys():
    import sentencepiece

    m, enc = sentencepiece.SentencePieceProcessor(model_file=B), align.PieceEncoder(B)
    texts = [t for t in odd_texts(3000) if t and "▁" not in t]
    for t, ids in zip(texts, enc.encode(texts), strict=True):
        assert (m.encode(t) if ids is None else ids.tolist()) == m.encode(t), t


def test_groups(spark, plain):
    texts = odd_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)
    for r in align.groups(df, A, B).collect():
        a, b, groups, _ = plain(texts[r["doc_id"]])
        assert [(g["a"], g["b"]) for g in r["groups"]] == groups
        assert not a or r["groups"][0]["at"] == 0 and len({g["at"] for g in r["groups"]}) == len(groups)


def test_linked(spark, plain):
    texts = odd_texts() + ["the same text again"] * 50
    df = spark.createDataFrame([(k if k % 7 else None, t, "x", 1.0) for k, t in enumerate(texts)], "doc_id int, text string, a string, block double").repartition(3)
    got = align.linked(df, A, B, size=2000)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    key = lambda r: (r[0] is None, *[x or 0 for x in r[:1]], *r[1:])
    want = [(k if k % 7 else None, *r) for k, r in enumerate(rows_of(texts, plain))]
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)
    assert align.linked(df.where("false"), A, B).collect() == []
    empty = align.linked(df.where("text = ''"), A, B).collect()
    assert len(empty) == texts.count("") and {tuple(r)[1:] for r in empty} == {(0, 0, 0, 0, 0, 0, "")}


def test_op13(spark, plain):
    docs = pq.read_table(f"{DIR}/documents.parquet").to_pylist()
    want = {d["doc_id"]: r for d, r in zip(docs, rows_of([d["text"] for d in docs], plain), strict=True)}
    got = QUERIES["op13_token_alignment"](spark, DIR)
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    assert {r["doc_id"]: tuple(r[1:]) for r in got.collect()} == want
