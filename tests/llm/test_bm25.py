"""The search over many shards: terms, thresholds from the first shards, postings read, blocks of queries."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from voxloom.llm import bm25

DOCUMENTS = "/root/testdata/sf0.01/documents.parquet"


def shard(texts):
    numbers, lengths, words = bm25.numbered_terms(texts)
    return {k: v[0] for k, v in bm25.shard_of(list(range(len(texts))), np.split(numbers, np.cumsum(lengths)[:-1]), words).items()}


def plain(texts, q, mean, k=10):
    """The best k by all documents' scores, contributions rounded as the module says."""
    out = []
    for i, t in enumerate(map(bm25.terms_of, texts)):
        s = sum(float(np.rint(t[w] * (bm25.K1 + 1) / (t[w] + bm25.K1 * (1 - bm25.B + bm25.B * t.total() / mean)) * (v * 2.0**32))) for w, v in zip(*q, strict=True) if w in t)
        if s > 0:
            out.append((-s, i))
    return [(i, -s / 2**32) for s, i in sorted(out)[:k]]


@pytest.fixture(scope="module")
def table():
    """(texts, queries, weights, mean length) of real prose."""
    texts = pq.read_table(DOCUMENTS).column("text").to_pylist()
    tf = [bm25.terms_of(t) for t in texts]
    df = bm25.Counter(w for t in tf for w in t)
    idf = {w: np.log(1 + (len(tf) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    terms = [sorted(t) for t in tf[::10]]
    return texts, terms, [np.array([t[w] * idf[w] for w in ws]) for t, ws in zip(tf[::10], terms, strict=True)], sum(t.total() for t in tf) / len(tf)


def test_terms_are_those_of_the_pattern():
    rng = random.Random(3)
    every = [chr(c) for c in [*range(1, 0x3100), 0x1D7D8, 0x10400, 0x1F600]]
    texts = [None, "", " ", "__", "a_b 1²", "İstanbul ẞ ΣΑΣ x́y ①②", " ".join(f"a{c}b {c}" for c in every), *("".join(rng.choices(every + [*"abc _"] * 3000, k=300)) for _ in range(50))]
    numbers, lengths, words = bm25.numbered_terms(texts)
    words, got = words.to_pylist(), np.split(numbers, np.cumsum(lengths)[:-1])
    assert [[words[i] for i in g] for g in got] == [bm25.TERM.findall(t.lower()) if t else [] for t in texts]
    assert [*bm25.numbered_terms([None, ""])[1]] == [0, 0]


def test_shards_are_searched_exactly_whatever_is_known(table):
    texts, terms, weights, mean = table
    s = bm25.Searcher(shard(texts), mean)
    want = [plain(texts, q, mean) for q in zip(terms[:12], weights[:12], strict=True)]
    assert s.answer(terms[:12], weights[:12], 10) == want
    for share in (0.5, 0.9, 1.0, 1.5, 4.0):  # of the tenth score: the documents from there on, no others
        known = [w[-1][1] * share * 2**32 for w in want]
        before = [*known]
        got = s.answer(terms[:12], weights[:12], 10, known)
        assert got == [[x for x in w if x[1] * 2**32 >= b] for w, b in zip(want, before, strict=True)]
        assert all(a >= b for a, b in zip(known, before, strict=True))


def test_fewer_postings_are_read(table):
    texts, terms, weights, mean = table
    s = bm25.Searcher(shard(texts), mean)
    known = [0.0] * len(terms)
    s.answer(terms, weights, 10, known)
    df = bm25.Counter(w for t in texts for w in bm25.terms_of(t))
    assert s.read < 0.2 * sum(df[w] for t in terms for w in t) and s.scored < 20 * len(terms)
    first, s.read, s.scored = s.read, 0, 0
    s.answer(terms, weights, 10, [x * 3 for x in known])  # as where copies of the query lie in another shard
    assert s.read < 0.5 * first and s.scored < 2 * len(terms)


def test_blocks_of_queries_are_filled():
    batches = [pa.RecordBatch.from_arrays([pa.array(range(i * 50, i * 50 + 50))], names=["query_id"]) for i in range(70)]
    got = [*bm25._filled(iter(batches))]
    assert all(bm25.QUERY_BLOCK <= b.num_rows < bm25.QUERY_BLOCK + 50 for b in got[:-1])
    assert sum((b.column(0).to_pylist() for b in got), []) == [*range(3500)]
    assert [*bm25._filled(iter([]))] == []


def test_many_shards_give_what_one_gives(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(1, 4)))
    rows = [(i, " ".join(word() for _ in range(rng.randint(1, 80)))) for i in range(900)]
    rows += [(2000 + i, rows[100][1]) for i in range(30)] + [(None, rows[100][1]), (1000, None), (1100, ""), (1200, "zz"), (3000, "nowhere else"), rows[7]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one, many = (bm25.search_rows(d, F.col("doc_id") % 100 == 0, k=10).collect() for d in (df.coalesce(1), df.repartition(60)))
    assert bm25.build(df.repartition(60)).count() == 60
    assert sorted(map(tuple, one), key=repr) == sorted(map(tuple, many), key=repr) and len(one) > 100
