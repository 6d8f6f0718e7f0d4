"""Every registered corpus query: its contract's columns against a plain computation over the same table."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from voxloom.llm import bm25, language_id, tokens, toxicity
from voxloom.llm.queries import QUERIES, vocabulary_path

DIR = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def table():
    return pq.read_table(f"{DIR}/documents.parquet").to_pylist()


@pytest.fixture(scope="module")
def labels():
    return pq.read_table(f"{DIR}/labels.parquet").to_pylist()


@pytest.fixture(scope="module")
def ids_of(table):
    """doc_id -> token ids with the end id, by the tokenizers library."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    return {d["doc_id"]: [*t.encode(d["text"] or "", add_special_tokens=False).ids, 1] for d in table}


def rows(spark, name):
    return [r.asDict() for r in QUERIES[name](spark, DIR).collect()]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op1(spark, table):
    got = rows(spark, "op1_mixing")
    size = {d["doc_id"]: len(WORDS.findall(d["text"] or "")) for d in table}
    source = {d["doc_id"]: d["source"] for d in table}
    total, taken = Counter(), Counter()
    for d in table:
        total[d["source"]] += size[d["doc_id"]]
    assert sorted(r["doc_id"] for r in got) == sorted(size)
    for r in got:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == total[source[r["doc_id"]]]
        assert r["taken"] in [k * r["size"] for k in range(4)]
        taken[source[r["doc_id"]]] += r["taken"]
    target = {source[r["doc_id"]]: r["target"] for r in got}
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    longest = max(size.values())
    assert all(abs(taken[s] - t) <= 2 * longest for s, t in target.items())
    again = {r["doc_id"]: r["taken"] for r in rows(spark, "op1_mixing")}
    assert again == {r["doc_id"]: r["taken"] for r in got}


def test_op2(spark, ids_of):
    seqs, seen = defaultdict(list), defaultdict(dict)
    for r in rows(spark, "op2_packing"):
        ids = ids_of[r["doc_id"]]
        part = ids[4096 * r["piece"] : 4096 * (r["piece"] + 1)]
        assert (r["start"], r["length"], r["ids_crc32"]) == (4096 * r["piece"], len(part), crc(part))
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
        seen[r["doc_id"]][r["piece"]] = r["length"]
    assert {k: sum(v.values()) for k, v in seen.items()} == {k: len(v) for k, v in ids_of.items()}
    for s in seqs.values():
        at = 0
        for off, n in sorted(s):
            assert off == at
            at += n
        assert at <= 4096
    assert len(seqs) <= 1.05 * sum(map(len, ids_of.values())) / 4096 + 1


def test_op3(spark, table, labels):
    got = {r["doc_id"]: r for r in rows(spark, "op3_toxicity")}
    assert len(got) == len(table) and all(0 <= r["junk_score"] <= 1 and 0 <= r["toxic_score"] <= 1 for r in got.values())
    assert all(isinstance(r["toxic"], bool) for r in got.values())
    clean = [x["doc_id"] for x in labels if x["toxic"] == 0]
    assert not [i for i in clean if got[i]["toxic"]]


def test_op6(spark, table):
    got = defaultdict(list)
    for r in sorted(rows(spark, "op6_bm25_search"), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["doc_id"], r["score"]))
    tf = {d["doc_id"]: bm25.terms_of(d["text"]) for d in table}
    n, mean = len(tf), sum(t.total() for t in tf.values()) / len(tf)
    df = Counter(w for t in tf.values() for w in t)
    idf = {w: np.log(1 + (n - k + 0.5) / (k + 0.5)) for w, k in df.items()}
    gain = lambda t, w: t[w] * (bm25.K1 + 1) / (t[w] + bm25.K1 * (1 - bm25.B + bm25.B * t.total() / mean))
    for q, terms in tf.items():
        if q % 100:
            continue
        score = {j: sum(k * idf[w] * gain(t, w) for w, k in terms.items() if w in t) for j, t in tf.items()}
        want = sorted(((-round(s, 6), j) for j, s in score.items() if s > 0))[:10]
        assert [i for i, _ in got[q]] == [j for _, j in want]
        assert np.allclose([s for _, s in got[q]], [-s for s, _ in want], atol=1e-5)


def test_op7(spark, ids_of):
    at = 0
    for r in sorted(rows(spark, "op7_token_shards"), key=lambda r: r["doc_id"]):
        ids = ids_of[r["doc_id"]]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), crc(ids))
        at += len(ids)
    assert at == sum(map(len, ids_of.values()))


def test_op8(spark, table):
    langs = {d["lang"] for d in table if d["lang"] is not None}
    lang = {d["doc_id"]: d["lang"] for d in table}
    got = rows(spark, "op8_language_id")
    assert len(got) == len(table)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["lang_pred"] in langs | {"und"} and 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"] and lang[r["doc_id"]]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.9


def test_op9(spark, table):
    got = rows(spark, "op9_quality_classifier")
    assert len(got) == len(table)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)


def test_language_probabilities_are_fitted_by_expectation():
    """One round of `expected` against sums over all segmentations, written out."""
    vocab = ["▁a", "ab", "b", "a", "▁ab", "c", "▁"]
    words = {"▁abc": 5, "▁ab": 2, "cab": 1}
    m = language_id.fit_counts({"x": words}, vocab)
    at = {p: i for i, p in enumerate(vocab)}

    def ways(w):
        if not w:
            yield ()
        for n in range(1, len(w) + 1):
            k = at.get(w[:n], len(vocab) if n == 1 else None)
            if k is not None:
                for rest in ways(w[n:]):
                    yield (k, *rest)

    want = np.zeros(len(vocab) + 1)
    for w, n in words.items():
        each = [(s, np.prod([m.prob[k, 0] for k in s])) for s in ways(w)]
        total = sum(p for _, p in each)
        for s, p in each:
            for k in s:
                want[k] += n * p / total
    got = m.expected(sorted(words), np.array([[float(words[w])] for w in sorted(words)]))
    assert np.allclose(got[:, 0], want)


def test_the_chain_is_logistic_models_in_turn():
    """Fitted links are optima of their ridge losses; scores are the chain written out."""
    rng = np.random.default_rng(1)
    docs = [np.flatnonzero(rng.random(12) < 0.3) for _ in range(300)]
    y1 = np.array([float(0 in d or rng.random() < 0.1) for d in docs])
    y2 = np.array([float((3 in d) and y or rng.random() < 0.05) for d, y in zip(docs, y1, strict=True)])
    m = toxicity.fit_chain(docs, np.column_stack([y1, y2]), {f"w{k}": k for k in range(12)}, ["a", "b"])
    x = np.zeros((300, 12))
    for i, d in enumerate(docs):
        x[i, d] = 1
    sig = lambda z: 1 / (1 + np.exp(-z))
    w = m.weights[0]
    p = sig(x @ w[:12] + w[12])
    assert np.abs(x.T @ (y1 - p) - w[:12]).max() < 0.05 and abs((y1 - p).sum()) < 0.05
    w = m.weights[1]
    q = sig(x @ w[:12] + w[12] * p + w[13])
    assert np.allclose(m.probabilities(docs), np.column_stack([p, q]))
    # the second link was taught with probabilities of models that had not seen the document
    fold = np.arange(300) % toxicity.FOLDS
    held = np.zeros(300)
    for f in range(toxicity.FOLDS):
        v = toxicity._logistic([d for d, k in zip(docs, fold, strict=True) if k != f], np.zeros(((fold != f).sum(), 0)), y1[fold != f], 12)
        held[fold == f] = sig(x[fold == f] @ v[:12] + v[12])
    q = sig(x @ w[:12] + w[12] * held + w[13])
    assert np.abs(x.T @ (y2 - q) - w[:12]).max() < 0.05 and abs(held @ (y2 - q) - w[12]) < 0.05


def test_additive_scores_are_looked_up_row_by_row():
    from voxloom.llm import gam

    rng = np.random.default_rng(2)
    x = rng.random((500, 4))
    y = ((x[:, 0] > 0.4) ^ (x[:, 2] > 0.6)).astype(float)
    m = gam.fit(x, y)
    for row, got in zip(x[:50].tolist(), m.margin(x[:50]), strict=True):
        z = m.intercept
        for j, v in enumerate(row):
            z += m.tables[j][sum(v >= c for c in m.cuts[j])]
        for (i, j), t in zip(m.pairs, m.pair_tables, strict=True):
            z += t[sum(row[i] >= c for c in m.pair_cuts[i])][sum(row[j] >= c for c in m.pair_cuts[j])]
        assert got == pytest.approx(z)


def test_words_of_latin_letters_are_encoded_alike():
    assert tokens.encoder(vocabulary_path("word_bpe_49k.json")).encode([None, b""]) == [b"", b""]
