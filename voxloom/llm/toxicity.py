"""Toxicity by a classifier chain of linear models over word presence.

Categories are predicted one after the other. Each has a logistic model over
the words that tell most about it; from the second on, the model also sees the
earlier categories' probabilities. For training these are out-of-fold: each
document's come from models fitted without its fold, so later models learn
from predictions as uncertain as the ones they will get.

Words are runs of letters in lower case; the stems of longer words count as
words of their own. Only words whose frequency in a category lies LEAST_Z
standard deviations off are used. Word choice needs document counts of
all words of the sample, which are summed in Spark; only the most telling
WORDS per category, and which of them each sampled document holds, reach the
driver. The sample has about TRAIN_ROWS labelled documents; scoring covers
every word of every text.

Edge cases: a null or empty text has no words and gets the models' intercepts;
null labels teach nothing; a document labelled more than once teaches its mean
label, rounded up from a half; without labels every probability is 0 and
nothing is toxic; documents that share an identifier teach as one, the first by
text; repeated rows get equal results; other columns are untouched, but for
those that have the names of the results, which are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from voxloom.llm.common import crc_mod, materialise, release

TRAIN_ROWS, WORDS, LEAST_DOCS, LEAST_Z, STEM, FOLDS = 12_000, 400, 4, 5.0, 5, 4
#: category -> SQL condition on the labels; in chain order, the last decides.
CHAIN = {"junk": "quality = 0", "toxic": "toxic = 1"}
LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> set[str]:
    """Distinct words and word stems: the first STEM letters of longer words, marked with *."""
    words = set(LETTERS.findall(text.lower())) if text else set()
    return words | {w[:STEM] + "*" for w in words if len(w) > STEM}


@dataclass
class Chain:
    words: dict[str, int]
    names: list[str]
    weights: list[np.ndarray]  # per category: words, then earlier probabilities, then the intercept
    threshold: float

    def probabilities(self, docs: list[np.ndarray]) -> np.ndarray:
        """A row per document (the numbers of its words), a column per category."""
        out = np.zeros((len(docs), len(self.names)))
        ends = np.cumsum([len(d) for d in docs])
        at = np.concatenate(docs).astype(np.int64) if docs else np.zeros(0, np.int64)
        for k, w in enumerate(self.weights):
            s = np.concatenate([[0.0], np.cumsum(w[at])])
            z = s[ends] - s[ends - [len(d) for d in docs]] if docs else np.zeros(0)
            z = z + out[:, :k] @ w[len(self.words) : -1] + w[-1]
            out[:, k] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out


def _logistic(docs: list[np.ndarray], extra: np.ndarray, y: np.ndarray, n_words: int, rounds: int = 150, ridge: float = 1.0) -> np.ndarray:
    """Ridge logistic regression by accelerated gradient steps; columns: words, extra, one."""
    lens = np.array([len(d) for d in docs])
    at, who = np.concatenate([*docs, np.zeros(0, np.int64)]).astype(np.int64), np.repeat(np.arange(len(docs)), lens)
    size = n_words + extra.shape[1] + 1
    w, v = np.zeros(size), np.zeros(size)
    # diagonal bound of the curvature
    step = 1 / (0.25 * np.concatenate([np.bincount(at, minlength=n_words), (extra**2).sum(0), [len(y)]]) * 4 + ridge)
    for t in range(rounds):
        u = w + t / (t + 3) * (w - v)
        z = np.bincount(who, u[at], len(y)) + extra @ u[n_words:-1] + u[-1]
        r = y - 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        g = np.concatenate([np.bincount(at, r[who], n_words), extra.T @ r, [r.sum()]])
        g[:-1] -= ridge * u[:-1]
        v, w = w, u + step * g
    return w


def fit_chain(docs: list[np.ndarray], labels: np.ndarray, words: dict[str, int], names: list[str]) -> Chain:
    fold = np.arange(len(docs)) % FOLDS
    earlier = np.zeros((len(docs), 0))
    weights, y, held = [], labels[:, -1], np.zeros(len(docs))
    for k in range(len(names)):
        held = np.zeros(len(docs))
        for f in range(FOLDS):
            there, here = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            if not len(there) or not len(here):
                continue
            w = _logistic([docs[i] for i in there], earlier[there], labels[there, k], len(words))
            held[here] = [1 / (1 + np.exp(-(w[docs[i]].sum() + earlier[i] @ w[len(words) : -1] + w[-1]))) for i in here]
        weights.append(_logistic(docs, earlier, labels[:, k], len(words)))
        earlier = np.column_stack([earlier, held])
    return Chain(words, names, weights, threshold(held, y))


def threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Between two different probabilities, where F1 is best of all that are right at least as often as wrong; above all where there is none."""
    order = np.argsort(-p, kind="stable")
    hit, at = np.cumsum(y[order]), np.arange(1, len(y) + 1)
    next_ = np.append(p[order][1:], 0.0)
    f1 = np.where((p[order] > next_) & (2 * hit >= at), 2 * hit / (at + max(y.sum(), 1)), 0.0)
    best = int(f1.argmax()) if len(y) else 0
    return float((p[order[best]] + next_[best]) / 2) if len(y) and f1[best] > 0 else 1.1


def fit(docs: DataFrame, labels: DataFrame, chain: dict[str, str] = CHAIN, text: str = "text", key: str = "doc_id", train_rows: int = TRAIN_ROWS) -> Chain | None:
    """Fit on labelled documents whose crc32(key) modulo 4 is not 2."""
    names = list(chain)
    marks = [(F.avg(F.expr(e).cast("double")) >= 0.5).cast("int").alias(f"y_{c}") for c, e in chain.items()]
    one = labels.where(crc_mod(key, 4) != 2).groupBy(F.col(key).alias("s_key")).agg(*marks).dropna()
    n = one.count()
    sample = one.where(F.pmod(F.xxhash64(F.lit("toxicity"), "s_key"), F.lit(1_000_000)) < min(1.0, train_rows / max(n, 1)) * 1_000_000)
    # bounded by train_rows, so it is broadcast; stored, since it is gone through more than once, and an identifier's rows count once
    d = docs.select(F.col(key).alias("d_key"), F.col(text).alias("t"))
    ys = [f"y_{c}" for c in names]
    drawn = d.join(F.broadcast(sample), F.col("d_key") == F.col("s_key")).groupBy("s_key", *ys).agg(F.min("t").alias("t"))
    drawn = materialise(drawn.select("s_key", "t", *ys))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, hits = Counter(), [Counter() for _ in names]
        for b in batches:
            ys = [b.column(f"y_{c}").to_pylist() for c in names]
            for i, t in enumerate(b.column("t").to_pylist()):
                w = words_of(t)
                total.update(w)
                for y, h in zip(ys, hits, strict=True):
                    if y[i]:
                        h.update(w)
        ws = list(total)
        yield pa.RecordBatch.from_arrays([pa.array(ws, pa.string()), pa.array([total[w] for w in ws], pa.int64()), pa.array([[h[w] for h in hits] for w in ws], pa.list_(pa.int64()))], names=["word", "n", "hits"])

    counts = drawn.mapInArrow(count, "word string, n long, hits array<long>")
    counts = counts.groupBy("word").agg(F.sum("n").alias("n"), *[F.sum(F.col("hits")[k]).alias(f"h{k}") for k in range(len(names))]).where(F.col("n") >= LEAST_DOCS)
    size = drawn.agg(F.count("*"), *[F.sum(f"y_{c}") for c in names]).first()
    if not size[0]:
        release(drawn)
        return None
    chosen: set[str] = set()
    for k in range(len(names)):
        p = (size[k + 1] or 0) / size[0]
        z = F.abs(F.col(f"h{k}") - F.col("n") * p) / F.sqrt(F.col("n") * (p * (1 - p)) + 1e-9)
        chosen |= {r[0] for r in counts.where(z >= LEAST_Z).orderBy(z.desc(), "word").limit(WORDS).collect()}
    words = {w: i for i, w in enumerate(sorted(chosen))}

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [sorted(words[w] for w in words_of(t) & words.keys()) for t in b.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("s_key"), pa.array(rows, pa.list_(pa.int32())), *(b.column(f"y_{c}") for c in names)], names=["s_key", "at", *[f"y_{c}" for c in names]])

    kind = drawn.schema["s_key"].dataType.simpleString()
    got = sorted(tuple(r) for r in drawn.mapInArrow(hold, f"s_key {kind}, at array<int>, " + ", ".join(f"y_{c} int" for c in names)).collect())
    release(drawn)
    return fit_chain([np.array(g[1], np.int64) for g in got], np.array([g[2:] for g in got], float), words, names)


def with_toxicity(docs: DataFrame, model: Chain | None, names: list[str] | None = None, text: str = "text") -> DataFrame:
    """docs with p_<category> for each category and the boolean is_toxic; all other columns of docs stay."""
    names = names or list(CHAIN)
    out = [f"p_{c}" for c in names]
    docs = docs.drop(*out, "is_toxic")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(text).to_pylist()
            if model is None:
                p, cut = np.zeros((len(texts), len(names))), 1.1
            else:
                p, cut = model.probabilities([np.array([model.words[w] for w in words_of(t) & model.words.keys()], np.int64) for t in texts]), model.threshold
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(p[:, k], pa.float64()) for k in range(len(names))), pa.array(p[:, -1] >= cut, pa.bool_())], names=[*b.schema.names, *out, "is_toxic"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *[StructField(c, DoubleType()) for c in out], *StructType.fromDDL("is_toxic boolean").fields]))
