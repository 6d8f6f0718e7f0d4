"""Language identification by segmentation-marginalised unigrams.

A language gives every piece of a fixed public vocabulary a probability. The
probability of a word is the sum over all its segmentations into pieces, found
by a forward pass; a text's is the product over its words (runs of letters,
lower case, with the vocabulary's mark for a word's start). The language with
the most probable text wins; the score is its share of the probability of all.

Piece probabilities are fitted by expectation maximisation, again over all
segmentations, on a bounded sample of labelled documents per language.
Scoring covers every word of every text; words met again come from a cache
of bounded size.

Edge cases: null text, empty text and text without a letter give `und` with
score 0; a null language never teaches; without any labelled text everything
is `und`; numerals are no letters; ties go to the language that sorts first;
repeated rows get equal results; other columns are untouched, but for those
that have the names of the results, which are replaced.
"""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from voxloom.llm.common import crc_mod, kept_in_worker, numbered

LETTERS = regex.compile(r"\p{L}+")
START = "▁"
#: Letters up to which words go through arrays together; longer ones go one by one, in logarithms, to the same sums.
LONGEST = 40
#: Documents a language is fitted on at most, in expectation.
TRAIN_DOCS = 250
ROUNDS = 2
#: Words remembered by a Python worker before it starts over.
CACHE_WORDS = 200_000
UND = "und"
#: Probabilities are carried times this for each letter, so that LONGEST letters that no language knows do not vanish.
SCALE = 1e6


def vocabulary(path: str) -> list[str]:
    """Pieces of a public sentencepiece model that can occur in lower-case words."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)))
    return [p for p in pieces if p == p.lower() and LETTERS.fullmatch(p.removeprefix(START) or "a")]


def letter_runs(token: str) -> list[str]:
    """Words of a token: runs of letters in lower case, marked at their start."""
    return [START + w for w in LETTERS.findall(token.lower())]


_BASE = np.uint64(0x9E3779B97F4A7C15)
_BITS = 18


class Pieces:
    """Hash table from the polynomial hash of a piece's letters to its number; looked up for whole arrays of hashes."""

    def __init__(self, vocab: list[str]):
        self.keys, self.number = np.zeros(1 << _BITS, np.uint64), np.full(1 << _BITS, -1)
        self.probes = 1
        for i, p in enumerate(vocab):
            h = np.zeros(1, np.uint64)
            for c in p:
                h = h * _BASE + np.uint64(ord(c))
            at = int(self._slot(h)[0])
            for n in range(1, 1 << _BITS):
                if self.number[at] < 0:
                    break
                if self.keys[at] == h[0]:
                    raise ValueError("two pieces with one hash")
                at, self.probes = (at + 1) & (1 << _BITS) - 1, max(self.probes, n + 1)
            self.keys[at], self.number[at] = h[0], i

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - _BITS)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Numbers of the pieces with these hashes, -1 where there is none."""
        at = self._slot(h)
        key, out = self.keys[at], self.number[at]
        miss = np.flatnonzero((key != h) & (out >= 0))
        out[key != h] = -1
        for _ in range(1, self.probes):
            if not len(miss):
                break
            at[miss] = (at[miss] + 1) & (1 << _BITS) - 1
            key, n = self.keys[at[miss]], self.number[at[miss]]
            hit = (key == h[miss]) & (n >= 0)
            out[miss[hit]] = n[hit]
            miss = miss[~hit & (n >= 0)]
        return out


Part = tuple[np.ndarray, np.ndarray]


@dataclass
class Model:
    """langs in sorted order; prob has a row per piece and one, the last, for single letters that are no piece; columns are languages."""

    langs: list[str]
    pieces: Pieces
    prob: np.ndarray
    longest: int

    def parts(self, words: list[str]) -> dict[tuple[int, int], Part]:
        """For words of one length: (i, j) -> (which words, rows of prob) where letters i to j are a piece."""
        n = len(words[0])
        code = np.array(words, f"<U{n}").view(np.uint32).reshape(len(words), n).astype(np.uint64)
        out = {}
        for i in range(n):
            h = np.zeros(len(words), np.uint64)
            for j in range(i + 1, min(n, i + self.longest) + 1):
                h = h * _BASE + code[:, j - 1]
                rows = self.pieces.find(h)
                if j == i + 1:
                    rows = np.where(rows < 0, len(self.prob) - 1, rows)
                who = np.flatnonzero(rows >= 0)
                if len(who):
                    out[i, j] = who, rows[who]
        return out

    def forward(self, count: int, n: int, parts: dict[tuple[int, int], Part]) -> list[np.ndarray]:
        """alpha[j]: probability of the first j letters times SCALE ** j, a row per word."""
        alpha = [np.ones((count, len(self.langs)))] + [np.zeros((count, len(self.langs))) for _ in range(n)]
        for (i, j), (who, rows) in sorted(parts.items()):  # by start: alpha[i] is whole when its pieces are added
            alpha[j][who] += alpha[i][who] * self.prob[rows] * SCALE ** (j - i)
        return alpha

    def long_parts(self, word: str) -> list[np.ndarray]:
        """For lengths from 1 on: the row of prob of the piece of that length that starts at each letter, -1 where there is none."""
        code = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
        out, h = [], np.zeros(len(code), np.uint64)
        for k in range(min(self.longest, len(code))):
            h = h[: len(code) - k] * _BASE + code[k:]
            out.append(self.pieces.find(h))
        out[0] = np.where(out[0] < 0, len(self.prob) - 1, out[0])
        return out

    def long_forward(self, parts: list[np.ndarray]) -> np.ndarray:
        """Log probability of the first j letters for every j, a column per language."""
        logs, n = np.log(self.prob), len(parts[0])
        out = np.zeros((n + 1, len(self.langs)))
        for j in range(1, n + 1):
            out[j] = np.logaddexp.reduce([out[j - k] + logs[r] for k, rows in enumerate(parts[:j], 1) if (r := rows[j - k]) >= 0])
        return out

    def long_expected(self, word: str, weight: np.ndarray, got: np.ndarray) -> None:
        """Add the expected piece counts of a word that occurs weight times."""
        parts, logs = self.long_parts(word), np.log(self.prob)
        n, alpha = len(parts[0]), self.long_forward(parts)
        beta = np.zeros_like(alpha)
        for i in range(n - 1, -1, -1):
            beta[i] = np.logaddexp.reduce([beta[i + k] + logs[rows[i]] for k, rows in enumerate(parts[: n - i], 1) if rows[i] >= 0])
        for k, rows in enumerate(parts, 1):
            at = np.flatnonzero(rows >= 0)
            np.add.at(got, rows[at], np.exp(alpha[at] + logs[rows[at]] + beta[at + k] - alpha[n]) * weight)

    def log_prob(self, words: list[str]) -> np.ndarray:
        """Log probability of each word, a column per language."""
        out = np.zeros((len(words), len(self.langs)))
        for at in _by_length(words):
            ws = [words[i] for i in at]
            if len(ws[0]) > LONGEST + 1:
                out[at] = [self.long_forward(self.long_parts(w))[-1] for w in ws]
                continue
            out[at] = np.log(self.forward(len(ws), len(ws[0]), self.parts(ws))[-1]) - len(ws[0]) * np.log(SCALE)
        return out

    def expected(self, words: list[str], weight: np.ndarray) -> np.ndarray:
        """Expected piece counts of words that occur weight times, over all segmentations."""
        got = np.zeros_like(self.prob)
        for at in _by_length(words):
            ws, wt = [words[i] for i in at], weight[at]
            if len(ws[0]) > LONGEST + 1:
                for w, many in zip(ws, wt, strict=True):
                    self.long_expected(w, many, got)
                continue
            n, parts = len(ws[0]), self.parts(ws)
            alpha = self.forward(len(ws), n, parts)
            beta = [np.zeros_like(alpha[0]) for _ in range(n)] + [np.ones_like(alpha[0])]
            for (i, j), (who, rows) in sorted(parts.items(), reverse=True):
                beta[i][who] += beta[j][who] * self.prob[rows] * SCALE ** (j - i)
            for (i, j), (who, rows) in parts.items():
                np.add.at(got, rows, alpha[i][who] * self.prob[rows] * SCALE ** (j - i) * beta[j][who] / alpha[n][who] * wt[who])
        return got


def _by_length(words: list[str], most: int = 8_000) -> Iterator[np.ndarray]:
    groups: dict[int, list[int]] = defaultdict(list)
    for i, w in enumerate(words):
        groups[len(w)].append(i)
    for at in groups.values():
        for k in range(0, len(at), most):
            yield np.array(at[k : k + most])


def fit_counts(counts: dict[str, dict[str, int]], vocab: list[str]) -> Model:
    """Model from counts[lang][word]. Pieces start at add-one-tenth substring counts, then ROUNDS of expectation maximisation."""
    langs = sorted(counts)
    words = sorted({w for c in counts.values() for w in c})
    weight = np.array([[counts[x].get(w, 0) for x in langs] for w in words], float).reshape(len(words), len(langs))
    got = np.zeros((len(vocab) + 1, len(langs)))
    m = Model(langs, Pieces(vocab), got, max(map(len, vocab)))
    for at in _by_length(words):
        if len(words[at[0]]) > LONGEST + 1:
            for i in at:
                for rows in m.long_parts(words[i]):
                    np.add.at(got, rows[rows >= 0], weight[i])
            continue
        for who, rows in m.parts([words[i] for i in at]).values():
            np.add.at(got, rows, weight[at[who]])
    for k in range(ROUNDS + 1):
        got = got + 0.1
        m.prob = got / got.sum(axis=0)
        if k < ROUNDS:
            got = m.expected(words, weight)
    return m


def word_counts(sample: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, word, n) of a bounded sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[str, Counter] = defaultdict(Counter)
        for b in batches:
            for t, x in zip(b.column(text).to_pylist(), b.column(lang).to_pylist(), strict=True):
                got[x].update(w for token in t.split() for w in letter_runs(token))
        rows = [(x, w, n) for x, c in got.items() for w, n in c.items()]
        yield pa.RecordBatch.from_pydict({"lang": pa.array([r[0] for r in rows], pa.string()), "word": pa.array([r[1] for r in rows], pa.string()), "n": pa.array([r[2] for r in rows], pa.int64())})

    return sample.select(text, lang).mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(train: DataFrame, vocab_path: str, text: str = "text", lang: str = "lang", key: str = "doc_id", train_docs: int = TRAIN_DOCS) -> Model | None:
    """Fit on about train_docs documents per language, chosen by a hash of the key; None without labelled text."""
    train = train.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(key, text, lang)
    sizes = {r[0]: r[1] for r in train.groupBy(lang).count().collect()}
    if not sizes:
        return None
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, train_docs / n))])
    sample = train.where(F.pmod(F.xxhash64(F.lit("language"), key), F.lit(1_000_000)) < share[F.col(lang)] * 1_000_000)
    counts: dict[str, dict[str, int]] = defaultdict(dict)
    for r in word_counts(sample, text, lang).toLocalIterator():
        counts[r[0]][r[1]] = r[2]
    return fit_counts(counts, vocabulary(vocab_path)) if counts else None


class _Rows(dict):
    """token -> its row; a new token gets the next row and waits in `new` to be worked out."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, token: str) -> int:
        self.new.append(token)
        self[token] = row = len(self)
        return row


class Scorer:
    """Scores texts token by token, with a cache of tokens' log probabilities and numbers of words."""

    def __init__(self, model: Model):
        self.model, self.rows = model, _Rows()
        self.table = np.zeros((1024, len(model.langs) + 1))

    def learn(self) -> None:
        """Work out the waiting tokens' rows."""
        new, n = self.rows.new, len(self.rows)
        if n > len(self.table):
            self.table = np.concatenate([self.table, np.zeros((max(n, 2 * len(self.table)) - len(self.table), self.table.shape[1]))])
        runs = [letter_runs(t) for t in new]
        words = list({w for r in runs for w in r})
        row = {w: i for i, w in enumerate(words)}
        who = np.repeat(np.arange(n - len(new), n), [len(r) for r in runs])
        self.table[n - len(new) : n] = 0
        np.add.at(self.table[:, :-1], who, self.model.log_prob(words)[[row[w] for r in runs for w in r]] if len(who) else np.zeros((0, len(self.model.langs))))
        self.table[n - len(new) : n, -1] = [len(r) for r in runs]
        self.rows.new = []

    def score(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if len(self.rows) > CACHE_WORDS:
            self.rows = _Rows()
        get = self.rows.__getitem__
        docs = [np.array([*map(get, t.split())], np.int64) if t else np.zeros(0, np.int64) for t in texts]
        if self.rows.new:
            self.learn()
        out = []
        for d in docs:
            total = self.table[d].sum(axis=0)
            if not total[-1]:
                out.append((UND, 0.0))
                continue
            lp = total[:-1]
            best = int(lp.argmax())
            out.append((self.model.langs[best], float(1 / np.exp(lp - lp[best]).sum())))
        return out


def with_language(docs: DataFrame, model: Model | None, text: str = "text", out: tuple[str, str] = ("lang_pred", "lang_score")) -> DataFrame:
    """docs with the predicted language and its score; all other columns of docs stay."""
    docs = docs.drop(*out)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # vocabulary by languages: its size is bounded
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = kept_in_worker(f"language {name}", lambda: Scorer(shared.value) if shared.value is not None else None)
        for b in batches:
            texts = b.column(text).to_pylist()
            got = []
            for i in range(0, len(texts), 256):
                part = texts[i : i + 256]
                got += scorer.score(part) if scorer else [(UND, 0.0)] * len(part)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=[*b.schema.names, *out])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out[0], StringType()), StructField(out[1], DoubleType())]))


def filter_documents(docs: DataFrame, vocab_path: str, least_score: float = 0.5, text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """The documents whose language is told with at least this score, with the columns of docs; `und` goes."""
    d, new = numbered(docs)
    model = fit(d.where(crc_mod(new[key], 5) != 0), vocab_path, new[text], new[lang], new[key])
    found = with_language(d, model, new[text])
    return found.where((F.col("lang_pred") != UND) & (F.col("lang_score") >= least_score)).select(*new.values()).toDF(*docs.columns)
