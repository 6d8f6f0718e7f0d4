"""Exact top-k search by BM25 over a sharded inverted index with block-max WAND pruning.

Every partition of documents becomes shards of at most SHARD_DOCS documents,
and of SHARD_TERMS words but for the last document: documents by length,
postings by term, the most frequent term first, stored as one row each.
Document frequencies, the number of documents and their mean length are summed
over all shards, so scores are global.

Each shard answers all queries, read from shared storage in blocks. Its
documents lie in windows of WINDOW each, and every list has a cursor to where
each window begins in it and the most it can contribute there. Several queries
go through a shard together:

* What the frequent lists contribute to each document comes from one product of
  matrices, and with it the most they contribute in a window.
* A window whose lists cannot reach the k-th best score known so far together
  is skipped: none of its postings is read. In others the longest lists stay
  unread as long as they reach no more together than a share of what the
  frequent lists lack there. The rest are merged.
* A document is a pivot if its sum and what the unread lists can add reach the
  score. Only pivots are scored in full, from the document's own terms.
* While the score known is low, it is raised first to what k documents of the
  shard reach for certain.

Some of the shards are searched first, and the score that k of their documents
reach is known to the searches of all others. The score known also rises from
shard to shard of a task.

The shards' own top k merge into the whole top k exactly: a document among the
best k overall is among the best k of its shard. Bounds are sums of single
precision with room for their roundings; contributions to a score are rounded to
2 ** -32, so sums do not depend on their order and equal texts score equally.

Terms are runs of letters and digits in lower case. Ties go to the smaller
doc_id. Only documents that share a term with the query are found.

Edge cases: null and empty texts hold no term, count as documents of length 0
and find nothing as queries; repeated rows are found as often as they occur; a
null identifier can be found, first among ties, but is no query; queries that
share an identifier are one query of all their terms; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from voxloom.llm.common import forget_kept, keep_freed, materialise, shared_dir

TERM = re.compile(r"[^\W_]+")
K1, B = 1.2, 0.75
SHARD_DOCS, SHARD_TERMS, WINDOW = 16_384, 6_000_000, 4096
#: Queries read at once, those whose frequent lists are multiplied at once, and those that are merged at once.
QUERY_BLOCK, PRODUCT, MERGED = 512, 128, 8
#: Lists whose contributions to all documents are multiplied: so many of a shard's terms at most, each in one of so many of its documents at least.
FREQUENT, FREQUENT_SHARE = 512, 32
#: Share of what a window's frequent lists lack to the score known that unread lists may reach where they lack all of it, and in proportion less where they lack less.
UNREAD = 0.5
#: More than what a sum of FREQUENT numbers of single precision can be off by.
NEAR = 1e-4
_ONE = float(1 << 32)


def terms_of(text: str | None) -> Counter:
    return Counter(TERM.findall(text.lower())) if text else Counter()


class _Numbers(dict):
    """term -> number, in the order of first use."""

    def __missing__(self, term: str) -> int:
        self[term] = n = len(self)
        return n


#: Characters beyond ASCII that belong to no term.
_ODD = re.compile(r"[^\w\x00-\x7f]")
#: UTF-8 with a space for every other character of ASCII.
_SPACES = bytes(c if c > 127 or TERM.match(chr(c)) else 32 for c in range(256))


def _spaced(text: str) -> bytes:
    """The terms of a text between spaces."""
    text = text.lower()
    return (text if text.isascii() else _ODD.sub(" ", text)).encode().translate(_SPACES)


def numbered_terms(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(number of each term of all texts in turn, terms of each text, the terms by number)."""
    pieces = pc.split_pattern(pa.array([_spaced(t) if t else b"" for t in texts], pa.large_binary()).cast(pa.large_string()), " ")
    coded = pieces.flatten().dictionary_encode()
    numbers = coded.indices.to_numpy()
    some = numbers != pc.index(coded.dictionary, pa.scalar("", pa.large_string())).as_py()  # between two spaces
    upto = np.concatenate([[0], np.cumsum(some)])
    return numbers[some], np.diff(upto[np.concatenate([[0], np.cumsum(pieces.value_lengths().to_numpy())])]), coded.dictionary


def _ranges(lo: np.ndarray, size: np.ndarray) -> np.ndarray:
    """lo[0], lo[0] + 1, ... (size[0] of them), lo[1], ..."""
    end = np.cumsum(size)
    out = np.repeat(lo - end + size, size)
    out += np.arange(len(out))
    return out


def shard_of(ids: list, texts: list[np.ndarray], numbers: _Numbers | pa.Array) -> dict[str, list]:
    """One index row: documents by length, postings of all terms, those of most documents first; texts are the documents' terms by number."""
    words = numbers if isinstance(numbers, pa.Array) else pa.array([*numbers], pa.large_string())
    lengths = np.array([len(t) for t in texts])
    order = np.argsort(lengths, kind="stable")
    place = np.empty(len(ids), np.int32)
    place[order] = np.arange(len(ids))
    key = np.concatenate(texts).astype(np.int64)
    key <<= 16  # in place, as this is the largest array there is
    key |= np.repeat(place, lengths)
    key.sort()
    first = np.flatnonzero(np.diff(key, prepend=-1))
    tf = np.diff(first, append=len(key))
    key = key[first]
    df = np.bincount(key >> 16, minlength=len(words))
    lists = np.argsort(-df, kind="stable")[: np.count_nonzero(df)]
    at = _ranges((np.cumsum(df) - df)[lists], df[lists])
    return {
        "n_docs": [len(ids)],
        "n_terms": [int(lengths.sum())],
        "ids": [[ids[i] for i in order]],
        "lengths": [lengths[order].tolist()],
        "words": ["\n".join(words.take(pa.array(lists)).to_pylist())],
        "df": [df[lists].astype("<i4").tobytes()],
        "docs": [(key & 0xFFFF).astype("<u2")[at].tobytes()],
        "tf": [tf.astype("<i4")[at].tobytes()],
    }


def build(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The stored index, a row per shard: (lot, n_docs, n_terms, ids, lengths, words, df, docs, tf); lot, from 0 to 2 ** 32, spreads the partitions evenly."""
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.string(), pa.binary(), pa.binary(), pa.binary())

    def batch(lot: int, ids: list, held: list[tuple]) -> pa.RecordBatch:
        coded = pa.chunked_array([pa.DictionaryArray.from_arrays(pa.array(n, pa.int32()), w) for n, _, w in held]).unify_dictionaries()
        texts = [t for c, (_, n, _) in zip(coded.chunks, held, strict=True) for t in np.split(c.indices.to_numpy(), np.cumsum(n)[:-1])]
        held.clear()
        one = {"lot": [lot]} | shard_of(ids, texts, coded.chunk(0).dictionary)
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(one.values(), kinds, strict=True)], names=list(one))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        lot = TaskContext.get().partitionId() * 2_654_435_769 % (1 << 32)
        ids, held, n_terms = [], [], 0
        for b in batches:
            at = 0
            while at < b.num_rows:
                part = b.slice(at, min(256, SHARD_DOCS - len(ids)))
                numbers, lengths, words = numbered_terms(part.column(1).to_pylist())
                over = n_terms + np.cumsum(lengths) >= SHARD_TERMS
                if over.any():  # the shard ends with this document
                    part = part.slice(0, int(over.argmax()) + 1)
                    lengths = lengths[: part.num_rows]
                    numbers = numbers[: lengths.sum()]
                held.append((numbers, lengths, words))
                ids += part.column(0).to_pylist()
                n_terms += int(lengths.sum())
                at += part.num_rows
                if len(ids) == SHARD_DOCS or n_terms >= SHARD_TERMS:
                    yield batch(lot, ids, held)
                    ids, held, n_terms = [], [], 0
        if ids:
            yield batch(lot, ids, held)
        del ids, held
        forget_kept()

    schema = "lot long, n_docs long, n_terms long, ids array<long>, lengths array<int>, words string, df binary, docs binary, tf binary"
    return materialise(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema))


def _split(words: pa.Array) -> pa.Array:
    """The words of one index row."""
    return pc.split_pattern(words.cast(pa.large_string()), "\n").flatten() if words[0].as_py() else pa.array([], pa.large_string())


def frequencies(index: DataFrame) -> DataFrame:
    """(term, df) over all shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for one in range(b.num_rows):
                df = np.frombuffer(b.column(1)[one].as_py(), "<i4").astype(np.int64)
                if len(df):
                    yield pa.RecordBatch.from_arrays([_split(b.column(0).slice(one, 1)).cast(pa.string()), pa.array(df)], names=["term", "df"])

    return index.select("words", "df").mapInArrow(run, "term string, df long").groupBy("term").agg(F.sum("df").alias("df"))


def query_terms(queries: DataFrame) -> DataFrame:
    """(query_id, term, n) of queries (query_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, w, n) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for w, n in terms_of(t).items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64())], names=["query_id", "term", "n"])

    return queries.select(F.col("query_id").cast("long"), "text").mapInArrow(run, "query_id long, term string, n long")


class Searcher:
    """One shard, ready for blocks of queries."""

    def __init__(self, row: dict, mean_length: float):
        self.ids, lengths = row["ids"], np.array(row["lengths"], float)
        self.n = len(lengths)
        self.words = _split(pa.array([row["words"]]))
        df = np.frombuffer(row["df"], "<i4").astype(np.int64)
        docs = np.frombuffer(row["docs"], "<u2")
        tf = np.frombuffer(row["tf"], "<i4")
        self.norm = K1 * (1 - B + B * lengths / max(mean_length, 1e-9))
        gain = tf * (K1 + 1) / (tf + self.norm[docs])
        lists = np.repeat(np.arange(len(df), dtype=np.int32), df)
        # where each window begins in each list, and the most the list contributes there
        self.windows = max(1, -(-self.n // WINDOW))
        self.width = self.windows * WINDOW
        size = np.bincount(lists * np.int64(self.windows) + docs // WINDOW, minlength=len(df) * self.windows)
        self.start = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        top = np.zeros(len(size))
        some = np.flatnonzero(size)
        if len(some):
            top[some] = np.maximum.reduceat(gain, self.start[some])
        self.top = np.nextafter(top.astype(np.float32), np.float32(np.inf), where=top > 0, out=np.zeros(len(top), np.float32)).reshape(-1, self.windows)
        # a posting: its contribution and its document in one number
        self.postings = np.empty(len(docs), np.uint64)
        self.postings.view(np.uint32)[0::2] = docs
        self.postings.view(np.float32)[1::2] = gain
        self.often = int(np.count_nonzero(df[:FREQUENT] * FREQUENT_SHARE >= self.n))
        end = int(df[: self.often].sum())
        self.dense = np.zeros((self.often, self.width), np.float32)
        self.dense[lists[:end], docs[:end]] = gain[:end]
        # the documents' own lists, in order: document * number of lists + list
        order = np.argsort(docs, kind="stable")
        self.own = docs[order] * np.int64(len(df)) + lists[order]
        self.tf = tf[order]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(docs, minlength=self.n))])
        self.weight = np.zeros(len(df))  # of a query's lists, while it is scored
        self.read = self.scored = 0

    def answer(self, terms: pa.Array | list[list[str]], weights: pa.Array | list[np.ndarray], k: int, known: list[float] | None = None) -> list[list[tuple[int | None, float]]]:
        """The best k (doc_id, score) of each query; known: scores (times 2 ** 32) that k documents of other shards reach already, raised here."""
        known = known if known is not None else [0.0] * len(terms)
        terms = terms if isinstance(terms, pa.Array) else pa.array(terms, pa.list_(pa.string()))
        weights = weights if isinstance(weights, pa.Array) else pa.array(weights, pa.list_(pa.float64()))
        if not len(terms):
            return []
        coded = terms.flatten().cast(pa.large_string()).dictionary_encode()
        there = pc.index_in(self.words, value_set=coded.dictionary).fill_null(-1).to_numpy(zero_copy_only=False)
        have = np.flatnonzero(there >= 0)
        place = np.full(len(coded.dictionary), -1)
        place[there[have]] = have
        at, w, q = place[coded.indices.to_numpy()], weights.flatten().to_numpy(), np.repeat(np.arange(len(terms)), terms.value_lengths().to_numpy())
        order = np.flatnonzero(at >= 0)
        order = order[np.argsort(q[order] * len(self.words) + at[order])]  # by query, its longest list first
        at, w, q = at[order], w[order], q[order]
        bounds = np.searchsorted(q, np.arange(len(terms) + 1))
        theta = np.array(known, float) / _ONE
        out = []
        for i in range(0, len(terms), PRODUCT):
            upto = min(i + PRODUCT, len(terms))
            near = self._product(at[bounds[i] : bounds[upto]], w[bounds[i] : bounds[upto]], q[bounds[i] : bounds[upto]] - i, upto - i)
            for j in range(i, upto, MERGED):
                m = min(j + MERGED, upto)
                a, b = bounds[j], bounds[m]
                out += self._some(at[a:b], w[a:b], q[a:b] - j, near[j - i : m - i], k, theta[j:m])
        known[:] = (theta * _ONE).tolist()
        return out

    def _product(self, at: np.ndarray, w: np.ndarray, q: np.ndarray, n: int) -> np.ndarray:
        """What the frequent lists contribute to each document, by query."""
        f = at < self.often
        return np.bincount(q[f] * self.often + at[f], w[f], n * self.often).reshape(n, self.often).astype(np.float32) @ self.dense

    def _unread(self, at: np.ndarray, w: np.ndarray, q: np.ndarray, peak: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which lists (rows) stay unread in which windows (columns), and by query the most that those can add in each window."""
        left = np.zeros(peak.shape)
        top = self.top[at] * w[:, None]
        upto = np.cumsum(top, axis=0)
        head = np.flatnonzero(np.diff(q, prepend=-1))
        last = np.append(head[1:], len(q)) - 1
        upto -= np.repeat(upto[head] - top[head], last - head + 1, axis=0)
        lack = least[:, None] - peak
        share = UNREAD * np.maximum(lack, 0.0) / np.maximum(least, 1e-10)[:, None]
        allowed = np.where(upto[last] < lack[q[head]], np.inf, (lack * share)[q[head]])  # a window out of reach stays unread whole
        unread = upto < np.repeat(allowed, last - head + 1, axis=0)
        many = np.add.reduceat(unread, head, axis=0, dtype=np.int64)
        h, j = np.nonzero(many)
        left[q[head[h]], j] = upto[head[h] + many[h, j] - 1, j]
        return unread | (top == 0), left

    def _some(self, at: np.ndarray, w: np.ndarray, q: np.ndarray, near: np.ndarray, k: int, theta: np.ndarray) -> list[list[tuple[int | None, float]]]:
        """The best k of some queries with lists `at` of weights w; near: what their frequent lists contribute; theta is raised."""
        n = len(theta)
        bounds = np.searchsorted(q, np.arange(n + 1))
        slack = np.diff(bounds) / _ONE  # for what is rounded to 2 ** -32
        least = theta * (1 - NEAR) - slack
        near = near.reshape(n, self.windows, WINDOW)
        left = np.zeros((n, self.windows))
        f = at >= self.often
        if f.any():
            rare, v, of = at[f], w[f], q[f]
            unread, left = self._unread(rare, v, of, near.max(axis=2).astype(float), least)
            p, j = np.nonzero(~unread)
            cursor = rare[p] * self.windows + j
            lo = self.start[cursor].astype(np.int64)
            size = self.start[cursor + 1] - lo
            read = self.postings[_ranges(lo, size)]
            self.read += len(read)
            document = np.repeat(of[p] * self.width, size)
            document += read.view(np.uint32)[0::2]
            near = near + np.bincount(document, read.view(np.float32)[1::2] * np.repeat(v[p], size), n * self.width).reshape(near.shape)
        pivots = np.flatnonzero(near >= np.maximum(least[:, None] - left, 1e-10)[:, :, None])
        each = np.searchsorted(pivots, np.arange(n + 1) * self.width)
        near = near.ravel()
        out = []
        for i in range(n):
            mine = pivots[each[i] : each[i + 1]]
            d = mine - i * self.width
            if len(d) > 2 * k:
                sums = near[mine]
                sure = float(np.partition(sums, len(d) - k)[len(d) - k]) * (1 - NEAR) - slack[i]
                if sure > theta[i]:
                    theta[i] = sure
                    d = d[sums + left[i, d // WINDOW] >= sure * (1 - NEAR) - slack[i]]
            if not len(d):
                out.append([])
                continue
            scores = self._scores(at[bounds[i] : bounds[i + 1]], w[bounds[i] : bounds[i + 1]] * _ONE, d)
            good = scores >= max(theta[i] * _ONE, 1.0)
            d, scores = d[good], scores[good]
            if len(scores) >= k:
                theta[i] = max(theta[i], np.partition(scores, len(scores) - k)[len(scores) - k] / _ONE)
            best = sorted((-s, self.ids[x] is not None, self.ids[x] or 0) for s, x in zip(scores.tolist(), d.tolist(), strict=True))
            out.append([(x if there else None, -s / _ONE) for s, there, x in best[:k]])
        return out

    def _scores(self, at: np.ndarray, w: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Exact scores of documents; w is times 2 ** 32."""
        self.scored += len(docs)
        np.add.at(self.weight, at, w)
        out = np.zeros(len(docs))
        size = self.first[docs + 1] - self.first[docs]
        long = size > 10 * len(at)
        for way, mine in ((True, np.flatnonzero(long)), (False, np.flatnonzero(~long))):
            for x in np.split(mine, range(2048, len(mine), 2048)) if len(mine) else ():
                start = docs[x] * len(self.weight)
                if way:  # the query's lists are looked up among those of the documents
                    lists = np.unique(at)
                    wanted = (start[:, None] + lists).ravel()
                    i = np.searchsorted(self.own, wanted)
                    held = np.flatnonzero(self.own[np.minimum(i, len(self.own) - 1)] == wanted)
                    i, of, w = i[held], held // len(lists), self.weight[lists][held % len(lists)]
                else:
                    i = _ranges(self.first[docs[x]], size[x])
                    w = self.weight[self.own[i] - np.repeat(start, size[x])]
                    held = np.flatnonzero(w)
                    i, of, w = i[held], np.searchsorted(np.cumsum(size[x]), held, side="right"), w[held]
                tf = self.tf[i]
                out[x] = np.bincount(of, np.rint(tf * (K1 + 1) / (tf + self.norm[docs[x]][of]) * w), len(x))
        self.weight[at] = 0.0
        return out


def _filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of QUERY_BLOCK rows or somewhat more, however small those of single files are."""
    held = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= QUERY_BLOCK:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def search(index: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, doc_id, score): the best k documents of each query (query_id, text)."""
    spark = index.sparkSession
    shards, n, length = index.agg(F.count("*"), F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    terms = materialise(query_terms(queries))
    df = frequencies(index)
    idf = F.log(1 + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = terms.join(df, "term").select("query_id", "term", (F.col("n") * idf).alias("w"))
    folder = f"{shared_dir(spark)}/queries"
    weighted.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("term", "w"))).alias("t")).select("query_id", F.col("t.term").alias("terms"), F.col("t.w").alias("weights")).write.parquet(folder)
    mean = length / max(n, 1)

    def best(index: DataFrame, reached: str | None) -> DataFrame:
        """The best k of each shard; reached: folder of (query_id, score that k documents elsewhere reach)."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import pyarrow.dataset as ds
            from pyarrow import fs

            forget_kept()
            keep_freed(4)
            known: dict[int, float] = {}  # query -> score of its k-th best so far, times 2 ** 32: a number for each query
            for b in batches:
                if not known and reached:
                    store, path = fs.FileSystem.from_uri(reached)
                    at = ds.dataset(path, filesystem=store, format="parquet", schema=pa.schema([("query_id", pa.int64()), ("score", pa.float64())])).to_table(use_threads=False)
                    known = dict(zip(at.column(0).to_pylist(), (at.column(1).to_numpy() * _ONE).tolist(), strict=True))
                store, path = fs.FileSystem.from_uri(folder)
                for one in range(b.num_rows):
                    shard = Searcher(b.slice(one, 1).to_pylist()[0], mean)
                    for q in _filled(ds.dataset(path, filesystem=store, format="parquet").to_batches(batch_size=QUERY_BLOCK, batch_readahead=1, fragment_readahead=1, use_threads=False)):
                        ids = q.column("query_id").to_pylist()
                        theta = [known.get(i, 0.0) for i in ids]
                        found = shard.answer(q.column("terms"), q.column("weights"), k, theta)
                        known.update(zip(ids, theta, strict=True))
                        rows = [(i, d, s) for i, f in zip(ids, found, strict=True) for d, s in f]
                        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.float64())], names=["query_id", "doc_id", "score"])
                    del shard
            forget_kept()

        return index.drop("lot").mapInArrow(run, StructType.fromDDL("query_id long, doc_id long, score double"))

    def ranked(found: DataFrame) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "doc_id"))
        return found.select("query_id", rank.alias("rank"), "doc_id", "score").where(F.col("rank") <= k)

    # so many shards of N are searched first that these and all others give about as many rows to a query
    first = max(math.sqrt(shards), spark.sparkContext.defaultParallelism) / max(shards, 1)
    if first > 0.5:
        return ranked(best(index, None))
    lot = F.col("lot") < F.lit(int(first * (1 << 32)))
    sample = materialise(ranked(best(index.where(lot), None)).drop("rank"))
    reached = f"{shared_dir(spark)}/reached"
    sample.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("score")).where(F.col("n") == k).select("query_id", "score").write.parquet(reached)
    return ranked(sample.unionByName(best(index.where(~lot), reached)))


def search_rows(docs: DataFrame, queries: Column, k: int = 10, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The best k of all documents for each document that meets the condition `queries`."""
    asked = docs.where(queries).select(F.col(key).alias("query_id"), F.col(text).alias("text"))
    return search(build(docs, text, key), asked, k)
