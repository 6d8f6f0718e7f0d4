"""Quality scores from a generalised additive model over measurements of whole texts.

The model is fitted on a bounded sample of labelled documents (TRAIN_ROWS in
expectation, chosen by a hash of the identifier) and scores every text by
looking up its measurements' bins and adding table entries, a batch at a time.

Edge cases: a null text counts as empty and is scored like any other text;
a document labelled more than once teaches its mean label, rounded up from a
half; null labels teach nothing; without labels every score is 0.5; measurements
saturate (200 bytes a word and 500 words a line count like any more); repeated
rows get equal scores; documents that share an identifier teach as one; other
columns are untouched, but for one that has the name of the score, which is
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from voxloom.llm import gam
from voxloom.llm.common import crc_mod, forget_kept, texts_in
from voxloom.llm.profile import measure

TRAIN_ROWS = 20_000
LEAST_SCORE = 0.7
FEATURES = ["log_words", "word_length", "longest_word", "distinct_words", "symbols", "dup_lines", "repeats", "echoes", "words_a_line", "upper", "digits", "punctuation", "bangs", "bars", "non_ascii"]

_UPPER, _DIGIT, _PUNCT, _BANG, _BAR, _HIGH = range(1, 7)
_KIND = np.zeros(256, np.uint8)
_KIND[65:91], _KIND[48:58], _KIND[128:] = _UPPER, _DIGIT, _HIGH
_KIND[[ord(c) for c in ".,;:'\"()?-"]] = _PUNCT
_KIND[ord("!")], _KIND[ord("|")] = _BANG, _BAR


def features(text: bytes | None) -> list[float]:
    """The numbers named in FEATURES."""
    n, chars, symbols, dup, rep, lines, echoes = measure(text)
    if not n:
        return [0.0] * len(FEATURES)
    words, size = text.split(), len(text)
    kinds = np.bincount(_KIND[np.frombuffer(text, np.uint8)], minlength=7) / size
    mean = [np.log1p(n), chars / n, min(max(map(len, words)), 200), len(set(words)) / n**0.8, symbols / chars, dup / max(lines, 1), rep / n, echoes / n, min(n / max(lines, 1), 500)]
    return [*map(float, mean), *(float(kinds[k]) for k in (_UPPER, _DIGIT, _PUNCT, _BANG, _BAR, _HIGH))]


def labelled_sample(labels: DataFrame, label: str, key: str, rows: int, teaches: Column) -> DataFrame:
    """(key, label): about `rows` labelled identifiers, one row each."""
    one = labels.where(F.col(label).isNotNull() & teaches).groupBy(key).agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias(label))
    n = one.count()
    return one.where(F.pmod(F.xxhash64(F.lit("label"), key), F.lit(1_000_000)) < min(1.0, rows / max(n, 1)) * 1_000_000)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", key: str = "doc_id", train_rows: int = TRAIN_ROWS) -> gam.Additive | None:
    """Fit on labelled documents whose crc32(key) modulo 4 is not 2."""
    sample = labelled_sample(labels, label, key, train_rows, crc_mod(key, 4) != 2).select(F.col(key).alias("s_key"), F.col(label).alias("s_label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [features(t) for t in b.column(0).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(rows, pa.list_(pa.float64()))], names=["s_key", "label", "x"])

    # the sample's size is bounded by train_rows, so it is broadcast and its measurements are collected
    d = docs.select(F.col(key).alias("d_key"), F.col(text).alias("d_text"))
    drawn = d.join(F.broadcast(sample), F.col("d_key") == F.col("s_key")).select("d_text", "s_key", F.col("s_label").cast("int"))
    schema = StructType([drawn.schema["s_key"], *StructType.fromDDL("label int, x array<double>").fields])
    got = drawn.mapInArrow(run, schema).groupBy("s_key").agg(F.min("label").alias("label"), F.min("x").alias("x")).collect()
    if not got:
        return None
    got = sorted((r["x"], r["label"]) for r in got)  # so that the order of rows changes nothing
    return gam.fit(np.array([g[0] for g in got]), np.array([g[1] for g in got], float))


def with_score(docs: DataFrame, model: gam.Additive | None, text: str = "text", out: str = "score") -> DataFrame:
    """docs with a score from 0 to 1; all other columns of docs stay."""
    docs = docs.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        for b in batches:
            x = np.array([features(t) for some in texts_in(b.column(text)) for t in some]).reshape(-1, len(FEATURES))
            s = model.score(x) if model is not None else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], names=[*b.schema.names, out])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out, DoubleType())]))
