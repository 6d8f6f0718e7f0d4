"""Quality rules with thresholds that adapt to each language and source.

Measured numbers of every document go into mergeable quantile sketches, one per
(lang, source, measure): counts of logarithmic bins (16 bins per power of two,
so within 1/16 of the true value), summed natively. Sums of sketches are
sketches, so groups too small for a quantile of their own use the sketch of
their language, or of everything. The thresholds, outer fences around the
middle half of a group, are joined to the documents and filter them. A fence is
as wide as the group's own middle half asks; beyond that a document is only
allowed what its size makes uncertain, the same for all groups.

Edge cases: a null or empty text has no words and fails the base rules; null
lang or source are groups of their own; repeated rows get the same verdict
each; an empty table gives an empty result; other columns are untouched,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from voxloom.llm.common import forget_kept, keyed_join, materialise, numbered, texts_in
from voxloom.llm.profile import measure

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_echoes"]

#: measure -> (value per thousand or per hundred as a long, its resolution in a document of that size, which fences count).
#: The resolution of a share is half a standard error of one event in as many places (a repeat is an event of 8 words), that of
#: the mean word length is its standard error as a count of letters. So a short text may stray farther than a long one.
MEASURES = {
    "symbols": ("1000 * n_symbols div greatest(word_chars, 1)", "500.0e0 / sqrt(greatest(word_chars, 1))", "high"),
    "dup_lines": ("1000 * n_dup_lines div greatest(n_lines, 1)", "500.0e0 / sqrt(greatest(n_lines, 1))", "high"),
    "repeats": ("1000 * n_repeat_words div greatest(n_words, 1)", "500.0e0 / sqrt(greatest(n_words, 8) / 8.0e0)", "high"),
    "echoes": ("1000 * n_echoes div greatest(n_words, 1)", "500.0e0 / sqrt(greatest(n_words, 1))", "high"),
    "word_length": ("100 * word_chars div greatest(n_words, 1)", "100.0e0 * sqrt(word_chars) / greatest(n_words, 1)", "both"),
}
#: Fences lie this many times (width of the middle half + the document's resolution) away from the middle half.
REACH = 3.0
#: A group with fewer documents uses the thresholds of its language, then of all documents.
LEAST_DOCS = 200
#: Base rules: fewest words; most words in repeated windows, per hundred.
LEAST_WORDS, MOST_REPEATED = 20, 30


def with_counts(docs: DataFrame, text: str = "text", prefix: str = "q_") -> DataFrame:
    """docs with the counts of `profile.measure` as long columns named prefix + name; all other columns of docs stay."""
    docs = docs.drop(*(prefix + c for c in COUNTS))
    schema = pa.schema([(prefix + c, pa.int64()) for c in COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        for b in batches:
            got = [measure(t) for some in texts_in(b.column(text)) for t in some]
            cols = [pa.array([g[i] for g in got], pa.int64()) for i in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=[*b.schema.names, *schema.names])
        forget_kept()

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *[StructField(n, LongType()) for n in schema.names]]))


def bin_of(v: str) -> Column:
    """Bin of a non-negative long: itself below 16, else 16 bins per power of two. Integer arithmetic only, so any engine agrees."""
    x = F.col(v)
    e = F.greatest(F.length(F.conv(x.cast("string"), 10, 2)) - 5, F.lit(0))
    return (16 * e + F.call_function("shiftright", x, e)).cast("long")


def value_of(b: Column) -> Column:
    """Least value of a bin."""
    e = F.greatest(F.floor(b / 16) - 1, F.lit(0)).cast("int")
    return F.when(b < 16, b).otherwise(F.call_function("shiftleft", (F.pmod(b, F.lit(16)) + 16).cast("long"), e)).cast("long")


def sketches(counted: DataFrame, groups: list[str], prefix: str = "q_") -> DataFrame:
    """(group columns, measure, bin, n): the sketch counts of documents that pass the base rules."""
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.expr(_named(e, prefix)).cast("long").alias("v")) for m, (e, _, _) in MEASURES.items()])
    rows = counted.where(~base_failed(prefix)).select(*groups, F.explode(pairs).alias("m")).select(*groups, "m.measure", "m.v")
    return rows.groupBy(*groups, "measure", bin_of("v").alias("bin")).agg(F.count("*").alias("n"))


def quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, docs, q25, q75) of summed sketches: least values of the bins that hold those ranks."""
    s = sketch.groupBy(*keys, "bin").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*keys)
    s = s.withColumn("docs", F.sum("n").over(w)).withColumn("upto", F.sum("n").over(w.orderBy("bin")))
    at = lambda p: F.min(F.when(F.col("upto") * 100 >= F.col("docs") * p, value_of(F.col("bin"))))
    return s.groupBy(*keys).agg(F.max("docs").alias("docs"), at(25).alias("q25"), at(75).alias("q75"))


def thresholds(sketch: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per (lang, source): low_<measure> and high_<measure> fences, without a document's resolution, from the smallest group that has LEAST_DOCS documents."""
    own = quantiles(sketch, [lang, source, "measure"])
    by_lang = quantiles(sketch, [lang, "measure"]).select(F.col(lang).alias("l_lang"), F.col("measure").alias("l_measure"), *[F.col(c).alias(f"l_{c}") for c in ("docs", "q25", "q75")])
    of_all = quantiles(sketch, ["measure"]).select(F.col("measure").alias("a_measure"), *[F.col(c).alias(f"a_{c}") for c in ("q25", "q75")])
    t = own.join(by_lang, own[lang].eqNullSafe(by_lang["l_lang"]) & (own["measure"] == by_lang["l_measure"])).join(F.broadcast(of_all), F.col("measure") == F.col("a_measure"))
    pick = lambda c: F.when(F.col("docs") >= LEAST_DOCS, F.col(c)).when(F.col("l_docs") >= LEAST_DOCS, F.col(f"l_{c}")).otherwise(F.col(f"a_{c}"))
    t = t.select(lang, source, "measure", pick("q25").alias("q25"), pick("q75").alias("q75"))
    reach = (F.col("q75") - F.col("q25")) * REACH
    t = t.select(lang, source, "measure", (F.col("q25") - reach).alias("low"), (F.col("q75") + reach).alias("high"))
    cols = [F.max(F.when(F.col("measure") == m, F.col(side))).alias(f"{side}_{m}") for m in MEASURES for side in ("low", "high")]
    return t.groupBy(lang, source).agg(*cols)


def base_failed(prefix: str = "q_") -> Column:
    return F.expr(_named(f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words", prefix))


def judged(counted: DataFrame, fences: DataFrame, n_fences: int, lang: str = "lang", source: str = "source", prefix: str = "q_") -> DataFrame:
    """counted with boolean columns q_base_failed and q_kept. A group without fences has only documents that fail the base rules."""
    names = {c: f"{prefix}{c}" for c in fences.columns if c not in (lang, source)}
    f = fences.select(lang, source, *[F.col(c).alias(n) for c, n in names.items()])
    j = keyed_join(counted, f, [lang, source], n_fences)
    ok = F.lit(True)
    for m, (e, fine, sides) in MEASURES.items():
        v, slack = F.expr(_named(e, prefix)), F.lit(REACH) * F.expr(_named(fine, prefix))
        ok = ok & F.coalesce(v <= F.col(f"{prefix}high_{m}") + slack, F.lit(True))
        if sides == "both":
            ok = ok & F.coalesce(v >= F.col(f"{prefix}low_{m}") - slack, F.lit(True))
    j = j.withColumn(f"{prefix}base_failed", base_failed(prefix))
    return j.withColumn(f"{prefix}kept", ~F.col(f"{prefix}base_failed") & ok).drop(*names.values())


def fit(counted: DataFrame, lang: str = "lang", source: str = "source", prefix: str = "q_") -> tuple[DataFrame, int]:
    """Fences of all groups, as a stored table, and their number."""
    t = materialise(thresholds(materialise(sketches(counted, [lang, source], prefix)), lang, source))
    return t, t.count()


def filter_documents(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that the rules keep, with the columns of docs."""
    d, new = numbered(docs)
    t, x, s = new[text], new[lang], new[source]
    fences = fit(with_counts(d.select(t, x, s), t).drop(t), x, s)
    return judged(with_counts(d, t), *fences, x, s).where("q_kept").select(*new.values()).toDF(*docs.columns)


def _named(expr: str, prefix: str) -> str:
    for c in COUNTS:
        expr = expr.replace(c, f"@{c}")
    return expr.replace("@", prefix)

