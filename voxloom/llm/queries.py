"""The corpus operators' registered queries, each over whole tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm import align, bm25, bpe, chat, dual_tree, language_id, mixing, near_dedup, packing, quality_classifier, quality_rules, sstable, toxicity
from voxloom.llm.common import crc_mod, documents, materialise


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = mixing.mix(documents(spark, sf_dir)).taken
    t = t.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return t.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), vocabulary_path("word_bpe_49k.json"), ids=False)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.fit(d, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.with_toxicity(d, model).select("doc_id", F.col("p_junk").alias("junk_score"), F.col("p_toxic").alias("toxic_score"), F.col("is_toxic").alias("toxic"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir).select("doc_id", "text", "lang", "source")
    counted = materialise(quality_rules.with_counts(d).drop("text"))
    j = quality_rules.judged(counted, *quality_rules.fit(counted))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return j.select("doc_id", *[F.col(f"q_{c}").alias(c) for c in names])


def op6_bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all documents for every document whose id is divisible by 100, its whole text as the query."""
    return bm25.search_rows(documents(spark, sf_dir), F.col("doc_id") % 100 == 0, k=10)


def op7_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir)
    back = sstable.read(spark, sstable.write(d, vocabulary_path("word_bpe_49k.json")))
    return back.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = language_id.fit(d.where(crc_mod("doc_id", 5) != 0), vocabulary_path("piece_bpe_32k.model"))
    found = language_id.with_language(d.select("doc_id", "text"), model, out=("lang_pred", "score"))
    return found.select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(True)).alias("held_out"), "lang_pred", "score")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir).select("doc_id", "text")
    model = quality_classifier.fit(d, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    found = quality_classifier.with_score(d, model)
    return found.select("doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= quality_classifier.LEAST_SCORE).cast("int").alias("predicted"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), words=4, percent=80)


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary_path("byte_bpe_50k.json")
    back = bpe.decoded(bpe.encoded(documents(spark, sf_dir).select("doc_id", "text"), path), path)
    ids, text = F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), F.col("text").cast("binary")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2(text, 256).alias("decoded_sha256"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dual_tree.clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=8, rounds=10, salt="3:")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.linked(documents(spark, sf_dir), vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_packing": op2_packing,
    "op3_toxicity": op3_toxicity,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_quality_rules": op5_quality_rules,
    "op6_bm25_search": op6_bm25_search,
    "op7_token_shards": op7_token_shards,
    "op8_language_id": op8_language_id,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_near_dedup": op10_near_dedup,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_token_alignment": op13_token_alignment,
}

_SPLIT = r"list_filter(string_split_regex({0}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _measure_sql() -> str:
    each = {m: (e.replace(" div ", " // "), f"{quality_rules.REACH} * ({fine})", sides) for m, (e, fine, sides) in quality_rules.MEASURES.items()}
    values = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS measure, CAST({e} AS BIGINT) AS v FROM c WHERE NOT base_failed" for m, (e, _, _) in each.items())
    fence = lambda side, m: f"(SELECT any_value({side}) FROM f WHERE f.measure = '{m}' AND f.lang IS NOT DISTINCT FROM c.lang AND f.source IS NOT DISTINCT FROM c.source)"
    bounds = " AND ".join(f"coalesce({e} <= {fence('high', m)} + {fine}, true)" for m, (e, fine, _) in each.items())
    bounds += "".join(f" AND coalesce({e} >= {fence('low', m)} - {fine}, true)" for m, (e, fine, sides) in each.items() if sides == "both")
    rank = lambda p: f"min(value) FILTER (upto * 100 >= docs * {p}) AS q{p}"

    def level(name: str, keys: str) -> str:
        return f"""{name} AS (SELECT {keys}, any_value(docs) AS docs, {rank(25)}, {rank(75)} FROM
        (SELECT {keys}, CASE WHEN bin < 16 THEN bin ELSE (bin % 16 + 16) << CAST(bin // 16 - 1 AS INT) END AS value, sum(n) OVER (PARTITION BY {keys} ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY {keys}) AS docs
         FROM (SELECT {keys}, bin, sum(n) AS n FROM sketch GROUP BY ALL)) GROUP BY {keys})"""

    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, {_SPLIT.format("text")} AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT row, i, array_to_string(words[i : i + 7], ' ') AS gram FROM (SELECT *, unnest(range(1, len(words) - 6)) AS i FROM w)),
again AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, gram) AS n FROM g) WHERE n > 1),
rep AS (SELECT row, count(DISTINCT i + k) AS n FROM again, range(8) r(k) GROUP BY row),
c0 AS (SELECT row, doc_id, lang, source, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
       length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, len(lines) AS n_lines, len(list_filter(range(1, greatest(len(words), 1)), lambda i: words[i] = words[i + 1])) AS n_echoes FROM w LEFT JOIN rep USING (row)),
c AS (SELECT *, n_words < {quality_rules.LEAST_WORDS} OR 100 * n_repeat_words > {quality_rules.MOST_REPEATED} * n_words AS base_failed FROM c0),
m AS ({values}),
sketch AS (SELECT lang, source, measure, 16 * e + (v >> CAST(e AS INT)) AS bin, count(*) AS n FROM (SELECT *, greatest(length(bin(v)) - 5, 0) AS e FROM m) GROUP BY ALL),
{level("own", "lang, source, measure")}, {level("by_lang", "lang, measure")}, {level("of_all", "measure")},
q AS (SELECT o.lang, o.source, o.measure,
      CASE WHEN o.docs >= {quality_rules.LEAST_DOCS} THEN o.q25 WHEN l.docs >= {quality_rules.LEAST_DOCS} THEN l.q25 ELSE a.q25 END AS q25, CASE WHEN o.docs >= {quality_rules.LEAST_DOCS} THEN o.q75 WHEN l.docs >= {quality_rules.LEAST_DOCS} THEN l.q75 ELSE a.q75 END AS q75
      FROM own o JOIN by_lang l ON l.lang IS NOT DISTINCT FROM o.lang AND l.measure = o.measure JOIN of_all a ON a.measure = o.measure),
f AS (SELECT *, q25 - {quality_rules.REACH} * (q75 - q25) AS low, q75 + {quality_rules.REACH} * (q75 - q25) AS high FROM q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {bounds} AS kept FROM c
"""


NEAR_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_SPLIT.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS words FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(words) < 4 THEN array_to_string(words, ' ') ELSE array_to_string(words[i : i + 3], ' ') END AS gram FROM (SELECT *, unnest(range(1, greatest(len(words) - 2, 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS i, b.doc_id AS j, count(*) AS k FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT i, j FROM both_ JOIN n a ON a.doc_id = i JOIN n b ON b.doc_id = j WHERE 100 * k >= 80 * (a.n + b.n - k)),
reach AS (SELECT i AS doc_id, j AS other FROM links UNION SELECT r.doc_id, l.j FROM reach r JOIN links l ON l.i = r.other),
c AS (SELECT doc_id, min(other) AS least FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(c.least, w.doc_id)) AS component_id, w.doc_id = least(w.doc_id, coalesce(c.least, w.doc_id)) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""

def _cluster_sql(k: int = 8, rounds: int = 10) -> str:
    """Lloyd's rounds written out, every vector against every centroid."""
    steps = "".join(
        f"""
d{t} AS (SELECT r, k, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS d FROM v JOIN c{t} c USING (j) GROUP BY r, k),
a{t} AS MATERIALIZED (SELECT r, k, d FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY d, k) AS place FROM d{t}) WHERE place = 1),"""
        + (f"""
m{t} AS (SELECT k, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM a{t} JOIN v USING (r) GROUP BY k, j),
c{t + 1} AS MATERIALIZED (SELECT c.k, c.j, coalesce((s - (s % n + n) % n) // n, c.x) AS x FROM c{t} c LEFT JOIN m{t} USING (k, j)),""" if t < rounds else "")
        for t in range(rounds + 1)
    )
    return f"""
WITH e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
v AS MATERIALIZED (SELECT r, i AS j, CAST(floor(1024 * CAST(embedding[i + 1] AS DOUBLE)) AS BIGINT) AS x FROM e, range(64) t(i)),
c0 AS MATERIALIZED (SELECT k - 1 AS k, j, x FROM (SELECT r, row_number() OVER (ORDER BY sha256('3:' || vec_id)) AS k FROM e) JOIN v USING (r) WHERE k <= {k}),{steps}
sha AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY j)) AS h FROM c{rounds} GROUP BY k)
SELECT vec_id, CAST(k AS INT) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
FROM a{rounds} JOIN e USING (r) JOIN sha USING (k)
"""


SQL: dict[str, str] = {"op12_centroid_clusters": _cluster_sql(), "op4_chat_formatting": chat.SQL, "op5_quality_rules": _measure_sql(), "op10_near_dedup": NEAR_SQL}
