"""Edge cases of the corpus operators: nulls, clashing names, hot keys, very long texts."""

import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.llm import chat, common, language_id, mixing, near_dedup, packing, profile, quality_classifier, quality_rules, sstable, tokens, toxicity
from voxloom.llm.queries import vocabulary_path

from .test_ops import brute_groups, brute_measure, prose, rows_of

PIECES, BPE = vocabulary_path("piece_bpe_32k.model"), vocabulary_path("word_bpe_49k.json")
PLAIN = "doc_id long, text string, lang string, source string"
#: Names that the operators use themselves, as columns of the input.
CLASH = ["row", "copies", "m_words", "m_place", "m_cuts", "size", "q_n_words", "q_kept", "lang_pred", "lang_score", "score", "is_toxic", "p_toxic", "h1", "h2", "v_key", "n_bucket", "digest", "label", "component", "kept", "ids", "piece", "sequence_id", "salt", "m_rank", "rows"]


@pytest.fixture(scope="module")
def clashing(spark):
    rng = random.Random(21)
    rows = [(i, prose(rng, rng.randint(25, 90)), rng.choice(["aa", "bb"]), rng.choice(["s1", "s2"])) for i in range(60)]
    rows += [(60, rows[3][1], "aa", "s1"), (61, None, None, None)]
    df = spark.createDataFrame(rows, PLAIN)
    return df.select("*", *[F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")).alias(c) for c in CLASH])


def mine(df):
    """Whether every column with a clashing name still has its own values."""
    return all(r[c] == f"{c} {r['doc_id']}" for r in df.collect() for c in CLASH)


def test_filters_leave_clashing_columns_alone(clashing):
    for out in (mixing.mix_documents(clashing), quality_rules.filter_documents(clashing), language_id.filter_documents(clashing, PIECES), near_dedup.one_of_each(clashing)):
        assert out.columns == clashing.columns and mine(out) and out.count() > 10


def test_results_replace_columns_of_their_name(spark, clashing):
    labels = spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(60)], "doc_id long, quality int, toxic int")
    out = language_id.with_language(clashing, language_id.fit(clashing, PIECES))
    assert {r["lang_pred"] for r in out.collect()} <= {"aa", "bb", "und"}
    out = quality_classifier.with_score(clashing, quality_classifier.fit(clashing, labels))
    assert all(0 <= r["score"] <= 1 for r in out.collect()) and out.columns.count("score") == 1
    out = toxicity.with_toxicity(clashing, toxicity.fit(clashing, labels))
    assert {r["is_toxic"] for r in out.collect()} <= {True, False} and out.columns.count("p_toxic") == 1
    out = quality_rules.with_counts(clashing)
    assert all(r["q_n_words"] == len((r["text"] or "").split()) for r in out.collect())
    assert tokens.with_ids(clashing, BPE).columns.count("ids") == 1
    assert packing.pack(clashing, BPE).count() == 62 and near_dedup.near_duplicates(clashing).count() == 62
    assert sstable.read(spark, sstable.write(clashing, BPE)).count() == 62


def test_null_ids_link_and_same_ids_differ(spark):
    rng = random.Random(22)
    a, b, c = (prose(rng, 40).split() for _ in range(3))
    text = lambda w, k: " ".join(w[: 40 - k] + [f"end{k}"] * k)
    rows = [(1, text(a, 0)), (None, text(a, 1)), (3, text(a, 2)), (3, text(b, 0)), (5, text(b, 0)), (5, text(c, 0)), (None, text(c, 0)), (9, " ".join(c)), (9, " ".join(c).upper()), (7, None), (7, None), (7, ""), (None, "alone here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(near_dedup.near_duplicates(df, words=4)) == brute_groups(rows, 4)
    out = [(r["doc_id"], r["text"]) for r in near_dedup.one_of_each(df, words=4).collect()]
    # one row of each group, named by its smallest id; rows without words all stay
    assert Counter(i for i, _ in out) == Counter([1, 3, 5, 7, 7, 7, None]), out
    assert (3, text(b, 0)) in out and (5, text(c, 0)) in out
    chain = [(None, text(a, 1)), (8, text(a, 0)), (4, text(a, 3))]
    assert rows_of(near_dedup.near_duplicates(spark.createDataFrame(chain, "doc_id long, text string"), words=4)) == brute_groups(chain, 4)


def test_rows_that_repeat_id_and_text_stay_once(spark):
    t = prose(random.Random(23), 50)
    rows = [(4, t)] * 40 + [(6, t)] * 30 + [(6, "some other words here that are alone")] * 3
    out = [(r["doc_id"], r["text"]) for r in near_dedup.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(out) == sorted({(4, t), (6, "some other words here that are alone")})


def test_blocks_of_a_region_lose_no_link(spark, monkeypatch):
    """Regions dealt into many small blocks give the same groups."""
    rng = random.Random(24)
    base = prose(rng, 60).split()
    rows = [(k, " ".join(base[:52] + [f"k{k}_{x}" for x in range(8)] + ([f"p{k // 2}"] * 0))) for k in range(120)]
    rows += [(1000 + k, " ".join(base[:52] + [f"k{k}_{x}" for x in range(7)] + ["last"])) for k in range(0, 120, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(near_dedup.mixed_regions, "__defaults__", (300,))
    assert rows_of(near_dedup.near_duplicates(df, words=4)) == brute_groups(rows, 4)


def test_sketches_ask_for_bits_that_alike_sets_have():
    least = near_dedup.least_bits(80)
    rng = np.random.default_rng(3)
    bits = []
    for _ in range(200):
        s = np.unique(rng.integers(0, 2**63, 900).astype(np.uint64))
        x, y = np.sort(s[:810]), np.sort(np.concatenate([s[:720], s[810:]]))  # 720 of 900
        a, b = (near_dedup._words(np.frombuffer(near_dedup.packed(near_dedup.signature(k), len(k)), np.uint8)[None, -near_dedup.BITS - 2 : -2]) for k in (x, y))
        bits.append(int(near_dedup._agree(a, b)[0]))
    assert least == 131 - 1 and min(bits) >= least and 145 < np.mean(bits) < 157


def test_mix_is_the_queue_written_out(spark):
    rng = random.Random(25)
    rows = [(i, prose(rng, rng.randint(1, 9)), None, "one") for i in range(150)] + [(500 + i, "w", None, "short") for i in range(300)]
    rows += [(900 + i, None, None, "none") for i in range(200)] + [(2000, prose(rng, 400), None, None)]
    df = spark.createDataFrame(rows, PLAIN).repartition(3)
    m = mixing.mix(df)
    size = {r[0]: len((r[1] or "").split()) for r in rows}
    place = {r["doc_id"]: (r["m_place"]["m_hash"], r["doc_id"]) for r in df.select("doc_id", mixing._place(F.col("doc_id"), mixing._size(F.col("text")), mixing.SEED).alias("m_place")).collect()}
    names, weight = ["none", "one", "short", None], [5, 2, 1, 5]
    queue = []
    for k, (s, w) in enumerate(zip(names, weight, strict=True)):
        own = sorted((place[r[0]], r[0]) for r in rows if r[3] == s)
        total = sum(size[i] for _, i in own)
        for turn in range(3):
            upto = 0
            for at, i in own:
                upto += size[i]
                queue.append(((turn * total + upto) / w, k, turn, at, i))
    want, words, budget = Counter(), 0, sum(size.values())
    for *_, i in sorted(queue):
        words += size[i]
        if words > budget:
            break
        want[i] += 1
    got = {r["doc_id"]: r["copies"] for r in m.taken.collect()}
    assert got == {i: want[i] for i in size}
    assert Counter(r["doc_id"] for r in mixing.mix_documents(df).collect()) == want
    order = mixing.in_mixing_order(m).collect()
    assert [r["total"] for r in order] == sorted(r["total"] for r in order) and len(order) == sum(want.values())


def test_ranges_hold_like_numbers_of_rows(spark):
    """Rows that all finish at one time are spread like others."""
    df = spark.range(4000).select(F.lit(0.0).alias("finish"), "id", F.lit(1).cast("long").alias("v")).union(spark.range(4000, 8000).select((F.col("id") * 1.0).alias("finish"), "id", F.lit(1).cast("long").alias("v")))
    stored = []
    keep = common.materialise
    try:
        common.materialise = lambda x: stored.append(keep(x)) or stored[-1]
        got = common.ranged_total(df.repartition(5), [], ["finish", "id"], "v", "t").collect()
    finally:
        common.materialise = keep
    assert {r["id"]: r["t"] for r in got} == {i: i + 1 for i in range(8000)}
    sizes = [r["count"] for r in stored[0].groupBy("rt_range").count().collect()]
    assert max(sizes) <= 2 * 8000 / len(sizes) + 100


def test_fences_follow_each_groups_habits(spark):
    """Two groups that differ in every habit get different fences for every measure."""
    rng = random.Random(26)

    def text(often):
        words = prose(rng, 100, "abcdefghijklmnop" if not often else "abcdefghijklmnopqrstuvwxyz").split()
        if often:
            words = [w * 2 + ("#" if rng.random() < 0.4 else "") for w in words]
            for _ in range(rng.randint(2, 9)):
                k = rng.randrange(len(words))
                words.insert(k, words[k])
        lines = [" ".join(words[i : i + 10]) for i in range(0, len(words), 10)]
        if often and rng.random() < 0.7:
            lines.insert(2, lines[rng.randrange(2)])
        return "\n".join(lines)

    rows = [(i, text(i % 2), "aa" if i % 2 else "bb", "s", 0) for i in range(900)]
    d = spark.createDataFrame([r[:4] for r in rows], PLAIN)
    fences, n = quality_rules.fit(quality_rules.with_counts(d).drop("text"))
    f = {r["lang"]: r for r in fences.collect()}
    assert n == 2
    for m in quality_rules.MEASURES:
        assert f["aa"][f"high_{m}"] > f["bb"][f"high_{m}"], m
    kept = {r["doc_id"] for r in quality_rules.filter_documents(d).collect()}
    assert len(kept) > 850
    strange = spark.createDataFrame([(9000, text(1).replace("#", "###").replace("a", "a#"), "bb", "s"), (9001, text(1), "aa", "s")], PLAIN)
    kept = {r["doc_id"] for r in quality_rules.filter_documents(d.union(strange)).collect()}
    assert 9000 not in kept and 9001 in kept


def test_texts_beyond_a_hundred_thousand_words():
    rng = random.Random(27)
    words = [rng.choice("abcdefgh") + str(rng.randrange(5000)) for _ in range(120_000)]
    words[110_000:110_020] = words[50_000:50_020]
    t = " ".join(words)
    assert profile.measure(t.encode())[:5] == brute_measure(t)
    want = {tuple(words[i : i + 4]) for i in range(len(words) - 3)}
    assert len(near_dedup.shingles(t.encode(), 4)) == len(want)


def test_long_foreign_words_and_numerals(spark):
    rng = random.Random(28)
    counts = {"xx": {"▁" + "".join(rng.choice("abcde") for _ in range(5)): 40_000 for _ in range(300)}, "yy": {"▁" + "".join(rng.choice("mnopq") for _ in range(5)): 40_000 for _ in range(300)}}
    m = language_id.fit_counts(counts, language_id.vocabulary(PIECES))
    texts = ["漢" * 400, "½ ² 12 Ⅷ", "", None, "abcde " + "ж" * 45, "12 !!"]
    got = language_id.Scorer(m).score(texts)
    assert all(0 <= s <= 1 for _, s in got) and not any(np.isnan(s) for _, s in got)
    assert [x for x, _ in got[1:4]] == ["und"] * 3 and got[5] == ("und", 0.0)
    assert got[4][0] == "xx" and got[0][0] in ("xx", "yy")
    assert np.isfinite(m.log_prob(["漢" * 40])).all()


def test_ids_that_do_not_fit_are_an_error():
    import io

    w = sstable.ShardWriter(io.BytesIO(), id_bytes=2)
    w.add(sstable.encode_key(1), np.array([65_535], "<u4").tobytes())
    with pytest.raises(ValueError, match="70000"):
        w.add(sstable.encode_key(2), np.array([70_000], "<u4").tobytes())
    f = io.BytesIO()
    w = sstable.ShardWriter(f, id_bytes=4)
    w.add(sstable.encode_key(2), np.array([70_000], "<u4").tobytes())
    w.close()
    assert sstable.Shard(f, len(f.getvalue())).get(sstable.encode_key(2)) == [np.array([70_000], "<u4").tobytes()]


def test_turns_with_line_breaks_are_not_mixed_up(spark):
    rows = [(1, 0, "a\nb", "c"), (2, 0, "a", "b\nc"), (2, 1, "x", "more"), (3, 0, "1:a", "b"), (4, 0, "1", ":ab")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    assert sorted(r["conv_id"] for r in chat.format_chats(df).collect()) == [1, 2, 3, 4]


def test_a_shared_folder_is_asked_for_on_a_cluster():
    conf = SimpleNamespace(get=lambda *a: None, set=lambda *a: None)
    spark = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077", getConf=lambda: conf))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(spark)
    spark.sparkContext.master = "local[4]"
    assert "voxloom-" in common.shared_dir(spark)


def test_released_tables_are_gone(spark):
    t = common.materialise(spark.range(5))
    folder = t.inputFiles()[0].rpartition("/")[0]
    common.release(t, spark.range(3))
    import os

    assert not os.path.exists(folder.removeprefix("file://"))


def test_sources_of_nothing_but_nulls(spark):
    df = spark.createDataFrame([(k, None, None, "s") for k in range(50)], PLAIN)
    t = mixing.mix(df).taken.collect()
    assert len(t) == 50 and {r["target"] for r in t} == {0.0}
    assert quality_rules.filter_documents(df).count() == 0 and language_id.filter_documents(df, PIECES).count() == 0
    assert near_dedup.one_of_each(df).count() == 50
    assert [r["kept"] for r in near_dedup.near_duplicates(df).collect()] == [True] * 50
