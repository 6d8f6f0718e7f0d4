"""The corpus operators against brute force, round trips and held-out accuracy, with the edge cases each docstring names."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voxloom.llm import bm25, chat, components, gam, language_id, mixing, near_dedup, packing, profile, quality_classifier, quality_rules, sstable, tokens, toxicity
from voxloom.llm.queries import QUERIES, SQL, vocabulary_path

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, kept string, label string"
BPE = vocabulary_path("word_bpe_49k.json")
DIR = "/root/testdata/sf0.001"


def prose(rng, n, alphabet="abcdefg"):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 6))) for _ in range(n))


def odd_docs(seed=1, n=40):
    """Prose, nulls, empty and long texts, repeated rows, ties; columns named like our own."""
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randint(1, 120)), rng.choice(["aa", "bb", None]), rng.choice(["s1", "s2", "s3", None]), i) for i in range(n)]
    rows += [(n, None, None, None, None), (n + 1, "", "aa", "s1", 0), (n + 2, " \n\t ", None, "s2", 3), (n + 3, prose(rng, 30_000), "aa", "s1", 9), (None, "a b c", "aa", None, 5)]
    rows += [rows[0], rows[0], rows[3]]
    rows += [(100 + i, rows[5][1], "aa", "s1", 1) for i in range(6)]
    return [(*r, "x", None, "y") for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_docs(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- 1


def test_mix_reaches_targets(spark, docs):
    t = mixing.mix(docs).taken.collect()
    size = {r[0]: len(WORDS.findall(r[1] or "")) for r in odd_docs()}
    assert sum(r["rows"] for r in t) == len(odd_docs())
    total = sum(r["size"] * r["rows"] for r in t)
    assert total == sum(len(WORDS.findall(r[1] or "")) for r in odd_docs())
    by = {}
    for r in t:
        assert 0 <= r["copies"] <= 3 and size[r["doc_id"]] == r["size"]
        b = by.setdefault(r["source"], [r["source_size"], r["target"], 0, 0])
        b[2] += r["copies"] * r["size"] * r["rows"]
        b[3] = max(b[3], r["size"] * r["rows"])
    names = sorted(by, key=lambda s: (s is None, s))
    w = dict(zip(names, [5, 2, 1, 5], strict=True))
    # brute-force water-filling
    cap, left, want = {s: 3 * by[s][0] for s in names}, total, {}
    while True:
        free = [s for s in names if s not in want]
        level = left / sum(w[s] for s in free)
        over = [s for s in free if w[s] * level > cap[s]]
        if not over:
            want |= {s: w[s] * level for s in free}
            break
        for s in over:
            want[s] = cap[s]
            left -= cap[s]
    for s in names:
        assert by[s][1] == pytest.approx(want[s])
        assert abs(by[s][2] - want[s]) <= 2 * max(b[3] for b in by.values())
    assert rows_of(mixing.mix(docs.repartition(5)).taken) == rows_of(mixing.mix(docs).taken)


def test_mix_takes_in_virtual_time_order(spark):
    rng = random.Random(2)
    d = spark.createDataFrame([(i, prose(rng, rng.randint(1, 9)), None, rng.choice("ab"), 0, "", "", "") for i in range(5000)], SCHEMA)
    o = mixing.mix(d).order.orderBy("total").collect()
    assert [r["finish"] for r in o] == sorted(r["finish"] for r in o)
    run = 0
    for r in o:
        run += r["size"] * r["rows"]
        assert r["total"] == run


def test_mix_stage_and_empty(docs, none):
    t = {(r["doc_id"], r["size"]): r for r in mixing.mix(docs).taken.collect()}
    got = Counter(r["doc_id"] for r in mixing.mix_documents(docs).collect())
    assert got[20] == t[20, len(WORDS.findall(odd_docs()[20][1]))]["copies"]
    assert mixing.mix_documents(docs).columns == docs.columns
    assert mixing.mix(none).taken.count() == 0 and mixing.mix_documents(none).count() == 0


# --- 2 and 7


@given(st.lists(st.sampled_from(["a", "B", "'s", "é", "é", "ß", "Σ", "İ", " ", "\n", "\x0b", "\x85", "\xa0", "1", "!", "<|", "|>", "<|endoftext|>", "漢", "ª"]), max_size=30))
@settings(max_examples=300, deadline=None)
def test_word_encoder_is_the_tokenizer(parts):
    from tokenizers import Tokenizer

    global _TOKENIZER
    _TOKENIZER = globals().get("_TOKENIZER") or Tokenizer.from_file(BPE)
    t = "".join(parts)
    got = np.frombuffer(tokens.encoder(BPE).encode([t.encode()])[0], "<u4").tolist()
    assert got == _TOKENIZER.encode(t, add_special_tokens=False).ids


def ids_of(text):
    return np.frombuffer(tokens.encoder(BPE).encode([(text or "").encode()])[0], "<u4").tolist() + [1]


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30))
@settings(max_examples=200, deadline=None)
def test_plan_covers_all_without_overlap(counts):
    p = packing.plan(counts, 64).tolist()
    used = {}
    for k, (n, first, seq, per, off) in enumerate(p):
        end = p[k + 1][1] if k + 1 < len(p) and p[k + 1][0] == n else counts[n]
        for r in range(first, end):
            used.setdefault(seq + (r - first) // per, []).append((off + (r - first) % per * n, n))
    assert sum(map(len, used.values())) == sum(counts.values())
    for x in used.values():
        at = 0
        for off, n in sorted(x):
            assert off == at
            at += n
        assert at <= 64 and sum(3 * n > 64 for _, n in x) <= 2
    assert len(used) <= 1.4 * sum(n * c for n, c in counts.items()) / 64 + 2 * sum(c for n, c in counts.items() if 3 * n > 64) / 2 + 1


def test_pack_places_every_piece(docs, none):
    got = packing.pack(docs, BPE, capacity=256).collect()
    by, seqs = {}, {}
    for r in got:
        by.setdefault((r["doc_id"], r["piece"]), []).append(np.frombuffer(r["ids"], "<u4").tolist())
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert r["length"] == len(r["ids"]) // 4 <= 256 and r["start"] == r["piece"] * 256
    for i, text in {(r[0], r[1]) for r in odd_docs()}:
        ids = ids_of(text)
        for k in range(0, len(ids), 256):
            assert ids[k : k + 256] in by[i, k // 256]
    assert len(got) == sum(-(-len(ids_of(r[1])) // 256) for r in odd_docs())
    for x in seqs.values():
        at = 0
        for off, n in sorted(x):
            assert off == at
            at += n
    assert packing.pack(none, BPE).count() == 0


def test_sequences_hold_their_pieces(docs):
    placed = packing.pack(docs, BPE, capacity=256)
    s = {r["sequence_id"]: r["ids"] for r in packing.sequences(placed).collect()}
    for r in placed.collect():
        assert s[r["sequence_id"]][4 * r["offset"] : 4 * (r["offset"] + r["length"])] == r["ids"]


def test_shards_round_trip_and_lookup(spark, docs, none):
    m = sstable.write(docs, BPE)
    got = sorted(sstable.read(spark, m).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in odd_docs()), key=lambda k: (k is not None, k))
    at = 0
    for r in got:
        assert r["start"] == at
        at += len(r["ids"]) // 4
    want = Counter((r[0], tuple(ids_of(r[1]))) for r in odd_docs())
    assert Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in got) == want
    assert [np.frombuffer(x, "<u4").tolist() for x in sstable.lookup(m, 7)] == [ids_of(odd_docs()[7][1])]
    assert len(sstable.lookup(m, 0)) == 3 and sstable.lookup(m, 10**9) == [] and len(sstable.lookup(m, None)) == 1
    assert sstable.read(spark, sstable.write(none, BPE)).count() == 0


@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-(2**40), 2**40)), st.lists(st.integers(0, 60000), max_size=50)), max_size=60))
@settings(max_examples=60, deadline=None)
def test_shard_file(entries):
    import io

    entries = sorted((sstable.encode_key(k), np.array(v, "<u4").tobytes()) for k, v in entries)
    f = io.BytesIO()
    w = sstable.ShardWriter(f)
    for k, v in entries:
        w.add(k, v)
    w.close()
    s = sstable.Shard(f, len(f.getvalue()))
    assert list(s) == entries and s.n_docs == len(entries)
    for k in {k for k, _ in entries}:
        assert s.get(k) == [v for q, v in entries if q == k]
    with pytest.raises(ValueError):
        sstable.Shard(io.BytesIO(f.getvalue()[:-3] + b"xxx"), len(f.getvalue()))


def test_blocks_are_many_and_blooms_refuse():
    import io

    f = io.BytesIO()
    w = sstable.ShardWriter(f)
    for k in range(3000):
        w.add(sstable.encode_key(2 * k), np.arange(100, dtype="<u4").tobytes())
    w.close()
    s = sstable.Shard(f, len(f.getvalue()))
    assert len(s.index) > 5
    assert sum(s.may_hold(sstable.encode_key(2 * k + 1)) for k in range(3000)) < 90
    assert s.get(sstable.encode_key(3000)) and not s.get(sstable.encode_key(3001))


# --- 5


def brute_measure(text):
    text = text or ""
    w = WORDS.findall(text)
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = {j for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(hit)


@given(st.lists(st.sampled_from(["a", "b", "é#", " ", " ", "\n", "\x0b", "\xa0", " ", "| "]), max_size=80).map("".join))
@settings(max_examples=300, deadline=None)
def test_measure_is_brute_force(text):
    assert profile.measure(text.encode())[:5] == brute_measure(text)


def test_rules_judge_by_group(spark, docs, none):
    rng = random.Random(3)
    rows = [(i, prose(rng, 60, "abcdefghij"), "aa", "s1", 0, "", "", "") for i in range(300)]
    rows += [(1000 + i, " ".join(w + "###" for w in prose(rng, 60).split()), "aa", "s1", 0, "", "", "") for i in range(20)]
    rows += [(2000 + i, " ".join(w + "###" for w in prose(rng, 60).split()), "bb", "s2", 0, "", "", "") for i in range(300)]
    rows += [(3000, "short text", "aa", "s1", 0, "", "", ""), (3001, "la la " * 50, "aa", "s1", 0, "", "", ""), (3002, None, None, None, 0, "", "", "")]
    kept = {r["doc_id"] for r in quality_rules.filter_documents(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert kept >= set(range(300)) and not kept & set(range(1000, 1020))
    assert kept >= set(range(2000, 2300))  # what is usual in its language and source stays
    assert not kept & {3000, 3001, 3002}
    out = quality_rules.filter_documents(docs)
    assert out.columns == docs.columns and quality_rules.filter_documents(none).count() == 0


def test_sketch_quantiles_are_near_and_mergeable(spark):
    v = [int(x) for x in np.random.default_rng(4).lognormal(5, 1, 5000)]
    s = spark.createDataFrame([(x, "m", k % 3) for k, x in enumerate(v)], "v long, measure string, g int")
    sk = s.groupBy("g", "measure", quality_rules.bin_of("v").alias("bin")).agg(F.count("*").alias("n"))
    r = quality_rules.quantiles(sk, ["measure"]).first()
    v.sort()
    for p, got in ((25, r["q25"]), (75, r["q75"])):
        true = v[-(-len(v) * p // 100) - 1]
        assert true * 15 / 16 <= got <= true
    assert r["docs"] == 5000


# --- 8


def test_forward_sums_all_segmentations():
    vocab = ["▁a", "ab", "b", "a", "▁ab", "c", "▁", "bc"]
    m = language_id.fit_counts({"x": {"▁abc": 5, "▁ab": 2}, "y": {"▁cba": 3, "é": 1}}, vocab)
    at = {p: i for i, p in enumerate(vocab)}

    def brute(w, k):
        if not w:
            return 1.0
        return sum(m.prob[at.get(w[:n], len(vocab) if n == 1 else 0), k] * brute(w[n:], k) for n in range(1, len(w) + 1) if w[:n] in at or n == 1)

    for w in ("▁abc", "▁ab", "▁zé", "c", "▁bcab"):
        assert m.log_prob([w])[0] == pytest.approx([np.log(brute(w, k)) for k in range(2)])
    assert np.allclose(m.prob.sum(axis=0), 1)


def test_language_held_out_and_odd_texts(spark, docs, none):
    rng = random.Random(5)
    rows = [(i, prose(rng, 40, "abcde" if i % 2 else "mnopq"), "xx" if i % 2 else "yy", None, 0, "", "", "") for i in range(400)]
    rows += [(900, None, None, None, 0, "", "", ""), (901, "", "xx", None, 0, "", "", ""), (902, "12 !! 7", "xx", None, 0, "", "", ""), (903, "Abc" * 5000, None, None, 0, "", "", "")]
    d = spark.createDataFrame(rows, SCHEMA)
    p = vocabulary_path("piece_bpe_32k.model")
    model = language_id.fit(d.where("doc_id % 5 <> 0"), p)
    got = {r["doc_id"]: r for r in language_id.with_language(d, model).collect()}
    assert all(got[i]["lang_pred"] == ("xx" if i % 2 else "yy") for i in range(400))
    assert [got[i]["lang_pred"] for i in (900, 901, 902)] == ["und"] * 3 and got[903]["lang_pred"] == "xx"
    assert all(0 <= r["lang_score"] <= 1 for r in got.values())
    assert language_id.fit(none, p) is None
    assert {r["lang_pred"] for r in language_id.with_language(docs, None).collect()} == {"und"}
    kept = language_id.filter_documents(d, p)
    assert kept.columns == d.columns and kept.count() == 401


# --- 10


def brute_groups(rows, words, percent=80):
    sets = []
    for i, t in rows:
        w = [x for x in re.split(rb"[ \t-\r]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())) if x]
        sets.append((i, frozenset(tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))) if w else frozenset()))
    group = list(range(len(sets)))

    def top(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = top(a), top(b)
                group[max(p, q)] = min(p, q)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    return sorted(((i, len(s), least.get(top(k)), i == least.get(top(k))) for k, (i, s) in enumerate(sets)), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_are_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(r[0], r[1]) for r in odd_docs(seed)]
    for base in range(5):
        words = prose(rng, 80, "abcdefghijklm").split()
        for k in range(rng.choice([2, 5, 30])):
            w = words.copy()
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = "new%d" % rng.randrange(9)
            rows.append((1000 + 100 * base + k, (" " if k % 3 else "\n").join(w).title() if k % 2 else " ".join(w)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(near_dedup.near_duplicates(df, words=4)) == brute_groups(rows, 4)


def test_links_in_a_crowd_are_all_found(spark):
    """Texts on one template, 79 % alike, and among them pairs that are 81 % alike."""
    rng = random.Random(7)
    template, rows = prose(rng, 63).split(), []
    for k in range(1500):
        own = ["k%d_%d" % (k, x) for x in range(8)]
        rows.append((k, " ".join(template + own)))
        if k < 60:
            rows.append((10_000 + k, " ".join(template + own[:1] + ["m%d_%d" % (k, x) for x in range(7)])))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(near_dedup.near_duplicates(df, words=4)) == sorted(((i, 68, i % 10_000, i < 10_000) for i, _ in rows), key=repr)


@pytest.mark.parametrize("sides", [False, True])
def test_links_between_are_brute_force(sides):
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 40, 30)).astype(np.uint64) for _ in range(60)]
    label, side = rng.integers(0, 9, 60), rng.integers(0, 2, 60) if sides else None
    mine, true = label.copy(), label.copy()
    for i, j in near_dedup.links_between(sets, label, side, 55):
        mine[mine == mine[i]] = mine[j]
    for i in range(60):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 55 * (len(sets[i]) + len(sets[j]) - both) and (not sides or side[i] != side[j]):
                true[true == true[i]] = true[j]
    assert len(set(true)) < len(set(label)) and all((mine[i] == mine[j]) == (true[i] == true[j]) for i in range(60) for j in range(i))


def test_one_row_of_each_group(docs, none):
    out = near_dedup.one_of_each(docs)
    ids = [r["doc_id"] for r in out.select("doc_id").collect()]
    assert out.columns == docs.columns and ids.count(0) == 1 and ids.count(5) == 1 and not [i for i in ids if i and i >= 100]
    assert near_dedup.one_of_each(none).count() == 0 and near_dedup.near_duplicates(none).count() == 0


def test_components_of_a_chain(spark):
    rng = random.Random(6)
    n = list(range(200))
    rng.shuffle(n)
    links = [(n[i], n[i + 1]) for i in range(150)] + [(n[160], n[161])]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["label"] for r in components.connected(df, few=0).collect()}
    assert {got[x] for x in n[:151]} == {min(n[:151])} and got[n[161]] == min(n[160:162]) and len(got) == 153
    assert {r["node"]: r["label"] for r in components.connected(df).collect()} == got


# --- 3 and 9


def test_gam_learns_steps_and_an_interaction():
    rng = np.random.default_rng(7)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = gam.fit(x[:3000], y[:3000])
    assert ((m.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9
    assert (0, 1) in m.pairs


def test_quality_scores(spark, docs, none):
    rng = random.Random(8)
    rows = [(i, prose(rng, 60) if i % 2 else prose(rng, 60).upper().replace(" ", " %%% "), None, None, 0, "", "", "") for i in range(400)]
    d = spark.createDataFrame(rows + [(900, None, None, None, 0, "", "", "")], SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(5, 1), (None, 1), (6, None)], "doc_id long, quality int")
    m = quality_classifier.fit(d, labels)
    got = {r["doc_id"]: r["score"] for r in quality_classifier.with_score(d, m).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(got[i] >= 0.7) == i % 2 for i in held]) > 0.95 and 0 <= got[900] <= 1
    assert quality_classifier.fit(none, labels) is None
    assert {r["score"] for r in quality_classifier.with_score(docs, None).collect()} == {0.5}
    assert quality_classifier.with_score(none, m).count() == 0


def test_toxic_words_are_found(spark, docs, none):
    rng = random.Random(9)
    rows = [(i, prose(rng, 60) + (" you " + rng.choice(["badword", "Ugly,", "badstemmed"]) if i % 5 == 0 else ""), None, None, 0, "", "", "") for i in range(600)]
    d = spark.createDataFrame(rows + [(900, None, None, None, 0, "", "", "")], SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 7 > 0), int(i % 5 == 0)) for i in range(600)], "doc_id long, quality int, toxic int")
    m = toxicity.fit(d, labels)
    got = {r["doc_id"]: r["is_toxic"] for r in toxicity.with_toxicity(d, m).collect()}
    assert all(got[i] == (i % 5 == 0) for i in range(600)) and got[900] is False
    assert len(m.weights[1]) == len(m.weights[0]) + 1  # the second link sees the first
    assert toxicity.fit(none, labels) is None
    assert not any(r["is_toxic"] for r in toxicity.with_toxicity(docs, None).collect())


# --- 4


def test_chats_are_the_sql(spark):
    rng = random.Random(10)
    rows = []
    for c in range(60):
        base = [("user" if k % 2 == 0 else "assistant", f"turn {k} {rng.choice('ab')}") for k in range(rng.randint(1, 6))]
        rows += [(c, k, r, t) for k, (r, t) in enumerate(base)]
    rows += [(500, k, "user", f"x{k}") for k in range(400)] + [(501, k, "user", f"x{k}") for k in range(130)] + [(502, k, "user", f"x{k}") for k in range(400)]
    rows += [(600, 0, None, None), (601, 0, "unknown", ""), (602, None, "user", "q"), (603, 5, "user", "q"), (604, 1, "user", "same"), (604, 1, "user", "same"), (605, 1, "user", "b"), (605, 1, "user", "a"), (None, 0, "user", "lost")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("position", F.lit(1))
    c = duckdb.connect()
    conversations = df.toPandas()  # noqa: F841
    conversations["conv_id"], conversations["turn"] = conversations["conv_id"].astype("Int64"), conversations["turn"].astype("Int64")
    c.register("conversations", conversations)
    want = c.sql(chat.SQL.replace("USING (conv_id) WHERE", "ON v.conv_id IS NOT DISTINCT FROM p.conv_id WHERE").replace("FROM p WHERE conv_id IN (SELECT conv_id FROM m)", "FROM p WHERE EXISTS (SELECT 1 FROM m WHERE m.conv_id IS NOT DISTINCT FROM p.conv_id)")).fetchall()
    got = [tuple(r) for r in chat.format_chats(df).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sorted(r[1] for r in got if r[0] == 500) == list(range(7)) and not [r for r in got if r[0] in (501, 502)]
    assert chat.format_chats(df.limit(0)).count() == 0


# --- 6


def test_search_is_brute_force(spark, docs, none):
    rng = random.Random(11)
    common = [prose(rng, 1) for _ in range(20)]
    rows = [(i, " ".join(rng.choice(common) if rng.random() < 0.6 else prose(rng, 1, "abcdefghij") for _ in range(rng.randint(5, 120)))) for i in range(700)]
    rows += [(800 + i, rows[100][1]) for i in range(15)] + [(900, None), (None, rows[100][1]), (1000, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {}
    for r in bm25.search_rows(df, F.col("doc_id") % 100 == 0, k=10).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["doc_id"], r["score"]))
    tf = [(i, bm25.terms_of(t)) for i, t in rows]
    n, mean = len(rows), sum(t.total() for _, t in tf) / len(rows)
    df_ = Counter(w for _, t in tf for w in t)
    for i, q in tf:
        if i is None or i % 100:
            continue
        want = []
        for j, t in tf:
            s = sum(k * np.log(1 + (n - df_[w] + 0.5) / (df_[w] + 0.5)) * t[w] * (bm25.K1 + 1) / (t[w] + bm25.K1 * (1 - bm25.B + bm25.B * t.total() / mean)) for w, k in q.items() if w in t)
            if s > 0:
                want.append((-round(s, 6), j is not None, j))
        want = sorted(want, key=lambda x: (x[0], x[1], x[2] or 0))[:10]
        assert [g[0] for g in got.get(i, [])] == [x[2] for x in want]
        assert np.allclose([g[1] for g in got.get(i, [])], [-x[0] for x in want], atol=1e-5)
    assert bm25.search_rows(none, F.col("doc_id") % 100 == 0).count() == 0
    assert bm25.search_rows(docs, F.col("doc_id") == 20, k=3).count() == 3


def test_pruning_scores_fewer_documents():
    rng = random.Random(12)
    texts = [prose(rng, 50, "abcd") for _ in range(3000)] + ["needle in hay " + prose(rng, 5, "abcd")] * 3
    numbers = bm25._Numbers()
    at = [np.array([numbers[w] for w in bm25.TERM.findall(t)], np.int32) for t in texts]
    row = {k: v[0] for k, v in bm25.shard_of(list(range(len(texts))), at, numbers).items()}
    s = bm25.Searcher(row, 50.0)
    got = s.answer([["ab", "hay", "needle"]], [np.array([0.2, 7.0, 7.0])], 3)
    assert [g[0] for g in got[0]] == [3000, 3001, 3002] and s.scored < 300


# --- the pipeline and the registered queries


def test_pipeline_is_its_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    seen = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen, DIR)
        assert out.columns == docs.columns
        ids = [r[0] for r in out.select("doc_id").collect()]
        assert set(ids) <= {r[0] for r in seen.select("doc_id").collect()}
        seen = out
    packed = corpus_pipeline.run(spark, DIR)
    got = Counter(r["doc_id"] for r in packed.where("piece = 0").collect())
    assert got == Counter(ids)


def test_pipeline_of_odd_documents(spark, docs, none, tmp_path):
    import corpus_pipeline

    for k, d in enumerate((docs, none)):
        d.write.parquet(f"{tmp_path}/{k}/documents.parquet")
        corpus_pipeline.run(spark, f"{tmp_path}/{k}").collect()


@pytest.mark.parametrize("name", sorted(SQL))
def test_registered_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    want = c.sql(SQL[name])
    df = QUERIES[name](spark, DIR).select(want.columns)
    assert rows_of(df) == sorted(want.fetchall(), key=repr)
