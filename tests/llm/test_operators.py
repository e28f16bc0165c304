"""Operators against brute force, round trips and held-out accuracy."""

import hashlib
import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tarmac.llm import chat_events, common, curriculum, fm_dedup, itq_dedup, jaccard_join, lang_backoff, lbl_score, mil_toxicity, token_binary, winnowing
from tarmac.llm.fm_index import FMIndex
from tests.conftest import SF_SMALL
from tests.llm.test_queries import DOCUMENTS, tables

SF = "/root/testdata/sf0.01"


def duck(sql, folder=SF_SMALL):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con.execute(sql).fetchall()


def by_text(rows):
    return sorted(map(tuple, rows), key=str)


# 1
@pytest.mark.parametrize("dim, noise, block", [(64, 0.035, 4096), (64, 0.035, 8), (8, 0.12, 4096)])
def test_itq_recall(spark, dim, noise, block):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(200, dim)) / np.sqrt(dim)
    near = [(i * 10 + j, 5, (b + rng.normal(0, noise, dim)).tolist()) for i, b in enumerate(base) for j in range(5)]
    d = spark.createDataFrame(near, "vec_id long, kept int, embedding array<double>").repartition(3)
    rows = itq_dedup.near_duplicates(d, block=block).orderBy("vec_id").collect()
    x = itq_dedup.unit([v for _, _, v in near])
    links = (x @ x.T >= 0.9).sum(1) - 1
    found = np.array([r.n_links for r in rows])
    assert links.sum() > 100 and (found <= links).all() and found.sum() >= 0.9 * links.sum()
    assert rows[0].asDict().keys() == {"vec_id", "embedding", "n_links", "component_id", "kept"} and isinstance(rows[0].kept, bool)


@pytest.mark.parametrize("dim", [64, 128])
def test_itq_recall_at_the_threshold_with_a_common_mean(spark, dim):
    """Pairs at cosine 0.90-0.92 among vectors that share a mean (median cosine 0.5)."""
    rng = np.random.default_rng(3)
    mean = rng.normal(size=dim)
    mean /= np.sqrt(mean @ mean)
    a = itq_dedup.unit(rng.normal(size=(4000, dim)))
    a = itq_dedup.unit(a + mean)
    other = rng.normal(size=a.shape)
    other = itq_dedup.unit(other - (other * a).sum(1, keepdims=True) * a)
    c = rng.uniform(0.901, 0.92, (len(a), 1))
    x = np.concatenate([a, c * a + np.sqrt(1 - c * c) * other])
    assert 0.4 < np.median(a[:500] @ a[500:1000].T) < 0.6
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    found = np.array([r.n_links for r in itq_dedup.near_duplicates(d).orderBy("vec_id").collect()])
    links = (x @ x.T >= 0.9).sum(1) - 1
    print("recall", found.sum() / links.sum())
    assert links.sum() >= 8000 and (found <= links).all() and found.sum() >= 0.97 * links.sum()


# 2
def test_winnowing_keeps_columns_and_reports_spans(spark, scratch):
    tables(scratch)
    d = spark.read.parquet(f"{scratch}/documents.parquet")
    out = winnowing.decontaminate(d, spark.read.parquet(f"{scratch}/benchmark.parquet")).where("doc_id = 9").first()
    assert out.key == 7 and out["_row"] == 7 and [(s.start, s.len) for s in out.spans] == [(1, 24)] and out["items"] == ["", "1", "2"]
    assert out.n_hit == 24 and out.contaminated


# 3
def test_fm_index_against_brute_force():
    rng = np.random.default_rng(0)
    for trial in range(8):
        segments = [rng.integers(1, 3 if trial % 2 else 6, rng.integers(20, 60)) for _ in range(30)]
        base = rng.integers(1, 200, 200)
        segments += [base[i:i + rng.integers(20, 50)] for i in rng.integers(0, 150, 20)]
        index = FMIndex(np.concatenate(segments), np.array([len(s) for s in segments]), 20)
        streams = segments + [rng.integers(1, 3, 60), np.concatenate([base[10:45], [999], base[60:90]]), base[:15]]
        lo, hi = index.search(np.concatenate(streams), np.array([len(s) for s in streams]))
        count = Counter(tuple(s[i:i + 20]) for s in segments for i in range(len(s) - 19))
        want = [count[tuple(s[i:i + 20])] if i + 20 <= len(s) else 0 for s in streams for i in range(len(s))]
        assert (hi - lo).tolist() == want


def test_substring_dedup_with_small_batches_and_hot_hashes(spark, scratch):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(5)
    want = by_text(duck(fm_dedup.OP3_SQL))
    for hot in (1, 1000):
        out = fm_dedup.deduplicate(d, 20_000, hot)
        assert by_text(out.drop("spans").collect()) == want
    long = out.where("n_removed > 0").first()
    words = d.where(F.col("doc_id") == long.doc_id).first().text.encode().split()
    kept = [w for i, w in enumerate(words) if not any(s.start <= i < s.start + s.length for s in long.spans)]
    assert hashlib.sha256(b" ".join(kept)).hexdigest() == long.kept_sha256


# 4
def test_divide_skip_against_all_pairs():
    rng = np.random.default_rng(1)
    base = [np.unique(rng.integers(0, 4000, 60)).astype(np.uint64) for _ in range(8)]
    sets = [np.unique(np.concatenate([b[rng.random(len(b)) > 0.06], rng.integers(0, 4000, 3).astype(np.uint64)])) for b in base for _ in range(6)]

    def groups(pairs, n):
        g = list(range(n))
        for a, b in pairs:
            g = [g[b] if x == g[a] else x for x in g]
        return [g.index(x) for x in g]

    linked = [(i, j) for i in range(len(sets)) for j in range(i)
              if 100 * len(both := np.intersect1d(sets[i], sets[j])) >= 85 * (len(sets[i]) + len(sets[j]) - len(both))]
    assert linked and groups(jaccard_join.divide_skip(sets, None, 85, 100), len(sets)) == groups(linked, len(sets))
    half = len(sets) // 2
    cross = [(half + q, i) for q, i in jaccard_join.divide_skip(sets[:half], sets[half:], 85, 100)]
    assert groups(cross, len(sets)) == groups([(i, j) for i, j in linked if i >= half > j], len(sets))


def test_jaccard_join_with_small_batches_and_blocks(spark):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(5)
    want = by_text(duck(jaccard_join.OP4_SQL))
    assert by_text(jaccard_join.join(d, batch_chars=20_000, block=1_500).drop("key", "group").collect()) == want


# 5
def test_base_score_and_normalisation(spark):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    held = common.fold(F.col("doc_id"), 5) == 1
    model = lbl_score.fit(d.where(~held))
    rows = lbl_score.score(d.withColumn("held_out", held), model).collect()
    texts = {r.doc_id: lbl_score.tokens(r.text) + [b""] for r in d.collect()}
    count = Counter(w for i, t in texts.items() if zlib.crc32(str(i).encode()) % 5 != 1 for w in t)
    n, v = sum(count.values()), len(count)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1) and r.train_tokens == n
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in texts[r.doc_id]), rel_tol=1e-9)
        assert (r.n_tokens, r.n_known) == (len(texts[r.doc_id]), sum(count[w] > 0 for w in texts[r.doc_id]))
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    vocabulary, network, _ = model
    scorer = lbl_score.Scorer(vocabulary, network.noise, network.dim, network.flat())
    context = scorer.a1[vocabulary.rank[b"of"]] + scorer.a2[vocabulary.rank[b"the"]]
    scorer("the of and")  # meets the context (the, of)
    p = np.exp(context - scorer.log_z[vocabulary.rank[b"of"] * scorer.classes + vocabulary.rank[b"the"]])
    assert math.isclose(p.sum(), 1, rel_tol=1e-6)
    inside = sum(10 ** scorer.base[i] for i in range(vocabulary.classes, len(vocabulary.counts)))
    assert len(vocabulary.counts) == v + 1  # all tokens are in the head here; one share is of unseen ones
    assert math.isclose(inside + 0.5 / (n + 0.5 * (v + 1)), 10 ** scorer.rest, rel_tol=1e-6)


# 6
def test_token_round_trip_and_single_documents(spark, scratch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    texts = [t for _, t, _ in DOCUMENTS] + ["x<|endoftext|>.y. <|startoftext|> a", "Σας ΣΑΣ. İ: ǵȱİ: É", "it's IT'S!! a.b,c;;", "日本語。 \u0085x", "क़. ﬁ́."]
    texts += [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    token_binary.write_tokens(d, f"{scratch}/t", path)
    rows = token_binary.read_tokens(spark, f"{scratch}/t").orderBy("start").collect()
    start = 0
    for i, (t, r) in enumerate(zip(texts, rows, strict=True)):
        want = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        assert (r.doc_id, r.start, r.n_tokens, r.ids, r.ids_crc32) == (i, start, len(want), want, zlib.crc32(np.array(want, "<u4").tobytes()))
        start += len(want)
    assert [x.tolist() for x in token_binary.read_document(spark, f"{scratch}/t", 5)] == [rows[5].ids]
    token_binary.write_tokens(d.withColumn("by", -F.col("doc_id")), f"{scratch}/u", path, order=["by"])
    assert [r.doc_id for r in token_binary.read_tokens(spark, f"{scratch}/u", with_ids=False).orderBy("start").collect()] == list(range(len(texts)))[::-1]


# 7
def test_fold_of_edits_and_regenerations(spark):
    log = [(1, 1, "append", 1, "user", "he"), (1, 2, "append", 1, "user", "llo"), (1, 3, "append", 2, "assistant", "bad"), (1, 4, "append", 3, "user", "?"),
           (1, 5, "regenerate", 2, None, None), (1, 6, "append", 2, "assistant", "go"), (1, 7, "append", 2, "assistant", "od"), (1, 8, "edit", 1, "user", "HELLO"),
           (1, 9, "append", 1, "user", "!"), (2, 1, "append", 1, "user", None), (2, 2, "note", 1, "x", "ignored"), (None, 1, "edit", 9, "system", "s")]
    events = spark.createDataFrame(log, "conv_id long, seq long, op string, msg long, role string, text string").repartition(4)
    got = sorted(((r.conv_id or 0, r.msg, r.role, r.text) for r in chat_events.fold(events).collect()))
    assert got == [(0, 9, "system", "s"), (1, 1, "user", "HELLO!"), (1, 2, "assistant", "good"), (2, 1, "user", "")]
    for text in ["</s>[INST] ok", "\\", "\\\\<|x|>", "<<s>>", "[/INST][INST", "<</SYS>>\n"]:
        row = spark.range(1).select(chat_events.escape(F.lit(text)).alias("e")).first()
        assert chat_events.unescape(row.e) == text and not any(c in row.e for c in chat_events.CONTROLS)


# 8
def test_language_of_held_out_documents(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    held = common.fold(F.col("doc_id"), 5) == 0
    model = lang_backoff.fit(d.where(~held))
    rows = lang_backoff.predict(d.where(held), model).collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows) and all(0 <= r.score <= 1 for r in rows)
    odd = spark.createDataFrame([(t,) for t in (None, "", "123 ... _ 4", "zzzqqq")], "text string")
    assert [r.lang_pred for r in lang_backoff.predict(odd, model).collect()][:3] == ["und"] * 3
    assert model.predict("the") [0] == "en" and model.places("ththth")


def test_language_words_outside_the_head_are_known(spark):
    """A small head in the tasks gives what the whole table gives: learnt words are never scored as unseen."""
    texts = [("haus baum wald feld " * 5 + "zug", "de"), ("house tree wood field " * 5 + "zug train", "en"), ("casa arbol bosque campo", "es"), ("zug zug baum", "de")]
    train = spark.createDataFrame(texts, "text string, lang string")
    d = spark.createDataFrame([(t,) for t, _ in texts] + [("train wood zzz",), ("zug zzz qqq",), (None,), ("",)], "text string").repartition(2)
    got = {}
    for most in (150_000, 3, 0):
        model = lang_backoff.fit(train, max_words=most)
        got[most] = {r.text: (r.lang_pred, round(r.score, 9)) for r in lang_backoff.predict(d, model).collect()}
    assert len(got[0]) == 8 and got[3] == got[150_000] == got[0]
    total, n = Counter(), Counter()
    for t, lang in texts:
        total[lang] += len(t.split())
        n.update((lang, w) for w in t.split())
    logs = [sum(math.log((n[lang, w] + 0.5) / (total[lang] + 1)) for w in texts[1][0].split()) for lang in ("de", "en", "es")]
    want = 1 / sum(math.exp(x - max(logs)) for x in logs)
    assert got[0][texts[1][0]] == ("en", round(want, 9)) and got[0][None] == ("und", 0)


# 9
def test_curriculum_order_and_shares(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").withColumn("size", F.lit("replaced")).withColumn("other", F.lit(1))
    mix = curriculum.curriculum(d)
    rows = mix.withColumn("part", F.spark_partition_id()).collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows) and all(0 <= r.position < 1 for r in rows)
    assert all(isinstance(r.size, int) and r.other == 1 for r in rows)
    taken = curriculum.assign_positions(d).groupBy("source").agg(F.sum("taken").alias("n"), F.first("target").alias("t"), F.max("size").alias("m")).collect()
    assert all(abs(r.n - r.t) <= r.m / 2 + 1 for r in taken)
    falling = sorted({r.source for r in rows})[0]  # weight 3, from 4.5 down to 1.5
    early = [r.size for r in rows if r.source == falling and r.position < 0.5]
    late = [r.size for r in rows if r.source == falling and r.position >= 0.5]
    assert sum(early) > 1.2 * sum(late)


# 10
def test_toxicity_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    d = spark.read.parquet(f"{sf}/documents.parquet")
    model = mil_toxicity.fit_on_folds(spark, sf, d)
    labels = spark.read.parquet(f"{sf}/labels.parquet").where(common.fold(F.col("doc_id"), 4) == 2)
    rows = mil_toxicity.score(d.select("doc_id", "text"), model).join(labels, "doc_id").collect()
    toxic, clean = [r.predicted for r in rows if r.toxic], [r.predicted for r in rows if not r.toxic]
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.02 and all(0 <= r.score <= 1 for r in rows)
    text = "The of and. What an idiot and moron and loser and scum you are! Of the."
    s = mil_toxicity.score(spark.createDataFrame([(text, "x")], "text string, score string"), model).first()
    assert s.predicted == 1 and [text[o.start:o.start + o.length].split()[0] for o in s.offending] == ["What"]


@pytest.mark.parametrize("label", [0, 1])
def test_toxicity_of_one_class(spark, label):
    d = spark.createDataFrame([(1, "a b."), (2, None)], "doc_id long, text string")
    model = mil_toxicity.fit(d, spark.createDataFrame([(1, label), (2, label)], "doc_id long, toxic int"))
    assert [r.predicted for r in mil_toxicity.score(d, model).collect()] == [label, label]


def test_connected_components_of_long_chains_and_stars(spark):
    rng = np.random.default_rng(2)
    edges = [(i, i + 1) for i in range(100, 400)] + [(7, i) for i in range(1000, 1500)] + [(int(a), int(b)) for a, b in rng.integers(5000, 5400, (300, 2))] + [(3, 3), (None, 4)]
    got = {r.node: r.component for r in common.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    parent = {}
    for a, b in edges:
        if a is not None and a != b:
            for x in (a, b):
                parent.setdefault(x, x)
    for _ in range(400):
        for a, b in edges:
            if a in parent and b in parent and a != b:
                m = min(parent[a], parent[b])
                parent[a] = parent[b] = m
    assert got == parent
