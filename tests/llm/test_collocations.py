"""Operator 13 against plain counts."""

import re
from collections import Counter

import numpy as np
import pytest

from tarmac.llm import collocations, common, phrase_index
from tarmac.llm.phrase_index import PIECE, RARE

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ASCII_LOWER))]


def plain(docs, least=10, top=2000):
    f, n, left, right = Counter(), Counter(), Counter(), Counter()
    for text, lang in docs:
        lang = lang or "und"
        for w in pieces(text):
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    key = lang, *w[i:i + k]
                    f[key] += 1
                    left[key] += i > 0
                    right[key] += i + k < len(w)
    candidates = {k: a for k, a in f.items() if len(k) > 2 and a >= least}
    gone = {(k[0], *k[i:i + 2]) for k, a in candidates.items() if len(k) == 4 for i in (1, 2) if 100 * a >= 50 * f[k[0], *k[i:i + 2]]}
    out = []
    for k, a in candidates.items():
        if k not in gone:
            cuts = [(1_000_000 * a * a // (f[k[:c]] * f[k[0], *k[c:]]), c) for c in range(2, len(k))]
            score, c = min(cuts)
            out.append((k[0], -score, -a, " ".join(k[1:]).encode(), f[k[:c]], f[k[0], *k[c:]], left[k], right[k]))
    rows, rank = [], Counter()
    for lang, score, a, phrase, x, y, nl, nr in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            rows.append((lang, rank[lang], phrase.decode(), -a, x, y, n[lang], -score, nl, nr))
    return rows


def corpus(n, seed=5):
    rng = np.random.default_rng(seed)
    share = 1 / np.arange(1, 81)
    words = [f"W{i}" if i % 7 else f"é{i}\x1c" for i in range(80)]
    marks = [" ", "  ", "\t", " ", " ", ". ", ",", "\r\n", "!?"]
    out = []
    for i in range(n):
        w = rng.choice(80, size=rng.integers(0, 90), p=share / share.sum())
        out.append(("".join(words[j] + marks[rng.integers(len(marks))] for j in w) + " New York City" * (i % 3), ["en", "de", None][i % 5 % 3]))
    return out + [(None, "en"), ("", None), (" \t ,", "fr"), ("only. singles! here", "fr")] + [("the same text again and again", "es")] * 12


def test_index_counts_and_open_ends():
    text = np.concatenate([np.random.default_rng(1).integers(0, 9, 3000), [PIECE]])

    def want(k, used=lambda a, b: True):
        out = {}
        for i in range(len(text) - k):
            key = tuple(text[i:i + k].tolist())
            if min(key) > RARE and all(used(a, b) for a, b in zip(key, key[1:])):
                c = out.setdefault(key, [0, 0, 0])
                c[0] += 1
                c[1] += i > 0 and text[i - 1] != PIECE
                c[2] += text[i + k] != PIECE
        return out

    got = lambda k, found: {tuple(map(int, x[:k])): list(map(int, x[k:])) for x in zip(*found)}
    odd = lambda a, b: (a * b) % 3 != 1
    assert got(2, phrase_index.pairs(text)) == want(2)
    assert got(3, phrase_index.triples(text, lambda a, b: a > 0)) == want(3)
    assert got(3, phrase_index.triples(text, odd)) == want(3, odd)
    for empty in (np.zeros(1, int), np.array([RARE, PIECE])):
        assert not len(phrase_index.pairs(empty)[0]) and not len(phrase_index.triples(empty, odd)[0])


@pytest.mark.parametrize("shard_words,bits", [(1_000_000, 26), (700, 8), (50, 3)])
def test_collocations(spark, shard_words, bits):
    common.shipped(spark)
    docs = corpus(400)
    df = spark.createDataFrame(docs, "text string, lang string").selectExpr("*", "1 AS n", "2 AS phrase").repartition(3)
    got = collocations.collocations(df, shard_words=shard_words, filter_bits=bits)
    assert sorted(map(tuple, got.collect())) == sorted(plain(docs))


def test_first_of_each_in_rounds(spark):
    rows = [("ab"[i % 10 == 0], f"p{i * 7919 % 3000}", i % 50, i % 4) for i in range(3000)]
    got = collocations.first_of_each(spark.createDataFrame(rows, "lang string, phrase string, score long, a long"), 40, share_rows=100)
    want = [(*r, i) for x in "ab" for i, r in enumerate(sorted((r for r in rows if r[0] == x), key=lambda r: (-r[2], -r[3], r[1]))[:40], 1)]
    assert sorted(tuple(r[c] for c in ("lang", "phrase", "score", "a", "rank")) for r in got.collect()) == sorted(want)


def test_scores_beyond_64_bits(spark):
    rows = [(10, 10, 10), (3_000_000_007, 3_000_000_019, 9_000_000_011), (10**15 + 1, 10**15 + 3, 10**15 + 7), (12, 999_983, 10**14)]
    df = spark.createDataFrame(rows, "a long, l long, r long").select("a", "l", "r", collocations._score("a", "l", "r").alias("s"))
    assert all(r.s == 1_000_000 * r.a * r.a // (r.l * r.r) for r in df.collect())
