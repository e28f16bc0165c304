"""Operator 11 against scoring every document."""

import math
from collections import Counter

import numpy as np
import pytest

from tarmac.llm import common, fp_tree


def corpus(n, vocabulary, seed):
    rng = np.random.default_rng(seed)
    share = 1 / np.arange(1, vocabulary + 1)
    words = [f"t{i}" for i in range(vocabulary)]
    return [[words[j] for j in rng.choice(vocabulary, size=rng.integers(1, 60), p=share / share.sum())] for _ in range(n)]


def plain(docs, items, top=20):
    """docs: (id, terms); items: lists of terms."""
    docs = [(i, t) for i, t in docs if t]
    n, total, df = len(docs), sum(len(t) for _, t in docs), Counter(x for _, t in docs for x in set(t))
    out = []
    for item in items:
        scored = []
        for i, t in docs:
            m, tf = 75 + 25 * len(t) * n // total, Counter(t)
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * (1_000_000_000 * tf[x] // (1000 * tf[x] + 12 * m)) for x in item if tf[x])
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out.append([(None if null else i, -s) for s, null, i in sorted(scored)[:top]])
    return out


def test_levels_bound_every_count():
    tf = np.array([0, 1, 126, 127, 128, 129, 1000, 2**31 - 1])
    assert (fp_tree.LEVELS[np.searchsorted(fp_tree.LEVELS, tf)] >= tf).all() and len(fp_tree.LEVELS) == 256


@pytest.mark.parametrize("trees", [1, 3])
def test_branch_and_bound_is_exact_and_prunes(trees):
    docs = corpus(900, 400, 1)
    docs[5] = ["t7"] * 1000 + docs[5]
    items = corpus(12, 400, 2)
    n, total = len(docs), sum(map(len, docs))
    df = Counter(x for t in docs for x in set(t))
    order = {x: r for r, x in enumerate(sorted(df, key=lambda x: -df[x]))}
    want, scored = plain(list(enumerate(docs)), items), 0
    for item, w in zip(items, want):
        q = Counter(x for x in item if x in order)
        query = np.array([order[x] for x in q])
        weight = np.array([k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) for x, k in q.items()])
        best = np.zeros((0, 2), np.int64)
        for part in np.array_split(np.arange(n), trees):
            vectors = [sorted((order[x], k) for x, k in Counter(docs[i]).items()) for i in part]
            tree = fp_tree.Tree(np.cumsum([0, *map(len, vectors)]), np.array([r for v in vectors for r, _ in v]), np.array([k for v in vectors for _, k in v]),
                                np.array([75 + 25 * len(docs[i]) * n // total for i in part]), len(order))
            assert len(tree.children) < len(part)
            best, some = tree.search(query, weight, part, best)
            scored += some
        assert [(i, s) for s, i in best.tolist()] == w
    assert scored < 0.75 * len(items) * n


@pytest.mark.parametrize("block_terms,cells", [(20_000, 1 << 25), (30, 1 << 14)])
def test_search_in_blocks(spark, monkeypatch, block_terms, cells):
    monkeypatch.setattr(fp_tree, "TREE_CELLS", cells)
    common.shipped(spark)
    texts = [" ".join(t) for t in corpus(300, 150, 3)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7]), (None, texts[7]), (400, None), (401, ""), (402, "?! -"), (403, texts[8].upper().replace(" ", "-")), (404, texts[9] * 50)]
    items = [(i, " ".join(t)) for i, t in enumerate(corpus(8, 150, 4))] + [(None, "t3 t5"), (20, None), (21, "nowhere"), (22, texts[7]), (22, "T1,t1;t2")]
    got = fp_tree.ranked_search(spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS no", "2 AS score"),
                                spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "3 AS terms"), block_terms=block_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    split = lambda t: [w.decode() for w in fp_tree.terms(t)]
    want = plain([(i, split(t)) for i, t in docs], [split(t) for _, t in items])
    want = [(i, r, d, s) for (i, _), found in zip(items, want) for r, (d, s) in enumerate(found, 1)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
