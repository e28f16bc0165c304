"""Operator 5: the word classes beyond the frequent tokens, against a token-by-token calculation."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import common, lbl_score
from tests.conftest import SF_SMALL

TEXTS = ["", None, "of", "zzzqqq never\x0bseen Ωμέγα 中", "of the and " * 300, "the zzzqqq of é of"]


@pytest.fixture(scope="module")
def model(spark):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    return d, lbl_score.fit(d.where(common.fold(F.col("doc_id"), 5) != 1), n_classes=100)


def known(model):
    return {bytes(r.token): r.n for r in model[2].collect()}


def test_classes_hold_all_tokens_with_their_mass(model):
    vocabulary, counts = model[1][0], known(model[1])
    total = vocabulary.total + 0.5 * (vocabulary.distinct + 1)
    alone = vocabulary.places - 1 - len(vocabulary.ending) - vocabulary.classes
    mass = Counter()
    for token, n in counts.items():
        place = vocabulary.find([token])[1][0] if token else 1
        if place >= vocabulary.classes:
            mass[place - vocabulary.classes] += n + 0.5
    assert len(vocabulary.finer_mass) == vocabulary.places - vocabulary.classes > 2 * math.isqrt(len(counts))
    for c, m in enumerate(vocabulary.finer_mass):
        unseen = 0 if c < alone else 0.5
        assert math.isclose(mass[c] + unseen, m * total, rel_tol=1e-9), c
    assert vocabulary.class_of("zz中".encode()) >= vocabulary.classes


def test_both_steps_are_normalised(model):
    finer = model[1][0].finer
    k = len(finer.noise)
    for w2, w1 in ((1, 1), (5, 200), (finer.places - 1, finer.places - 2)):
        p = np.exp(finer.log_p(np.full(k, w2), np.full(k, w1), np.arange(k)))
        assert math.isclose(p.sum(), 1, rel_tol=1e-5)


def brute(model, text):
    """Score of one text, a token at a time, in plain sums over all classes; other tokens' counts included."""
    (vocabulary, network, _), counts = model, known(model)
    p, q, n = network.p, vocabulary.finer.p, vocabulary.classes
    total = vocabulary.total + 0.5 * (vocabulary.distinct + 1)
    w2 = w1 = 1
    score = 0.0
    for token in lbl_score.tokens(text) + [b""]:
        place = 1 if not token else vocabulary.rank.get(token, 0)
        place = vocabulary.place[place] if place else vocabulary.class_of(token)
        top = [x if x < n else 0 for x in (w2, w1, place)]
        h = p["R"][top[1]] @ p["C1"] + p["R"][top[0]] @ p["C2"]
        e = np.exp((p["Q"] @ h + p["b"]).astype(float))
        score += math.log10(e[top[2]] / e.sum())
        if place >= n:
            size, c = vocabulary.finer.size, place - n
            h, g = q["R1"][w1] + q["R2"][w2], c // size
            e = np.exp((q["S"] @ h + q["e"]).astype(float))
            score += math.log10(e[g] / e.sum())
            e = np.exp((q["Q"][g * size:(g + 1) * size] @ h + q["b"][g * size:(g + 1) * size]).astype(float))
            score += math.log10(e[c - g * size] / e.sum())
            score += math.log10((counts.get(token, 0) + 0.5) / total / vocabulary.finer_mass[c])
        w2, w1 = w1, place
    return score


def test_scores_equal_token_by_token(spark, model):
    d, fitted = model
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(r.doc_id + 100, r.text) for r in d.where("length(text) < 4000").orderBy("doc_id").limit(15).collect()]
    found = lbl_score.score(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), fitted).collect()
    texts = dict(rows)
    assert len(found) == len(rows)
    for r in found:
        assert math.isclose(r.score, brute(fitted, texts[r.doc_id]), rel_tol=1e-4), r


def test_classes_tell_held_out_tokens_apart(model):
    """Without the word classes' choice, other tokens would get their base share of the rest; it must gain."""
    d, (vocabulary, network, counts) = model
    scorer = lbl_score.Scorer(vocabulary, network.noise, network.dim, network.flat())
    texts = [r.text for r in d.where(common.fold(F.col("doc_id"), 5) == 1).where("text is not null").collect()]
    full = sum(x[3] for x in scorer.many(texts))
    finer, gain, n = vocabulary.finer, 0.0, 0
    for t in texts:
        place = np.concatenate([[1, 1], vocabulary.find(lbl_score.tokens(t))[1]])
        at = np.flatnonzero(place[2:] >= vocabulary.classes) + 2
        c = place[at] - vocabulary.classes
        gain += (finer.log_p(place[at - 2], place[at - 1], c) / math.log(10) - scorer.share[c]).sum()
        n += len(at)
    assert n > 1000 and gain > 0.02 * n and full < 0


def test_parameters_grow_with_the_vocabulary(spark):
    def classes(n):
        d = spark.range(n).select(F.concat(F.lit("w"), F.col("id"), F.lit("x y"), F.col("id") % 7).alias("text"))
        return len(lbl_score.fit(d, n_classes=10)[0].finer_mass)

    small, large = classes(400), classes(6400)
    assert large > 3 * small


def test_texts_at_once_are_found_as_word_by_word(model):
    import pyarrow as pa

    vocabulary = model[1][0]
    texts = [None, " A\x0bb \x1c c\x85d E\n\n", "", "of the zzzqqq OF", "  ", "É İ of\r\f\x00 \x1f中"]
    for part in (pa.array(texts, pa.string()), pa.array(texts, pa.string()).slice(1, 4)):
        words = [lbl_score.tokens(t) for t in part.to_pylist()]
        ranks, places, starts, outside, where = vocabulary.find_all(part)
        want = [vocabulary.find(w) for w in words]
        assert starts.tolist() == np.cumsum([0] + [len(w) + 1 for w in words])[:-1].tolist()
        assert ranks.tolist() == np.concatenate([r for r, _ in want]).tolist() and places.tolist() == np.concatenate([p for _, p in want]).tolist()
        assert outside == [w for ws in words for w in ws if w not in vocabulary.rank] and where.tolist() == np.flatnonzero(ranks == 0).tolist()
        assert sum((x.to_pylist() for x in lbl_score.pieces(part, 4)), []) == part.to_pylist()


def test_all_contexts_are_summed_without_an_exponential_each(model):
    """Every context's sum over the classes is there before a text is scored."""
    vocabulary, network, _ = model[1]
    scorer = lbl_score.Scorer(vocabulary, network.noise, network.dim, network.flat())
    k = scorer.classes
    for w1, w2 in ((0, 0), (1, 1), (k - 1, 5)):
        assert math.isclose(scorer.log_z[w1 * k + w2], np.log(np.exp(scorer.a1[w1] + scorer.a2[w2]).sum()), rel_tol=1e-12, abs_tol=1e-12)
