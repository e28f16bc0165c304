"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, trained from document labels.

A document is a bag of sentences (split at . ! ? and line breaks). A sentence's probability is
sigmoid(bias + sum of the weights of its distinct words); a document's is 1 - product(1 - sentence). A
word's weight is the sum over its features: the word and its beginnings of 3 to 6 letters, so that forms
never seen before still count. Only document labels are known; the gradient of the noisy-or likelihood
gives each sentence its part of the blame. ``offending`` lists the sentences at or above ``flag_at``.

Fitting uses a bounded sample: at most ``per_class`` labelled documents of each label, chosen by a hash of the
id, their whole texts read by a join with that bounded list of ids. Features are chosen by their
document counts in the sample, at most ``max_features``. Scoring covers every text and only reads text.

Defined results: null, empty and wordless texts count as one sentence without words (score: the bias
alone); rows with a null label are not learnt from; a document with several label rows counts as toxic
if one says so; without both labels in the sample the model has no weights and every score is the share of
toxic ones, or 0. Input columns named like a result are replaced, others pass through.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm import common as C

SENTENCE = re.compile(r"[^.!?\n]+")
LETTERS = re.compile(r"[^\W\d_]+")
PREFIXES = (3, 4, 5, 6)
CACHE_WORDS = 100_000
RESULT = "struct<score:double,offending:array<struct<start:int,length:int,score:double>>>"


def features(word: str) -> list[str]:
    return ["=" + word] + [word[:n] for n in PREFIXES if len(word) > n]


@dataclass
class Model:
    bias: float = -20.0
    weights: dict[str, float] = field(default_factory=dict)
    flag_at: float = 0.3

    def scorer(self):
        """text -> (score, offending sentences)."""
        cache: dict[str, float] = C.worker_cache(("toxicity", self.bias, len(self.weights)), dict)

        def weight(word: str) -> float:
            w = cache.get(word)
            if w is None:
                if len(cache) >= CACHE_WORDS:
                    cache.clear()
                w = cache[word] = sum(self.weights.get(f, 0.0) for f in features(word))
            return w

        rest = -math.log1p(math.exp(self.bias))  # log(1 - p) of a sentence without known words

        def score(text: str | None):
            text = text or ""
            heavy = {w for w in set(LETTERS.findall(text.lower())) if weight(w)}
            log_clean, offending = 0.0, []
            if heavy:
                for m in SENTENCE.finditer(text):
                    found = heavy.intersection(LETTERS.findall(m.group().lower()))
                    if not found:
                        log_clean += rest
                        continue
                    s = self.bias + math.fsum(weight(w) for w in sorted(found))
                    log_clean -= np.logaddexp(0.0, s)
                    if (p := 1 / (1 + math.exp(-min(max(s, -500), 500)))) >= self.flag_at:
                        offending.append((m.start(), m.end() - m.start(), p))
            else:
                log_clean = rest * max(1, sum(1 for _ in SENTENCE.finditer(text)))
            return min(1.0, max(0.0, -math.expm1(log_clean))), offending

        return score


def _sample(labels: DataFrame, per_class: int) -> DataFrame:
    """(doc_id, toxic) of at most ``per_class`` documents of each label, by hash of the id."""
    one = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    counts = {r.toxic: r["count"] for r in one.groupBy("toxic").count().collect()}  # two rows
    h, out = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)), None
    for toxic, n in sorted(counts.items()):
        part = one.where((F.col("toxic") == toxic) & (h < int((1 << 40) * min(1.0, 1.1 * per_class / n)))).orderBy(h, "doc_id").limit(per_class)
        out = part if out is None else out.union(part)
    return one.limit(0) if out is None else out


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 8_000, max_features: int = 5_000, steps: int = 300) -> Model:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    wanted = _sample(labels, per_class)  # at most 2 * per_class rows of 12 bytes
    bags = C.written(docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id").select("toxic", "text"), "toxicity")
    sizes = {r.toxic: r["count"] for r in bags.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        share = n_toxic / max(1, n_toxic + n_clean)
        return Model(bias=30.0 if share else -30.0)

    def document_counts(batches):
        for pdf in batches:
            counts = (Counter(), Counter())
            for toxic, text in zip(pdf.toxic, pdf.text):
                words = set(LETTERS.findall((text or "").lower()))
                counts[toxic].update({f for w in words for f in features(w)})
            keys = sorted(counts[1])  # a feature that no toxic document has is never chosen
            yield pd.DataFrame({"f": keys, "t": [counts[1][k] for k in keys], "c": [counts[0][k] for k in keys]})
            keys = sorted(k for k in counts[0] if k not in counts[1])
            yield pd.DataFrame({"f": keys, "t": [0] * len(keys), "c": [counts[0][k] for k in keys]})

    df = bags.mapInPandas(document_counts, "f string, t long, c long").groupBy("f").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    odds = F.log((F.col("t") + 0.5) / (n_toxic + 1)) - F.log((F.col("c") + 2) / (n_clean + 1))
    df = C.written(df.select("f", "t", odds.alias("o")).where("t >= 4 and o > 1.5"), "features")
    chosen = C.highest(df, F.col("t") * F.col("o"), max_features).orderBy("f").collect()
    ids = {r.f: i for i, r in enumerate(chosen)}

    def sentences(batches):
        cache: dict[str, list[int]] = {}
        for pdf in batches:
            rows = []
            for toxic, text in zip(pdf.toxic, pdf.text):
                empty, at, known = 0, [], []
                for m in SENTENCE.finditer(text or ""):
                    found = set()
                    for w in set(LETTERS.findall(m.group().lower())):
                        if (x := cache.get(w)) is None:
                            if len(cache) >= CACHE_WORDS:
                                cache.clear()
                            x = cache[w] = [ids[f] for f in features(w) if f in ids]
                        found.update([(w, i) for i in x])
                    if found:
                        known += [i for _, i in sorted(found)]
                        at += [len(found)]
                    else:
                        empty += 1
                rows.append((int(toxic), max(empty, 0 if at else 1), at, known))
            yield pd.DataFrame(rows, columns=["toxic", "empty", "n", "ids"])

    rows = bags.mapInPandas(sentences, "toxic int, empty int, n array<int>, ids array<int>").toPandas()
    bias, w = _train(rows, np.array([0.3 * r.o for r in chosen]), steps)
    return Model(bias, {f: float(w[i]) for f, i in ids.items() if abs(w[i]) > 1e-4})


def _train(rows: pd.DataFrame, start: np.ndarray, steps: int) -> tuple[float, np.ndarray]:
    """Adam on the noisy-or likelihood with a pull to ``start``; rows in a fixed order, so reruns agree."""
    n_features = len(start)
    rows = rows.assign(k=[(len(i), tuple(i)) for i in rows.ids]).sort_values(["toxic", "empty", "k"])
    y, empty = rows["toxic"].to_numpy(float), rows["empty"].to_numpy(float)
    n_sent = np.array([len(x) for x in rows.n])
    doc = np.repeat(np.arange(len(rows)), n_sent)
    per = np.concatenate([np.asarray(x, int) for x in rows.n] or [np.zeros(0, int)]).astype(int)
    sent = np.repeat(np.arange(len(per)), per)
    feat = np.concatenate([np.asarray(x, int) for x in rows.ids] or [np.zeros(0, int)]).astype(int)
    theta = np.concatenate([[-5.0], start])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        b, w = theta[0], theta[1:]
        s = b + np.bincount(sent, w[feat], len(per))
        p, p0 = 1 / (1 + np.exp(-np.clip(s, -500, 500))), 1 / (1 + math.exp(-b))
        log_clean = -np.bincount(doc, np.logaddexp(0, s), len(rows)) - empty * np.logaddexp(0, b)
        toxic = np.maximum(-np.expm1(log_clean), 1e-9)
        blame = np.where(y > 0, np.exp(log_clean) / toxic, -1.0)  # d log-likelihood / d sentence score, over its p
        g_s = p * blame[doc]
        g = np.concatenate([[g_s.sum() + (p0 * empty * blame).sum()], np.bincount(feat, g_s[sent], n_features)]) / len(rows)
        g[1:] -= 1e-4 * (w - start)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta + 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return float(theta[0]), theta[1:]


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``docs`` with score, predicted and offending (start, length and probability of sentences)."""

    def judged(it: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        f = model.scorer()
        for texts in it:
            found = [f(t) for t in texts]
            yield pd.DataFrame({"score": [x[0] for x in found],
                                "offending": [[{"start": a, "length": n, "score": p} for a, n, p in x[1]] for x in found]})

    judge = F.pandas_udf(judged, RESULT)
    keep = [F.col(f"`{c}`") for c in C.keep_columns(docs, ["score", "predicted", "offending"])]
    (name,) = C.fresh(docs.columns, "_judged")
    out = docs.withColumn(name, judge(F.col("text").cast("string")))
    return out.select(*keep, F.col(name)["score"].alias("score"), (F.col(name)["score"] >= threshold).cast("int").alias("predicted"),
                      F.col(name)["offending"].alias("offending"))


def fit_on_folds(spark, sf_dir, docs: DataFrame) -> Model:
    """The model of the registered queries: learnt from rows whose crc32(doc_id) mod 4 is not 2."""
    labels = C.read(spark, sf_dir, "labels").select("doc_id", "toxic").where(C.fold(F.col("doc_id"), 4) != 2)
    return fit(docs.where(C.fold(F.col("doc_id"), 4) != 2), labels)


def op10_query(spark, sf_dir):
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, fit_on_folds(spark, sf_dir, docs)).select(
        "doc_id", (C.fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")
