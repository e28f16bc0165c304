"""Language identification, words first with backoff to character n-grams.

A text's words (runs of letters, lower case) are scored one by one and summed over the text. A known word
scores its log frequency in each language. An unseen word is padded as ``^word$``; from each position the
longest known n-gram, of 4 letters down to 1, scores its log frequency among n-grams of its length, and the
word scores the mean over positions. The softmax of the sums gives the probability of each language.

Word counts are taken from every training text and n-gram counts from every distinct word of them, both as
grouped sums that are added up inside each task first. The model that tasks receive is bounded: at most
``max_words`` words and ``max_grams`` n-grams, those of the highest share in some language. The other words of a
text are counted per text and joined to the written word counts by word, so every learnt word is scored as known;
those that the counts do not hold are the unseen words.

Defined results: a text that is null or has no letter is ``und`` with score 0; rows with a null language
are not learnt from; ties go to the language first in order; with nothing learnt all texts are ``und``.
Input columns named like a result are replaced, others pass through.
"""

import math
import re
from collections import Counter, defaultdict
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm import common as C

LETTERS = re.compile(r"[^\W\d_]+")
N = 4
FLUSH = 200_000


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over all texts of ``docs`` (text, lang)."""

    def count(it):
        held: dict[str, Counter] = defaultdict(Counter)

        def flush():
            rows = [(lang, w, n) for lang, c in held.items() for w, n in c.items()]
            held.clear()
            return pd.DataFrame(rows, columns=["lang", "word", "n"])

        for pdf in it:
            for text, lang in zip(pdf.text, pdf.lang):
                held[lang].update(LETTERS.findall(text.lower()))
                if sum(map(len, held.values())) >= FLUSH:
                    yield flush()
        yield flush()

    rows = docs.where("text is not null and lang is not null").select("text", F.col("lang").cast("string").alias("lang"))
    return rows.mapInPandas(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def gram_counts(words: DataFrame) -> DataFrame:
    """(lang, gram, n): how many distinct words of a language hold the n-gram at how many places."""

    def count(it):
        for pdf in it:
            held: dict[str, Counter] = defaultdict(Counter)
            for lang, word in zip(pdf.lang, pdf.word):
                p = f"^{word}$"
                held[lang].update([p[i:i + n] for n in range(1, N + 1) for i in range(len(p) - n + 1)])
            yield pd.DataFrame([(lang, g, n) for lang, c in held.items() for g, n in c.items()], columns=["lang", "gram", "n"])

    return words.select("lang", "word").mapInPandas(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _top(counts: DataFrame, key: str, size, most: int):
    """Totals by (language, size of the key) and the ``most`` keys of the highest share in some language."""
    totals = {(r.lang, r.s): r.n for r in counts.groupBy("lang", size.alias("s")).agg(F.sum("n").alias("n")).collect()}
    if not totals:
        return totals, []
    table = F.create_map(*[F.lit(x) for (lang, s), n in totals.items() for x in (f"{s} {lang}", n)])
    share = F.col("n") / table[F.concat(size.cast("string"), F.lit(" "), F.col("lang"))]
    by_key = counts.groupBy(key).agg(F.max(share).alias("share"), F.collect_list("lang").alias("langs"), F.collect_list("n").alias("ns"))
    top = C.highest(by_key, F.col("share"), most).select(key, "langs", "ns").toArrow()
    return totals, sorted(zip(*(top.column(i).to_pylist() for i in range(3))))


class Model:
    def __init__(self, langs: list[str], words: dict, grams: dict, counts: DataFrame | None = None, totals: dict | None = None):
        """words, grams: key -> log frequency in each of ``langs``; words holds the head of ``counts`` (lang, word, n),
        ``totals`` the sum of n in each language."""
        self.langs, self.counts, self.totals = langs, counts, totals
        self.words, self.word_rows = {w: i + 1 for i, w in enumerate(words)}, self._rows(words)
        self.grams, self.gram_rows = {g: i + 1 for i, g in enumerate(grams)}, self._rows(grams)

    def __getstate__(self):
        return self.__dict__ | {"counts": None}  # a table stays with the driver

    def _rows(self, logs: dict) -> np.ndarray:
        """Row 0, of a key that is not there, adds nothing."""
        return np.array([[0.0] * len(self.langs), *logs.values()]).reshape(len(logs) + 1, len(self.langs))

    def head(self, text: str | None) -> tuple[np.ndarray | None, Counter]:
        """What the head's words of a text add (None: no word at all), and the counts of its other words."""
        words = LETTERS.findall(text.lower()) if text else []
        if not words or not self.langs:
            return None, Counter()
        total, other = np.zeros(len(self.langs)), Counter()
        for i in range(0, len(words), 10_000):
            part = words[i:i + 10_000]
            ids = list(map(self.words.get, part, repeat(0)))
            total += self.word_rows[ids].sum(0)
            j = -1
            for _ in range(ids.count(0)):
                j = ids.index(0, j + 1)
                other[part[j]] += 1
        return total, other

    def unseen(self, word: str) -> np.ndarray:
        """What an unseen word adds: the mean over its positions."""
        found = self.places(word)
        return self.gram_rows[found].sum(0) / len(found) if found else self.gram_rows[0]

    def predict(self, text: str | None) -> tuple[str, float]:
        """Of one text on the driver; the words outside the head are looked up in the counts."""
        total, other = self.head(text)
        if total is None:
            return "und", 0.0
        known = {r.word: np.array(r.logs) for r in self.known().where(F.col("word").isin(list(other))).collect()} if other else {}
        for word, k in other.items():
            total = total + k * (known[word] if word in known else self.unseen(word))
        best = int(total.argmax())
        return self.langs[best], float(1 / np.exp(total - total[best]).sum())

    def known(self) -> DataFrame:
        """(word, logs) of every counted word."""
        by_word = self.counts.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("lang", F.col("n").cast("double")))).alias("ns"))
        logs = [F.log((F.coalesce(F.col("ns")[F.lit(x)], F.lit(0.0)) + 0.5) / F.lit(float(self.totals.get(x, 0) + 1))) for x in self.langs]
        return by_word.select("word", F.array(*logs).alias("logs"))

    def places(self, word: str) -> list[int]:
        """The longest known n-gram from each position of an unseen word."""
        p, get = f"^{word}$", self.grams.get
        out = [get(p[i:i + N]) for i in range(len(p))]  # shorter by itself at the end of the word
        if None in out:
            for i, k in enumerate(out):
                n = min(N, len(p) - i) - 1
                while k is None and n:
                    k, n = get(p[i:i + n]), n - 1
                out[i] = k or 0
        return [k for k in out if k]


def fit(docs: DataFrame, max_words: int = 150_000, max_grams: int = 60_000) -> Model:
    """Learn from ``docs`` (text, lang)."""
    words = C.written(word_counts(docs), "words")
    word_total, top_words = _top(words, "word", F.lit(0), max_words)
    if not word_total:
        return Model([], {}, {})
    gram_total, top_grams = _top(C.written(gram_counts(words), "grams"), "gram", F.length("gram"), max_grams)
    langs = sorted({lang for lang, _ in word_total})

    def logs(rows, total, size):
        out = {}
        for key, found, ns in rows:
            n = dict(zip(found, ns))
            out[key] = [math.log((n.get(x, 0) + 0.5) / (total.get((x, size(key)), 0) + 1)) for x in langs]
        return out

    totals = {lang: n for (lang, _), n in word_total.items()}
    return Model(langs, logs(top_words, word_total, lambda _: 0), logs(top_grams, gram_total, len), words, totals)


def predict(docs: DataFrame, model: Model, without: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with lang_pred and score, in the order of ``docs``; columns ``without`` are not passed on."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in C.keep_columns(docs, ["lang_pred", "score"]) if c not in without]
    row = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(0))
    slim = docs.select(row.alias("_row"), F.col("text").cast("string").alias("text"))
    schema = slim.select("_row", F.lit(0).cast("long").alias("key"), F.lit(None).cast("array<double>").alias("head"),
                         F.lit(None).cast("array<struct<word:string,k:long>>").alias("tail")).schema

    def count(batches):
        from pyspark import TaskContext

        key, tail_type = TaskContext.get().partitionId() << 33, pa.list_(pa.struct([("word", pa.string()), ("k", pa.int64())]))
        for batch in (b.slice(i, 512) for b in batches for i in range(0, b.num_rows, 512)):
            found = [held.value.head(t.as_py()) for t in batch.column(1)]
            head = pa.array([None if total is None else total.tolist() for total, _ in found], pa.list_(pa.float64()))
            tail = pa.array([[{"word": w, "k": k} for w, k in other.items()] for _, other in found], tail_type)
            keys = pa.array(range(key, key + len(found)), pa.int64())
            key += len(found)
            yield pa.RecordBatch.from_arrays([batch.column(0), keys, head, tail], ["_row", "key", "head", "tail"])

    def guess(words: pd.Series) -> pd.Series:
        return pd.Series([held.value.unseen(w).tolist() for w in words], dtype=object)

    part = C.written(slim.mapInArrow(count, schema), "languages")
    columns = [F.col("_row")[c].alias(c) for c in keep]
    if not model.langs:
        return part.orderBy("key").select(*columns, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    tail = C.written(part.select("key", F.inline("tail")).join(model.known(), "word", "left"), "tail")
    unseen = tail.where("logs is null").groupBy("word").agg(F.first("word").alias("w")).select("word", F.pandas_udf(guess, "array<double>")("w").alias("logs"))
    rows = tail.where("logs is not null").select("key", "k", "logs").union(
        tail.where("logs is null").select("key", "word", "k").join(unseen, "word").select("key", "k", "logs"))
    langs = range(len(model.langs))
    more = rows.groupBy("key").agg(F.array(*[F.sum(F.col("logs")[i] * F.col("k")) for i in langs]).alias("more"))
    total = F.zip_with("head", F.coalesce("more", F.array(*[F.lit(0.0)] * len(langs))), lambda a, b: a + b)
    out = part.drop("tail").join(more, "key", "left").withColumn("total", total).withColumn("best", F.array_max("total"))
    names = F.array(*[F.lit(x) for x in model.langs])
    lang = F.when(F.col("head").isNull(), "und").otherwise(F.element_at(names, F.array_position("total", F.col("best")).cast("int")))
    score = F.when(F.col("head").isNull(), 0.0).otherwise(1 / F.aggregate("total", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("best"))))
    return out.orderBy("key").select(*columns, lang.alias("lang_pred"), score.alias("score"))


def op8_query(spark, sf_dir):
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = C.fold(F.col("doc_id"), 5) == 0
    model = fit(docs.where(~held_out).select("text", "lang"))
    return predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model, ("text",)).select("doc_id", "held_out", "lang_pred", "score")
